"""Every registered query against its SQL, on the smallest tables."""

import pytest

from compare import connect, spark_rows, sql_rows
from jobmeld.queries.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for banned in ("NestedLoopJoin", "CartesianProduct", "BatchEvalPython", "Window"):
        assert banned not in plan
    assert spark_rows(df) == sql_rows(con, SQL[name])


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["company_id", "corporate_number", "identify_method", "updated_at", "created_at"]
    assert set(QUERIES) <= set(e.queries()) and set(SQL) <= set(e.oracle_sql()) <= set(e.queries())
