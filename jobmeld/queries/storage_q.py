"""Sources, sinks and schema operators."""

from __future__ import annotations

from pyspark.sql import Observation, functions as F, types as T

from jobmeld.operators import dedupe
from jobmeld.queries.base import query, store, table
from jobmeld.session import scratch_path
from jobmeld.sources import jsonl, schema

EVENT_COLS = "event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value, props"
EVENT_SCHEMA = "event_id bigint, ts string, user_id bigint, event_type string, value double, props string"


def _events(spark, sf):
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("string"))


def _landed(spark, sf, label):
    path = scratch_path(spark, label)
    jsonl.write_jsonl(_events(spark, sf), path)
    return path


@query("src1_jsonl_ingest", f"SELECT {EVENT_COLS} FROM events")
def _(spark, sf):
    df = jsonl.read_jsonl(spark, _landed(spark, sf, "src1"), EVENT_SCHEMA)
    return df.filter(F.col(jsonl.CORRUPT).isNull()).drop(jsonl.CORRUPT)


@query("src2_jsonl_inferred", f"SELECT {EVENT_COLS} FROM events")
def _(spark, sf):
    return jsonl.read_jsonl(spark, _landed(spark, sf, "src2"))


@query("src3_read_table", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def _(spark, sf):
    st = store(spark, "src3")
    st.write(table(spark, sf, "orders"), "raw/orders")
    return st.read("raw/orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("src4_known_ids", "SELECT DISTINCT o_custkey AS known_id FROM orders")
def _(spark, sf):
    st = store(spark, "src4")
    st.write(table(spark, sf, "orders"), "raw/orders")
    return dedupe.distinct_values(st.read("raw/orders", ["o_custkey"]), "o_custkey").select(
        F.col("o_custkey").alias("known_id")
    )


_TABLES = ["customer", "events", "orders", "part", "supplier"]


@query(
    "src5_table_exists",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, true AS found, count(*) AS row_count FROM {t}" for t in _TABLES)
    + " UNION ALL SELECT 'absent', false, 0",
)
def _(spark, sf):
    st = store(spark, "src5")
    for t in _TABLES:
        st.write(table(spark, sf, t), t)
    parts = []
    for t in [*_TABLES, "absent"]:
        there = st.exists(t)
        rows = st.read(t) if there else spark.range(0)
        parts.append(
            rows.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(t).alias("table_name"), F.lit(there).alias("found"), "row_count"
            )
        )
    return schema.consolidate(parts)


@query(
    "src7_sql_view",
    "SELECT o_orderstatus, count(*) AS n, min(o_orderkey) AS first_key FROM orders GROUP BY o_orderstatus",
)
def _(spark, sf):
    st = store(spark, "src7")
    st.write(table(spark, sf, "orders"), "master/recruit")
    view = st.register("master/recruit", "jobmeld_src7")
    return spark.sql(f"SELECT o_orderstatus, count(*) AS n, min(o_orderkey) AS first_key FROM {view} GROUP BY o_orderstatus")


@query("snk1_overwrite", "SELECT o_orderkey, lower(o_orderpriority) AS o_orderpriority FROM orders")
def _(spark, sf):
    st = store(spark, "snk1")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    st.write(orders, "raw/jobs")
    return st.write(st.read("raw/jobs").withColumn("o_orderpriority", F.lower("o_orderpriority")), "raw/jobs")


@query("snk2_schema_replace", "SELECT o_orderkey, o_orderstatus = 'F' AS closed FROM orders")
def _(spark, sf):
    st = store(spark, "snk2")
    st.write(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "master/recruit")
    replaced = st.read("master/recruit").select("o_orderkey", (F.col("o_orderstatus") == "F").alias("closed"))
    return st.write(replaced, "master/recruit")


@query("snk3_first_write", "SELECT c_custkey AS company_id, 1 AS refused FROM customer")
def _(spark, sf):
    st = store(spark, "snk3")
    idmap = table(spark, sf, "customer").select(F.col("c_custkey").alias("company_id"))
    first = st.create(idmap, "uuid/a")
    try:
        st.create(idmap, "uuid/a")
        refused = 0
    except FileExistsError:
        refused = 1
    return first.withColumn("refused", F.lit(refused))


@query(
    "snk4_dated_landing",
    """SELECT event_id, event_type, strftime(ts, '%Y') AS "year", strftime(ts, '%m') AS "month",
       strftime(ts, '%d') AS "day", 'feed' AS spider FROM events""",
)
def _(spark, sf):
    root = scratch_path(spark, "snk4")
    jsonl.land_dated(table(spark, sf, "events"), root, "feed", F.col("ts"))
    back = "event_id bigint, event_type string, year string, month string, day string, spider string"
    return spark.read.schema(back).json(root)


@query("snk5_feed_export", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def _(spark, sf):
    path = scratch_path(spark, "snk5")
    jsonl.write_jsonl(table(spark, sf, "customer"), path)
    return jsonl.read_jsonl(spark, path).select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


@query("snk6_output_check", "SELECT count(*) AS row_count, 1 AS missing_refused FROM orders")
def _(spark, sf):
    path = scratch_path(spark, "snk6")
    jsonl.write_jsonl(table(spark, sf, "orders").select("o_orderkey"), path)
    try:
        jsonl.require_output(spark, path + "-absent")
        refused = 0
    except jsonl.MissingOutput:
        refused = 1
    return jsonl.require_output(spark, path).agg(
        F.count(F.lit(1)).alias("row_count"), F.lit(refused).alias("missing_refused")
    )


@query(
    "sc1_create_if_absent",
    "SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS note FROM customer",
)
def _(spark, sf):
    st = store(spark, "sc1")
    customer = table(spark, sf, "customer").select("c_custkey", "c_name")
    st.create_if_absent(schema.empty_like(spark, customer.schema, {"note": T.StringType()}), "t")
    return schema.consolidate([st.read("t"), customer])


@query(
    "sc2_evolve",
    """SELECT c_custkey, c_name, CAST(NULL AS DOUBLE) AS s_acctbal FROM customer""",
)
def _(spark, sf):
    dest = table(spark, sf, "customer").select("c_custkey", "c_name")
    src = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("c_custkey"), "s_acctbal")
    return schema.evolve(dest, src)


@query(
    "sc3_backfill",
    "SELECT s_suppkey AS c_custkey, CAST(NULL AS VARCHAR) AS c_mktsegment, s_acctbal AS c_acctbal FROM supplier",
)
def _(spark, sf):
    src = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"))
    return schema.backfill(src, table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"))


@query(
    "sc3_cast_counts",
    """SELECT unnest(['min_salary', 'max_salary', 'posted_at']) AS column_name, unnest([
         count(*) FILTER (WHERE o_orderkey % 5 = 0), count(*) FILTER (WHERE o_orderkey % 4 = 0 AND o_orderkey % 3 <> 0),
         count(*) FILTER (WHERE o_orderkey % 2 = 0)]) AS lost FROM orders""",
)
def _(spark, sf):
    lost = Observation()
    jobs = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS id", "IF(o_orderkey % 5 = 0, 'Thỏa thuận', CAST(o_custkey AS STRING)) AS min_salary",
        "CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN 1e20 ELSE 1.5D END AS max_salary",
        "IF(o_orderkey % 2 = 0, 'soon', CAST(o_orderdate AS STRING)) AS posted_at",
    )
    wanted = T.StructType.fromDDL("id bigint, min_salary decimal(18,2), max_salary decimal(18,2), posted_at timestamp, skills array<string>")
    schema.conform(jobs, wanted, lost).write.format("noop").mode("overwrite").save()
    counts = [(c, int(lost.get[c])) for c in ("min_salary", "max_salary", "posted_at")]
    return spark.createDataFrame(counts, "column_name string, lost bigint")


@query("sc4_all_nullable", "SELECT p_partkey, p_name, 'none' AS required FROM part")
def _(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name").withColumn("size", F.lit(1))
    free = spark.createDataFrame([], schema.all_nullable(part.schema)).unionByName(part)
    required = ",".join(f.name for f in free.schema.fields if not f.nullable) or "none"
    return free.select("p_partkey", "p_name", F.lit(required).alias("required"))


@query(
    "sc5_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS column_type, count(*) AS row_count, count({c}) AS filled_count FROM customer"
        for c, t in [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string")]
    ),
)
def _(spark, sf):
    return schema.profile(table(spark, sf, "customer"))


@query("agg4_row_count", "SELECT count(*) AS row_count FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("row_count"))


@query("lim1_preview", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 20")
def _(spark, sf):
    return schema.preview(table(spark, sf, "orders"), 20, ["o_totalprice", "o_orderkey"]).select("o_orderkey", "o_custkey")


@query(
    "set2_consolidate",
    """SELECT CAST(c_custkey AS VARCHAR) AS company_id, c_name AS company_name, c_mktsegment AS industry,
         CAST(NULL AS DOUBLE) AS balance, 'a' AS media_code FROM customer
       UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL, s_acctbal, 'b' FROM supplier""",
)
def _(spark, sf):
    a = table(spark, sf, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS company_id", "c_name AS company_name", "c_mktsegment AS industry", "'a' AS media_code"
    )
    b = table(spark, sf, "supplier").selectExpr(
        "CAST(s_suppkey AS STRING) AS company_id", "s_name AS company_name", "s_acctbal AS balance", "'b' AS media_code"
    )
    return schema.consolidate([a, b])
