"""Golden records and upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobmeld.operators import survivorship, upsert
from jobmeld.queries.base import AS_OF, LATER, query, store, table, when

# ---- survivorship ---------------------------------------------------------------------------------
_D = """dst AS (SELECT c_custkey AS corporate_number, c_name AS company_name,
    CASE c_custkey % 3 WHEN 0 THEN 20000 WHEN 1 THEN 28000 ELSE 30000 END AS company_name_quality,
    CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS industry,
    CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 24000 ELSE 30000 END AS industry_quality,
    '2024-01-01 00:00:00' AS updated_at, '2024-01-01 00:00:00' AS created_at FROM customer)"""
_S = """src AS (SELECT s_suppkey * 20 AS corporate_number, s_name AS company_name, 28000 AS company_name_quality,
    CASE s_suppkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'steel' END AS industry,
    CASE WHEN s_suppkey % 4 < 2 THEN 0 ELSE 28000 END AS industry_quality,
    CASE WHEN s_suppkey % 2 = 0 THEN 'HN' END AS province,
    CASE WHEN s_suppkey % 2 = 0 THEN 28000 ELSE 0 END AS province_quality,
    '2024-02-01 00:00:00' AS updated_at, '2024-02-01 00:00:00' AS created_at FROM supplier)"""


def _moves(c: str, old: str | None) -> str:
    ok = f"(s.{c} IS NOT NULL AND s.{c} <> '')"
    return ok if old is None else f"{ok} AND (d.{c}_quality IS NULL OR d.{c}_quality <= s.{c}_quality)"


def _sql_survive() -> str:
    cols, moved = [], []
    for c, old in (("company_name", "d"), ("industry", "d"), ("province", None)):
        move = _moves(c, old)
        moved.append(f"coalesce({move}, false)")
        for x in (c, f"{c}_quality"):
            keep = f"d.{x}" if old else "NULL"
            cols.append(f"CASE WHEN d.corporate_number IS NULL OR ({move}) THEN s.{x} ELSE {keep} END AS {x}")
    return f"""WITH {_D}, {_S} SELECT coalesce(d.corporate_number, s.corporate_number) AS corporate_number, {', '.join(cols)},
      CASE WHEN d.corporate_number IS NULL OR {' OR '.join(moved)} THEN s.updated_at ELSE d.updated_at END AS updated_at,
      coalesce(d.created_at, s.created_at) AS created_at
      FROM dst d FULL JOIN src s ON d.corporate_number = s.corporate_number"""


def _dest(spark, sf):
    return table(spark, sf, "customer").selectExpr(
        "c_custkey AS corporate_number",
        "c_name AS company_name",
        "CASE c_custkey % 3 WHEN 0 THEN 20000 WHEN 1 THEN 28000 ELSE 30000 END AS company_name_quality",
        f"CAST('{AS_OF}' AS TIMESTAMP) AS company_name_updated_at",
        "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS industry",
        "CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 24000 ELSE 30000 END AS industry_quality",
        f"CAST('{AS_OF}' AS TIMESTAMP) AS industry_updated_at",
        f"CAST('{AS_OF}' AS TIMESTAMP) AS updated_at",
        f"CAST('{AS_OF}' AS TIMESTAMP) AS created_at",
    )


def _src(spark, sf):
    src = table(spark, sf, "supplier").selectExpr(
        "s_suppkey * 20 AS corporate_number",
        "s_name AS name",
        "CASE s_suppkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'steel' END AS industry",
        "CASE WHEN s_suppkey % 2 = 0 THEN 'HN' END AS province",
    )
    return survivorship.scored(
        src, [("name", "company_name"), ("industry", "industry"), ("province", "province")], 28000, when(LATER)
    )


def _survived(spark, sf):
    return _plain_times(survivorship.survive(_dest(spark, sf), _src(spark, sf)))


def _plain_times(merged):
    return merged.select(
        "corporate_number", "company_name", "company_name_quality", "industry", "industry_quality", "province", "province_quality",
        F.col("updated_at").cast("string").alias("updated_at"), F.col("created_at").cast("string").alias("created_at"),
    )


@query("ups1_survivorship", _sql_survive())
def _(spark, sf):
    return _survived(spark, sf)


@query("jn6_merge_join", f"WITH m AS ({_sql_survive()}) SELECT corporate_number, industry, created_at FROM m")
def _(spark, sf):
    return _survived(spark, sf).select("corporate_number", "industry", "created_at")


@query("ups1_touched_buckets", _sql_survive())
def _(spark, sf):
    tables = store(spark, "golden")
    tables.buckets = 256
    tables.write_buckets(_dest(spark, sf), "master", ["corporate_number"])
    return _plain_times(tables.merge("master", _src(spark, sf), ["corporate_number"], survivorship.survive))


@query("ups2_quality", f"WITH {_S} SELECT corporate_number, company_name_quality, industry_quality, province_quality FROM src")
def _(spark, sf):
    return _src(spark, sf).select("corporate_number", "company_name_quality", "industry_quality", "province_quality")


# ---- coalescing upsert ----------------------------------------------------------------------------
# the table holds all orders; the batch is the line items, one row per order and line, with a
# second media code so that some rows update, some insert and the rest stay
_JOBS = f"""jd AS (SELECT CAST(o_orderkey AS VARCHAR) AS media_internal_id, 'topcv' AS media_code,
    o_orderpriority AS title, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderstatus END AS benefits,
    CAST(o_custkey AS VARCHAR) AS _ingest_id, '{AS_OF}' AS created_at, '{AS_OF}' AS updated_at FROM orders)"""
_BATCH = f"""js AS (SELECT CAST(l_orderkey AS VARCHAR) AS media_internal_id,
    CASE WHEN l_linenumber <= 4 THEN 'topcv' ELSE 'vieclam24h' END AS media_code,
    CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_returnflag END AS title, l_linestatus AS benefits,
    CAST(l_suppkey AS VARCHAR) AS _ingest_id, concat('p', l_partkey) AS skills,
    '{LATER}' AS created_at, '{LATER}' AS updated_at FROM lineitem)"""
# a key that the batch repeats: each column by itself, its largest value as the last, its smallest as the first
_ONE = """j1 AS (SELECT media_internal_id, media_code, max(title) AS title, max(benefits) AS benefits, min(_ingest_id) AS _ingest_id,
    max(skills) AS skills, min(created_at) AS created_at, max(updated_at) AS updated_at FROM js GROUP BY media_internal_id, media_code)"""


def _sql_upsert(where: str = "") -> str:
    return f"""WITH {_JOBS}, {_BATCH.replace(" FROM lineitem", " FROM lineitem " + where)}, {_ONE}
        SELECT coalesce(s.media_internal_id, d.media_internal_id) AS media_internal_id,
          coalesce(s.media_code, d.media_code) AS media_code, coalesce(s.title, d.title) AS title,
          coalesce(s.benefits, d.benefits) AS benefits, coalesce(d._ingest_id, s._ingest_id) AS _ingest_id, s.skills AS skills,
          coalesce(d.created_at, s.created_at) AS created_at, coalesce(s.updated_at, d.updated_at) AS updated_at
        FROM jd d FULL JOIN j1 s ON d.media_internal_id = s.media_internal_id AND d.media_code = s.media_code"""


def _upserted(merged):
    return merged.select(
        "media_internal_id", "media_code", "title", "benefits", "_ingest_id", "skills",
        F.col("created_at").cast("string").alias("created_at"), F.col("updated_at").cast("string").alias("updated_at"),
    )


@query("ups3_coalesce", _sql_upsert())
def _(spark, sf):
    return _upserted(upsert.upsert(_job_table(spark, sf), _job_batch(spark, sf)))


# a batch of one supplier's lines, as a source sends a few jobs of a large table; all of the table is the result
@query("ups3_touched_buckets", _sql_upsert("WHERE l_suppkey = 1"))
def _(spark, sf):
    tables, keys = store(spark, "jobs"), list(upsert.JOB_KEYS)
    tables.buckets = 256
    tables.write_buckets(_job_table(spark, sf), "jobs", keys)
    return _upserted(tables.merge("jobs", _job_batch(spark, sf, "l_suppkey = 1"), keys, upsert.upsert_stored))


# titles and benefits of a line come as two records of one key, each without the other's value
_HALVES = """h AS (SELECT media_internal_id, media_code, title, CAST(NULL AS {s}) AS benefits, nth FROM l
    UNION ALL SELECT media_internal_id, media_code, NULL, benefits, nth FROM l)"""


@query(
    "ups3_repeated_key",
    f"""WITH {_JOBS}, l AS (SELECT CAST(l_orderkey AS VARCHAR) AS media_internal_id, 'topcv' AS media_code, l_linenumber AS nth,
            CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_returnflag END AS title, CASE WHEN l_partkey % 2 = 0 THEN l_linestatus END AS benefits FROM lineitem),
          {_HALVES.format(s='VARCHAR')},
          s AS (SELECT media_internal_id, media_code, (max(struct_pack(n := nth, v := title)) FILTER (WHERE title IS NOT NULL)).v AS title,
            (max(struct_pack(n := nth, v := benefits)) FILTER (WHERE benefits IS NOT NULL)).v AS benefits FROM h GROUP BY media_internal_id, media_code)
        SELECT coalesce(s.media_internal_id, d.media_internal_id) AS media_internal_id, coalesce(s.title, d.title) AS title,
          coalesce(s.benefits, d.benefits) AS benefits FROM jd d FULL JOIN s ON d.media_internal_id = s.media_internal_id""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").selectExpr(
        "CAST(l_orderkey AS STRING) AS media_internal_id", "'topcv' AS media_code", "l_linenumber AS nth",
        "CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_returnflag END AS title", "CASE WHEN l_partkey % 2 = 0 THEN l_linestatus END AS benefits",
    )
    none = F.lit(None).cast("string")
    halves = lines.withColumn("benefits", none).unionByName(lines.withColumn("title", none))
    return upsert.upsert(_job_table(spark, sf), halves, order="nth").select("media_internal_id", "title", "benefits")


def _job_table(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS media_internal_id", "'topcv' AS media_code", "o_orderpriority AS title",
        "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderstatus END AS benefits", "CAST(o_custkey AS STRING) AS _ingest_id",
        f"CAST('{AS_OF}' AS TIMESTAMP) AS created_at", f"CAST('{AS_OF}' AS TIMESTAMP) AS updated_at",
    )


def _job_batch(spark, sf, where="true"):
    return table(spark, sf, "lineitem").filter(where).selectExpr(
        "CAST(l_orderkey AS STRING) AS media_internal_id",
        "CASE WHEN l_linenumber <= 4 THEN 'topcv' ELSE 'vieclam24h' END AS media_code",
        "CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_returnflag END AS title", "l_linestatus AS benefits",
        "CAST(l_suppkey AS STRING) AS _ingest_id", "concat('p', l_partkey) AS skills",
        f"CAST('{LATER}' AS TIMESTAMP) AS created_at", f"CAST('{LATER}' AS TIMESTAMP) AS updated_at",
    )


@query(
    "jn7_composite_merge",
    f"""WITH {_JOBS}, {_BATCH}, d AS (SELECT media_internal_id, media_code, true AS t FROM jd),
          s AS (SELECT DISTINCT media_internal_id, media_code, true AS b FROM js)
        SELECT media_internal_id, media_code, coalesce(t, false) AS in_table, coalesce(b, false) AS in_batch
        FROM d FULL JOIN s USING (media_internal_id, media_code)""",
)
def _(spark, sf):
    keys = ["media_internal_id", "media_code"]
    dest = _job_table(spark, sf).select(*keys, F.lit(True).alias("in_table"))
    src = _job_batch(spark, sf).select(*keys, F.lit(True).alias("in_batch"))
    merged = upsert.upsert(dest, src, keys)
    return merged.select(*keys, F.coalesce("in_table", F.lit(False)).alias("in_table"), F.coalesce("in_batch", F.lit(False)).alias("in_batch"))


# ---- several sources, several batches ---------------------------------------------------------------
@query(
    "set2_fold_feeds",
    f"""WITH a AS (SELECT c_custkey AS k, c_name AS name, CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE c_mktsegment END AS industry FROM customer),
          b AS (SELECT s_suppkey * 20 AS k, s_name AS name, CASE s_suppkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'steel' END AS industry FROM supplier)
        SELECT coalesce(a.k, b.k) AS corporate_number, coalesce(b.name, a.name) AS company_name,
          CASE WHEN coalesce(b.industry, '') <> '' THEN b.industry WHEN a.k IS NOT NULL THEN a.industry ELSE b.industry END AS industry,
          CASE WHEN coalesce(b.industry, '') <> '' OR coalesce(a.industry, '') <> '' THEN 28000 ELSE 0 END AS industry_quality
        FROM a FULL JOIN b ON a.k = b.k""",
)
def _(spark, sf):
    a = table(spark, sf, "customer").selectExpr(
        "c_custkey AS corporate_number", "c_name AS name", "CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE c_mktsegment END AS industry"
    )
    b = table(spark, sf, "supplier").selectExpr(
        "s_suppkey * 20 AS corporate_number", "s_name AS name", "CASE s_suppkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'steel' END AS industry"
    )
    columns = [("name", "company_name"), ("industry", "industry")]
    feeds = [survivorship.scored(df, columns, 28000, when()) for df in (a, b)]
    return survivorship.fold(feeds).select("corporate_number", "company_name", "industry", "industry_quality")


_LINES = """SELECT CAST(l_orderkey AS {s}) AS media_internal_id, 'topcv' AS media_code, l_linenumber AS _batch,
    CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_returnflag END AS title, CAST(l_suppkey AS {s}) AS _ingest_id"""


@query(
    "ups3_fold_batches",
    f"""WITH x AS ({_LINES.format(s='VARCHAR')} FROM lineitem)
        SELECT media_internal_id, media_code, (max(struct_pack(b := _batch, t := title)) FILTER (WHERE title IS NOT NULL)).t AS title,
          (min(struct_pack(b := _batch, i := _ingest_id))).i AS _ingest_id FROM x GROUP BY media_internal_id, media_code""",
)
def _(spark, sf):
    exprs = _LINES.format(s="STRING").removeprefix("SELECT ")
    parts = [
        "CAST(l_orderkey AS STRING) AS media_internal_id", "'topcv' AS media_code", "l_linenumber AS _batch",
        "CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_returnflag END AS title", "CAST(l_suppkey AS STRING) AS _ingest_id",
    ]
    return upsert.fold(table(spark, sf, "lineitem").selectExpr(*parts), "_batch")
