"""Feeds, streams and whole steps, run over tables kept in a scratch store."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from jobmeld.operators.enrich import EDUCATION_DEFAULT, EDUCATION_RULES
from jobmeld.plans import specs, steps
from jobmeld.queries.base import AS_OF, LATER, query, store, table, when
from jobmeld.queries.enrich_q import CATEGORIES, SKILLS, sql_case, sql_multi, sql_single
from jobmeld.queries.identity_q import BOTH, _sql_cascade, texts
from jobmeld.queries.lookalikes import (
    HELD_SQL,
    RAW_SQL,
    SALARY_TEXT,
    held,
    job_pages,
    markup_pages,
    master_companies,
    raw_companies,
)
from jobmeld.session import scratch_path
from jobmeld.sources import jsonl
from jobmeld.streaming import jobs as st


# ---- company feed and master ------------------------------------------------------------------------
def _source_companies(spark, sf):
    """Raw companies in the layout of one source, some columns blank."""
    return raw_companies(spark, sf).select(
        "company_id", "company_name", "company_only_name", "company_domain", "province", "ward", "street",
        F.lit("").alias("district"),
        F.concat(F.lit("at "), "street").alias("company_address"),
        F.when(F.col("company_id").cast("int") % 2 == 0, F.concat(F.lit("about "), "company_id")).alias("company_description"),
        F.concat(F.lit("https://x.vn/"), "company_id").alias("source_company_url"),
        F.col("company_id").alias("company_size"),
    )


_FEED_SRC = f"""{RAW_SQL}, fs AS (SELECT *, '' AS district, concat('at ', street) AS company_address,
    CASE WHEN CAST(company_id AS INT) % 2 = 0 THEN concat('about ', company_id) END AS company_description,
    concat('https://x.vn/', company_id) AS source_company_url, company_id AS company_size FROM raw)"""


def _sql_feed(idmap: str | None) -> str:
    number = "coalesce(h.corporate_number, sha256(f.company_only_name))" if idmap else "sha256(f.company_only_name)"
    joined = f"fs f LEFT JOIN {idmap} h ON h.company_id = f.company_id" if idmap else "fs f"
    filled = " + ".join(
        f"(coalesce({c}, '') <> '')::INT" for c, _ in specs.SOURCES["topcv"].company
    )
    return f"""feed AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY corporate_number ORDER BY {filled} DESC, company_id) AS rn
      FROM (SELECT f.*, {number} AS corporate_number FROM {joined})) WHERE rn = 1)"""


_FEED_COLS = """corporate_number, company_id AS topcv_company_id, company_name, company_only_name AS standard_name, company_address AS address,
  company_description AS description, CASE WHEN company_description IS NULL THEN 0 ELSE 30000 END AS description_quality,
  company_domain AS domain, CASE WHEN company_domain = '' THEN 0 ELSE 30000 END AS domain_quality, 0 AS district_quality"""
_FEED_OUT = [
    "corporate_number", "topcv_company_id", "company_name", "standard_name", "address", "description", "description_quality",
    "domain", "domain_quality", "district_quality",
]


@query("ups4_company_feed", f"WITH {_FEED_SRC}, {HELD_SQL}, {_sql_feed('held')} SELECT {_FEED_COLS} FROM feed")
def _(spark, sf):
    feed = steps.company_feed(_source_companies(spark, sf), held(spark, sf), specs.SOURCES["topcv"], when())
    return feed.select(*_FEED_OUT)


# ---- job feed -------------------------------------------------------------------------------------
_MEDIA_JOBS = {
    "topcv": """SELECT CAST(o_orderkey AS {s}) AS job_id, CAST(o_custkey AS {s}) AS job_company_id, concat('u', o_custkey) AS job_company_url,
        o_orderpriority AS job_title, concat('d', o_orderkey) AS job_description, o_orderstatus AS job_employment_type,
        CAST(o_custkey % 24 AS {s}) AS job_experience_requirements, o_orderpriority AS job_industry, '2024' AS job_posted_date,
        CAST(floor(o_totalprice) AS BIGINT) AS job_min_salary, CAST(floor(o_totalprice) AS BIGINT) + 5 AS job_max_salary,
        concat('s', o_orderkey) AS source_job_url, 'b' AS job_benefits FROM orders""",
}


def _raw_jobs(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("jobmeld_orders")
    return spark.sql(_MEDIA_JOBS["topcv"].format(s="STRING").replace("FROM orders", "FROM jobmeld_orders"))


def _careerviet_jobs(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS job_id", "CAST(o_custkey AS STRING) AS job_company_id", "o_orderpriority AS job_title",
        f"{SALARY_TEXT} AS job_salary", "array(o_orderstatus) AS job_employment_type", "concat('d', o_orderkey) AS job_description",
    )


def _known(spark, sf):
    """Master companies that know some of the customers under their source ids."""
    return master_companies(spark, sf).selectExpr(
        "corporate_number", "company_name", "province",
        "CAST(CAST(corporate_number AS INT) * 2 AS STRING) AS topcv_company_id", "corporate_number AS careerviet_company_id",
    )


@query(
    "ups5_job_feed",
    f"""WITH {BOTH}, j AS ({_MEDIA_JOBS['topcv'].format(s='VARCHAR')}), k AS (SELECT CAST(CAST(corporate_number AS INT) * 2 AS VARCHAR) AS cid,
          corporate_number, province FROM master)
        SELECT job_id AS media_internal_id, 'topcv' AS media_code, k.corporate_number, job_company_id AS company_id, k.province, job_title AS title,
          job_employment_type AS employment, job_experience_requirements AS experience, CAST(job_min_salary AS DOUBLE) AS min_salary, CAST(NULL AS VARCHAR) AS skills
        FROM j JOIN k ON k.cid = j.job_company_id""",
)
def _(spark, sf):
    feed = steps.job_feed(_raw_jobs(spark, sf), _known(spark, sf), specs.SOURCES["topcv"], when())
    return feed.select(
        "media_internal_id", "media_code", "corporate_number", "company_id", "province", "title",
        F.array_join("employment_type", ",").alias("employment"), "experience", F.col("min_salary").cast("double").alias("min_salary"), "skills",
    )


@query(
    "ups5_job_feed_salary_text",
    f"""WITH {BOTH} SELECT CAST(o_orderkey AS VARCHAR) AS media_internal_id, corporate_number,
          CASE WHEN o_orderkey % 5 < 3 THEN CAST(floor(o_totalprice) AS BIGINT) END AS max_salary
        FROM orders JOIN master ON corporate_number = CAST(o_custkey AS VARCHAR)""",
)
def _(spark, sf):
    feed = steps.job_feed(_careerviet_jobs(spark, sf), _known(spark, sf), specs.SOURCES["careerviet"], when())
    return feed.select("media_internal_id", "corporate_number", F.col("max_salary").cast("bigint").alias("max_salary"))


# ---- ingest -----------------------------------------------------------------------------------------
_LINE_SCHEMA = "job_id string, job_title string, job_company_id string, amount double"
_FIRST_LINE = """SELECT job_id, job_title, job_company_id, amount FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY {order}) AS rn FROM (
  SELECT CAST(l_orderkey AS VARCHAR) AS job_id, l_returnflag AS job_title, CAST(l_suppkey AS VARCHAR) AS job_company_id, l_extendedprice AS amount FROM lineitem)) WHERE rn = 1"""


def _land_lines(spark, sf, label, key="job_id"):
    path = scratch_path(spark, label)
    rows = table(spark, sf, "lineitem").selectExpr(
        f"CAST(l_orderkey AS STRING) AS {key}", "l_returnflag AS job_title", "CAST(l_suppkey AS STRING) AS job_company_id", "l_extendedprice AS amount"
    )
    jsonl.write_jsonl(rows, path)
    return path


@query("ups6_ingest", _FIRST_LINE.format(order="job_title, job_company_id, amount"))
def _(spark, sf):
    return steps.run_ingest(store(spark, "ups6"), "topcv", "recruit", _land_lines(spark, sf, "ups6"), _LINE_SCHEMA)


def _mixed_lines(spark, sf):
    """Broken lines, records without an id and whole records."""
    return table(spark, sf, "lineitem").selectExpr(
        """CASE l_linenumber % 3 WHEN 0 THEN concat('cut ', l_orderkey)
             ELSE concat('{', if(l_linenumber % 3 = 2, concat('"job_id":"', l_orderkey, '",'), ''), '"job_title":"', l_linestatus, '","amount":', l_partkey, '}') END AS value"""
    )


@query(
    "ups6_rejected",
    """SELECT CASE l_linenumber % 3 WHEN 0 THEN 'unreadable' ELSE 'no id' END AS reason,
         CASE l_linenumber % 3 WHEN 0 THEN concat('cut ', l_orderkey) ELSE concat('{"job_title":"', l_linestatus, '","amount":', CAST(l_partkey AS VARCHAR), '.0}') END AS record
       FROM lineitem WHERE l_linenumber % 3 < 2""",
)
def _(spark, sf):
    path = scratch_path(spark, "ups6r")
    _mixed_lines(spark, sf).write.text(path)
    s = store(spark, "ups6r")
    steps.run_ingest(s, "topcv", "recruit", path, _LINE_SCHEMA)
    return s.read("raw/topcv/recruit_rejected")


@query(
    "ups6_counts",
    """SELECT count(*)::BIGINT AS records, count(DISTINCT l_orderkey) FILTER (WHERE l_linenumber % 3 = 2)::BIGINT AS kept,
         (count(*) FILTER (WHERE l_linenumber % 3 = 1))::BIGINT AS no_id, (count(*) FILTER (WHERE l_linenumber % 3 = 0))::BIGINT AS unreadable,
         (count(*) FILTER (WHERE l_linenumber % 3 = 2) - count(DISTINCT l_orderkey) FILTER (WHERE l_linenumber % 3 = 2))::BIGINT AS repeated FROM lineitem""",
)
def _(spark, sf):
    path = scratch_path(spark, "ups6c")
    _mixed_lines(spark, sf).write.text(path)
    counts = steps.ingest(store(spark, "ups6c"), "topcv", "recruit", path, _LINE_SCHEMA)[1]
    columns = ["records", "kept", "no_id", "unreadable", "repeated"]
    return spark.createDataFrame([tuple(counts[c] for c in columns)], ", ".join(f"{c} bigint" for c in columns))


@query("pip1_ingest_jobs", _FIRST_LINE.format(order="amount, job_company_id, job_title"))
def _(spark, sf):
    # without a schema the columns come out in alphabetical order, and so does the order of preference
    df = steps.run_ingest(store(spark, "pip1"), "topcv", "recruit", _land_lines(spark, sf, "pip1"))
    return df.select("job_id", "job_title", "job_company_id", "amount")


@query("pip2_ingest_companies", _FIRST_LINE.format(order="job_title, job_company_id, amount").replace("SELECT job_id,", "SELECT job_id AS company_id,", 1))
def _(spark, sf):
    schema = _LINE_SCHEMA.replace("job_id", "company_id", 1)
    return steps.run_ingest(store(spark, "pip2"), "topcv", "company", _land_lines(spark, sf, "pip2", "company_id"), schema)


# ---- whole steps --------------------------------------------------------------------------------------
def _store_with_raw(spark, sf, label):
    s = store(spark, label)
    s.write(_source_companies(spark, sf), "raw/topcv/company")
    s.write(_raw_jobs(spark, sf), "raw/topcv/recruit")
    return s


@query("pip3_identify", _sql_cascade("parity"))
def _(spark, sf):
    s = _store_with_raw(spark, sf, "pip3")
    s.write(master_companies(spark, sf), "master/company")
    return texts(steps.run_identify(s, "topcv", when()))


_STEP_FEED = _sql_feed(None)


@query(
    "pip4_master_jobs",
    f"""WITH {_FEED_SRC}, {_STEP_FEED}, j AS ({_MEDIA_JOBS['topcv'].format(s='VARCHAR')})
        SELECT job_id AS media_internal_id, corporate_number, province, job_title AS title, '{AS_OF}' AS created_at
        FROM j JOIN feed ON feed.company_id = j.job_company_id""",
)
def _(spark, sf):
    s = _store_with_raw(spark, sf, "pip4")
    _, jobs = steps.run_master(s, "topcv", when())
    return jobs.select("media_internal_id", "corporate_number", "province", "title", F.col("created_at").cast("string").alias("created_at"))


@query(
    "pip4_master_again",
    f"""WITH {_FEED_SRC}, {_STEP_FEED} SELECT corporate_number, company_id AS topcv_company_id, '{LATER}' AS updated_at, '{AS_OF}' AS created_at FROM feed""",
)
def _(spark, sf):
    # a second run of the same batch moves times and changes no value
    s = _store_with_raw(spark, sf, "pip4b")
    steps.upsert_companies(s, "topcv", when())
    again = steps.upsert_companies(s, "topcv", when(LATER))
    return again.select(
        "corporate_number", "topcv_company_id", F.col("updated_at").cast("string").alias("updated_at"), F.col("created_at").cast("string").alias("created_at")
    )


# job ads with the documents as text, and companies whose descriptions name an industry or none
_DEGREE_ASKED = "concat(CASE doc_id % 3 WHEN 0 THEN 'Tốt nghiệp THPT. ' WHEN 1 THEN 'Cấp 2. ' ELSE '' END, coalesce(text, ''))"
_BUSINESS = """CASE CAST(corporate_number AS INT) % 4 WHEN 0 THEN 'Nhà máy gia công' WHEN 1 THEN 'Ngân hàng, bảo hiểm'
  WHEN 2 THEN 'Xử lý nước' ELSE 'Khác' END"""


@query(
    "pip5_enrich",
    f"""WITH {BOTH}, c AS ({sql_single(CATEGORIES)}), e AS ({sql_multi(SKILLS)}), d AS (SELECT doc_id, {_DEGREE_ASKED} AS text FROM documents)
        SELECT CAST(doc_id AS VARCHAR) AS media_internal_id, label AS category, skills AS expertise,
          {sql_case(EDUCATION_RULES, EDUCATION_DEFAULT)} AS edu,
          CASE CAST(corporate_number AS INT) % 4 WHEN 0 THEN 'Sản xuất' WHEN 1 THEN 'Tài chính và ngân hàng'
            WHEN 2 THEN 'Môi trường và bảo vệ thiên nhiên' END AS industry
        FROM d JOIN c USING (doc_id) JOIN e USING (doc_id) JOIN master ON corporate_number = CAST(1 + doc_id % 100 AS VARCHAR)""",
)
def _(spark, sf):
    s = store(spark, "pip5")
    companies = master_companies(spark, sf).selectExpr(
        "corporate_number", "company_name", "province", "corporate_number AS timviec365_company_id", f"{_BUSINESS} AS description"
    )
    ads = table(spark, sf, "documents").selectExpr(
        "CAST(doc_id AS STRING) AS job_id", "CAST(1 + doc_id % 100 AS STRING) AS job_company_id",
        "text AS job_description", "array(text) AS industries", f"{_DEGREE_ASKED} AS requirements",
    )
    s.write(companies, "master/company")
    s.write(ads, "raw/timviec365/recruit")
    steps.upsert_jobs(s, "timviec365", when())
    jobs = steps.run_enrich(s, CATEGORIES, SKILLS).select("media_internal_id", "category", "expertise", "edu", "corporate_number")
    industry = s.read("master/company").select(F.col("corporate_number").alias("number"), F.col("category").alias("industry"))
    return jobs.join(industry, F.col("corporate_number") == F.col("number")).drop("corporate_number", "number")


# ---- streams ------------------------------------------------------------------------------------------
_EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
    ]
)


def _event_stream(spark, sf):
    return st.read_stream(spark, f"{sf}/events.parquet*", _EVENT, "parquet")


@query(
    "st1_land",
    "SELECT event_id, event_type, strftime(ts, '%Y') AS \"year\", strftime(ts, '%m') AS \"month\", strftime(ts, '%d') AS \"day\" FROM events",
)
def _(spark, sf):
    root = scratch_path(spark, "st1")
    st.land(_event_stream(spark, sf), f"{root}/landed", f"{root}/checkpoint", "feed", F.col("ts")).awaitTermination()
    back = "event_id bigint, event_type string, year string, month string, day string, spider string"
    return spark.read.schema(back).json(f"{root}/landed").drop("spider")


@query("st2_first_seen", "SELECT event_id, user_id, event_type FROM events")
def _(spark, sf):
    # the same events land twice; each must come out once
    root = scratch_path(spark, "st2")
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    for _ in range(2):
        events.write.mode("append").json(f"{root}/landed")
    items = st.read_stream(spark, f"{root}/landed", _EVENT)
    (
        st.first_seen(items, ["event_id"], "ts", "400 days")
        .select("event_id", "user_id", "event_type")
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{root}/seen")
        .awaitTermination()
    )
    return spark.read.schema("event_id bigint, user_id bigint, event_type string").parquet(f"{root}/seen")


_JOB = T.StructType([T.StructField(n, T.StringType()) for n in ("media_internal_id", "media_code", "title", "benefits")])


_ST3_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS media_internal_id, 'topcv' AS media_code, o_orderpriority AS title,
         CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) THEN 'covered' END AS benefits FROM orders"""


@query("st3_upsert", _ST3_SQL)
def _(spark, sf):
    return _st3(spark, sf, None)


def _st3(spark, sf, per_batch, whole=False):
    """Titles and benefits of the same jobs, as separate records; `whole` brings them into one file and so one batch."""
    root = scratch_path(spark, "st3")
    titles = table(spark, sf, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS media_internal_id", "'topcv' AS media_code", "o_orderpriority AS title"
    )
    benefits = table(spark, sf, "lineitem").selectExpr(
        "CAST(l_orderkey AS STRING) AS media_internal_id", "'topcv' AS media_code", "'covered' AS benefits"
    )
    for df in [titles.unionByName(benefits, allowMissingColumns=True)] if whole else [titles, benefits]:
        df.write.mode("append").json(f"{root}/landed")
    s = store(spark, "st3")
    items = st.read_stream(spark, f"{root}/landed", _JOB, per_batch=per_batch)
    return st.upsert_stream(items, s, "master/recruit", f"{root}/checkpoint")


@query("st3_one_batch", _ST3_SQL)
def _(spark, sf):
    # a key's title and benefits meet in one micro-batch
    return _st3(spark, sf, None, whole=True)


@query(
    "prj1_dated_jobs",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 5 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS posted_on,
         CASE o_orderkey % 3 WHEN 0 THEN '2024-02-29' WHEN 1 THEN NULL ELSE '2001-09-09' END AS ends_on FROM orders""",
)
def _(spark, sf):
    day = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
    jobs = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        f"""CASE o_orderkey % 6 WHEN 0 THEN {day} WHEN 1 THEN concat({day}, 'T10:20:30+00:00') WHEN 2 THEN concat({day}, ' 23:59:59')
              WHEN 3 THEN date_format(o_orderdate, 'dd/MM/yyyy') WHEN 4 THEN concat(' ', date_format(o_orderdate, 'dd-MM-yyyy')) ELSE 'hôm qua' END AS posted_at""",
        "CASE o_orderkey % 3 WHEN 0 THEN '29/02/2024 08:30' WHEN 1 THEN '30/02/2024' ELSE '1000000000000' END AS end_at",
    )
    on = steps.dated_jobs(jobs)
    return on.select("o_orderkey", *[F.col(c).cast("date").cast("string").alias(c) for c in ("posted_on", "ends_on")])


# every second line of an order arrives in a run of its own, the later lines of an order first
@query(
    "st3_late_run",
    """WITH l AS (SELECT l_orderkey, l_linenumber AS n, CASE WHEN l_partkey % 3 > 0 THEN l_returnflag END AS title,
           CASE WHEN l_partkey % 2 = 0 THEN l_linestatus END AS benefits, CAST(l_suppkey AS VARCHAR) AS i FROM lineitem)
       SELECT CAST(l_orderkey AS VARCHAR) AS media_internal_id, (max(struct_pack(n := n, v := title)) FILTER (WHERE title IS NOT NULL)).v AS title,
         (max(struct_pack(n := n, v := benefits)) FILTER (WHERE benefits IS NOT NULL)).v AS benefits,
         (min(struct_pack(n := n, v := i))).v AS _ingest_id, max(n)::BIGINT AS nth FROM l GROUP BY l_orderkey""",
)
def _(spark, sf):
    root, s = scratch_path(spark, "st3late"), store(spark, "st3late")
    lines = table(spark, sf, "lineitem").selectExpr(
        "CAST(l_orderkey AS STRING) AS media_internal_id", "'topcv' AS media_code", "CASE WHEN l_partkey % 3 > 0 THEN l_returnflag END AS title",
        "CASE WHEN l_partkey % 2 = 0 THEN l_linestatus END AS benefits", "CAST(l_suppkey AS STRING) AS _ingest_id", "CAST(l_linenumber AS BIGINT) AS nth",
    )
    for part in (0, 1):
        lines.filter(F.col("nth") % 2 == part).write.mode("append").parquet(f"{root}/landed")
        items = st.read_stream(spark, f"{root}/landed", lines.schema, "parquet")
        jobs = st.upsert_stream(items, s, "master/recruit", f"{root}/checkpoint", order="nth")
    return jobs.select("media_internal_id", "title", "benefits", "_ingest_id", "nth")


# ---- pages straight to raw tables ----------------------------------------------------------------------
@query(
    "pip1_extract_jobs",
    """SELECT CAST(o_orderkey AS VARCHAR) AS job_id, concat('Job ', o_orderpriority) AS job_title, CAST(o_custkey AS VARCHAR) AS job_company_id,
         CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS job_min_salary FROM orders""",
)
def _(spark, sf):
    raw = steps.run_extract(store(spark, "pip1x"), "vieclam24h", "recruit", job_pages(spark, sf))
    return raw.select("job_id", "job_title", "job_company_id", "job_min_salary")


@query(
    "pip2_extract_companies",
    """SELECT CAST(c_custkey AS VARCHAR) AS company_id, concat('firm ', c_custkey) AS company_only_name, concat('street ', c_custkey % 97) AS street,
         'X' AS province FROM customer""",
)
def _(spark, sf):
    # every nation is a province of the address table, and so is the X of the pages
    names = table(spark, sf, "nation").selectExpr("inline(array(named_struct('name', n_name), named_struct('name', 'X')))")
    none = F.lit(None).cast("string")
    units = names.select(F.lit("province").alias("level"), "name", none.alias("district"), none.alias("province"))
    raw = steps.run_extract(store(spark, "pip2x"), "topcv", "company", markup_pages(spark, sf), units)
    return raw.select("company_id", "company_only_name", "street", "province")
