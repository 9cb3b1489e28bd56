"""Joins, aggregates, de-duplication, identity resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobmeld.operators import dedupe, identity, incremental, known, lookup, matching
from jobmeld.queries.base import AS_OF, LATER, query, store, table, when
from jobmeld.queries.lookalikes import (
    CLAIM_SQL,
    HELD_SQL,
    MASTER_SQL,
    RAW_SQL,
    claims,
    held,
    master_companies,
    raw_companies,
)

BOTH = f"{RAW_SQL},\n{MASTER_SQL}"


def sql_pairs(keys) -> str:
    """All pairs with equal, non-blank keys."""
    on = []
    for k in keys:
        r, m = f"r.{matching.RAW_KEYS[k]}", f"m.{matching.MASTER_KEYS[k]}"
        on.append(f"{r} = {m} AND trim({r}) <> ''")
    return f"SELECT r.company_id, m.corporate_number FROM raw r JOIN master m ON {' AND '.join(on)}"


def sql_unique(pairs: str, left: str = "company_id", right: str = "corporate_number") -> str:
    """The two-step one-to-one rule over a pair query."""
    return f"""SELECT min({left}) AS {left}, {right} FROM (
        SELECT {left}, min({right}) AS {right} FROM ({pairs}) GROUP BY {left} HAVING count(*) = 1)
      GROUP BY {right} HAVING count(*) = 1"""


def sql_candidates(m: matching.Matcher) -> str:
    return f"""SELECT company_id, corporate_number, {m.code} AS identify_method, '{AS_OF}' AS updated_at,
      '{AS_OF}' AS created_at FROM ({sql_unique(sql_pairs(m.keys))})"""


def sql_merge(d: str, s: str, out: str, conflict: str = "parity") -> str:
    """CTEs that merge candidates `s` into map `d`, giving `out`."""
    blocked = "" if conflict == "replace" else f" AND NOT EXISTS (SELECT 1 FROM {d} d WHERE d.corporate_number = s.corporate_number)"
    return f"""{out}_s AS MATERIALIZED (SELECT * FROM {s} s WHERE NOT EXISTS (
        SELECT 1 FROM {d} d WHERE d.corporate_number = s.corporate_number AND s.identify_method <= d.identify_method)),
      {out} AS MATERIALIZED (
        SELECT s.company_id, s.corporate_number, s.identify_method, s.updated_at, d.created_at
          FROM {d} d JOIN {out}_s s ON s.company_id = d.company_id AND s.identify_method >= d.identify_method
        UNION ALL
        SELECT d.* FROM {d} d
          WHERE NOT EXISTS (SELECT 1 FROM {out}_s s WHERE s.company_id = d.company_id AND s.identify_method >= d.identify_method)
            AND NOT EXISTS (SELECT 1 FROM {out}_s s WHERE s.corporate_number = d.corporate_number AND s.company_id <> d.company_id)
        UNION ALL
        SELECT s.* FROM {out}_s s
          WHERE NOT EXISTS (SELECT 1 FROM {d} d WHERE d.company_id = s.company_id){blocked})"""


def texts(df):
    """Identity-map rows with their times as text."""
    return df.select(
        "company_id", "corporate_number", "identify_method",
        F.col("updated_at").cast("string").alias("updated_at"), F.col("created_at").cast("string").alias("created_at"),
    )


# ---- joins ----------------------------------------------------------------------------------------
_COUNTED = "SELECT company_id, CAST(count(*) AS BIGINT) AS candidates, min(corporate_number) AS corporate_number FROM ({}) GROUP BY company_id"


@query("jn1_equi_join", f"WITH {BOTH} {_COUNTED.format(sql_pairs(['name']))}")
def _(spark, sf):
    return matching.candidate_counts(
        raw_companies(spark, sf), master_companies(spark, sf), [("company_only_name", "standard_name")]
    )


@query("jn2_composite_join", f"WITH {BOTH} {_COUNTED.format(sql_pairs(['ward', 'province', 'name']))}")
def _(spark, sf):
    return matching.candidate_counts(
        raw_companies(spark, sf), master_companies(spark, sf),
        [("ward", "ward"), ("province", "province"), ("company_only_name", "standard_name")],
    )


@query(
    "jn3_attach_number",
    f"""WITH {RAW_SQL}, {HELD_SQL} SELECT r.company_id, r.company_name, h.corporate_number
        FROM raw r LEFT JOIN held h ON h.company_id = r.company_id""",
)
def _(spark, sf):
    raw = raw_companies(spark, sf).select("company_id", "company_name")
    return lookup.attach_number(raw, held(spark, sf))


@query(
    "prj4_single_join_key",
    f"""WITH {HELD_SQL} SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS company_id, corporate_number
        FROM orders LEFT JOIN held ON company_id = CAST(o_custkey AS VARCHAR)""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("company_id"))
    return lookup.attach_number(orders, held(spark, sf))


@query("prj5_map_columns", f"WITH {HELD_SQL} SELECT company_id, corporate_number FROM held")
def _(spark, sf):
    return held(spark, sf).select("company_id", "corporate_number")


_BETTER = """SELECT company_id, corporate_number, identify_method FROM claim s WHERE NOT EXISTS (SELECT 1 FROM held d
  WHERE d.corporate_number = s.corporate_number AND s.identify_method <= d.identify_method)"""


@query("jn4_priority_anti", f"WITH {HELD_SQL}, {CLAIM_SQL} {_BETTER}")
def _(spark, sf):
    return identity.better_only(claims(spark, sf), held(spark, sf)).select("company_id", "corporate_number", "identify_method")


@query(
    "jn4b_incremental",
    "SELECT DISTINCT c_custkey AS item FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)",
)
def _(spark, sf):
    items = table(spark, sf, "customer").select(F.col("c_custkey").alias("item"))
    known = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("item"))
    return dedupe.unseen(items, known, "item")


@query("src4_unseen_ids", "SELECT c_custkey AS item, c_name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey * 3 FROM supplier)")
def _(spark, sf):
    # the ids come in two batches that overlap
    ids = known.KnownIds(store(spark, "known"), "customer", places=1 << 16)
    for part in ("s_suppkey % 3 < 2", "s_suppkey % 3 > 0"):
        ids.add(table(spark, sf, "supplier").filter(part).select((F.col("s_suppkey") * 3).alias("id")), "id")
    return ids.unseen(table(spark, sf, "customer").select(F.col("c_custkey").alias("item"), "c_name"), "item")


_LOOKUP_MASTER = """lm AS (SELECT CAST(c_custkey AS VARCHAR) AS corporate_number, c_name AS company_name, n_name AS province,
  CAST(c_custkey - c_custkey % 2 AS VARCHAR) AS topcv_company_id FROM customer JOIN nation ON n_nationkey = c_nationkey)"""
_LOOKUP = f"""{_LOOKUP_MASTER}, lk AS (SELECT topcv_company_id AS company_id, min(corporate_number) AS corporate_number,
  arg_min(company_name, corporate_number) AS master_company_name, arg_min(province, corporate_number) AS province
  FROM lm GROUP BY 1)"""


def _lookup_master(spark, sf):
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "CAST(c_custkey AS STRING) AS corporate_number", "c_name AS company_name", "n_name AS province",
        "CAST(c_custkey - c_custkey % 2 AS STRING) AS topcv_company_id",
    )


@query("agg3_company_lookup", f"WITH {_LOOKUP} SELECT * FROM lk")
def _(spark, sf):
    return lookup.company_lookup(_lookup_master(spark, sf), "topcv_company_id")


@query(
    "jn5_job_company",
    f"""WITH {_LOOKUP} SELECT o_orderkey AS job_id, lk.corporate_number, lk.master_company_name, lk.province
        FROM orders JOIN lk ON lk.company_id = CAST(o_custkey AS VARCHAR)""",
)
def _(spark, sf):
    jobs = table(spark, sf, "orders").select(F.col("o_orderkey").alias("job_id"), F.col("o_custkey").alias("job_company_id"))
    known = lookup.company_lookup(_lookup_master(spark, sf), "topcv_company_id")
    return lookup.attach_company(jobs, known, "job_company_id").select("job_id", "corporate_number", "master_company_name", "province")


@query(
    "jn8_overlap_pairs",
    f"""WITH {HELD_SQL}, {CLAIM_SQL} SELECT d.company_id AS d_company_id, d.corporate_number AS d_corporate_number,
          s.company_id AS s_company_id, s.corporate_number AS s_corporate_number
        FROM held d JOIN claim s ON d.company_id = s.company_id OR d.corporate_number = s.corporate_number""",
)
def _(spark, sf):
    return identity.overlaps(held(spark, sf), claims(spark, sf)).select(
        "d_company_id", "d_corporate_number", "s_company_id", "s_corporate_number"
    )


# ---- aggregates and de-duplication ------------------------------------------------------------------
@query("agg1_count_and_one", "SELECT o_custkey, count(o_orderkey) AS n, min(o_orderkey) AS one FROM orders GROUP BY o_custkey")
def _(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"), F.min("o_orderkey").alias("one"))


@query("agg2_mutual_unique", sql_unique("SELECT l_orderkey, l_partkey FROM lineitem", "l_orderkey", "l_partkey"))
def _(spark, sf):
    return matching.mutual_unique(table(spark, sf, "lineitem"), "l_orderkey", "l_partkey").select("l_orderkey", "l_partkey")


@query(
    "agg2_repeated_ids",
    sql_unique(
        """SELECT o.o_custkey, e.user_id FROM orders o JOIN (
             SELECT user_id, CAST(event_id AS VARCHAR) AS k FROM events) e ON CAST(o.o_orderkey AS VARCHAR) = e.k""",
        "o_custkey", "user_id",
    ),
)
def _(spark, sf):
    left = table(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").cast("string").alias("k"))
    right = table(spark, sf, "events").select("user_id", F.col("event_id").cast("string").alias("k"))
    return matching.match_repeated(left, right, [("k", "k")], "o_custkey", "user_id")


_ITEM = "l_orderkey AS job_id, l_linenumber, l_partkey, l_quantity"


@query(
    "dd1_job",
    f"""SELECT {_ITEM} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
          ORDER BY l_linenumber, l_partkey, l_quantity) AS rn FROM lineitem) WHERE rn = 1""",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem").selectExpr(*[c.strip() for c in _ITEM.split(",")])
    return dedupe.one_per_id(df, "job_id")


@query(
    "dd1_fullest",
    """SELECT job_id, title, part, mode FROM (SELECT *, row_number() OVER (PARTITION BY job_id
         ORDER BY (coalesce(title, '') <> '')::INT + (part IS NOT NULL)::INT + (mode IS NOT NULL)::INT DESC,
           title NULLS FIRST, part NULLS FIRST, mode NULLS FIRST) AS rn
       FROM (SELECT l_orderkey AS job_id, CASE l_linenumber % 3 WHEN 0 THEN '' WHEN 1 THEN l_returnflag END AS title,
         CASE WHEN l_partkey % 2 = 0 THEN l_partkey END AS part, CASE WHEN l_suppkey % 2 = 0 THEN l_linestatus END AS mode FROM lineitem)) WHERE rn = 1""",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS job_id", "CASE l_linenumber % 3 WHEN 0 THEN '' WHEN 1 THEN l_returnflag END AS title",
        "CASE WHEN l_partkey % 2 = 0 THEN l_partkey END AS part", "CASE WHEN l_suppkey % 2 = 0 THEN l_linestatus END AS mode",
    )
    return dedupe.one_per_id(df, "job_id")


@query(
    "dd2_company",
    """SELECT company_id, day, o_orderkey FROM (SELECT o_custkey AS company_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_orderkey,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("company_id"), F.col("o_orderdate").cast("date").cast("string").alias("day"), "o_orderkey"
    )
    return dedupe.one_per_id(df, "company_id")


_DD3 = """SELECT CAST(o_custkey AS VARCHAR) AS corporate_number, CAST(o_orderkey AS VARCHAR) AS company_id,
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END AS industry,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS size FROM orders"""


@query(
    "dd3_corporate",
    f"""SELECT corporate_number, company_id, industry, size FROM (SELECT *, row_number() OVER (PARTITION BY corporate_number
          ORDER BY (coalesce(industry, '') <> '')::INT + (coalesce(size, '') <> '')::INT DESC, company_id) AS rn FROM ({_DD3})) WHERE rn = 1""",
)
def _(spark, sf):
    df = table(spark, sf, "orders").selectExpr(
        "CAST(o_custkey AS STRING) AS corporate_number", "CAST(o_orderkey AS STRING) AS company_id",
        "CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END AS industry",
        "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS size",
    )
    return dedupe.keep_fullest(df, "corporate_number", ["industry", "size"], "company_id")


@query("dd4_distinct_values", "SELECT DISTINCT url FROM pages WHERE url IS NOT NULL")
def _(spark, sf):
    return dedupe.distinct_values(table(spark, sf, "pages"), "url")


@query(
    "dd5_first_seen",
    """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
       FROM events) WHERE rn = 1""",
)
def _(spark, sf):
    df = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    return dedupe.keep_first(df, ["user_id"], [F.col("ts"), F.col("event_id")]).drop("ts")


# ---- identity resolution --------------------------------------------------------------------------
def _register_matcher(i: int, m: matching.Matcher) -> None:
    sql = f"WITH {BOTH} SELECT company_id, corporate_number, {m.code} AS identify_method FROM ({sql_unique(sql_pairs(m.keys))})"

    @query(f"idr{i}_{m.name}", sql)
    def _(spark, sf):
        found = matching.match(raw_companies(spark, sf), master_companies(spark, sf), m, when())
        return found.select("company_id", "corporate_number", "identify_method")


for _i, _m in enumerate(matching.MATCHERS, 1):
    _register_matcher(_i, _m)


@query(
    "idr8_all_matchers",
    f"WITH {BOTH} "
    + " UNION ALL ".join(
        f"SELECT company_id, corporate_number, {m.code} AS identify_method FROM ({sql_unique(sql_pairs(m.keys))})" for m in matching.MATCHERS
    ),
)
def _(spark, sf):
    return matching.candidates(raw_companies(spark, sf), master_companies(spark, sf))


def _sql_cascade(conflict: str) -> str:
    first, *rest = matching.MATCHERS
    ctes = [BOTH, f"m0 AS MATERIALIZED ({sql_candidates(first)})"]
    for i, m in enumerate(rest, 1):
        ctes.append(f"c{i} AS MATERIALIZED ({sql_candidates(m)})")
        ctes.append(sql_merge(f"m{i - 1}", f"c{i}", f"m{i}", conflict))
    return f"WITH {', '.join(ctes)} SELECT * FROM m{len(rest)}"


def _cascade(spark, sf, conflict):
    pairs = matching.candidates(raw_companies(spark, sf), master_companies(spark, sf))
    return texts(identity.cascade(None, matching.stamp(pairs, when()), conflict=conflict))


@query("idr9_cascade", _sql_cascade("parity"))
def _(spark, sf):
    return _cascade(spark, sf, "parity")


@query("idr9_cascade_replace", _sql_cascade("replace"))
def _(spark, sf):
    return _cascade(spark, sf, "replace")


# a first batch in which two of three master companies are missing or have another's name and address, and some raw
# companies that will be gone; then what puts it right
@query("idr9_incremental", f"WITH whole AS ({_sql_cascade('parity')}) SELECT company_id, corporate_number, identify_method FROM whole")
def _(spark, sf):
    tables, raw, master = store(spark, "incremental"), raw_companies(spark, sf), master_companies(spark, sf)
    tables.buckets = 8
    number = F.col("corporate_number").try_cast("int")
    wrong = [F.concat(F.lit("other "), c).alias(c) for c in ("standard_name", "domain", "street")]
    early = master.select("corporate_number", "ward", "province", *wrong).filter(number % 3 == 1)
    early = early.unionByName(master.filter(number % 3 == 0).select(*early.columns))
    extra = raw.withColumn("company_id", F.concat(F.lit("gone "), "company_id")).filter("company_id LIKE '%1'")
    incremental.identify_changes(tables, "id", when(), raw.unionByName(extra), early)
    late = master.filter(number % 3 != 0)
    found = incremental.identify_changes(tables, "id", when(LATER), None, late, gone_raw=extra)
    return found.select("company_id", "corporate_number", "identify_method")


@query("idr10_better_only", f"WITH {HELD_SQL}, {CLAIM_SQL} {_BETTER}")
def _(spark, sf):
    return identity.better_only(claims(spark, sf), held(spark, sf)).select("company_id", "corporate_number", "identify_method")


for _rule in ("parity", "replace"):

    def _merge(spark, sf, rule=_rule):
        return texts(identity.merge(held(spark, sf), claims(spark, sf), rule))

    query(
        f"idr11_merge_{_rule}", f"WITH {HELD_SQL}, {CLAIM_SQL}, {sql_merge('held', 'claim', 'merged', _rule)} SELECT * FROM merged"
    )(_merge)


@query(
    "idr12_mint",
    f"""WITH {RAW_SQL}, {HELD_SQL} SELECT r.company_id,
          coalesce(CASE WHEN CAST(r.company_id AS INT) % 3 = 0 THEN h.corporate_number END,
            CASE WHEN CAST(r.company_id AS INT) % 4 = 1 THEN sha256(concat('topcv', chr(31), r.company_id)) ELSE sha256(r.company_only_name) END) AS corporate_number
        FROM raw r LEFT JOIN held h ON h.company_id = r.company_id""",
)
def _(spark, sf):
    number = F.col("company_id").cast("int")
    raw = raw_companies(spark, sf).withColumn(
        "company_only_name", F.when(number % 4 == 1, F.lit("")).otherwise(F.col("company_only_name"))
    )
    tied = lookup.attach_number(raw, held(spark, sf)).withColumn(
        "corporate_number", F.when(number % 3 == 0, F.col("corporate_number"))
    )
    return identity.mint(tied, "topcv").select("company_id", "corporate_number")
