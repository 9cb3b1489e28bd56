"""Projections, filters, scalar functions and text normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobmeld.functions import address, names, numbers, predicates as pr, text as tx, urls
from jobmeld.operators import survivorship, upsert
from jobmeld.queries.base import query, table, when
from jobmeld.queries.lookalikes import _MASTER_NAME, _RAW_NAME, SALARY_TEXT, sql_name_key

# blank and null text out of a table that has neither
SEGMENT = "CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE c_mktsegment END"


# ---- projections --------------------------------------------------------------------------------
@query("prj1_rename_select", "SELECT o_orderkey AS media_internal_id, o_orderstatus, o_totalprice AS max_salary FROM orders")
def _(spark, sf):
    return upsert.rename_select(
        table(spark, sf, "orders"),
        [("o_orderkey", "media_internal_id"), ("o_orderstatus", None), ("o_totalprice", "max_salary")],
    )


_TRIPLE = """SELECT c_custkey AS corporate_number, c_name AS company_name, 30000 AS company_name_quality,
  {seg} AS industry, CASE WHEN {seg} IS NOT NULL AND {seg} <> '' THEN 30000 ELSE 0 END AS industry_quality
  FROM customer"""


def _scored(spark, sf):
    src = table(spark, sf, "customer").selectExpr("c_custkey AS corporate_number", "c_name", f"{SEGMENT} AS segment")
    return survivorship.scored(src, [("c_name", "company_name"), ("segment", "industry")], 30000, when())


@query("prj2_value_quality_time", _TRIPLE.format(seg=SEGMENT).replace("FROM customer", ", '2024-01-01 00:00:00' AS industry_updated_at FROM customer"))
def _(spark, sf):
    return _scored(spark, sf).select(
        "corporate_number", "company_name", "company_name_quality", "industry", "industry_quality",
        F.col("industry_updated_at").cast("string").alias("industry_updated_at"),
    )


@query("prj3_tag_source", "SELECT o_orderkey, 'topcv' AS media_code FROM orders")
def _(spark, sf):
    return upsert.tag_source(table(spark, sf, "orders").select("o_orderkey"), "topcv")


# ---- predicates ---------------------------------------------------------------------------------
_LIST = "CASE WHEN o_orderkey % 3 = 0 THEN {none} WHEN o_orderkey % 3 = 1 THEN {empty} ELSE {one} END"


@query(
    "flt1_has_value",
    f"""SELECT c_custkey, ({SEGMENT}) IS NOT NULL AND ({SEGMENT}) <> '' AS text_filled,
        c_custkey % 3 = 2 AS list_filled, c_acctbal IS NOT NULL AS number_filled FROM customer""",
)
def _(spark, sf):
    df = table(spark, sf, "customer").selectExpr(
        "c_custkey", f"{SEGMENT} AS t",
        "CASE c_custkey % 3 WHEN 0 THEN CAST(NULL AS ARRAY<STRING>) WHEN 1 THEN CAST(array() AS ARRAY<STRING>) ELSE array(c_name) END AS l",
        "c_acctbal",
    )
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        "c_custkey",
        pr.has_value(F.col("t"), kinds["t"]).alias("text_filled"),
        pr.has_value(F.col("l"), kinds["l"]).alias("list_filled"),
        pr.has_value(F.col("c_acctbal"), kinds["c_acctbal"]).alias("number_filled"),
    )


@query("flt2_exactly_one", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) = 1")
def _(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")).filter("n = 1")


@query("flt3_fill_null", f"SELECT c_custkey, coalesce({SEGMENT}, lower(c_name)) AS segment FROM customer")
def _(spark, sf):
    df = table(spark, sf, "customer").selectExpr("c_custkey", "c_name", f"{SEGMENT} AS segment")
    return df.select("c_custkey", pr.fill_null(F.col("segment"), F.lower("c_name")).alias("segment"))


@query("flt4_when_present", f"SELECT c_custkey, CASE WHEN ({SEGMENT}) IS NOT NULL THEN lower({SEGMENT}) END AS segment FROM customer")
def _(spark, sf):
    df = table(spark, sf, "customer").selectExpr("c_custkey", f"{SEGMENT} AS segment")
    return df.select("c_custkey", pr.when_present(F.col("segment"), F.lower("segment")).alias("segment"))


@query(
    "flt6_key_fallback",
    f"SELECT c_custkey, coalesce({SEGMENT}, sha256(c_name)) AS corporate_number FROM customer",
)
def _(spark, sf):
    df = table(spark, sf, "customer").selectExpr("c_custkey", "c_name", f"{SEGMENT} AS k")
    return df.select("c_custkey", F.coalesce("k", pr.text_hash(F.col("c_name"))).alias("corporate_number"))


_WORDS = "string_split(lower(regexp_replace(c.text, '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ')"


@query(
    "flt8_drop_tokens",
    f"""SELECT conv_id, turn, array_to_string(list_filter({_WORDS}, lambda s: s <> '' AND NOT starts_with(s, 'th')), ' ') AS kept
        FROM conversations c""",
)
def _(spark, sf):
    ws = F.split(F.lower(F.regexp_replace("text", r"[^\p{L}\p{N}]+", " ")), " ")
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", F.array_join(tx.drop_tokens(ws, "th"), " ").alias("kept")
    )


# ---- scalar functions -----------------------------------------------------------------------------
@query("fn1_text_hash", f"SELECT c_custkey, sha256(coalesce({SEGMENT}, '')) AS h FROM customer")
def _(spark, sf):
    return table(spark, sf, "customer").selectExpr("c_custkey", f"{SEGMENT} AS t").select(
        "c_custkey", pr.text_hash(F.col("t")).alias("h")
    )


@query("fn2_coalesce_text", "SELECT l_orderkey, l_linenumber, coalesce(CAST(CASE WHEN l_linenumber > 2 THEN NULL ELSE l_partkey END AS VARCHAR), '') AS t FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.coalesce(numbers.to_text(F.when(F.col("l_linenumber") <= 2, F.col("l_partkey"))), F.lit("")).alias("t"),
    )


@query("fn3_concat_ws", f"SELECT c_custkey, concat_ws(', ', c_name, {SEGMENT}, CAST(c_nationkey AS VARCHAR)) AS joined FROM customer")
def _(spark, sf):
    df = table(spark, sf, "customer").selectExpr("c_custkey", "c_name", f"{SEGMENT} AS t", "CAST(c_nationkey AS STRING) AS k")
    return df.select("c_custkey", tx.joined([F.col("c_name"), F.col("t"), F.col("k")], ", ").alias("joined"))


@query("fn4_wrap_scalar", f"SELECT c_custkey, CASE WHEN ({SEGMENT}) IS NULL THEN -1 ELSE 1 END AS n, {SEGMENT} AS item FROM customer")
def _(spark, sf):
    df = table(spark, sf, "customer").selectExpr("c_custkey", f"{SEGMENT} AS t").withColumn("a", numbers.as_array(F.col("t")))
    return df.select(
        "c_custkey", F.when(F.col("a").isNull(), -1).otherwise(F.size("a")).alias("n"),
        F.try_element_at("a", F.lit(1)).alias("item"),
    )


_BIG = "o_orderkey * 1000000000000"


@query("fn5_try_decimal", f"SELECT o_orderkey, CAST(TRY_CAST({_BIG} AS DECIMAL(16,2)) AS VARCHAR) AS amount FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", numbers.to_decimal(F.expr(_BIG), "decimal(16,2)").cast("string").alias("amount")
    )


@query("fn6_to_text", "SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS id, CAST(p_size AS VARCHAR) AS size FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", numbers.to_text(F.col("p_partkey")).alias("id"), numbers.to_text(F.col("p_size")).alias("size")
    )


@query(
    "fn7_salary",
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 3 THEN CAST(floor(o_totalprice) AS BIGINT) END AS max_salary FROM orders""",
)
def _(spark, sf):
    df = table(spark, sf, "orders").selectExpr("o_orderkey", f"{SALARY_TEXT} AS t")
    return df.select("o_orderkey", numbers.salary(F.col("t")).cast("bigint").alias("max_salary"))


@query("fn8_rlike_any_case", "SELECT doc_id, regexp_matches(text, '(?i)license|version [0-9]') AS hit FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.col("text").rlike("(?iu)license|version [0-9]").alias("hit"))


@query("fn9_as_of", "SELECT s_suppkey, '2024-01-01 00:00:00' AS updated_at FROM supplier")
def _(spark, sf):
    return upsert.stamped(table(spark, sf, "supplier").select("s_suppkey"), when()).select(
        "s_suppkey", F.col("updated_at").cast("string").alias("updated_at")
    )


@query("fn10_case_null", f"SELECT c_custkey, CASE WHEN ({SEGMENT}) IS NULL THEN 'none' WHEN ({SEGMENT}) = '' THEN 'blank' ELSE 'set' END AS state FROM customer")
def _(spark, sf):
    df = table(spark, sf, "customer").selectExpr("c_custkey", f"{SEGMENT} AS t")
    return df.select(
        "c_custkey", F.when(F.col("t").isNull(), F.lit("none")).when(F.col("t") == "", F.lit("blank")).otherwise(F.lit("set")).alias("state")
    )


@query(
    "fn11_any_of",
    "SELECT l_orderkey, l_linenumber, (l_quantity > 45 OR l_discount > 0.08 OR l_returnflag = 'R') AS changed FROM lineitem",
)
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        pr.any_of([F.col("l_quantity") > 45, F.col("l_discount") > 0.08, F.col("l_returnflag") == "R"]).alias("changed"),
    )


@query("fn12_dotted_token", "SELECT page_id, list_extract(string_split(url, '.'), -2) AS token FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.dotted_id(F.col("url"), -2).alias("token"))


# ---- normalisation --------------------------------------------------------------------------------
@query(
    "nrm1_name_key",
    f"""SELECT 'raw' AS side, s_suppkey AS id, {sql_name_key(f'trim({_RAW_NAME})')} AS name_key FROM supplier
        UNION ALL SELECT 'master', c_custkey, {sql_name_key(f'trim({_MASTER_NAME})')} FROM customer
        UNION ALL SELECT 'text', doc_id, {sql_name_key('trim(text)')} FROM documents""",
)
def _(spark, sf):
    raw = table(spark, sf, "supplier").selectExpr("'raw' AS side", "s_suppkey AS id", f"{_RAW_NAME} AS name")
    master = table(spark, sf, "customer").selectExpr("'master' AS side", "c_custkey AS id", f"{_MASTER_NAME} AS name")
    docs = table(spark, sf, "documents").selectExpr("'text' AS side", "doc_id AS id", "text AS name")
    return raw.unionByName(master).unionByName(docs).select("side", "id", names.name_key(F.col("name")).alias("name_key"))


@query("nrm2_fold_text", "SELECT doc_id, lower(trim(regexp_replace(nfc_normalize(text), '\\s+', ' ', 'g'))) AS folded FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.fold_text(F.col("text")).alias("folded"))


_BRACKETED = "concat(c_name, ' (', c_mktsegment, ') x', CASE WHEN c_custkey % 2 = 0 THEN '(b)' ELSE '' END)"


@query("nrm3_remove_brackets", f"SELECT c_custkey, trim(regexp_replace({_BRACKETED}, '\\s*\\(.*?\\)\\s*', '', 'g')) AS t FROM customer")
def _(spark, sf):
    df = table(spark, sf, "customer").selectExpr("c_custkey", f"{_BRACKETED} AS t")
    return df.select("c_custkey", tx.remove_brackets(F.col("t")).alias("t"))


# addresses over nations as provinces; every region name doubles as the one district of its nations
_ADDR = """concat('no ', c_custkey, CASE WHEN c_custkey % 3 = 0 THEN ', lane 7' ELSE '' END,
  CASE WHEN c_custkey % 5 = 0 THEN '' ELSE concat(', Phường ', c_custkey % 4) END,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE concat(', Quận ', lower(r_name)) END,
  ', ', CASE WHEN c_custkey % 11 = 0 THEN 'Nowhere' ELSE concat('Tỉnh ', n_name) END)"""


@query(
    "nrm4_address",
    """SELECT c_custkey,
         CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE n_name END AS province,
         CASE WHEN c_custkey % 11 = 0 OR c_custkey % 7 = 0 THEN NULL ELSE r_name END AS district,
         CASE WHEN c_custkey % 11 = 0 OR c_custkey % 7 = 0 OR c_custkey % 5 = 0 OR c_custkey % 4 = 3 THEN NULL
              ELSE concat('Phường ', c_custkey % 4) END AS ward,
         concat('no ', c_custkey, CASE WHEN c_custkey % 3 = 0 THEN ', lane 7' ELSE '' END,
           CASE WHEN c_custkey % 5 <> 0 AND (c_custkey % 11 = 0 OR c_custkey % 7 = 0 OR c_custkey % 4 = 3)
                THEN concat(', Phường ', c_custkey % 4) ELSE '' END,
           CASE WHEN c_custkey % 11 = 0 AND c_custkey % 7 <> 0 THEN concat(', Quận ', lower(r_name)) ELSE '' END,
           CASE WHEN c_custkey % 11 = 0 THEN ', Nowhere' ELSE '' END) AS street
       FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
)
def _(spark, sf):
    nation = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    units = nation.selectExpr(
        """stack(5,
             'province', n_name, CAST(NULL AS STRING), CAST(NULL AS STRING),
             'district', r_name, NULL, n_name,
             'ward', 'Phường 0', r_name, n_name,
             'ward', 'Phường 1', r_name, n_name,
             'ward', 'Phường 2', r_name, n_name) AS (level, name, district, province)"""
    )
    home = nation.select("n_nationkey", "n_name", "r_name")
    df = table(spark, sf, "customer").join(home, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr("c_custkey", f"{_ADDR} AS address")
    return address.split_address(df, "address", units).select("c_custkey", "addr.province", "addr.district", "addr.ward", "addr.street")


_ENTITIES = [("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")]


def _sql_clean(expr: str) -> str:
    for a, b in [*_ENTITIES, ("<li>", "- "), ("</li>", "\n"), ("<br>", "\n")]:
        expr = f"replace({expr}, '{a}', '{b}')"
    return expr


@query("nrm5_clean_html", f"SELECT page_id, {_sql_clean('html')} AS body FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.clean_html(F.col("html")).alias("body"))


@query(
    "nrm6_clean_html_blank",
    "SELECT page_id, " + "regexp_replace(" + _sql_clean("coalesce(CASE WHEN page_id % 5 = 0 THEN NULL ELSE html END, '')") + ", '^\\s+|\\s+$', '', 'g') AS body FROM pages",
)
def _(spark, sf):
    h = F.when(F.col("page_id") % 5 != 0, F.col("html"))
    return table(spark, sf, "pages").select("page_id", tx.clean_html_or_blank(h).alias("body"))


@query("nrm7_clean_text", "SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.clean_text(F.col("text")).alias("t"))


@query("nrm8_squeeze", "SELECT conv_id, turn, regexp_replace(text, '\\s+', ' ', 'g') AS t FROM conversations")
def _(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", tx.squeeze(F.col("text")).alias("t"))


@query(
    "nrm9_strip_controls",
    """SELECT doc_id, translate(text, chr(13) || chr(10) || chr(9), '') AS body FROM documents""",
)
def _(spark, sf):
    # raw line breaks inside a JSON string: unreadable until the control characters are gone
    raw = F.concat(F.lit('{"t":"'), F.replace(F.replace("text", F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"}'))
    doc = F.try_parse_json(tx.strip_controls(raw))
    return table(spark, sf, "documents").select("doc_id", F.try_variant_get(doc, "$.t", "string").alias("body"))


@query("nrm10_strip_slashes", "SELECT page_id, regexp_replace(coalesce(url, ''), '/+$', '') AS domain FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.strip_slashes(F.col("url")).alias("domain"))


_SEG = "list_extract(string_split(url, '/'), -1)"


@query(
    "nrm11_id_from_url",
    f"""SELECT page_id, {_SEG} AS last_segment, replace({_SEG}, '.html', '') AS page_key,
          list_extract(string_split({_SEG}, '-'), -1) AS dash_id, list_extract(string_split({_SEG}, '.'), 1) AS first_token,
          list_extract(string_split(url, '.'), -2) AS dotted_id FROM pages""",
)
def _(spark, sf):
    u = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id",
        urls.last_segment(u).alias("last_segment"),
        urls.page_id(u).alias("page_key"),
        urls.dash_id(u).alias("dash_id"),
        urls.first_token(u).alias("first_token"),
        urls.dotted_id(u, -2).alias("dotted_id"),
    )


@query(
    "nrm12_resolve_url",
    """SELECT page_id, concat(regexp_extract(url, '^[a-z]+://[^/?#]*'), '/jobs/', page_id, '.html') AS rooted,
         concat(regexp_extract(url, '^[a-z]+://[^?#]*/'), 'next') AS beside,
         concat(regexp_extract(url, '^[a-z]+:'), '//cdn.example.com/x') AS other_host, 'http://a.b/c' AS absolute,
         concat(regexp_replace(url, '[?#].*$', ''), '?p=2') AS same_page
       FROM pages""",
)
def _(spark, sf):
    u = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id",
        urls.resolve(u, F.concat(F.lit("/jobs/"), F.col("page_id"), F.lit(".html"))).alias("rooted"),
        urls.resolve(u, F.lit("./x/../next")).alias("beside"),
        urls.resolve(u, F.lit("//cdn.example.com/x")).alias("other_host"),
        urls.resolve(u, F.lit("http://a.b/c")).alias("absolute"),
        urls.resolve(u, F.lit("?p=2")).alias("same_page"),
    )


@query(
    "nrm13_headcount",
    """SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN concat(s_nationkey, '-', s_nationkey + 100)
         WHEN 1 THEN concat('từ ', s_nationkey) ELSE '' END AS company_size FROM supplier""",
)
def _(spark, sf):
    pieces = F.expr(
        """CASE s_suppkey % 3 WHEN 0 THEN array(s_name, '1 nhân viên', concat(' ', s_nationkey, '-', s_nationkey + 100, ' nhân viên '))
           WHEN 1 THEN array(concat('từ ', s_nationkey, ' nhân viên'), s_name) ELSE array(s_name) END"""
    )
    return table(spark, sf, "supplier").select("s_suppkey", tx.headcount(pieces).alias("company_size"))


@query(
    "nrm14_experience",
    """SELECT event_id, CASE event_id % 4
         WHEN 0 THEN CASE WHEN CAST(props->>'$.k' AS INT) = 0 THEN 'Không rõ' ELSE concat(props->>'$.k', ' tháng') END
         WHEN 1 THEN concat(event_type, ' năm') ELSE 'Không rõ' END AS experience FROM events""",
)
def _(spark, sf):
    doc = F.expr(
        """CASE event_id % 4
             WHEN 0 THEN concat('{"experienceRequirements":', replace(props, '"k"', '"monthsOfExperience"'), '}')
             WHEN 1 THEN concat('{"experienceRequirements":"', event_type, ' năm"}')
             WHEN 2 THEN '{"experienceRequirements":{}}' ELSE props END"""
    )
    return table(spark, sf, "events").select("event_id", tx.months_text(doc, "$.experienceRequirements").alias("experience"))


@query(
    "nrm15_list_or_text",
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN concat(event_type, ', ', user_id) WHEN 1 THEN event_type END AS skills FROM events""",
)
def _(spark, sf):
    doc = F.expr(
        """CASE event_id % 3 WHEN 0 THEN to_json(named_struct('skills', array(event_type, CAST(user_id AS STRING))))
             WHEN 1 THEN to_json(named_struct('skills', event_type)) ELSE props END"""
    )
    return table(spark, sf, "events").select(
        "event_id", tx.list_or_text(F.try_parse_json(doc), "$.skills").alias("skills")
    )


@query(
    "nrm16_join_filled",
    """SELECT doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda s: trim(s) <> ''), ' | ') AS t FROM documents""",
)
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.join_filled(F.split("text", "\n"), " | ").alias("t"))


@query("nrm17_first_filled", f"SELECT c_custkey, coalesce(nullif({SEGMENT}, ''), c_name) AS t FROM customer")
def _(spark, sf):
    df = table(spark, sf, "customer").selectExpr("c_custkey", "c_name", f"{SEGMENT} AS s")
    return df.select("c_custkey", tx.first_filled(F.col("s"), F.col("c_name")).alias("t"))


@query(
    "nrm18_opening_hours",
    """SELECT user_id, concat('Mo=', CASE WHEN user_id % 2 = 0 THEN '9 - 12' ELSE concat(user_id % 10, ' - ', user_id % 10 + 8) END,
         ';Tu=', user_id % 10, ' - ', user_id % 10 + 8) AS hours FROM (SELECT DISTINCT user_id FROM events)""",
)
def _(spark, sf):
    users = dedupe_users(table(spark, sf, "events"))
    specs = F.expr(
        """CASE WHEN user_id % 2 = 0
             THEN array(named_struct('dayOfWeek', array('Mo', 'Tu'), 'opens', CAST(user_id % 10 AS STRING), 'closes', CAST(user_id % 10 + 8 AS STRING)),
                        named_struct('dayOfWeek', array('Mo'), 'opens', '9', 'closes', '12'))
             ELSE array(named_struct('dayOfWeek', array('Mo', 'Tu'), 'opens', CAST(user_id % 10 AS STRING), 'closes', CAST(user_id % 10 + 8 AS STRING))) END"""
    )
    days = F.array_sort(F.map_entries(tx.opening_hours(specs)))
    return users.select("user_id", F.array_join(F.transform(days, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("hours"))


def dedupe_users(events):
    from jobmeld.operators.dedupe import distinct_values

    return distinct_values(events, "user_id")


@query(
    "nrm19_pluck",
    """SELECT p_partkey, concat(p_brand, '|', p_type, '|') AS names, p_brand AS first_name FROM part""",
)
def _(spark, sf):
    items = F.expr("array(named_struct('name', p_brand), named_struct('name', p_type), named_struct('name', CAST(NULL AS STRING)))")
    names_ = tx.pluck(items, "name")
    return table(spark, sf, "part").select(
        "p_partkey", F.array_join(names_, "|").alias("names"), F.try_element_at(names_, F.lit(1)).alias("first_name")
    )
