"""Company, job and page tables derived from the given tables, in Spark and in SQL.

Raw companies come from suppliers and master companies from customers. Their formulas repeat some
names, streets and domains, so that matching meets 1:1, 1:n and n:1 cases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobmeld.functions.names import PREFIXES, SUFFIXES, name_key
from jobmeld.queries.base import table

_RAW_M = "(s_suppkey * 3 - CASE WHEN (s_suppkey * 3) % 7 = 6 THEN 3 ELSE 0 END)"
_RAW_NAME = f"""concat(CASE s_suppkey % 4 WHEN 0 THEN 'Công ty TNHH ' WHEN 1 THEN 'Công ty Cổ phần '
  WHEN 2 THEN 'CÔNG TY CP ' ELSE 'Company ' END, 'Firm ', {_RAW_M})"""
_RAW_DOMAIN = f"""CASE WHEN (s_suppkey * 3) % 9 = 0 THEN '' ELSE
  concat('http://d', {_RAW_M} - CASE WHEN (s_suppkey * 3) % 13 = 12 THEN 1 ELSE 0 END, '.vn') END"""
_MASTER_M = "(c_custkey - CASE WHEN c_custkey % 10 = 9 THEN 1 ELSE 0 END)"
_MASTER_NAME = f"""concat('Firm ', {_MASTER_M}, CASE c_custkey % 4 WHEN 0 THEN ' Co., Ltd' WHEN 1 THEN ' Corporation'
  WHEN 2 THEN ', Limited' ELSE ' Corp.' END)"""
_MASTER_DOMAIN = f"""CASE WHEN c_custkey % 9 = 0 THEN '' ELSE
  concat('http://d', {_MASTER_M} - CASE WHEN c_custkey % 13 = 12 THEN 1 ELSE 0 END, '.vn') END"""


def sql_name_key(expr: str) -> str:
    """The name key in SQL, one step per legal form."""
    for p in PREFIXES:
        expr = f"regexp_replace({expr}, '^{p}\\s+', '', 'i')"
    for s in SUFFIXES:
        expr = f"regexp_replace({expr}, '\\s+{s}$|,\\s*{s}$', '', 'i')"
    expr = f"regexp_replace({expr}, '[^0-9a-zA-ZÀ-ỹ\\s]', '', 'g')"
    return f"lower(trim(regexp_replace({expr}, '\\s+', ' ', 'g')))"


RAW_SQL = f"""raw AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS company_id, {_RAW_NAME} AS company_name,
    {sql_name_key(f'trim({_RAW_NAME})')} AS company_only_name, {_RAW_DOMAIN} AS company_domain,
    concat('street ', {_RAW_M} % 97) AS street, concat('ward ', (s_suppkey * 3) % 4) AS ward, n_name AS province
  FROM supplier JOIN nation ON n_nationkey = {_RAW_M} % 25)"""

MASTER_SQL = f"""master AS (
  SELECT CAST(c_custkey AS VARCHAR) AS corporate_number, {_MASTER_NAME} AS company_name,
    {sql_name_key(f'trim({_MASTER_NAME})')} AS standard_name, {_MASTER_DOMAIN} AS domain,
    concat('street ', {_MASTER_M} % 97) AS street, concat('ward ', c_custkey % 4) AS ward, n_name AS province
  FROM customer JOIN nation ON n_nationkey = {_MASTER_M} % 25)"""


def dealt(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table, its rows dealt out evenly, three tasks to a core.

    A table of narrow rows may be one small file and so one task, while each row becomes a page or several match keys.
    Rows go by their place in the file, not by a value, so repeated and null keys spread too, and nothing is sorted.
    """
    tasks = 3 * spark.sparkContext.defaultParallelism
    return table(spark, sf, name).select(*columns).repartition(tasks, F.monotonically_increasing_id())


def raw_companies(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    base = dealt(spark, sf, "supplier", "s_suppkey").selectExpr(
        "CAST(s_suppkey AS STRING) AS company_id",
        f"{_RAW_NAME} AS company_name",
        f"{_RAW_DOMAIN} AS company_domain",
        f"concat('street ', {_RAW_M} % 97) AS street",
        "concat('ward ', (s_suppkey * 3) % 4) AS ward",
        f"{_RAW_M} % 25 AS nk",
    )
    return base.join(nation, F.col("nk") == F.col("n_nationkey")).select(
        "company_id",
        "company_name",
        name_key(F.col("company_name")).alias("company_only_name"),
        "company_domain",
        "street",
        "ward",
        F.col("n_name").alias("province"),
    )


def master_companies(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    base = dealt(spark, sf, "customer", "c_custkey").selectExpr(
        "CAST(c_custkey AS STRING) AS corporate_number",
        f"{_MASTER_NAME} AS company_name",
        f"{_MASTER_DOMAIN} AS domain",
        f"concat('street ', {_MASTER_M} % 97) AS street",
        "concat('ward ', c_custkey % 4) AS ward",
        f"{_MASTER_M} % 25 AS nk",
    )
    return base.join(nation, F.col("nk") == F.col("n_nationkey")).select(
        "corporate_number",
        "company_name",
        name_key(F.col("company_name")).alias("standard_name"),
        "domain",
        "street",
        "ward",
        F.col("n_name").alias("province"),
    )


# ---- jobs ---------------------------------------------------------------------------------------
# the amount as text in the ways the sources write it
_AMOUNT = "CAST(floor(o_totalprice) AS BIGINT)"
SALARY_TEXT = f"""CASE o_orderkey % 5
  WHEN 0 THEN concat(CAST(({_AMOUNT} - {_AMOUNT} % 1000) / 1000 AS BIGINT), '.', right(concat('00', {_AMOUNT} % 1000), 3))
  WHEN 1 THEN concat(CAST(({_AMOUNT} - {_AMOUNT} % 1000) / 1000 AS BIGINT), ',', right(concat('00', {_AMOUNT} % 1000), 3))
  WHEN 2 THEN concat(CAST(({_AMOUNT} - {_AMOUNT} % 1000) / 1000 AS BIGINT), ' ', right(concat('00', {_AMOUNT} % 1000), 3))
  WHEN 3 THEN 'Thỏa thuận' ELSE '' END"""
# media codes for the three order states
MEDIA = "CASE o_orderstatus WHEN 'F' THEN 'topcv' WHEN 'O' THEN 'careerviet' ELSE 'vietnamworks' END"

# two identity tables over the same companies, with every kind of overlap between them
HELD_EXPRS = {
    "company_id": "CAST(c_custkey AS {s})",
    "corporate_number": "CAST({x1} AS {s})",
    "identify_method": "CASE c_custkey % 4 WHEN 0 THEN 30000 WHEN 1 THEN 38000 WHEN 2 THEN 40000 ELSE 47500 END",
}
CLAIM_EXPRS = {
    "company_id": "CAST(c_custkey * 2 AS {s})",
    "corporate_number": "CAST({x2} AS {s})",
    "identify_method": "CASE c_custkey % 3 WHEN 0 THEN 35000 WHEN 1 THEN 40000 ELSE 45000 END",
}


def _ident_sql(name: str, exprs: dict[str, str], at: str) -> str:
    cols = ", ".join(
        f"{e.format(s='VARCHAR', x1='xor(c_custkey, 1)', x2='xor(c_custkey, 3)')} AS {c}" for c, e in exprs.items()
    )
    return f"{name} AS (SELECT {cols}, '{at}' AS updated_at, '{at}' AS created_at FROM customer)"


def _ident_df(spark: SparkSession, sf: str, exprs: dict[str, str], at: str) -> DataFrame:
    return table(spark, sf, "customer").selectExpr(
        *[f"{e.format(s='STRING', x1='(c_custkey ^ 1)', x2='(c_custkey ^ 3)')} AS {c}" for c, e in exprs.items()],
        f"CAST('{at}' AS TIMESTAMP) AS updated_at",
        f"CAST('{at}' AS TIMESTAMP) AS created_at",
    )


HELD_SQL = _ident_sql("held", HELD_EXPRS, "2023-06-01 00:00:00")
CLAIM_SQL = _ident_sql("claim", CLAIM_EXPRS, "2024-01-01 00:00:00")


def held(spark: SparkSession, sf: str) -> DataFrame:
    return _ident_df(spark, sf, HELD_EXPRS, "2023-06-01 00:00:00")


def claims(spark: SparkSession, sf: str) -> DataFrame:
    return _ident_df(spark, sf, CLAIM_EXPRS, "2024-01-01 00:00:00")


# ---- pages ----------------------------------------------------------------------------------------
SITE = "https://jobs.example.vn"
_MIN = "CAST(floor(o_totalprice) AS BIGINT)"
_DAY = "CAST(CAST(o_orderdate AS DATE) AS {s})"


def job_pages(spark: SparkSession, sf: str, tail: str = ".html") -> DataFrame:
    """One job page per order: two structured blocks, a heading and a link to the employer.

    The job's location is a list, an object or missing; its skills a list or a text; its experience
    an object, a text or missing. A line break stands inside a JSON string, as on real pages.
    """
    spread = "o_orderkey % 3"
    loc = """concat('{"address":{"streetAddress":"street ', o_custkey, '","postalCode":"', o_custkey % 100, '"}}')"""
    doc = f"""concat('{{"@type":"JobPosting","title":"Job ', o_orderpriority, '","description":"<li>Line one&\\nA &amp; B</li>',
      o_orderkey, '","datePosted":"', {_DAY.format(s='STRING')}, '","industry":"', o_orderpriority, '","jobBenefits":"<br>', o_orderstatus,
      '","hiringOrganization":{{"name":"Công ty TNHH Firm ', o_custkey, '","url":"{SITE}/nha-tuyen-dung/firm.', o_custkey,
      '.html","sameAs":"http://d', o_custkey, '.vn/","logo":"l', o_custkey, '.png","description":"about ', o_custkey, '"}}',
      ',"identifier":{{"name":"n","value":"', o_custkey, '"}},"employmentType":["FULL_TIME","', o_orderstatus, '"]',
      ',"baseSalary":{{"currency":"VND","minValue":', {_MIN}, ',"value":{{"minValue":', {_MIN}, ',"maxValue":', {_MIN} + 1000, ',"unitText":"MONTH"}}}}',
      CASE {spread} WHEN 0 THEN concat(',"jobLocation":[', {loc}, ']') WHEN 1 THEN concat(',"jobLocation":', {loc}) ELSE '' END,
      CASE {spread} WHEN 0 THEN ',"skills":["a","b"]' ELSE ',"skills":"c"' END,
      CASE {spread} WHEN 0 THEN concat(',"experienceRequirements":{{"monthsOfExperience":', o_custkey % 24, '}}')
        WHEN 1 THEN ',"experienceRequirements":"2 năm"' ELSE '' END, '}}')"""
    html = f"""concat('<!DOCTYPE html><html lang="vi"><head><title>Job &amp; ', o_orderkey, '</title>',
      '<link rel="canonical" href="{SITE}/c/', o_orderkey, '"><meta name="description" content="d', o_custkey, '">',
      '<script type="application/ld+json">{{"@type":"BreadcrumbList"}}</script>',
      '<script type="application/ld+json">', {doc}, '</script></head><body><div class="job-desc"><h1>Job ', o_orderpriority, '</h1></div>',
      '<a class="employer job-company-name" href="{SITE}/nha-tuyen-dung/firm.', o_custkey, '.html">Firm ', o_custkey, '</a>',
      '<a href="/viec-lam/', o_custkey, '.html">similar</a><a href="/viec-lam/', o_custkey, '.html">similar</a>',
      CASE WHEN o_orderkey % 2 = 0 THEN concat('<a rel="next" href="?page=', o_orderkey % 10 + 1, '">next</a>') ELSE '' END,
      '</body></html>')"""
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS page_id", f"concat('{SITE}/viec-lam/', o_orderkey, '{tail}') AS url", f"{html} AS html"
    )


def profile_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One employer page per customer: business-profile block, embedded state, labelled details."""
    profile = """concat('{"@type":"Professionalservice","name":"Công ty Cổ phần Firm ', c_custkey, '","founder":"F', c_custkey,
      '","email":"e', c_custkey, '@x.vn","location":{"address":{"streetAddress":"street ', c_custkey % 97, '","addressRegion":"R', c_nationkey, '"}}',
      ',"sameAs":["s1","s', c_custkey, '"],"openingHoursSpecification":[{"dayOfWeek":["Mo","Tu"],"opens":"08:00","closes":"17:00"}',
      CASE WHEN c_custkey % 2 = 0 THEN ',{"dayOfWeek":["Sa"],"opens":"09:00","closes":"12:00"}' ELSE '' END, ']}')"""
    state = """concat('{"props":{"initialState":{"api":{"employerDetail":{"data":{"id":', c_custkey, ',"name":"CÔNG TY TNHH Firm ', c_custkey,
      '","slug":"firm-', c_custkey, '","address":"street ', c_custkey % 97, '","province":', c_nationkey,
      CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat(',"tax_code":"T', c_custkey, '"') END, '}}}}}}')"""
    html = f"""concat('<html><head><script type="application/ld+json">', {profile}, '</script>',
      CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '' ELSE concat('<script id="__NEXT_DATA__" type="application/json">', {state}, '</script>') END,
      '</head><body><i class="cli-map-pin-line d-flex mr-2">at ', c_custkey % 97, '</i>',
      '<div class="element_detail"><div class="in"><span>Quy mô:</span></div><p> ', c_nationkey, '&ndash;99 <b>người</b></p></div>',
      '<div class="element_detail"><span>Email</span><p>Email</p><p>e', c_custkey, '@x.vn</p></div>',
      '<p class="item_if">Bằng cấp</p> <span>Đại  học <i>', c_custkey % 7, '</i></span>',
      '</body></html>')"""
    return dealt(spark, sf, "customer", "c_custkey", "c_nationkey", "c_mktsegment").selectExpr(
        "c_custkey AS page_id", f"concat('{SITE}/viec-lam-cua/', c_custkey) AS url", f"{html} AS html"
    )


def answers(spark: SparkSession, sf: str) -> DataFrame:
    """One search answer per order, with two jobs in it."""
    item = """concat('{{"jobId":', o_orderkey * 2 + {i}, ',"jobUrl":"u', o_orderkey, '","jobTitle":"T ', o_orderpriority, '","companyName":"Công ty TNHH Firm ', o_custkey,
      '","companyId":', o_custkey, ',"companySize":"', o_custkey % 50, '","companyProfile":"<li>p&amp;q</li>","address":"street ', o_custkey,
      '","workingLocations":[{{"address":"a', o_custkey, '"}},{{"city":"x"}}],"salaryMin":', CAST(floor(o_totalprice) AS BIGINT),
      ',"salaryMax":', CAST(floor(o_totalprice) AS BIGINT) * 2, ',"skills":[{{"skillName":"s{i}"}},{{"skillName":"t"}}],"benefits":[{{"benefitValue":"b"}}],',
      '"jobDescription":"<li>x</li><br> y ","industriesV3":[{{"industryV3Name":"', o_orderstatus, '"}}]}}')"""
    body = f"""concat('{{"meta":{{"nbPages":', o_orderkey % 4, '}},"data":[', {item.format(i=0)}, ',', {item.format(i=1)}, ']}}')"""
    return table(spark, sf, "orders").selectExpr("o_orderkey AS answer_id", f"{body} AS body")


def markup_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One page per customer in the markup of sources that have no structured blocks."""
    html = """concat('<h1 class="com_post" data-id="', c_custkey, '">Job <b>', c_mktsegment, '</b> &amp; co</h1>',
      CASE WHEN c_custkey % 2 = 0 THEN concat('<p class="x mluong_mbi">', c_nationkey, ' triệu</p>') ELSE '<p class="mluong">Thỏa thuận</p>' END,
      '<a class="com_name" href="https://x.vn/cong-ty/', c_nationkey, '"><p class="com_name_text">Firm ', c_nationkey, '</p></a>',
      '<p class="index">Ngành nghề: <a class="tag">', c_mktsegment, '</a><a class="tag">Khác</a></p>',
      '<p class="item_if">Bằng cấp</p><span>Đại học</span><p class="item_if">Số lượng cần tuyển:</p><span>', c_custkey % 9, ' người</span>',
      '<div><h2>Mô tả công việc</h2></div><div class="text_content"><div>line ', c_custkey, '</div><p>more</p></div><div class="text_content">other</div>',
      '<div class="a ycau_tdung"><div><div>need ', c_custkey % 5, '</div></div></div>',
      '<h1 class="company-detail-name text-highlight">Công ty TNHH Firm ', c_custkey, '</h1><div class="desc"> street ', c_custkey % 97, ', X </div>',
      '<div class="content"><div><p>about ', c_custkey, '</p></div><p>end</p>no</div>',
      '<div class="company-subdetail-info website"><a href="http://d', c_custkey, '.vn//">w</a></div>',
      '<span class="company-subdetail-info-text">X</span><span class="company-subdetail-info-text"> ', c_nationkey, '-99 nhân viên </span>')"""
    return dealt(spark, sf, "customer", "c_custkey", "c_nationkey", "c_mktsegment").selectExpr(
        "c_custkey AS page_id", "concat('https://x.vn/p/', c_custkey, '.html') AS url", f"{html} AS html"
    )


# one list page per customer, of one of these sources: entries, pager, links that are meant, next page
_TAIL = "<!-- <a class=\"job_link company\" rel=\"next\" target=\"_blank\" href=\"/comment\">c</a> --><script>var a = '<a class=\"job_link company\" target=\"_blank\" href=\"/viec-lam/script\">';</script>"
_ROUND = "h-8 w-8 rounded-full bg-white border border-se-blue-10 flex justify-center items-center cursor-pointer"
LISTS = [
    ("careerviet", "recruit", "<a class='job_link big' href='/j/{c}?a=1&amp;b=2'>x</a><a href='/menu'>m</a>", '<li class="page-item next-page"><a href="?page=2&#38;c={c}">2</a></li>', ["/j/{c}?a=1&b=2"], "?page=2&c={c}"),
    ("careerviet", "company", '<div class="caption"><a class="company-name">n</a><a href="/e/{c}" class=job_link>x</a></div><a class="job_link" href="/other">o</a>', "", ["/e/{c}"], None),
    ("jobsgo", "index", '<a href="/viec-lam-{c}.html">x</a><a href="/cong-ty">y</a>', "", ["/viec-lam-{c}.html"], None),
    ("jobsgo", "recruit", '<a href="/no">n</a><div class="col-grid x"><div><a href="/j/{c}">x</a><a href="/j/{c}">x</a></div></div><a href="/after">a</a>', "", ["/j/{c}"], None),
    ("jobsgo", "company", "<p><a href='/tuyen-dung/{c}'>x</a><p><a href='/blog'>b</a>", "", ["/tuyen-dung/{c}"], None),
    ("timviec365", "recruit", '<a class="title_cate tag_th" href=/j/{c}>x</a><a class="tag_th" href="/tag">t</a>', "<ul><li><a href='/p/1'>1</a><li class='pagi_pre on'><a href='/p/{c}'>next</a></ul>", ["/j/{c}"], "/p/{c}"),
    ("timviec365", "company", '<h2 class="box_mb box_new_left_mb"><a href="/c/{c}">x</a></h2><h2 class="box_mb"><a href="/d">d</a></h2>', "", ["/c/{c}"], None),
    ("topcv", "index", '<div class="ctn-list-jobs"><div><div><a href="/i/{c}">x</a></div></div><a href="/direct">d</a></div><div class="ctn-list-jobs"><div><div><a href="/second">x</a></div></div></div>', "", ["/i/{c}"], None),
    ("topcv", "recruit", '<a href="/viec-lam/menu">m</a><div data-box="BoxSearchResult"><a href="/viec-lam/{c}">x</a><a href="/cong-ty/{c}">y</a></div>', "", ["/viec-lam/{c}"], None),
    ("topcv", "company", '<a class="company" href="/cong-ty/{c}">x</a><a class="company" href="/cong-ty/{c}">again</a><a class="companies" href="/all">y</a>', "", ["/cong-ty/{c}"], None),
    ("vieclam24h", "recruit", "".join(f'<a target="_blank" href="/v/{i}-{{c}}">x</a>' for i in range(32)) + '<a href="/same">s</a>', f'<a class="{_ROUND}" href="?page=1">1</a><a class="{_ROUND} on" href="?page=2&amp;c={{c}}">2</a>', [f"/v/{i}-{{c}}" for i in range(30)], "?page=2&c={c}"),
    ("careerlink", "index", '<div class="jobs-quick-category"><ul><li><a href="/k/{c}">x</a></ul></div><a href="/no">n</a>', "", ["/k/{c}"], None),
    ("careerlink", "recruit", '<a class="job-link clickable-outside" href="/tim-viec-lam/{c}">x</a><a class="job-link" href="/no">n</a>', "<a rel='next' href='/trang/{c}'>next</a>", ["/tim-viec-lam/{c}"], "/trang/{c}"),
    ("careerlink", "company", '<a href="/viec-lam-cua/{c}">x</a>', '<a href="/trang/{c}" rel="next nofollow">next</a>', ["/viec-lam-cua/{c}"], "/trang/{c}"),
]


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _with_key(template: str | None, text: str) -> str:
    return "NULL" if template is None else f"replace({_quoted(template)}, '{{c}}', CAST(c_custkey AS {text}))"


def list_pages(spark: SparkSession, sf: str) -> DataFrame:
    """List pages with links in comments, scripts and menus, in any quoting, with more than one class."""
    html = " ".join(f"WHEN {i} THEN {_with_key(x[2] + x[3] + _TAIL, 'STRING')}" for i, x in enumerate(LISTS)).replace("''", "\\'")
    source = " ".join(f"WHEN {i} THEN '{x[0]} {x[1]}'" for i, x in enumerate(LISTS))
    turn = f"CASE c_custkey % {len(LISTS)}"
    return dealt(spark, sf, "customer", "c_custkey").selectExpr(
        "c_custkey AS page_id", f"concat('{SITE}/list/', c_custkey) AS url", f"{turn} {source} END AS source", f"{turn} {html} END AS html"
    )


def list_pages_sql(next_page: bool) -> str:
    """The links that are meant, or the next pages."""
    parts = []
    for i, (media, kind, _, _, links, after) in enumerate(LISTS):
        for link in [after] if next_page else links:
            base = f"'{SITE}/list/' || c_custkey" if link and link.startswith("?") else f"'{SITE}'"
            parts.append(f"SELECT c_custkey AS page_id, '{media} {kind}' AS source, {base} || {_with_key(link, 'VARCHAR')} AS link FROM customer WHERE c_custkey % {len(LISTS)} = {i}")
    return " UNION ALL ".join(parts)


def trap_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Detail pages whose labels also stand in menus, with breaks, entities and single quotes."""
    html = """concat("<ul><li><p>Giới tính</p><span>Trang chủ</span></li><li><div>Cấp bậc</div></li></ul>",
      "<h1 class='x com_post' data-id='", c_custkey, "'>A &amp; B <b>", c_nationkey, "</b></h1><!-- <h1 id='job-title'>no</h1> -->",
      "<h1 id='job-title'> C &amp;amp; D ", c_custkey, "</h1><a class='com_name' href='/cong-ty/", c_nationkey, "?a=1&amp;b=2'><p class='com_name_text'>R&amp;D</p></a>",
      "<p class='item_if one'>Giới tính</p><br><!-- x --><i></i><span>Nam ", c_custkey % 3, "</span><span>no</span>",
      "<p class='item_if'> Bằng  cấp\n</p><br/><span>Đại học</span><p class='item_if'>Độ tuổi</p></div>",
      "<script>document.write('<p class=item_if>Độ tuổi</p><span>99</span>')</script>",
      "<div><div>Cấp bậc</div><br><p>x</p><div>Trưởng &amp; phó</div></div><a title='Firm &quot;", c_custkey, "&quot;' href='/viec-lam-cua/f/", c_custkey, "'>f</a>")"""
    return dealt(spark, sf, "customer", "c_custkey", "c_nationkey").selectExpr("c_custkey AS page_id", f"concat('{SITE}/p/', c_custkey) AS url", f"{html} AS html")
