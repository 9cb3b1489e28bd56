"""Records out of pages and API answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobmeld.operators import extract as ex, markup
from jobmeld.queries.base import query, table
from jobmeld.queries.lookalikes import (
    SITE,
    answers,
    job_pages,
    list_pages,
    list_pages_sql,
    markup_pages,
    profile_pages,
    trap_pages,
)
from jobmeld.sources.schema import consolidate

_MIN = "CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR)"
_MAX = "CAST(CAST(floor(o_totalprice) AS BIGINT) + 1000 AS VARCHAR)"
_DAY = "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)"
_STREET = "CASE WHEN o_orderkey % 3 < 2 THEN concat('street ', o_custkey) END"
_POSTAL = "CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_custkey % 100 AS VARCHAR) END"
_EXP = """CASE o_orderkey % 3 WHEN 0 THEN CASE WHEN o_custkey % 24 = 0 THEN 'Không rõ' ELSE concat(o_custkey % 24, ' tháng') END
  WHEN 1 THEN '2 năm' ELSE 'Không rõ' END"""


@query(
    "ext1_jsonld_blocks",
    """SELECT o_orderkey AS page_id, i AS block_no, CASE i WHEN 0 THEN 'BreadcrumbList' ELSE 'JobPosting' END AS kind
       FROM orders, (VALUES (0), (1)) t(i)""",
)
def _(spark, sf):
    return ex.jsonld_blocks(job_pages(spark, sf), None).select("page_id", "block_no", ex.at("['@type']").alias("kind"))


@query("flt7_marked_blocks", "SELECT o_orderkey AS page_id, 1 AS block_no FROM orders")
def _(spark, sf):
    return ex.jsonld_blocks(job_pages(spark, sf)).select("page_id", "block_no")


@query(
    "ext2_jobs_topcv",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS job_id, concat('Job ', o_orderpriority) AS job_title, CAST(o_custkey AS VARCHAR) AS job_company_id,
          concat('Công ty TNHH Firm ', o_custkey) AS job_company_name, concat('http://d', o_custkey, '.vn/') AS job_company_url,
          concat('- Line one&A & B', chr(10), o_orderkey) AS job_description, {_MIN} AS job_min_salary, {_MAX} AS job_max_salary, 'VND' AS job_salary_currency,
          {_DAY} AS job_posted_date, {_STREET} AS job_street_address, {_POSTAL} AS job_postal_code,
          CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey % 24 AS VARCHAR) END AS job_experience_requirements, concat(chr(10), o_orderstatus) AS job_benefits
        FROM orders""",
)
def _(spark, sf):
    return ex.job_postings(job_pages(spark, sf), "topcv").select(
        "job_id", "job_title", "job_company_id", "job_company_name", "job_company_url", "job_description", "job_min_salary",
        "job_max_salary", "job_salary_currency", "job_posted_date", "job_street_address", "job_postal_code",
        "job_experience_requirements", "job_benefits",
    )


@query(
    "ext2_jobs_careerviet",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS job_id, concat('Job ', o_orderpriority) AS job_title, concat('Firm ', o_custkey) AS job_company_name,
          concat('{SITE}/nha-tuyen-dung/firm.', o_custkey, '.html') AS job_company_url, CAST(o_custkey AS VARCHAR) AS job_company_id,
          o_orderpriority AS job_industry, {_DAY} AS job_created_at, '' AS job_salary, {_MIN} AS job_min_salary, {_MAX} AS job_max_salary, 'MONTH' AS job_salary_level,
          concat('FULL_TIME,', o_orderstatus) AS employment, coalesce({_STREET}, '') AS job_street_address,
          concat('<li>Line one&A &amp; B</li>', o_orderkey) AS job_description
        FROM orders""",
)
def _(spark, sf):
    return ex.job_postings(job_pages(spark, sf), "careerviet").select(
        "job_id", "job_title", "job_company_name", "job_company_url", "job_company_id", "job_industry", "job_created_at", "job_salary",
        "job_min_salary", "job_max_salary", "job_salary_level", F.array_join("job_employment_type", ",").alias("employment"),
        "job_street_address", "job_description",
    )


@query(
    "ext2_jobs_jobsgo",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS job_id, {_EXP} AS job_exp_requirement, {_MIN} AS job_min_salary, concat('FULL_TIME, ', o_orderstatus) AS job_employment_type,
          o_orderpriority AS job_industry, concat('firm.', o_custkey, '.html') AS job_company_id, {_POSTAL} AS postal_code, 'VND' AS job_salary_unit FROM orders""",
)
def _(spark, sf):
    pages = job_pages(spark, sf, "").withColumn("url", F.concat(F.lit(SITE + "/viec-lam/x-y-"), F.col("page_id")))
    return ex.job_postings(pages, "jobsgo").select(
        "job_id", "job_exp_requirement", "job_min_salary", "job_employment_type", "job_industry", "job_company_id", "postal_code", "job_salary_unit"
    )


@query(
    "ext2_jobs_vieclam24h",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS job_id, CASE WHEN o_orderkey % 3 = 0 THEN 'a, b' ELSE 'c' END AS job_skills, coalesce({_STREET}, '') AS job_street_address,
          {_MIN} AS job_min_salary, {_MAX} AS job_max_salary, '' AS job_currency, CAST(o_custkey AS VARCHAR) AS job_company_id, concat('l', o_custkey, '.png') AS job_company_logo FROM orders""",
)
def _(spark, sf):
    return ex.job_postings(job_pages(spark, sf), "vieclam24h").select(
        "job_id", "job_skills", "job_street_address", "job_min_salary", "job_max_salary", "job_currency", "job_company_id", "job_company_logo"
    )


@query(
    "ext3_posting_companies",
    f"""SELECT CAST(o_custkey AS VARCHAR) AS company_id, concat('Công ty TNHH Firm ', o_custkey) AS company_name, concat('firm ', o_custkey) AS company_only_name,
          concat('http://d', o_custkey, '.vn/') AS company_domain, concat('about ', o_custkey) AS company_description, coalesce({_STREET}, '') AS company_address, '' AS company_postal_code
        FROM orders""",
)
def _(spark, sf):
    return ex.posting_companies(job_pages(spark, sf)).select(
        "company_id", "company_name", "company_only_name", "company_domain", "company_description", "company_address", "company_postal_code"
    )


@query(
    "ext4_service_companies",
    """SELECT CAST(c_custkey AS VARCHAR) AS company_id, concat('firm ', c_custkey) AS company_only_name, concat('F', c_custkey) AS company_representative,
         concat('e', c_custkey, '@x.vn') AS company_email, concat('street ', c_custkey % 97) AS company_street_address, concat('R', c_nationkey) AS company_address_address,
         '' AS company_postal_code, concat('at ', c_custkey % 97) AS company_address, concat('s1,s', c_custkey) AS social,
         concat('Mo=08:00 - 17:00;', CASE WHEN c_custkey % 2 = 0 THEN 'Sa=09:00 - 12:00;' ELSE '' END, 'Tu=08:00 - 17:00') AS hours FROM customer""",
)
def _(spark, sf):
    hours = F.array_sort(F.map_entries("company_working_hours"))
    return ex.service_companies(profile_pages(spark, sf)).select(
        "company_id", "company_only_name", "company_representative", "company_email", "company_street_address", "company_address_address",
        "company_postal_code", "company_address", F.array_join("company_social_url", ",").alias("social"),
        F.array_join(F.transform(hours, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("hours"),
    )


@query(
    "ext5_state_companies",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS company_id, concat('{SITE}/viec-lam-cua/', c_custkey) AS source_company_url, concat('firm ', c_custkey) AS company_only_name,
          concat('firm-', c_custkey) AS company_slug, CAST(c_nationkey AS VARCHAR) AS company_province_id,
          CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat('T', c_custkey) END AS company_tax_code
        FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'""",
)
def _(spark, sf):
    return ex.state_companies(profile_pages(spark, sf)).select(
        "company_id", "source_company_url", "company_only_name", "company_slug", "company_province_id", "company_tax_code"
    )


@query(
    "ext6_api_jobs",
    """SELECT o_orderkey * 2 + i AS job_id, o_custkey AS job_company_id, concat('T ', o_orderpriority) AS job_title, CAST(floor(o_totalprice) AS BIGINT) AS job_salary_min,
         concat('a', o_custkey, '|') AS places, concat('s', i, '|t') AS skills, 'b' AS benefits, concat('- x', chr(10), chr(10), ' y') AS job_description, '' AS job_requirement
       FROM orders, (VALUES (0), (1)) t(i)""",
)
def _(spark, sf):
    return ex.api_jobs(answers(spark, sf)).select(
        "job_id", "job_company_id", "job_title", "job_salary_min", F.array_join("job_locations", "|").alias("places"),
        F.array_join("job_skills", "|").alias("skills"), F.array_join("job_benefits", "|").alias("benefits"), "job_description", "job_requirement",
    )


@query(
    "ext6_api_companies",
    """SELECT o_custkey AS company_id, concat('firm ', o_custkey) AS company_only_name, '- p&q' AS company_profile, CAST(o_custkey % 50 AS VARCHAR) AS company_size,
         o_orderstatus AS industry FROM orders, (VALUES (0), (1)) t(i)""",
)
def _(spark, sf):
    return ex.api_companies(answers(spark, sf)).select("company_id", "company_only_name", "company_profile", "company_size", "industry")


@query("ext7_page_numbers", "SELECT o_orderkey AS answer_id, CAST(unnest(range(0, o_orderkey % 4 + 1)) AS INT) AS page FROM orders")
def _(spark, sf):
    return ex.page_numbers(answers(spark, sf)).select("answer_id", "page")


@query(
    "ext8_labelled_values",
    """SELECT c_custkey AS page_id, concat(c_nationkey, '–99 người') AS "Quy mô", concat('e', c_custkey, '@x.vn') AS "Email", '' AS "Website" FROM customer""",
)
def _(spark, sf):
    return markup.labelled_values(profile_pages(spark, sf), ["Quy mô", "Email", "Website"]).drop("url")


@query("ext8_sibling_value", "SELECT c_custkey AS page_id, concat('Đại học ', c_custkey % 7) AS degree FROM customer")
def _(spark, sf):
    return profile_pages(spark, sf).select("page_id", ex.sibling_value(F.col("html"), "Bằng cấp").alias("degree"))


@query(
    "ext8_markup_jobs",
    """SELECT CAST(c_custkey AS VARCHAR) AS job_id, concat('Job ', c_mktsegment, ' & co') AS job_title,
         CASE WHEN c_custkey % 2 = 0 THEN concat(c_nationkey, ' triệu') ELSE 'Thỏa thuận' END AS job_salary, concat('Firm ', c_nationkey) AS job_company_name,
         CAST(c_nationkey AS VARCHAR) AS job_company_id, concat(c_mktsegment, '|Khác') AS industries, 'Đại học' AS degree, concat(c_custkey % 9, ' người') AS headcount,
         concat('line ', c_custkey, chr(10), 'more') AS job_description, concat('need ', c_custkey % 5) AS requirements, '' AS benefits FROM customer""",
)
def _(spark, sf):
    return ex.extract_jobs(markup_pages(spark, sf), "timviec365").select(
        "job_id", "job_title", "job_salary", "job_company_name", "job_company_id", F.array_join("industries", "|").alias("industries"),
        "degree", "headcount", "job_description", "requirements", "benefits",
    )


@query(
    "ext9_markup_companies",
    """SELECT CAST(c_custkey AS VARCHAR) AS company_id, concat('firm ', c_custkey) AS company_only_name, 'end' AS company_description,
         concat('street ', c_custkey % 97, ', X') AS company_address, concat('http://d', c_custkey, '.vn') AS company_domain, concat(c_nationkey, '-99') AS company_size FROM customer""",
)
def _(spark, sf):
    return ex.extract_companies(markup_pages(spark, sf), "topcv").select(
        "company_id", "company_only_name", "company_description", "company_address", "company_domain", "company_size"
    )


_SQL_TEXT = "replace(nullif(regexp_extract(html, '(?s)<{t}[^>]*>([^<]*)', 1), ''), '&amp;', '&')"


@query(
    "ext9_page_facts",
    f"""SELECT page_id, replace({_SQL_TEXT.format(t='title')}, '&quot;', '"') AS title, replace({_SQL_TEXT.format(t='h1')}, '&quot;', '"') AS heading,
          regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang FROM pages""",
)
def _(spark, sf):
    return ex.page_facts(table(spark, sf, "pages")).select("page_id", "title", "heading", "lang")


@query(
    "ext9_head_attributes",
    f"""SELECT o_orderkey AS page_id, concat('Job & ', o_orderkey) AS title, concat('{SITE}/c/', o_orderkey) AS canonical, concat('d', o_custkey) AS description FROM orders""",
)
def _(spark, sf):
    return ex.page_facts(job_pages(spark, sf)).select("page_id", "title", "canonical", "description")


_HREFS = """SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]+') AS site, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages"""


@query("ext10_links", f"SELECT DISTINCT page_id, concat(site, href) AS link FROM ({_HREFS})")
def _(spark, sf):
    return ex.outgoing(table(spark, sf, "pages")).select("page_id", "link")


@query("ext10_links_containing", f"SELECT DISTINCT concat(site, href) AS link FROM ({_HREFS}) WHERE contains(href, '/th')")
def _(spark, sf):
    links = ex.outgoing(table(spark, sf, "pages"), "/th")
    return links.select("link").distinct()


@query("ext10_by_class", list_pages_sql(False))
def _(spark, sf):
    pages, parts = list_pages(spark, sf), []
    for media, kind in ex.LISTINGS:
        mine = pages.filter(F.col("source") == f"{media} {kind}")
        parts.append(ex.listed(mine, media, kind).select("page_id", F.lit(f"{media} {kind}").alias("source"), "link"))
    return consolidate(parts)


@query("ext11_pager", list_pages_sql(True))
def _(spark, sf):
    pages, parts = list_pages(spark, sf), []
    for media, kind in ex.LISTINGS:
        mine = pages.filter(F.col("source") == f"{media} {kind}")
        parts.append(mine.select("page_id", "source", ex.next_page(F.col("url"), F.col("html"), media, kind).alias("link")))
    return consolidate(parts)


@query(
    "ext8_traps",
    """SELECT CAST(c_custkey AS VARCHAR) AS job_id, concat('A & B ', c_nationkey) AS job_title, concat('/cong-ty/', c_nationkey, '?a=1&b=2') AS job_company_url,
         'R&D' AS job_company_name, concat('Nam ', c_custkey % 3) AS gender, 'Đại học' AS degree, '' AS age FROM customer""",
)
def _(spark, sf):
    return ex.extract_jobs(trap_pages(spark, sf), "timviec365").select(
        "job_id", "job_title", "job_company_url", "job_company_name", "gender", "degree", "age"
    )


@query(
    "ext9_traps",
    """SELECT CAST(c_custkey AS VARCHAR) AS job_id, concat(' C &amp; D ', c_custkey) AS job_title, concat('Firm "', c_custkey, '"') AS job_company_name,
         CAST(c_custkey AS VARCHAR) AS job_company_id, 'Trưởng & phó' AS job_position FROM customer""",
)
def _(spark, sf):
    return ex.extract_jobs(trap_pages(spark, sf), "careerlink").select(
        "job_id", "job_title", "job_company_name", "job_company_id", "job_position"
    )


@query("lim2_first_links", """SELECT page_id, len(list_slice(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1, 4)) AS n,
  array_to_string(list_slice(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1, 4), ' ') AS links FROM pages""")
def _(spark, sf):
    links = ex.first_links(F.col("html"), 4)
    return table(spark, sf, "pages").select("page_id", F.size(links).alias("n"), F.array_join(links, " ").alias("links"))


@query("lim3_last_link", """SELECT page_id, list_extract(regexp_extract_all(html, '<a href="([^"]*)"', 1), -1) AS link FROM pages""")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", ex.last_link(F.col("html")).alias("link"))


@query(
    "ext11_next_page",
    f"""SELECT o_orderkey AS page_id, CASE WHEN o_orderkey % 2 = 0 THEN concat('{SITE}/viec-lam/', o_orderkey, '.html?page=', o_orderkey % 10 + 1) END AS next_page FROM orders""",
)
def _(spark, sf):
    return job_pages(spark, sf).select("page_id", ex.next_page(F.col("url"), F.col("html")).alias("next_page"))


@query(
    "ext12_parent_context",
    f"""SELECT p.o_orderkey AS parent_id, concat('{SITE}/viec-lam/', p.o_custkey, '.html') AS link, concat('Job ', p.o_orderpriority) AS context, c.o_orderkey AS child_id
        FROM orders p LEFT JOIN orders c ON c.o_orderkey = p.o_custkey""",
)
def _(spark, sf):
    return ex.with_parent_context(job_pages(spark, sf), ex.tag_text(F.col("html"), "h1"), "/viec-lam/")


@query(
    "ext13_location",
    f"SELECT o_orderkey AS page_id, {_STREET} AS street, {_POSTAL} AS postal_code FROM orders",
)
def _(spark, sf):
    return ex.jsonld_blocks(job_pages(spark, sf)).select(
        "page_id", ex.location("streetAddress").alias("street"), ex.location("postalCode").alias("postal_code")
    )
