"""Records out of crawled pages: structured blocks, embedded state, API answers, markup, links.

Input is a page table `pages(page_id, url, html)`. JSON is parsed once per block into a variant and
read by path; a path that is absent or of another shape gives null.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from jobmeld.functions import text as tx, urls
from jobmeld.functions.address import split_address
from jobmeld.functions.binding import bind, detached
from jobmeld.functions.names import name_key
from jobmeld.functions.numbers import as_array
from jobmeld.operators.markup import El, Field, elements, labelled, only, read_fields, with_fields, without_label

# What marks a block as a job or as a company profile
JOB_MARKER = "JobPosting"
SERVICE_MARKER = "Professionalservice"

_JSONLD = r"""(?is)<script[^>]*\stype\s*=\s*["']?application/ld\+json["']?[^>]*>(.*?)</script>"""
_STATE = r"""(?is)<script[^>]*\sid\s*=\s*["']?__NEXT_DATA__["']?[^>]*>(.*?)</script>"""


# ---- structured blocks --------------------------------------------------------------------------
def jsonld_blocks(pages: DataFrame, marker: str | None = JOB_MARKER, fields: Mapping[str, Field] | None = None) -> DataFrame:
    """One row per JSON-LD block that contains `marker`, parsed into `doc` (EXT1, FLT7, NRM9).

    Line breaks and tabs are removed first: sites put them inside strings, where JSON forbids them. `fields`
    of the page's markup come as columns beside.
    """
    blocks = F.regexp_extract_all("html", F.lit(_JSONLD), F.lit(1))
    if marker:
        blocks = F.transform(blocks, lambda b: F.when(b.contains(marker), b))
    beside = list(fields or {})
    read = [read_fields(F.col("html"), fields).alias("_read")] if fields else []
    rows = pages.select("page_id", "url", "html", *read, F.posexplode(blocks).alias("block_no", "raw"))
    return rows.filter(F.col("raw").isNotNull()).select(
        "page_id", "url", "html", "block_no", F.try_parse_json(tx.strip_controls(F.col("raw"))).alias("doc"),
        *[F.col("_read")[f].alias(f) for f in beside],
    )


def at(path: str, dtype: str = "string", doc: str = "doc") -> Column:
    """A value of the parsed block by path."""
    dot = "" if path.startswith("[") else "."
    return F.try_variant_get(F.col(doc), f"${dot}{path}", dtype)


def either(path_a: str, path_b: str, dtype: str = "string", doc: str = "doc") -> Column:
    """The first of two paths that gives a value: a list or an object in the same place (EXT13)."""
    return F.coalesce(at(path_a, dtype, doc), at(path_b, dtype, doc))


def location(part: str) -> Column:
    """Part of the first job location, which may be a list or an object (EXT13)."""
    return either(f"jobLocation[0].address.{part}", f"jobLocation.address.{part}")


def text_at(path: str) -> Column:
    """A list joined to text, or the text itself (NRM15)."""
    return tx.list_or_text(F.col("doc"), f"$.{path}")


def blank(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def _job_columns(media: str) -> dict[str, Column]:
    """Where a source's job columns are found, in its JobPosting block or its page."""
    url = F.col("url")
    org = "hiringOrganization"
    if media == "careerviet":
        employer = only(F.col("_employer_url"))
        return {
            "type": F.lit("job"),
            "job_id": urls.page_id(url),
            "job_title": only(F.col("_title")),
            "job_company_name": only(F.col("_employer")),
            "job_company_url": employer,
            "job_benefits": blank(at("jobBenefits")),
            "job_industry": blank(at("industry")),
            "job_created_at": blank(at("datePosted")),
            "job_valid_through": blank(at("validThrough")),
            "job_description": tx.clean_text(at("description")),
            "source_job_url": url,
            "job_company_id": urls.dotted_id(employer, -2),
            "job_salary": blank(at("baseSalary.value.value")),
            "job_min_salary": blank(at("baseSalary.value.minValue")),
            "job_max_salary": blank(at("baseSalary.value.maxValue")),
            "job_salary_level": blank(at("baseSalary.value.unitText")),
            "job_exp_requirement": blank(at("experienceRequirements.monthsOfExperience")),
            "job_salary_currency": blank(at("baseSalary.value.currency")),
            "job_employment_type": F.coalesce(at("employmentType", "array<string>"), as_array(at("employmentType"))),
            "job_skills": blank(text_at("skills")),
            "job_working_hours": blank(at("workHours")),
            "job_education_requirement": blank(at("educationRequirements.credentialCategory")),
            "job_street_address": blank(location("streetAddress")),
        }
    if media == "jobsgo":
        company_url = at(f"{org}.url")
        return {
            "source_job_url": url,
            "job_id": urls.dash_id(url),
            "job_title": at("title"),
            "posted_at": at("datePosted"),
            "end_at": at("validThrough"),
            "job_employment_type": text_at("employmentType"),
            "job_exp_requirement": tx.months_of(F.col("doc"), "$.experienceRequirements"),
            "job_edu_requirement": at("educationRequirements.credentialCategory"),
            "job_min_salary": at("baseSalary.minValue"),
            "job_max_salary": at("baseSalary.maxValue"),
            "job_salary_unit": at("baseSalary.currency"),
            "job_industry": text_at("industry"),
            "job_description": at("description"),
            "job_benefit": at("jobBenefits"),
            "job_company_name": at(f"{org}.name"),
            "job_company_url": company_url,
            "job_company_id": urls.last_segment(F.nullif(company_url, F.lit(""))),
            "postal_code": location("postalCode"),
        }
    if media == "topcv":
        return {
            "job_id": urls.first_token(url),
            "source_job_url": url,
            "job_company_id": at("identifier.value"),
            "job_title": blank(at("title")),
            "job_company_name": blank(at(f"{org}.name")),
            "job_company_url": at(f"{org}.sameAs"),
            "job_company_logo": at(f"{org}.logo"),
            "job_description": tx.clean_html(blank(at("description"))),
            "job_industry": at("industry"),
            "job_street_address": location("streetAddress"),
            "job_district_address": location("addressLocality"),
            "job_city_address": location("addressRegion"),
            "job_postal_code": location("postalCode"),
            "job_country_address": location("addressCountry"),
            "job_min_salary": at("baseSalary.value.minValue"),
            "job_max_salary": at("baseSalary.value.maxValue"),
            "job_salary_currency": at("baseSalary.currency"),
            "job_posted_date": at("datePosted"),
            "job_valid_date": at("validThrough"),
            "job_employment_type": text_at("employmentType"),
            "job_level": at("occupationalCategory"),
            "job_experience_requirements": at("experienceRequirements.monthsOfExperience"),
            "job_skills": text_at("skills"),
            "job_total_openings": at("totalJobOpenings"),
            "job_benefits": tx.clean_html(blank(at("jobBenefits"))),
        }
    if media == "vieclam24h":
        return {
            "type": F.lit("job"),
            "source_job_url": url,
            "job_title": blank(at("title")),
            "job_id": urls.page_id(url),
            "job_employment_type": blank(text_at("employmentType")),
            "job_date_posted": blank(at("datePosted")),
            "job_valid_through": blank(at("validThrough")),
            "job_industry": blank(at("industry")),
            "job_education_requirements": blank(at("qualifications")),
            "job_min_salary": F.coalesce(at("baseSalary.value.minValue"), F.lit("0")),
            "job_max_salary": F.coalesce(at("baseSalary.value.maxValue"), F.lit("0")),
            "job_currency": blank(at("baseSalary.value.currency")),
            "job_description": blank(at("description")),
            "job_benefits": blank(at("benefits")),
            "job_skills": blank(text_at("skills")),
            "job_street_address": blank(location("streetAddress")),
            "job_postal_code": blank(location("postalCode")),
            "job_company_name": blank(at(f"{org}.name")),
            "job_company_url": blank(at(f"{org}.sameAs")),
            "job_company_id": blank(at("identifier.value")),
            "job_company_logo": blank(at(f"{org}.logo")),
        }
    raise KeyError(media)


_EMPLOYER = El("a", css="employer job-company-name")
# what a source's job columns take from the markup beside the block
_BESIDE_BLOCKS = {
    "careerviet": {
        "_title": Field(El("h1", within=El("div", css="job-desc")), "own"),
        "_employer": Field(_EMPLOYER, "own"),
        "_employer_url": Field(_EMPLOYER, "href"),
    }
}


def _fields(columns: Mapping[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in columns.items()]


def job_postings(pages: DataFrame, media: str) -> DataFrame:
    """Job rows from the JobPosting blocks of a source's pages (EXT2)."""
    return jsonld_blocks(pages, fields=_BESIDE_BLOCKS.get(media)).select(*_fields(_job_columns(media)))


def posting_companies(pages: DataFrame) -> DataFrame:
    """Company rows from the hiring organisation of JobPosting blocks (EXT3)."""
    org = "hiringOrganization"
    name, url = at(f"{org}.name"), at(f"{org}.url")
    return jsonld_blocks(pages).select(
        F.lit("company").alias("type"),
        urls.dotted_id(F.nullif(url, F.lit("")), -2).alias("company_id"),
        blank(name).alias("company_name"),
        F.when(name != "", name_key(name)).alias("company_only_name"),
        blank(at(f"{org}.sameAs")).alias("company_domain"),
        blank(at(f"{org}.description")).alias("company_description"),
        blank(url).alias("company_url"),
        blank(url).alias("source_company_url"),
        blank(at(f"{org}.logo")).alias("company_logo"),
        blank(location("streetAddress")).alias("company_address"),
        blank(either("jobLocation[0].postalCode", "jobLocation.postalCode")).alias("company_postal_code"),
    )


def service_companies(pages: DataFrame) -> DataFrame:
    """Company rows from business-profile blocks, with opening hours as a map (EXT4, NRM18)."""
    spec = "array<struct<dayOfWeek:array<string>,opens:string,closes:string>>"
    hours = F.coalesce(at("openingHoursSpecification", spec), F.array().cast(spec))
    name = at("name")
    place = {
        "company_street_address": "streetAddress",
        "company_adrress_district": "addressLocality",
        "company_address_address": "addressRegion",
        "company_address_country": "addressCountry",
        "company_postal_code": "postalCode",
    }
    plain = {
        "company_representative": "founder",
        "company_description": "description",
        "company_email": "email",
        "company_phone": "telephone",
        "company_homepage_url": "url",
        "company_logo": "logo",
        "company_price_range": "priceRange",
    }
    place_mark = {"_address": Field(El("i", css="cli-map-pin-line d-flex mr-2"), "own")}
    return jsonld_blocks(pages, SERVICE_MARKER, place_mark).select(
        urls.last_segment(F.col("url")).alias("company_id"),
        blank(name).alias("company_name"),
        F.when(name != "", name_key(name)).alias("company_only_name"),
        *[blank(at(p)).alias(c) for c, p in plain.items()],
        *[blank(at(f"location.address.{p}")).alias(c) for c, p in place.items()],
        only(F.col("_address")).alias("company_address"),
        F.coalesce(at("sameAs", "array<string>"), F.array().cast("array<string>")).alias("company_social_url"),
        at("open_hours").alias("company_open_hour"),
        tx.opening_hours(hours).alias("company_working_hours"),
    )


# ---- embedded state and API answers ---------------------------------------------------------------
def app_state(pages: DataFrame, fields: Mapping[str, Field] | None = None) -> DataFrame:
    """Pages with their embedded application state parsed into `doc`; pages without it fall out.

    `fields` of the page's markup come as columns beside.
    """
    raw = F.regexp_extract("html", _STATE, 1)
    with_state = pages.select("page_id", "url", "html", F.nullif(raw, F.lit("")).alias("raw")).filter("raw IS NOT NULL")
    read = [read_fields(F.col("html"), fields).alias("_read")] if fields else []
    return with_state.select("page_id", "url", "html", F.try_parse_json("raw").alias("doc"), *read).select(
        "page_id", "url", "html", "doc", *[F.col("_read")[f].alias(f) for f in fields or {}]
    )


def state_companies(pages: DataFrame) -> DataFrame:
    """Company rows from the embedded state of employer pages, one per company (EXT5)."""
    base = "props.initialState.api.employerDetail.data"
    plain = {
        "company_slug": "slug",
        "company_address": "address",
        "company_province_id": "province",
        "company_description": "description",
        "company_description_html": "description_html",
        "company_tax_code": "tax_code",
    }
    name = blank(at(f"{base}.name"))
    site = {"_site": Field(El("div", css="truncate", attr_part=("title", "https")), "title")}
    return app_state(pages, site).select(
        blank(at(f"{base}.id")).alias("company_id"),
        F.col("url").alias("source_company_url"),
        name.alias("company_name"),
        only(F.col("_site")).alias("company_domain"),
        name_key(name).alias("company_only_name"),
        *[blank(at(f"{base}.{p}")).alias(c) for c, p in plain.items()],
    )


_API_ITEM = """struct<
  jobId:bigint, jobUrl:string, jobTitle:string, companyName:string, companyId:bigint,
  companyProfile:string, companySize:string, companyLogo:string,
  workingLocations:array<struct<address:string>>, address:string, languageSelectedVI:string,
  salaryMin:bigint, salaryMax:bigint, prettySalary:string, salary:string,
  jobLevel:string, jobLevelVI:string, skills:array<struct<skillName:string>>,
  benefits:array<struct<benefitValue:string>>, jobDescription:string, jobRequirement:string,
  createdOn:string, expiredOn:string, typeWorkingId:string,
  industriesV3:array<struct<industryV3Name:string>>, visibilityDisplay:string>"""
API_SCHEMA = f"meta struct<nbPages:int>, data array<{_API_ITEM}>"


def _plucked(field: str, part: str) -> Column:
    empty = F.array().cast("array<string>")
    return F.coalesce(tx.pluck(F.col(field), part), empty)


def api_items(answers: DataFrame, body: str = "body") -> DataFrame:
    """One row per entry of `data` in a search answer, columns as the API names them."""
    return answers.select(F.from_json(body, API_SCHEMA).alias("a")).select(F.inline("a.data"))


def api_jobs(answers: DataFrame, body: str = "body") -> DataFrame:
    """Job rows from search answers (EXT6, NRM19)."""
    return api_items(answers, body).select(
        F.lit("job").alias("type"),
        F.col("jobId").alias("job_id"),
        F.col("jobUrl").alias("job_url"),
        F.col("jobTitle").alias("job_title"),
        F.col("companyName").alias("job_company_name"),
        F.col("companyId").alias("job_company_id"),
        _plucked("workingLocations", "address").alias("job_locations"),
        F.col("address").alias("job_address"),
        F.col("languageSelectedVI").alias("job_language_vi"),
        F.col("salaryMin").alias("job_salary_min"),
        F.col("salaryMax").alias("job_salary_max"),
        F.col("prettySalary").alias("job_salary_display"),
        F.col("salary").alias("job_salary_text"),
        F.col("jobLevel").alias("job_level"),
        F.col("jobLevelVI").alias("job_level_vi"),
        _plucked("skills", "skillName").alias("job_skills"),
        _plucked("benefits", "benefitValue").alias("job_benefits"),
        tx.clean_html_or_blank(F.col("jobDescription")).alias("job_description"),
        tx.clean_html_or_blank(F.col("jobRequirement")).alias("job_requirement"),
        F.col("createdOn").alias("job_posted_at"),
        F.col("expiredOn").alias("job_expired_at"),
        F.col("typeWorkingId").alias("type_working_id"),
        F.col("industriesV3").alias("job_industry"),
        F.col("visibilityDisplay").alias("visibility_display"),
    )


def api_companies(answers: DataFrame, body: str = "body") -> DataFrame:
    """Company rows from search answers (EXT6)."""
    name = F.col("companyName")
    return api_items(answers, body).select(
        F.lit("company").alias("type"),
        F.col("companyId").alias("company_id"),
        name.alias("company_name"),
        F.when(name != "", name_key(name)).alias("company_only_name"),
        tx.clean_html_or_blank(F.col("companyProfile")).alias("company_profile"),
        F.col("companySize").alias("company_size"),
        F.col("companyLogo").alias("company_logo"),
        F.col("address").alias("company_address"),
        blank(F.try_element_at("industriesV3", F.lit(1))["industryV3Name"]).alias("industry"),
    )


def page_numbers(answers: DataFrame, body: str = "body", plausible: int = 100_000) -> DataFrame:
    """Pages still to fetch, 0 to the stated count inclusive, one row each; 1 when not stated (EXT7).

    An answer that states more than `plausible` pages is taken for broken: it keeps one row, with a null page.
    """
    stated = F.coalesce(F.get_json_object(body, "$.meta.nbPages").try_cast("int"), F.lit(1))
    pages = F.when(stated <= plausible, F.sequence(F.lit(0), F.greatest(stated, F.lit(0))))
    return answers.select("*", F.explode(F.coalesce(pages, F.array(F.lit(None).cast("int")))).alias("page"))


# ---- markup -------------------------------------------------------------------------------------
def _el(tag: str, css: str | None, attr: str) -> El:
    if css is None:
        return El(tag)
    return El(tag, css=css) if attr == "class" else El(tag, attrs=((attr, css),))


def tag_text(html: Column, tag: str, css: str | None = None, attr: str = "class") -> Column:
    """First text of the first such element that is its own, not that of elements in it (EXT9).

    Elements are picked by class words, or by the whole value of another attribute. Null when there is none.
    Each of these functions reads the page; `with_fields` reads it once for all its fields.
    """
    return only(elements(html, _el(tag, css, attr), "own"))


def tag_text_within(html: Column, outer: str, css: str, tag: str) -> Column:
    """First text of the first `tag` in an `outer` element of the class (EXT9)."""
    return only(elements(html, El(tag, within=El(outer, css=css)), "own"))


def tag_attr(html: Column, tag: str, name: str, css: str | None = None, attr: str = "class") -> Column:
    """An attribute of the first such element that has it (EXT9)."""
    return only(elements(html, _el(tag, css, attr), name))


def page_facts(pages: DataFrame) -> DataFrame:
    """Title, first heading, canonical link, description and language of each page (EXT9)."""
    fields = {
        "title": Field(El("title"), "own"),
        "heading": Field(El("h1"), "own"),
        "canonical": Field(El("link", attrs=(("rel", "canonical"),)), "href"),
        "_plain": Field(El("meta", attrs=(("name", "description"),)), "content"),
        "_social": Field(El("meta", attrs=(("property", "og:description"),)), "content"),
        "lang": Field(El("html"), "lang"),
    }
    first = {f: only(F.col(f)) for f in fields}
    return with_fields(pages, fields, "page_id", "url").select(
        "page_id", "url", *[first[f].alias(f) for f in ("title", "heading", "canonical")],
        F.coalesce(first["_plain"], first["_social"]).alias("description"), first["lang"].alias("lang"),
    )


def beside(label: str, label_tag: str = "p", value_tag: str = "span", exact: bool = True, css: str | None = None) -> El:
    """The first `value_tag` behind an element that names the label: its text is the label, or its own text holds it."""
    named = El(label_tag, css=css, text=label) if exact else El(label_tag, css=css, own_has=label)
    return El(value_tag, after=named)


def sibling_value(
    html: Column, label: str, label_tag: str = "p", value_tag: str = "span", exact: bool = True, css: str | None = None
) -> Column:
    """Text of the first sibling behind the element with the label; name its class where others bear the label too (EXT8)."""
    return _cleaned(elements(html, beside(label, label_tag, value_tag, exact, css)))


def icon_value(html: Column, icon: str, tag: str = "span") -> Column:
    """Text of the first sibling behind an icon (EXT9)."""
    return _cleaned(elements(html, El(tag, after=El("i", css_part=icon))))


def element_text(html: Column, tag: str, css: str | None = None) -> Column:
    """All text of the first such element, white space collapsed; blank if none (EXT9). The class has to contain `css`."""
    return _cleaned(elements(html, El(tag, css_part=css)))


def _cleaned(texts: Column) -> Column:
    return tx.clean_text(only(texts))


# ---- records of sources without structured blocks --------------------------------------------------
_TIMVIEC_LABELS = {
    "job_employment_type": "Hình thức làm việc",
    "probation": "Thời gian thử việc",
    "degree": "Bằng cấp",
    "gender": "Giới tính",
    "age": "Độ tuổi",
}
_COM_NAME, _EMPLOYER_LINK = El("a", css_part="com_name"), El("a", attr_part=("href", "/viec-lam-cua/"))


def _section(title: str) -> El:
    return El("div", css_part="text_content", after=El("div", parent_of=El("h2", text=title)))


def _tagged(naming: str) -> El:
    return El("a", css="tag", within=El("p", css_part="index", has=naming))


# Where a source's job pages and company pages hold what
_JOB_FIELDS: dict[str, dict[str, Field]] = {
    "timviec365": {
        "_id": Field(El("h1", css_part="com_post"), "data-id"),
        "_title": Field(El("h1", css_part="com_post")),
        "_pay_range": Field(El("p", css_part="mluong_mbi")),
        "_pay": Field(El("p", css_part="mluong")),
        "_company": Field(El("p", css_part="com_name_text")),
        "_company_url": Field(_COM_NAME, "href"),
        "_industries": Field(_tagged("Ngành nghề"), "own"),
        "_fields": Field(_tagged("Lĩnh vực"), "own"),
        "_address": Field(El(css="diachi"), "texts"),
        "_headcount": Field(beside("Số lượng cần tuyển", exact=False, css="item_if")),
        "_desc": Field(_section("Mô tả công việc"), "texts"),
        "_need": Field(El("div", css_part="ycau_tdung"), "texts"),
        "_gain": Field(_section("Quyền lợi"), "texts"),
        **{f"_{c}": Field(beside(label, css="item_if")) for c, label in _TIMVIEC_LABELS.items()},
    },
    "careerlink": {
        "_title": Field(El("h1", ident="job-title"), "own"),
        "_company": Field(_EMPLOYER_LINK, "title"),
        "_company_url": Field(_EMPLOYER_LINK, "href"),
        "_pay": Field(El("span", css="text-primary"), "own"),
        "_place": Field(El("div", ident="job-location"), "texts"),
        "_experience": Field(El("span", after=El("i", css_part="cli-suitcase-simple"))),
        "_desc": Field(El("div", after=El("div", ident="job-description")), "texts"),
        "_gain": Field(El("span", within=El("div", css_part="job-benefit-item", within=El(ident="section-job-benefits"))), "texts"),
        "_skill": Field(El("div", css="raw-content rich-text-content", within=El(ident="section-job-skills")), "texts"),
        "_class": Field(El("a", within=El("div", css_part="job-summary-item", holds=El("div", own_has="Ngành nghề"))), "texts"),
        "_type": Field(beside("Loại công việc", "div", "div", exact=False)),
        "_position": Field(beside("Cấp bậc", "div", "div", exact=False)),
        "_education": Field(beside("Học vấn", "div", "div", exact=False)),
    },
}


def page_jobs(pages: DataFrame, media: str) -> DataFrame:
    """Job rows from the markup of detail pages (EXT8, EXT9)."""
    read = with_fields(pages, _JOB_FIELDS[media], "url")
    url, one = F.col("url"), {f: only(F.col(f)) for f in _JOB_FIELDS[media]}
    clean = {f: tx.clean_text(c) for f, c in one.items()}
    if media == "timviec365":
        company_url = blank(one["_company_url"])
        return read.select(
            clean["_id"].alias("job_id"),
            clean["_title"].alias("job_title"),
            tx.first_filled(clean["_pay_range"], clean["_pay"]).alias("job_salary"),
            clean["_company"].alias("job_company_name"),
            company_url.alias("job_company_url"),
            urls.last_segment(company_url).alias("job_company_id"),
            F.col("_industries").alias("industries"),
            F.col("_fields").alias("fields"),
            clean["_address"].alias("address"),
            clean["_job_employment_type"].alias("job_employment_type"),
            clean["_headcount"].alias("headcount"),
            *[clean[f"_{c}"].alias(c) for c in ("probation", "degree", "gender", "age")],
            F.array_join("_desc", "\n").alias("job_description"),
            F.array_join("_need", "\n").alias("requirements"),
            F.array_join("_gain", "\n").alias("benefits"),
            url.alias("source_url"),
        )
    return read.select(
        F.lit("job").alias("type"),
        urls.last_segment(url).alias("job_id"),
        url.alias("source_job_url"),
        one["_title"].alias("job_title"),
        one["_company"].alias("job_company_name"),
        one["_company_url"].alias("job_company_url"),
        urls.last_segment(one["_company_url"]).alias("job_company_id"),
        one["_pay"].alias("job_salary"),
        tx.squeeze(F.array_join("_place", " ")).alias("job_location"),
        clean["_experience"].alias("job_experience_requirement"),
        F.array_join("_desc", "\n").alias("job_description"),
        F.array_join("_gain", " ").alias("job_benefits"),
        tx.drop_tokens(F.col("_skill"), "*").alias("job_skills"),
        clean["_type"].alias("job_employment_type"),
        clean["_position"].alias("job_position"),
        clean["_education"].alias("job_education_requirements"),
        F.array_join("_class", ", ").alias("job_industry"),
    )


# Detail labels of one source's company pages
_DETAIL_LABELS = {
    "company_industry": "Lĩnh vực hoạt động",
    "company_scale": "Quy mô",
    "tax_code": "Mã số thuế",
    "company_domain": "Website",
    "company_address": "Trụ sở chính",
    "company_established_date": "Ngày thành lập",
    "company_representative": "Người đại diện",
    "company_phone": "Điện thoại",
    "company_email": "Email",
}


def _contact(icon: str) -> El:
    return El("li", parent_of=El("i", css_part=icon), within=El("div", css_part="get-touch"))


_COMPANY_FIELDS: dict[str, dict[str, Field]] = {
    "topcv": {
        "_name": Field(El("h1", css="company-detail-name text-highlight"), "own"),
        "_about": Field(El("p", child_of=El("div", css="content")), "own"),
        "_address": Field(El("div", css="desc"), "own"),
        "_facts": Field(El("span", css="company-subdetail-info-text"), "own"),
        "_site": Field(El("a", within=El("div", css="company-subdetail-info website")), "href"),
    },
    "jobsgo": {
        "_name": Field(El("h1", child_of=El("div", css="company-name")), "own"),
        "_canonical": Field(El("link", attrs=(("rel", "canonical"),)), "href"),
        "_plain": Field(El("meta", attrs=(("name", "description"),)), "content"),
        "_social": Field(El("meta", attrs=(("property", "og:description"),)), "content"),
        "_address": Field(El("span", child_of=_contact("pb-heroicons-map-pin"))),
        "_site": Field(El("a", within=_contact("pb-heroicons-globe-alt")), "href"),
        "_industry": Field(El("span", within=El("span", css="company-category-list")), "own"),
    },
    "timviec365": {
        "_name": Field(El("h1", child_of=El("a", css="name_com")), "own"),
        "_url": Field(El("a", css="name_com"), "href"),
        **{f"_{c}": labelled(label) for c, label in _DETAIL_LABELS.items()},
    },
}


def page_companies(pages: DataFrame, media: str) -> DataFrame:
    """Company rows from the markup of profile pages (EXT8, EXT9)."""
    read = with_fields(pages, _COMPANY_FIELDS[media], "url")
    url, one = F.col("url"), {f: only(F.col(f)) for f in _COMPANY_FIELDS[media]}
    if media == "topcv":
        name = one["_name"]
        return read.select(
            url.alias("source_company_url"),
            urls.page_id(url).alias("company_id"),
            name.alias("company_name"),
            name_key(name).alias("company_only_name"),
            F.array_join("_about", "\n").alias("company_description"),
            tx.clean_text(one["_address"]).alias("company_address"),
            urls.strip_slashes(one["_site"]).alias("company_domain"),
            tx.headcount(F.col("_facts")).alias("company_size"),
        )
    if media == "jobsgo":
        name = tx.remove_brackets(one["_name"])
        return read.select(
            one["_canonical"].alias("source_company_url"),
            urls.last_segment(url).alias("company_id"),
            name.alias("company_name"),
            name_key(name).alias("company_only_name"),
            F.coalesce(one["_plain"], one["_social"]).alias("company_description"),
            tx.clean_text(one["_address"]).alias("company_address"),
            one["_site"].alias("company_domain"),
            one["_industry"].alias("company_industry"),
        )
    name = tx.clean_text(one["_name"])
    return read.select(
        urls.last_segment(url).alias("company_id"),
        name.alias("company_name"),
        name_key(name).alias("company_only_name"),
        tx.clean_text(one["_url"]).alias("company_url"),
        *[without_label(F.col(f"_{c}"), label).alias(c) for c, label in _DETAIL_LABELS.items()],
    )


def extract_jobs(pages: DataFrame, media: str) -> DataFrame:
    """A source's job pages, or search answers with a `body`, as raw job rows (EXT2, EXT6, EXT8)."""
    if media == "vietnamworks":
        return api_jobs(pages)
    if media in ("timviec365", "careerlink"):
        return page_jobs(pages, media)
    return job_postings(pages, media)


def extract_companies(pages: DataFrame, media: str, units: DataFrame | None = None) -> DataFrame:
    """A source's company pages as raw company rows, with the parts of the address when the
    administrative units are given (EXT3-EXT6, EXT8, NRM4)."""
    by_media = {
        "careerviet": posting_companies,
        "careerlink": service_companies,
        "vieclam24h": state_companies,
        "vietnamworks": api_companies,
    }
    rows = by_media[media](pages) if media in by_media else page_companies(pages, media)
    if units is None:
        return rows
    return split_address(rows, "company_address", units, "_addr").select(
        *rows.columns, *[F.col(f"_addr.{p}").alias(p) for p in ("province", "district", "ward", "street")]
    )


# ---- links --------------------------------------------------------------------------------------
_ANY_LINK = El("a")


class Listing(NamedTuple):
    """A source's list pages: which links lead on, how many of them at most, and the pager; `last` of the pager's links."""

    links: El
    pager: El | None = None
    first: int | None = None
    last: bool = False


def _href(part: str, **more) -> El:
    return El("a", attr_part=("href", part), **more)


_NEXT_ITEM, _NEXT_STEP = El("a", child_of=El("li", css="next-page")), El("a", child_of=El("li", css="pagi_pre"))
_NEXT_REL = El("a", attr_part=("rel", "next"))
_ROUND = El("a", css="h-8 w-8 rounded-full bg-white border border-se-blue-10 flex justify-center items-center cursor-pointer")
# the index of a source's categories, its lists of jobs or of companies
# The elements of each source's pages
LISTINGS: dict[tuple[str, str], Listing] = {
    ("careerviet", "recruit"): Listing(El("a", css="job_link"), _NEXT_ITEM),
    ("careerviet", "company"): Listing(El("a", css="job_link", within=El("div", css="caption")), _NEXT_ITEM),
    ("jobsgo", "index"): Listing(_href("/viec-lam-")),
    ("jobsgo", "recruit"): Listing(El(within=El("div", css="col-grid"))),
    ("jobsgo", "company"): Listing(_href("/tuyen-dung/")),
    ("timviec365", "index"): Listing(_href("/viec-lam-")),
    ("timviec365", "recruit"): Listing(El("a", css="tag_th title_cate"), _NEXT_STEP),
    ("timviec365", "company"): Listing(El(within=El("h2", css="box_mb box_new_left_mb")), _NEXT_STEP),
    ("topcv", "index"): Listing(El("a", child_of=El("div", child_of=El("div", within=El("div", css="ctn-list-jobs", first=True))))),
    ("topcv", "recruit"): Listing(_href("/viec-lam/", within=El("div", attrs=(("data-box", "BoxSearchResult"),)))),
    ("topcv", "company"): Listing(El("a", css="company")),
    ("vieclam24h", "recruit"): Listing(El("a", attrs=(("target", "_blank"),)), _ROUND, 30, True),
    ("vieclam24h", "company"): Listing(_href("/danh-sach-tin-tuyen-dung"), first=1),
    ("careerlink", "index"): Listing(El("a", within=El("div", css="jobs-quick-category"))),
    ("careerlink", "recruit"): Listing(El("a", css="job-link clickable-outside"), _NEXT_REL),
    ("careerlink", "company"): Listing(_href("/viec-lam-cua/"), _NEXT_REL),
}


def page_links(html: Column, select: El = _ANY_LINK) -> Column:
    """Targets of the links that a selector means, in page order; none out of scripts and comments."""
    return elements(html, select, "href")


def outgoing(pages: DataFrame, containing: str = "", *carried: Column, select: El = _ANY_LINK, first: int | None = None) -> DataFrame:
    """Distinct outgoing links per page, absolute, of the elements `select` means, optionally only those containing
    a text, and the first so many (EXT10, LIM2, DD4).

    `carried` columns of the page are repeated on each of its links.
    """
    hrefs = page_links(F.col("html"), select)
    if containing:
        hrefs = F.filter(hrefs, lambda h: h.contains(containing))
    if first:
        hrefs = F.slice(hrefs, 1, first)
    read = pages.select("page_id", "url", *carried, hrefs.alias("_hrefs"))
    full = F.array_distinct(F.transform("_hrefs", lambda h: urls.resolve(F.col("url"), h)))
    return read.select(*[c for c in read.columns if c != "_hrefs"], F.explode(full).alias("link"))


def listed(pages: DataFrame, media: str, kind: str) -> DataFrame:
    """Where a source's list pages lead: page_id, url and link of each entry (EXT10, LIM2)."""
    spec = LISTINGS[media, kind]
    return outgoing(pages, select=spec.links, first=spec.first)


def first_links(html: Column, n: int = 30, select: El = _ANY_LINK) -> Column:
    """The first links of a page, or of what a selector means (LIM2)."""
    return F.slice(page_links(html, select), 1, n)


def next_page(url: Column, html: Column, media: str | None = None, kind: str = "recruit") -> Column:
    """Absolute address of the next list page, by the pager of a source, or by any known one: a rel=next link, an item
    of a class for it, or the last of a row of page numbers (EXT11, LIM3). Null without one.
    """
    if media:
        spec = LISTINGS[media, kind]
        if spec.pager is None:
            return F.lit(None).cast("string")
        found = elements(html, spec.pager, "href")
        target = F.try_element_at(found, F.lit(-1 if spec.last else 1))
    else:
        pagers = {"rel": _NEXT_REL, "item": _NEXT_ITEM, "step": _NEXT_STEP, "number": _ROUND}
        read = read_fields(html, {n: Field(p, "href") for n, p in pagers.items()})
        target = F.coalesce(*[only(read[n]) for n in ("rel", "item", "step")], F.try_element_at(read["number"], F.lit(-1)))
    return bind(target, lambda t: F.when(t.isNotNull(), urls.resolve(url, t)))


def last_link(html: Column, select: El = _ANY_LINK) -> Column:
    """The last link of a page, or of the pager that a selector means (LIM3)."""
    return F.try_element_at(page_links(html, select), F.lit(-1))


def with_parent_context(pages: DataFrame, context: Column, containing: str = "", select: El = _ANY_LINK) -> DataFrame:
    """Child pages with a value of the page that links to them (EXT12).

    Links to pages not fetched keep their context with a null child; a page fetched several times is
    one child, the first by id.
    """
    links = outgoing(pages, containing, context.alias("context"), select=select).select(
        F.col("page_id").alias("parent_id"), "link", "context"
    )
    child = (
        pages.groupBy("url").agg(F.min("page_id").alias("child_id")).select(detached(F.col("url")).alias("link"), "child_id")
    )
    return links.join(child, "link", "left").select("parent_id", "link", "context", "child_id")
