"""What differs between the sources: column names, qualities, clean-up expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from jobmeld.functions.numbers import as_array, salary, to_decimal, to_text

# ---- canonical tables ---------------------------------------------------------------------------

_TEXT, _MONEY = T.StringType(), T.DecimalType(18, 2)


def _struct(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


IDENTITY_SCHEMA = _struct(
    company_id=_TEXT,
    corporate_number=_TEXT,
    identify_method=T.IntegerType(),
    updated_at=T.TimestampType(),
    created_at=T.TimestampType(),
)

# One type per master column, whatever the sources send.
JOB_SCHEMA = _struct(
    media_internal_id=_TEXT,
    media_code=_TEXT,
    corporate_number=_TEXT,
    company_id=_TEXT,
    company_name=_TEXT,
    company_url=_TEXT,
    province=_TEXT,
    title=_TEXT,
    description=_TEXT,
    benefits=_TEXT,
    requirements=_TEXT,
    degree=_TEXT,
    employment_type=T.ArrayType(_TEXT),
    experience=_TEXT,
    industries=_TEXT,
    skills=_TEXT,
    min_salary=_MONEY,
    max_salary=_MONEY,
    posted_at=_TEXT,
    end_at=_TEXT,
    url=_TEXT,
    age=_TEXT,
    gender=_TEXT,
    address=_TEXT,
    recruit_count=_TEXT,
)

COMPANY_TYPES = {
    name: T.StringType()
    for name in [
        "company_name", "standard_name", "address", "description", "domain", "company_url", "province", "ward", "street",
        "district", "industry", "company_industry", "company_size", "email", "establish_date", "representative",
    ]
}


@dataclass(frozen=True)
class SourceSpec:
    """One source: `company` and `job` are (source column, master column) in merge order."""

    media: str
    quality: int
    company: tuple[tuple[str, str], ...]
    job: tuple[tuple[str, str], ...]
    fix_job: Mapping[str, Callable[[DataFrame], Column]] = field(default_factory=dict)
    fix_company: Mapping[str, Callable[[DataFrame], Column]] = field(default_factory=dict)

    @property
    def id_column(self) -> str:
        return f"{self.media}_company_id"


def _company(media: str, *pairs: tuple[str, str]) -> tuple[tuple[str, str], ...]:
    return (
        ("company_id", f"{media}_company_id"),
        ("company_name", "company_name"),
        ("company_only_name", "standard_name"),
        *pairs,
        ("province", "province"),
        ("ward", "ward"),
        ("street", "street"),
        ("district", "district"),
    )


def _job(*pairs: tuple[str, str]) -> tuple[tuple[str, str], ...]:
    return (
        ("job_id", "media_internal_id"),
        ("media_code", "media_code"),
        ("corporate_number", "corporate_number"),
        ("province", "province"),
        ("job_company_id", "company_id"),
        ("job_title", "title"),
        ("job_description", "description"),
        *pairs,
    )


def _province_of(df: DataFrame) -> Column:
    """The province itself where a source delivers the whole address struct in its place."""
    if isinstance(df.schema["province"].dataType, T.StructType):
        return F.col("province.province")
    return F.col("province")


# Source names, qualities and column mappings
SOURCES = {
    s.media: s
    for s in (
        SourceSpec(
            "careerviet",
            29000,
            _company(
                "careerviet",
                ("company_address", "address"),
                ("company_description", "description"),
                ("company_domain", "domain"),
                ("source_company_url", "company_url"),
            ),
            _job(
                ("job_benefits", "benefits"),
                ("job_company_name", "company_name"),
                ("job_education_requirement", "degree"),
                ("job_employment_type", "employment_type"),
                ("job_exp_requirement", "experience"),
                ("job_industry", "industries"),
                ("job_max_salary", "max_salary"),
                ("job_skills", "skills"),
                ("source_job_url", "url"),
            ),
            fix_job={"job_max_salary": lambda df: salary(F.col("job_salary").cast("string"))},
            fix_company={"province": _province_of},
        ),
        SourceSpec(
            "jobsgo",
            24000,
            _company(
                "jobsgo",
                ("company_address", "address"),
                ("company_description", "description"),
                ("company_domain", "domain"),
                ("source_company_url", "company_url"),
                ("company_industry", "industry"),
            ),
            _job(
                ("end_at", "end_at"),
                ("job_benefit", "benefits"),
                ("job_company_name", "company_name"),
                ("job_employment_type", "employment_type"),
                ("job_exp_requirement", "experience"),
                ("job_industry", "industries"),
                ("job_max_salary", "max_salary"),
                ("job_min_salary", "min_salary"),
                ("source_job_url", "url"),
            ),
        ),
        SourceSpec(
            "timviec365",
            20000,
            _company(
                "timviec365",
                ("company_url", "company_url"),
                ("company_industry", "company_industry"),
                ("company_scale", "company_size"),
                ("company_email", "email"),
                ("company_established_date", "establish_date"),
                ("company_industry", "industry"),
                ("company_representative", "representative"),
            ),
            _job(
                ("job_company_name", "company_name"),
                ("benefits", "benefits"),
                ("requirements", "requirements"),
                ("degree", "degree"),
                ("industries", "industries"),
                ("job_min_salary", "min_salary"),
                ("job_max_salary", "max_salary"),
                ("source_url", "url"),
                ("age", "age"),
                ("gender", "gender"),
                ("address", "address"),
                ("headcount", "recruit_count"),
            ),
            # this source sends its salary as text only
            fix_job={
                "industries": lambda df: F.concat_ws(",", "industries"),
                "job_min_salary": lambda df: F.lit(None).cast("decimal(18,2)"),
                "job_max_salary": lambda df: F.lit(None).cast("decimal(18,2)"),
            },
        ),
        SourceSpec(
            "topcv",
            30000,
            _company(
                "topcv",
                ("company_address", "address"),
                ("company_description", "description"),
                ("company_domain", "domain"),
                ("source_company_url", "company_url"),
                ("company_size", "company_size"),
            ),
            _job(
                ("job_company_url", "company_url"),
                ("job_employment_type", "employment_type"),
                ("job_experience_requirements", "experience"),
                ("job_industry", "industries"),
                ("job_posted_date", "posted_at"),
                ("job_min_salary", "min_salary"),
                ("job_max_salary", "max_salary"),
                ("source_job_url", "url"),
                ("job_benefits", "benefits"),
            ),
            fix_job={"job_employment_type": lambda df: as_array(F.col("job_employment_type"))},
        ),
        SourceSpec(
            "vieclam24h",
            30000,
            _company(
                "vieclam24h",
                ("company_address", "address"),
                ("company_description", "description"),
                ("company_domain", "domain"),
                ("source_company_url", "company_url"),
            ),
            _job(
                ("job_company_url", "company_url"),
                ("job_benefits", "benefits"),
                ("job_education_requirements", "degree"),
                ("job_employment_type", "employment_type"),
                ("job_industry", "industries"),
                ("job_skills", "skills"),
                ("job_min_salary", "min_salary"),
                ("job_max_salary", "max_salary"),
                ("job_date_posted", "posted_at"),
                ("source_job_url", "url"),
            ),
            fix_job={"job_employment_type": lambda df: as_array(F.col("job_employment_type"))},
        ),
        SourceSpec(
            "vietnamworks",
            28000,
            _company(
                "vietnamworks",
                ("company_address", "address"),
                ("company_profile", "description"),
                ("company_size", "company_size"),
            ),
            _job(
                ("job_company_name", "company_name"),
                ("job_benefits", "benefits"),
                ("job_requirement", "requirements"),
                ("job_salary_min", "min_salary"),
                ("job_salary_max", "max_salary"),
                ("job_posted_at", "posted_at"),
                ("job_expired_at", "end_at"),
                ("job_url", "url"),
            ),
            fix_job={
                "job_id": lambda df: to_text(F.col("job_id")),
                "job_benefits": lambda df: F.concat_ws(", ", "job_benefits"),
                "job_salary_min": lambda df: to_decimal(F.col("job_salary_min")),
                "job_salary_max": lambda df: to_decimal(F.col("job_salary_max")),
            },
        ),
    )
}

# landed and extracted like the others, but not merged
RAW_ONLY = ("careerlink",)


def fixed(df: DataFrame, fixes: Mapping[str, Callable[[DataFrame], Column]], wanted: list[str]) -> DataFrame:
    """Apply a source's clean-up; wanted columns the raw table lacks become null strings."""
    cols = {c: F.col(c) for c in df.columns}
    for name in wanted:
        cols.setdefault(name, F.lit(None).cast("string"))
    for name, make in fixes.items():
        cols[name] = make(df)
    return df.select(*[c.alias(n) for n, c in cols.items()])


# Columns of the raw tables. Text unless listed below; a value of another JSON shape is
# read as its JSON text.
RAW_COMPANY_COLUMNS = [
    "company_id", "company_name", "company_only_name", "company_address", "province", "district", "ward", "street",
]
RAW_COLUMNS = {
    ("careerviet", "recruit"): [
        "type", "job_id", "job_title", "job_company_name", "job_company_url", "job_benefits", "job_industry", "job_created_at",
        "job_valid_through", "job_description", "source_job_url", "job_company_id", "job_salary", "job_min_salary",
        "job_max_salary", "job_salary_level", "job_exp_requirement", "job_salary_currency", "job_employment_type", "job_skills",
        "job_working_hours", "job_education_requirement", "job_street_address",
    ],
    ("jobsgo", "recruit"): [
        "source_job_url", "job_id", "job_title", "posted_at", "end_at", "job_employment_type", "job_exp_requirement",
        "job_edu_requirement", "job_min_salary", "job_max_salary", "job_salary_unit", "job_industry", "job_description",
        "job_benefit", "job_company_name", "job_company_url", "job_company_id", "postal_code",
    ],
    ("timviec365", "recruit"): [
        "job_id", "job_title", "job_salary", "job_company_name", "job_company_url", "job_company_id", "industries", "fields",
        "address", "job_employment_type", "headcount", "probation", "degree", "gender", "age", "job_description",
        "requirements", "benefits", "source_url",
    ],
    ("topcv", "recruit"): [
        "job_id", "source_job_url", "job_company_id", "job_title", "job_company_name", "job_company_url", "job_company_logo",
        "job_description", "job_industry", "job_street_address", "job_district_address", "job_city_address", "job_postal_code",
        "job_country_address", "job_min_salary", "job_max_salary", "job_salary_currency", "job_posted_date", "job_valid_date",
        "job_employment_type", "job_level", "job_experience_requirements", "job_skills", "job_total_openings", "job_benefits",
    ],
    ("vieclam24h", "recruit"): [
        "type", "source_job_url", "job_title", "job_id", "job_employment_type", "job_date_posted", "job_valid_through",
        "job_industry", "job_education_requirements", "job_min_salary", "job_max_salary", "job_currency", "job_description",
        "job_benefits", "job_skills", "job_street_address", "job_postal_code", "job_company_name", "job_company_url",
        "job_company_id", "job_company_logo",
    ],
    ("vietnamworks", "recruit"): [
        "type", "job_id", "job_url", "job_title", "job_company_name", "job_company_id", "job_locations", "job_address",
        "job_language_vi", "job_salary_min", "job_salary_max", "job_salary_display", "job_salary_text", "job_level",
        "job_level_vi", "job_skills", "job_benefits", "job_description", "job_requirement", "job_posted_at", "job_expired_at",
        "type_working_id", "job_industry", "visibility_display",
    ],
    ("careerlink", "recruit"): [
        "type", "job_id", "source_job_url", "job_title", "job_company_name", "job_company_url", "job_company_id", "job_salary",
        "job_location", "job_experience_requirement", "job_description", "job_benefits", "job_skills", "job_employment_type",
        "job_position", "job_education_requirements", "job_industry",
    ],
    ("careerviet", "company"): [
        "type", "company_domain", "company_description", "company_url", "company_logo", "source_company_url",
        "company_postal_code",
    ],
    ("jobsgo", "company"): ["source_company_url", "company_description", "company_domain", "company_industry"],
    ("timviec365", "company"): [
        "company_url", "company_industry", "company_scale", "tax_code", "company_domain", "company_established_date",
        "company_representative", "company_phone", "company_email",
    ],
    ("topcv", "company"): ["source_company_url", "company_description", "company_domain", "company_size"],
    ("vieclam24h", "company"): [
        "source_company_url", "company_domain", "company_slug", "company_province_id", "company_description",
        "company_description_html", "company_tax_code",
    ],
    ("vietnamworks", "company"): ["type", "company_profile", "company_size", "company_logo", "industry"],
    ("careerlink", "company"): [
        "company_representative", "company_description", "company_email", "company_phone", "company_homepage_url",
        "company_logo", "company_price_range", "company_street_address", "company_adrress_district", "company_address_address",
        "company_address_country", "company_postal_code", "company_social_url", "company_open_hour", "company_working_hours",
    ],
}
_LIST = T.ArrayType(_TEXT)
RAW_TYPES = {
    ("careerviet", "job_employment_type"): _LIST,
    ("careerviet", "province"): _struct(street=_TEXT, ward=_TEXT, district=_TEXT, province=_TEXT),
    ("timviec365", "industries"): _LIST,
    ("timviec365", "fields"): _LIST,
    ("vietnamworks", "job_id"): T.LongType(),
    ("vietnamworks", "job_company_id"): T.LongType(),
    ("vietnamworks", "job_locations"): _LIST,
    ("vietnamworks", "job_salary_min"): T.LongType(),
    ("vietnamworks", "job_salary_max"): T.LongType(),
    ("vietnamworks", "job_skills"): _LIST,
    ("vietnamworks", "job_benefits"): _LIST,
    ("vietnamworks", "job_industry"): T.ArrayType(_struct(industryV3Name=_TEXT)),
    ("careerlink", "job_skills"): _LIST,
    ("careerlink", "company_social_url"): _LIST,
    ("careerlink", "company_working_hours"): T.MapType(_TEXT, _TEXT),
}


def raw_schema(media: str, kind: str) -> T.StructType:
    """Schema of a source's landed records: reading with it needs no inference pass."""
    names = RAW_COLUMNS[media, kind]
    if kind == "company":
        names = RAW_COMPANY_COLUMNS + names
    return T.StructType([T.StructField(n, RAW_TYPES.get((media, n), _TEXT)) for n in names])
