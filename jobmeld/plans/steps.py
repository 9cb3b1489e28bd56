"""The steps of a run, each a function over a table store.

Tables: `raw/{media}/{company|recruit}`, `uuid/{media}`, `master/company`, `master/recruit/{media}`.
Jobs are kept per source, so an upsert reads and rewrites one source's rows only. Both master tables are
kept in buckets of their key, so a merge reads and writes what its batch touches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from jobmeld.functions.dates import to_time
from jobmeld.operators import dedupe, enrich, extract, identity, incremental, lookup, matching, survivorship, upsert
from jobmeld.plans.specs import COMPANY_TYPES, IDENTITY_SCHEMA, JOB_SCHEMA, SOURCES, SourceSpec, fixed
from jobmeld.sources.jsonl import CORRUPT, read_jsonl
from jobmeld.sources.schema import conform, consolidate, empty_like
from jobmeld.sources.store import SnapshotStore

KEYS = {"company": "company_id", "recruit": "job_id"}
# of the master tables, which are kept in buckets of them
COMPANY_KEYS, JOB_KEYS = ["corporate_number"], ["media_internal_id"]


def run_ingest(store: SnapshotStore, media: str, kind: str, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON Lines -> one row per id, the fullest, -> `raw/{media}/{kind}` (UPS6, PIP1, PIP2).

    Lines that do not parse and records without an id go to `raw/{media}/{kind}_rejected` (reason, record),
    so nothing is lost and nothing without an id counts as a repeat. Give the source's schema
    (`specs.raw_schema`) to spare the pass that infers one.
    """
    return ingest(store, media, kind, path, schema)[0]


def ingest(
    store: SnapshotStore, media: str, kind: str, path: str, schema: T.StructType | str | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """`run_ingest` and its counts: records read, kept, repeated, without an id, unreadable (UPS6, AGG4).

    The input is read once: its records are landed by outcome in `raw/{media}/{kind}_landed`, and counted on the way.
    """
    df = read_jsonl(store.spark, path, schema)
    if df.columns == [CORRUPT]:
        # not one line parses; Spark refuses to read this column alone
        df = store.spark.read.text(path).select(F.col("value").alias(CORRUPT))
    return _land_raw(store, df, media, kind)


def _land_raw(store: SnapshotStore, df: DataFrame, media: str, kind: str) -> tuple[DataFrame, dict[str, int]]:
    key, name = KEYS[kind], f"raw/{media}/{kind}"
    values = [c for c in df.columns if c != CORRUPT]
    line = F.col(CORRUPT) if CORRUPT in df.columns else F.lit(None).cast("string")
    # no record names the id, as in a file of broken lines
    has_id = dedupe.with_id(df, key) if key in values else F.lit(False)
    outcome = F.when(line.isNotNull(), "unreadable").when(has_id, "kept").otherwise("no id")
    as_text = F.to_json(F.struct(*values)) if values else line
    tagged = df.select(*values, F.coalesce(line, F.when(~has_id, as_text)).alias("_record"), outcome.alias("_outcome"))
    seen, written = Observation(), Observation()
    counts = {"kept": "kept", "no_id": "no id", "unreadable": "unreadable"}
    tagged = tagged.observe(seen, *[F.count_if(F.col("_outcome") == o).alias(c) for c, o in counts.items()])
    landed = store.write(tagged, f"{name}_landed", ["_outcome"])

    rejected = landed.filter(F.col("_outcome") != "kept").select(F.col("_outcome").alias("reason"), F.col("_record").alias("record"))
    store.write(rejected, f"{name}_rejected")
    kept = landed.filter(F.col("_outcome") == "kept")
    if key in values:
        kept = dedupe.one_per_id(kept.select(*values), key)
    else:
        kept = kept.select(*values, F.lit(None).cast("string").alias(key))
    raw = store.write(kept.observe(written, F.count(F.lit(1)).alias("rows")), name)
    found = {c: int(n) for c, n in seen.get.items()}
    rows = int(written.get["rows"])
    return raw, {"records": sum(found.values()), **found, "kept": rows, "repeated": found["kept"] - rows}


def run_extract(
    store: SnapshotStore, media: str, kind: str, pages: DataFrame, units: DataFrame | None = None
) -> DataFrame:
    """Crawled pages -> one row per id -> `raw/{media}/{kind}` (PIP1, PIP2 from pages).

    The records are landed by outcome, as for `run_ingest`, so a page is read once.
    """
    if kind == "company":
        df = extract.extract_companies(pages, media, units)
    else:
        df = extract.extract_jobs(pages, media)
    return _land_raw(store, df, media, kind)[0]


def run_identify(store: SnapshotStore, media: str, as_of: Column, conflict: str = "parity") -> DataFrame:
    """All matchers of one source against the master, merged into `uuid/{media}` (IDR9, PIP3)."""
    raw = dedupe.one_per_id(_companies(store, SOURCES[media]), "company_id")
    master = store.read("master/company")
    name = f"uuid/{media}"
    held = store.read(name) if store.exists(name) else None
    pairs = matching.stamp(matching.candidates(raw, master), as_of)
    return store.write(conform(identity.cascade(held, pairs, conflict=conflict), IDENTITY_SCHEMA), name)


def run_identify_changes(
    store: SnapshotStore,
    media: str,
    as_of: Column,
    raw: DataFrame | None = None,
    master: DataFrame | None = None,
    gone: DataFrame | None = None,
    conflict: str = "parity",
) -> DataFrame:
    """Identification of what changed only (IDR9, PIP3): `raw` companies crawled since the last call, `master` rows that
    were merged since, `gone` raw company ids. Returns the map over all companies so far, which is kept below
    `identified/{media}` and does not depend on how they were divided into calls.
    """
    if raw is not None:
        spec = SOURCES[media]
        wanted = ["company_id", *matching.RAW_KEYS.values()]
        raw = dedupe.one_per_id(fixed(raw, spec.fix_company, wanted).select(*wanted), "company_id")
    return incremental.identify_changes(store, f"identified/{media}", as_of, raw, master, gone, conflict=conflict)


def company_feed(raw: DataFrame, idmap: DataFrame | None, spec: SourceSpec, as_of: Column) -> DataFrame:
    """One source's companies, identified and scored, one row per corporate_number (UPS4)."""
    one = dedupe.one_per_id(raw, "company_id")
    if idmap is not None:
        one = lookup.attach_number(one, idmap)
    numbered = identity.mint(one, spec.media)
    values = sorted({c for c, _ in spec.company})
    golden = dedupe.keep_fullest(numbered.select("corporate_number", *values), "corporate_number", values, "company_id")
    text = golden.select(*[F.col(c).cast("string").alias(c) for c in golden.columns])
    return survivorship.scored(text, spec.company, spec.quality, as_of)


def job_feed(raw: DataFrame, master: DataFrame, spec: SourceSpec, as_of: Column, lost: Observation | None = None) -> DataFrame:
    """One source's jobs in the canonical layout, with their company (UPS5); `lost` counts the values that do not fit it."""
    df = fixed(raw, spec.fix_job, [c for c, _ in spec.job if c not in ("media_code", "corporate_number", "province")])
    known = lookup.company_lookup(master, spec.id_column)
    jobs = lookup.attach_company(upsert.tag_source(df, spec.media), known, "job_company_id")
    return upsert.stamped(conform(upsert.rename_select(jobs, spec.job), JOB_SCHEMA, lost), as_of)


def run_master(store: SnapshotStore, media: str, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """Companies first, then the jobs that refer to them (PIP4)."""
    return upsert_companies(store, media, as_of), upsert_jobs(store, media, as_of)


def upsert_companies(store: SnapshotStore, media: str, as_of: Column) -> DataFrame:
    return _merge_companies(store, [_feed(store, media, as_of)], as_of)


def upsert_all_companies(store: SnapshotStore, medias: Sequence[str], as_of: Column) -> DataFrame:
    """Companies of several identified sources in one merge, later sources winning ties (SET2, UPS4)."""
    return _merge_companies(store, [_feed(store, m, as_of) for m in medias], as_of)


def _feed(store: SnapshotStore, media: str, as_of: Column) -> DataFrame:
    spec = SOURCES[media]
    idmap = store.read(f"uuid/{media}") if store.exists(f"uuid/{media}") else None
    return company_feed(_companies(store, spec), idmap, spec, as_of)


def _merge_companies(store: SnapshotStore, feeds: Sequence[DataFrame], as_of: Column) -> DataFrame:
    batch = feeds[0] if len(feeds) == 1 else survivorship.fold(feeds)
    # start from every canonical column, so that matchers find their keys whichever source came first
    start = empty_like(store.spark, _scored_schema(as_of, store))
    return store.merge("master/company", batch, COMPANY_KEYS, survivorship.survive, start)


def upsert_jobs(store: SnapshotStore, media: str, as_of: Column, lost: Observation | None = None) -> DataFrame:
    """One source's jobs into its table; `lost` counts, per column, the values that do not fit (SC3, FN5)."""
    spec = SOURCES[media]
    feed = job_feed(store.read(f"raw/{media}/recruit"), store.read("master/company"), spec, as_of, lost)
    # the table holds one source, so its media_code adds nothing to the key; without it, reducing the
    # batch and joining it share one shuffle
    return store.merge(f"master/recruit/{media}", feed, JOB_KEYS, lambda d, s: upsert.upsert_stored(d, s, JOB_KEYS))


def read_jobs(store: SnapshotStore) -> DataFrame:
    """All sources' jobs as one table (SET2)."""
    parts = [store.read(f"master/recruit/{m}") for m in SOURCES if store.exists(f"master/recruit/{m}")]
    if not parts:
        raise FileNotFoundError("no jobs yet")
    return consolidate(parts)


def dated_jobs(jobs: DataFrame) -> DataFrame:
    """Jobs with `posted_on` and `ends_on`, the times that their texts say; the texts stay as the sources wrote them."""
    return jobs.select("*", to_time(F.col("posted_at")).alias("posted_on"), to_time(F.col("end_at")).alias("ends_on"))


def enrich_jobs(
    jobs: DataFrame, categories: enrich.Rules = enrich.CATEGORY_RULES, skill_rules: enrich.Rules = enrich.SKILL_RULES
) -> DataFrame:
    """Add category, expertise and edu; filled expertise is kept (ENR1, ENR2, ENR4)."""
    had = [c for c in jobs.columns if c not in ("category", "expertise", "edu")]
    skills = enrich.classify_multi(F.col("description"), skill_rules)
    if "expertise" in jobs.columns:
        skills = F.coalesce(F.col("expertise"), skills)
    return jobs.select(
        *had,
        enrich.classify_single(F.col("industries"), categories).alias("category"),
        skills.alias("expertise"),
        enrich.education(F.col("requirements")).alias("edu"),
    )


def run_enrich(
    store: SnapshotStore,
    categories: enrich.Rules = enrich.CATEGORY_RULES,
    skill_rules: enrich.Rules = enrich.SKILL_RULES,
    industries: enrich.Rules = enrich.INDUSTRY_RULES,
) -> DataFrame:
    """Enrich jobs per source, and companies with their industry class (PIP5)."""
    for m in SOURCES:
        name = f"master/recruit/{m}"
        if store.exists(name):
            store.rewrite(name, lambda jobs: enrich_jobs(jobs, categories, skill_rules), JOB_KEYS)
    industry = enrich.classify_single(F.col("description"), industries).alias("category")
    store.rewrite(
        "master/company", lambda c: c.select(*[n for n in c.columns if n != "category"], industry), COMPANY_KEYS
    )
    return read_jobs(store)


def _companies(store: SnapshotStore, spec: SourceSpec) -> DataFrame:
    raw = store.read(f"raw/{spec.media}/company")
    wanted = [c for c, _ in spec.company] + list(matching.RAW_KEYS.values())
    return fixed(raw, spec.fix_company, wanted)


def _scored_schema(as_of: Column, store: SnapshotStore) -> T.StructType:
    when = store.spark.range(1).select(as_of.alias("t")).schema["t"].dataType
    fields = [T.StructField("corporate_number", T.StringType())]
    names = [s.id_column for s in SOURCES.values()] + list(COMPANY_TYPES)
    for n in names:
        fields += [
            T.StructField(n, T.StringType()),
            T.StructField(f"{n}_quality", T.IntegerType()),
            T.StructField(f"{n}_updated_at", when),
        ]
    fields += [T.StructField("updated_at", when), T.StructField("created_at", when)]
    return T.StructType(fields)
