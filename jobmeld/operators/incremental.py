"""Identification kept up to date batch by batch.

A pair of a raw and a master company counts where a key occurs once on either side, so what a batch changes
is decided by the keys it adds or takes away. Four tables in buckets are kept below one name:

- `records` (side, id) -> the keys of every company seen, by which a changed company's old keys are found;
- `entries` one row per key and company, from which the keys that changed are counted anew;
- `pairs` key -> its pair, where it has one;
- `map` the identity map.

The map is the one that all matchers in run order give over the pairs there are. As a row of it depends on pairs
that share a company or a number, directly or through others, only the pairs connected with a changed one are merged
anew. The result is that of a run over all companies, however these come in batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobmeld.operators import matching
from jobmeld.operators.identity import COLUMNS, cascade
from jobmeld.operators.matching import MASTER_KEYS, MATCHERS, RAW_KEYS, Matcher
from jobmeld.session import cut_lineage
from jobmeld.sources.store import SnapshotStore

KEY = ["method", "_k1", "_k2", "_k3"]
RECORD, OWN = ["side", "id"], ["company_id"]
_ENTRY = f"array<struct<{','.join(f'{k}:{t}' for k, t in zip(KEY, ['int', *['string'] * 3]))}>>"
_NO_RECORDS = f"side string, id string, keys {_ENTRY}"
_NO_ENTRIES = "method int, _k1 string, _k2 string, _k3 string, side string, id string"
_NO_PAIRS = "method int, _k1 string, _k2 string, _k3 string, company_id string, corporate_number string"
_NO_MAP = "company_id string, corporate_number string, identify_method int, updated_at timestamp, created_at timestamp"


def _records(df: DataFrame, side: str, ident: str, columns: dict[str, str], matchers: Sequence[Matcher]) -> DataFrame:
    """(side, id, keys): the keys of each company by all matchers."""
    entries = matching.key_entries(df, matchers, columns)
    return df.select(
        F.lit(side).alias("side"), F.col(ident).cast("string").alias("id"), F.array_distinct(entries).cast(_ENTRY).alias("keys")
    ).filter("id IS NOT NULL")


def _gone(df: DataFrame, side: str, ident: str) -> DataFrame:
    return df.select(F.lit(side).alias("side"), F.col(ident).cast("string").alias("id"), F.array().cast(_ENTRY).alias("keys"))


def _changes(batch: DataFrame, known: DataFrame) -> DataFrame:
    """(key, side, id, there): keys that companies of the batch have now and had not, or the other way round."""
    old = known.select("side", "id", F.col("keys").alias("had"))
    both = batch.join(old, RECORD, "left").withColumn("had", F.coalesce("had", F.array().cast(_ENTRY)))
    signed = F.concat(
        F.transform(F.array_except("keys", "had"), lambda e: F.struct(*[e[k].alias(k) for k in KEY], F.lit(True).alias("there"))),
        F.transform(F.array_except("had", "keys"), lambda e: F.struct(*[e[k].alias(k) for k in KEY], F.lit(False).alias("there"))),
    )
    return both.select("side", "id", F.inline(signed))


def _applied(dest: DataFrame, changes: DataFrame) -> DataFrame:
    """Entries after the changes; applying these twice is applying them once."""
    mark = changes.select(*KEY, *RECORD, "there")
    both = dest.withColumn("_held", F.lit(True)).join(mark, [*KEY, *RECORD], "full")
    return both.filter(F.coalesce("there", "_held")).select(*dest.columns)


def _replaced(keys: Sequence[str], value: str):
    """How rows of a batch take the place of those with their keys; without a `value` the key goes."""
    def how(dest: DataFrame, batch: DataFrame) -> DataFrame:
        kept = dest.join(batch.select(*keys), list(keys), "left_anti")
        return kept.unionByName(batch.filter(F.col(value).isNotNull()).select(*dest.columns))

    return how


def _counted(entries: DataFrame, keys: DataFrame) -> DataFrame:
    """Every one of `keys` with its pair, or with nulls where it is not held once on either side."""
    one = F.count_if(F.col("side") == "raw") == 1, F.count_if(F.col("side") == "master") == 1
    both = entries.select(*KEY, *RECORD).unionByName(keys.withColumn("_asked", F.lit(True)), allowMissingColumns=True)
    found = both.groupBy(*KEY).agg(
        F.when(one[0] & one[1], F.min(F.when(F.col("side") == "raw", F.col("id")))).alias("company_id"),
        F.when(one[0] & one[1], F.min(F.when(F.col("side") == "master", F.col("id")))).alias("corporate_number"),
        F.bool_or("_asked").alias("_asked"),
    )
    return found.filter("_asked").drop("_asked")


def connected(pairs: DataFrame, companies: DataFrame, numbers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The companies reached from the given companies and numbers over pairs, and the pairs between them.

    A round adds the pairs that share a company or a number with those reached so far; each is written to the
    shared folder. As many rounds as the longest chain is, and few pairs hang together.
    """
    seen = -1
    while True:
        reached = pairs.join(companies, OWN, "left_semi").unionByName(pairs.join(numbers, "corporate_number", "left_semi"))
        reached = cut_lineage(reached.distinct())
        companies = cut_lineage(companies.union(reached.select(*OWN)).distinct())
        numbers = reached.select("corporate_number").distinct()
        now = reached.count()
        if now == seen:
            return companies, reached
        seen = now


def identify_changes(
    store: SnapshotStore,
    name: str,
    as_of: Column,
    raw: DataFrame | None = None,
    master: DataFrame | None = None,
    gone_raw: DataFrame | None = None,
    gone_master: DataFrame | None = None,
    matchers: Sequence[Matcher] = MATCHERS,
    conflict: str = "parity",
) -> DataFrame:
    """Bring the map below `name` up to date with new, changed and vanished companies; returns it (IDR8, IDR9, PIP3).

    `raw` and `master` hold the present state of companies that are new or may have changed, one row per id, with the
    columns that `matching.candidates` reads; `gone_raw` and `gone_master` the ids of companies that are no more. Rows
    that nothing changed for keep their times, others get `as_of` as `updated_at`; a company's `created_at` is that of
    its first row as long as it stays in the map. Only buckets that the changes touch are read and written, but for
    the narrow `pairs`, which is read whole. A run that stopped half way is made up for by running it again.
    """
    parts = []
    if raw is not None:
        parts.append(_records(raw, "raw", "company_id", RAW_KEYS, matchers))
    if master is not None:
        parts.append(_records(master, "master", "corporate_number", MASTER_KEYS, matchers))
    if gone_raw is not None:
        parts.append(_gone(gone_raw, "raw", "company_id"))
    if gone_master is not None:
        parts.append(_gone(gone_master, "master", "corporate_number"))
    if not parts:
        raise ValueError("no companies given")
    records, entries, pairs, idmap = (f"{name}/{t}" for t in ("records", "entries", "pairs", "map"))
    for table, schema, keys in ((records, _NO_RECORDS, RECORD), (entries, _NO_ENTRIES, KEY), (pairs, _NO_PAIRS, KEY), (idmap, _NO_MAP, OWN)):
        if not store.exists(table):
            store.write_buckets(store.spark.createDataFrame([], schema), table, keys)

    batch = parts[0]
    for p in parts[1:]:
        batch = batch.unionByName(p)
    batch = cut_lineage(batch)
    changes = cut_lineage(_changes(batch, store.read_touched(records, batch, RECORD)))
    store.merge(entries, changes, KEY, _applied, store.spark.createDataFrame([], _NO_ENTRIES))

    keys = cut_lineage(changes.select(*KEY).distinct())
    now = cut_lineage(_counted(store.read_touched(entries, changes, KEY), keys))
    before = store.read_touched(pairs, changes, KEY).join(keys, KEY, "left_semi")
    held = store.read(pairs).join(keys, KEY, "left_anti").unionByName(now.filter("company_id IS NOT NULL"))
    # each round of `connected` reads it
    held = cut_lineage(held.select("company_id", "corporate_number", F.col("method").alias("identify_method")))
    ends = before.select(*COLUMNS[:2]).union(now.filter("company_id IS NOT NULL").select(*COLUMNS[:2]))
    ends = cut_lineage(ends)
    touched, near = connected(held, ends.select(*OWN).distinct(), ends.select("corporate_number").distinct())

    fresh = cascade(None, matching.stamp(near, as_of), matchers, conflict).select(*COLUMNS)
    old = store.read_touched(idmap, touched, OWN).select(*[F.col(c).alias(f"_{c}") for c in COLUMNS])
    same = (F.col("corporate_number") == F.col("_corporate_number")) & (F.col("identify_method") == F.col("_identify_method"))
    rows = touched.join(fresh, OWN, "left").join(old, F.col("company_id") == F.col("_company_id"), "left").select(
        "company_id", "corporate_number", "identify_method",
        F.when(same, F.col("_updated_at")).otherwise(F.col("updated_at")).alias("updated_at"),
        F.coalesce("_created_at", "created_at").alias("created_at"),
    )
    # the records come last: as long as they are the old ones, a rerun finds the same changes
    store.merge(idmap, rows, OWN, _replaced(OWN, "corporate_number"), store.spark.createDataFrame([], _NO_MAP))
    store.merge(pairs, now, KEY, _replaced(KEY, "company_id"), store.spark.createDataFrame([], _NO_PAIRS))
    store.merge(records, batch, RECORD, _replaced(RECORD, "id"), store.spark.createDataFrame([], _NO_RECORDS))
    return store.read(idmap)
