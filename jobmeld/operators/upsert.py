"""Upsert where a new non-null value wins and a null never erases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobmeld.functions.binding import detached
from jobmeld.operators.dedupe import orderable
from jobmeld.sources.schema import backfill, evolve

JOB_KEYS = ("media_internal_id", "media_code")
# the version of each value, where a table keeps them
VERSIONS = "_versions"


def rename_select(df: DataFrame, columns: Sequence[tuple[str, str | None]]) -> DataFrame:
    """Select (name, alias) pairs; no alias keeps the name (PRJ1)."""
    return df.select(*[F.col(n).alias(a or n) for n, a in columns])


def tag_source(df: DataFrame, media: str) -> DataFrame:
    """Mark rows with their source (PRJ3)."""
    return df.withColumn("media_code", F.lit(media))


def stamped(df: DataFrame, as_of: Column) -> DataFrame:
    return df.select("*", as_of.alias("created_at"), as_of.alias("updated_at"))


def fold(
    changes: DataFrame,
    seq: str | None = None,
    keys: Sequence[str] = JOB_KEYS,
    created: str = "created_at",
    first_wins: Sequence[str] = ("_ingest_id",),
) -> DataFrame:
    """Changes as one row per key, equal to upserting them in the order of `seq`.

    Each column is reduced by itself, in one aggregate: its last non-null value by `seq`, the first one
    for `created` and `first_wins`. Among values of the same `seq`, or without one, the largest counts
    as the last and the smallest as the first. A null never takes the place of a value, and no value
    depends on how the rows are laid out. A null in `seq` comes before all others.
    """
    values = [c for c in changes.columns if c not in keys and c != seq]
    if not values:
        return changes.select(*keys).distinct()
    picks = _picks(changes, values, seq, created, first_wins)
    return changes.groupBy(*keys).agg(*picks).select(*[c for c in changes.columns if c != seq])


def _tie(df: DataFrame, c: str, side: str = "") -> Column:
    # maps and variants have no order; their text has
    col = F.col(side + c)
    return col if orderable(df.schema[c].dataType) else F.to_json(col)


def _picks(
    changes: DataFrame, values: Sequence[str], seq: str | None, created: str, first_wins: Sequence[str], what: str | None = None
) -> list[Column]:
    """Per column its last value, or the first one; or `what` stands beside it."""
    out = []
    for c in values:
        pick = F.min_by if c == created or c in first_wins else F.max_by
        rank = F.struct(*([F.col(seq)] if seq else []), _tie(changes, c))
        out.append(pick(F.col(what or c), F.when(F.col(c).isNotNull(), rank)).alias(c))
    return out


def fold_versions(
    changes: DataFrame,
    seq: str,
    keys: Sequence[str] = JOB_KEYS,
    created: str = "created_at",
    first_wins: Sequence[str] = ("_ingest_id",),
) -> DataFrame:
    """`fold` that also keeps, as a map in `_versions`, the `seq` of every value."""
    values = [c for c in changes.columns if c not in keys and c != seq]
    versions = [c.alias(f"_v{i}") for i, c in enumerate(_picks(changes, values, seq, created, first_wins, seq))]
    one = changes.groupBy(*keys).agg(*_picks(changes, values, seq, created, first_wins), *versions)
    entries = F.array(*[F.struct(F.lit(c).alias("key"), F.col(f"_v{i}").alias("value")) for i, c in enumerate(values)])
    known = F.filter(entries, lambda e: e["value"].isNotNull())
    return one.select(*[c for c in changes.columns if c != seq], F.map_from_entries(known).alias(VERSIONS))


def upsert_versions(
    dest: DataFrame,
    src: DataFrame,
    keys: Sequence[str] = JOB_KEYS,
    created: str = "created_at",
    first_wins: Sequence[str] = ("_ingest_id",),
) -> DataFrame:
    """Merge rows of `fold_versions` into a table that keeps versions as well.

    A value gives way to one of a later version only, whichever of them arrives later; `created` and `first_wins`
    columns to one of an earlier version. Of the same version the larger value counts as the later one. A value
    without a version, as of a table that kept none so far, is older than any. So any division of records into merges,
    and any order of these, gives one table.
    """
    dest = evolve(dest, src)
    src = backfill(src, dest)
    out, versions = [F.coalesce(F.col(f"d.{k}"), F.col(f"s.{k}")).alias(k) for k in keys], []
    for c in dest.columns:
        if c in keys or c == VERSIONS:
            continue
        old, new = F.col(f"d.{c}"), F.col(f"s.{c}")
        at = {side: F.try_element_at(F.col(f"{side}.{VERSIONS}"), F.lit(c)) for side in "ds"}
        had, comes = (F.struct(at[side], _tie(dest, c, f"{side}.")) for side in "ds")
        wins = comes < had if c == created or c in first_wins else comes > had
        takes = new.isNotNull() & (old.isNull() | wins)
        out.append(F.when(takes, new).otherwise(old).alias(c))
        versions.append(F.struct(F.lit(c).alias("key"), F.when(takes, at["s"]).otherwise(at["d"]).alias("value")))
    known = F.map_from_entries(F.filter(F.array(*versions), lambda e: e["value"].isNotNull()))
    cond = [F.col(f"d.{k}") == F.col(f"s.{k}") for k in keys]
    merged = dest.alias("d").join(src.alias("s"), cond, "full").select(*out, known.alias(VERSIONS))
    return merged.select(*dest.columns)


def upsert(
    dest: DataFrame,
    src: DataFrame,
    keys: Sequence[str] = JOB_KEYS,
    created: str = "created_at",
    first_wins: Sequence[str] = ("_ingest_id",),
    order: str | None = None,
) -> DataFrame:
    """Merge a batch into the table on a composite key (UPS3, JN7).

    Per column the batch's value if it has one, else the table's; `created` never changes and
    `first_wins` columns keep the table's value. A key that the batch repeats is first reduced to one
    row, column by column (`fold`), by the batch's column `order` if one is named.
    """
    dest = evolve(dest, src)
    layout = backfill(src, dest)
    if order:
        layout = layout.withColumn("_order", F.col(order))
    return _joined(dest, fold(layout, "_order" if order else None, keys, created, first_wins), keys, created, first_wins)


def upsert_stored(
    dest: DataFrame,
    src: DataFrame,
    keys: Sequence[str] = JOB_KEYS,
    created: str = "created_at",
    first_wins: Sequence[str] = ("_ingest_id",),
) -> DataFrame:
    """`upsert` of a batch that is stored, as `SnapshotStore.merge` gives it.

    Its keys, which are narrow, are counted first. Only the rows of keys that repeat are reduced, which sorts them whole;
    most batches have none.
    """
    again = src.groupBy(*keys).count().filter("count > 1").select(*keys)
    if again.isEmpty():
        dest = evolve(dest, src)
        return _joined(dest, backfill(src, dest), keys, created, first_wins)
    key = [F.col(f"b.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    again = again.select(*[detached(F.col(k)).alias(k) for k in keys]).alias("r")
    once = src.alias("b").join(again, key, "left_anti")
    folded = fold(src.alias("b").join(again, key, "left_semi"), None, keys, created, first_wins)
    dest = evolve(dest, src)
    return _joined(dest, backfill(once.unionByName(folded), dest), keys, created, first_wins)


def _joined(dest: DataFrame, src: DataFrame, keys: Sequence[str], created: str, first_wins: Sequence[str]) -> DataFrame:
    """Both sides with one row per key, column by column."""
    cond = [F.col(f"d.{k}") == F.col(f"s.{k}") for k in keys]
    out = []
    for c in dest.columns:
        old, new = F.col(f"d.{c}"), F.col(f"s.{c}")
        table_first = c == created or c in first_wins
        out.append((F.coalesce(old, new) if table_first else F.coalesce(new, old)).alias(c))
    return dest.alias("d").join(src.alias("s"), cond, "full").select(*out)
