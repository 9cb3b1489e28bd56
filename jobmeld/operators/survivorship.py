"""Golden record: each column keeps the value of the best source, with its quality and time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobmeld.functions.predicates import any_of, has_value
from jobmeld.sources.schema import backfill, consolidate, evolve

KEY = "corporate_number"


def scored(src: DataFrame, columns: Sequence[tuple[str, str]], quality: int, as_of: Column, key: str = KEY) -> DataFrame:
    """Source columns as value, quality, time triples (PRJ2, UPS2).

    `columns` are (source column, master column). The quality of a missing value is 0.
    """
    out = [F.col(key)]
    for name, alias in columns:
        full = has_value(F.col(name), src.schema[name].dataType)
        out += [
            F.col(name).alias(alias),
            F.when(full, F.lit(quality)).otherwise(F.lit(0)).alias(f"{alias}_quality"),
            as_of.alias(f"{alias}_updated_at"),
        ]
    return src.select(*out, as_of.alias("updated_at"), as_of.alias("created_at"))


def fold(feeds: Sequence[DataFrame], key: str = KEY) -> DataFrame:
    """Scored rows of several sources as one row per key, equal to merging them one after the other (SET2).

    Per column the filled value of the highest quality, of the last such feed on a tie; where no feed
    has a value, what the first feed with this key holds. One aggregate and one later merge take the
    place of a rewrite of the master table per source. All feeds carry the same time.
    """
    union = consolidate([f.select("*", F.lit(i).alias("_feed")) for i, f in enumerate(feeds)])
    carried = [c[: -len("_quality")] for c in union.columns if c.endswith("_quality")]
    types = {f.name: f.dataType for f in union.schema.fields}
    picks, out = [], [F.col(key)]
    for c in carried:
        triple = F.struct(*[F.col(x) for x in (c, f"{c}_quality", f"{c}_updated_at")])
        rank = F.when(has_value(F.col(c), types[c]), F.struct(F.col(f"{c}_quality"), F.col("_feed")))
        picks += [F.max_by(triple, rank).alias(f"_best_{c}"), F.min_by(triple, F.col("_feed")).alias(f"_first_{c}")]
        for x in (c, f"{c}_quality", f"{c}_updated_at"):
            best = F.col(f"_best_{c}")
            out.append(F.when(best.isNotNull(), best[x]).otherwise(F.col(f"_first_{c}")[x]).alias(x))
    times = ["updated_at", "created_at"]
    picks += [F.min(t).alias(t) for t in times]
    return union.groupBy(key).agg(*picks).select(*out, *times)


def survive(dest: DataFrame, src: DataFrame, key: str = KEY) -> DataFrame:
    """Merge scored rows into the master table (UPS1, JN6).

    A column moves when the source has a value and the table's quality for it is unknown or not
    higher; its quality and time move with it. `updated_at` moves when any column did. New keys come
    in whole. Both sides have one row per key, so the outer join neither fans out nor skews.
    """
    dest = evolve(dest, src)
    carried = [c[: -len("_quality")] for c in src.columns if c.endswith("_quality")]
    src = backfill(src, dest)
    d, s = dest.alias("d"), src.alias("s")

    def dc(c):
        return F.col(f"d.{c}")

    def sc(c):
        return F.col(f"s.{c}")

    fresh = dc(key).isNull()
    moves = {
        c: F.coalesce(
            has_value(sc(c), dest.schema[c].dataType)
            & (dc(f"{c}_quality").isNull() | (dc(f"{c}_quality") <= sc(f"{c}_quality"))),
            F.lit(False),
        )
        for c in carried
    }
    out = [F.coalesce(dc(key), sc(key)).alias(key)]
    for c in dest.columns:
        if c == key:
            continue
        owner = next((o for o in (c, c.removesuffix("_quality"), c.removesuffix("_updated_at")) if o in moves), None)
        if c == "updated_at":
            cond = fresh | any_of(moves.values())
        elif owner:
            cond = fresh | moves[owner]
        else:
            cond = fresh
        out.append(F.when(cond, sc(c)).otherwise(dc(c)).alias(c))
    return d.join(s, dc(key) == sc(key), "full").select(*out)
