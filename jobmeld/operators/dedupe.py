"""One row per key, chosen the same way on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from jobmeld.functions.binding import detached
from jobmeld.functions.predicates import has_value


def orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return False
    if isinstance(dtype, T.ArrayType):
        return orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(orderable(f.dataType) for f in dtype.fields)
    return True


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """The row of each key that comes first by `order`, then by all other columns (DD1, DD2, DD3, DD5).

    An aggregate rather than a window: each task reduces its own rows first, so a key that holds a
    large share of the table sends one row per task through the shuffle instead of all its rows.
    """
    rest = [c for c in df.columns if c not in keys]
    ranks = [o.alias(f"_o{i}") for i, o in enumerate(order)]
    if not rest:
        return df.select(*keys).distinct()
    odd = [c for c in rest if not orderable(df.schema[c].dataType)]
    if odd:
        tie = [F.to_json(c).alias(c) if c in odd else F.col(c) for c in rest]
        picked = F.min_by(F.struct(*rest), F.struct(*ranks, *tie))
    else:
        picked = F.min(F.struct(*ranks, *rest))
    row = df.groupBy(*keys).agg(picked.alias("_row"))
    return row.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def filled_count(df: DataFrame, columns: Sequence[str]) -> Column:
    """How many of `columns` hold a value."""
    marks = [has_value(F.col(c), df.schema[c].dataType).cast("int") for c in columns]
    return sum(marks[1:], marks[0])


def one_per_id(df: DataFrame, key: str) -> DataFrame:
    """One row per id: the one with the most values, ties by all columns (DD1, DD2).

    Rows without an id are not repeats of one another; take them out before (`with_id`).
    """
    rest = [c for c in df.columns if c != key]
    return keep_first(df, [key], [-filled_count(df, rest)] if rest else [])


def with_id(df: DataFrame, key: str) -> Column:
    """Whether a row has an id: neither null nor, for text, blank."""
    col = F.col(key)
    return F.coalesce(F.trim(col) != "", F.lit(False)) if isinstance(df.schema[key].dataType, T.StringType) else col.isNotNull()


def keep_fullest(df: DataFrame, key: str, columns: Sequence[str], tie: str) -> DataFrame:
    """The most complete row of each key, ties by the smallest `tie` (DD3)."""
    return keep_first(df, [key], [-filled_count(df, columns), F.col(tie)])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values of a column (DD4)."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct()


def unseen(items: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Items whose key the known table lacks (SRC4, JN4b).

    Of the known side only the key is read, reduced to one row per key before the join.
    """
    ids = distinct_values(known, key).select(detached(F.col(key)).alias(key))
    return items.join(ids, key, "left_anti")
