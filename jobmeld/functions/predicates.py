"""Conditions shared by the merge and enrichment operators."""

from __future__ import annotations

import operator
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, functions as F, types as T


def has_value(col: Column, dtype: T.DataType) -> Column:
    """Not null; for strings also not empty, for arrays also not of size 0 (FLT1). Never null."""
    if isinstance(dtype, T.StringType):
        return F.coalesce(col != "", F.lit(False))
    if isinstance(dtype, T.ArrayType):
        return F.coalesce(F.size(col) > 0, F.lit(False))
    return col.isNotNull()


def any_of(conditions: Iterable[Column]) -> Column:
    """True when at least one condition holds (FN11)."""
    return reduce(operator.or_, conditions)


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(operator.and_, conditions)


def fill_null(col: Column, value: Column) -> Column:
    """`value` only where `col` is null (FLT3)."""
    return F.when(col.isNull(), value).otherwise(col)


def when_present(col: Column, value: Column) -> Column:
    """`value` only where `col` is there (FLT4)."""
    return F.when(col.isNotNull(), value)


def filled_key(*cols: Column) -> Column:
    """All parts of a match key are there and not blank."""
    return all_of(F.coalesce(F.trim(c) != "", F.lit(False)) for c in cols)


def text_hash(col: Column) -> Column:
    """sha-256 hex of a text, null as blank (FN1, FN2)."""
    return F.sha2(F.coalesce(col.cast("string"), F.lit("")), 256)
