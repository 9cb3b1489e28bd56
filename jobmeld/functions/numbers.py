"""Numbers and casts. ANSI mode is on by default, so every cast that may fail is a try-cast."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"


def salary(col: Column, dtype: str = MONEY) -> Column:
    """Amount written with dots, commas or blanks between the digits; other text gives null (FN7)."""
    digits = F.regexp_replace(col, r"[.,\s]", "")
    return F.when(col.rlike(r"^[\d.,\s]+$"), digits.try_cast(dtype))


def to_decimal(col: Column, dtype: str = MONEY) -> Column:
    """Decimal, or null where the value does not fit (FN5)."""
    return col.try_cast(dtype)


def to_text(col: Column) -> Column:
    return col.cast("string")


def as_array(col: Column) -> Column:
    """A scalar as a one-element array, null stays null (FN4)."""
    return F.when(col.isNotNull(), F.array(col))
