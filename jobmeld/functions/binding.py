"""Expressions that steer evaluation, not values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def detached(col: Column) -> Column:
    """The same value as an expression Spark does not connect with an earlier grouping by `col`.

    A join on a grouped side would take that grouping's shuffle over, and adaptive execution splits
    a hot key only where the join has a shuffle of its own on either side. Joined on the detached
    key, the grouped side, one row per key, is shuffled once more and hot keys of the other side are
    split.
    """
    return F.greatest(col, col)
