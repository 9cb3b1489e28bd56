"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from jobmeld.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: lineage ends there, a lost executor loses nothing."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_keys(*columns: str) -> list[Column]:
    """96 bits that tell rows with other values in `columns` apart; never null."""
    return [F.xxhash64(*columns).alias("r1"), F.hash(*columns).alias("r2")]


def without(docs: DataFrame, keys: DataFrame, *columns: str) -> DataFrame:
    """The rows of `docs` whose key over `columns` is not in `keys` (r1, r2), whatever else `docs` holds.

    Broadcast by Spark where the keys turn out to be few, else one shuffle of `docs`.
    """
    return _by_key(docs, keys, columns, "left_anti")


def only(docs: DataFrame, keys: DataFrame, *columns: str) -> DataFrame:
    """The rows of `docs` whose key over `columns` is in `keys` (r1, r2)."""
    return _by_key(docs, keys, columns, "left_semi")


def _by_key(docs: DataFrame, keys: DataFrame, columns: tuple[str, ...], how: str) -> DataFrame:
    r1, r2 = row_keys(*[f"d.{c}" for c in columns])
    right = keys.select(F.col("r1").alias("k1"), F.col("r2").alias("k2")).distinct().alias("k")
    return docs.alias("d").join(right, (r1 == F.col("k.k1")) & (r2 == F.col("k.k2")), how)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, UPPER, LOWER)


def buffers(column: pa.Array) -> Iterator[bytes]:
    """The values of a binary column; a null is empty."""
    for v in column:
        yield v.as_py() or b""


def chunks(column: pa.Array, limit: int = 1 << 21) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, values) of runs of rows whose values hold some `limit` bytes together, or one row that holds more."""
    start, size, run = 0, 0, []
    for i, value in enumerate(buffers(column)):
        run.append(value)
        size += len(value)
        if size >= limit:
            yield start, run
            start, size, run = i + 1, 0, []
    if run:
        yield start, run
