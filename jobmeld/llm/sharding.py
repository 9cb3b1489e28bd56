"""Shards of equal bytes, by histogram sort.

Rows are ordered by key. A shard's border is a place in that order; how many bytes lie below a candidate place is
counted exactly, by all tasks over narrow rows. Candidates are spread over the stretch that must hold the border,
counted, and the stretch shrinks to that between two of them, until no row is left inside. Only then do the rows
themselves move, once, each to the part of its shard that its key falls into.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from jobmeld.llm.common import stored
from jobmeld.operators.dedupe import orderable

FAN = 32  # candidates per border and round
PART_BYTES = 32 << 20  # of a shard's parts, one task each
MOST_PARTS = 1 << 14
_CHUNK = 1000
_KEY = np.dtype([("k", ">u8"), ("a", ">u8"), ("b", ">u4")])
_BITS = 96  # of the content, below the key


class Border(NamedTuple):
    """A stretch of keys, low to high, with the rows and bytes below either end, that holds a border."""

    low: int
    high: int
    rows_low: int
    rows_high: int
    bytes_low: int
    bytes_high: int


def size_of(text: Column) -> Column:
    """Bytes a row takes in its shard: its text and one more."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def _keyed(docs: DataFrame, key: str, text: str) -> list[Column]:
    """Key, 96 bits of the content that order rows with equal keys, and size. A null key comes first."""
    plain = [F.col(f.name) if orderable(f.dataType) else F.to_json(F.struct(f.name)) for f in docs.schema.fields]
    # a hash skips nulls, so where they stand is part of the content
    content = [F.array(*[F.col(c).isNull() for c in docs.columns]), *plain]
    return [
        F.coalesce(F.col(key).cast("bigint"), F.lit(-(1 << 63))).alias("_k"),
        F.xxhash64(*content).alias("_a"),
        F.hash(*content).alias("_b"),
        size_of(F.col(text)).alias("_size"),
    ]


def _sortable(k: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Keys and contents as byte strings that compare as they do."""
    out = np.empty(len(k), _KEY)
    out["k"] = k.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    out["a"] = a.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    out["b"] = b.astype(np.int32).view(np.uint32) ^ np.uint32(1 << 31)
    return out.view(f"S{_KEY.itemsize}")


def _probes(places: list[int]) -> np.ndarray:
    return np.array([p.to_bytes(_KEY.itemsize, "big") for p in places], f"S{_KEY.itemsize}")


def _place(row) -> int:
    k, a, b = (np.array([x]) for x in row)
    return int.from_bytes(_sortable(k, a, b).tobytes(), "big")


def below(keys: DataFrame, places: list[int]) -> list[tuple[int, int]]:
    """(rows, bytes) below each of the ascending `places`, counted over all rows."""
    probes = _probes(places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sizes = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
        for batch in batches:
            k, a, b, size = (c.to_numpy() for c in batch.columns)
            at = np.searchsorted(probes, _sortable(k, a, b), side="right")
            rows += np.bincount(at, minlength=len(rows))
            np.add.at(sizes, at, size)
        seen = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (seen, rows[seen], sizes[seen])], ["at", "rows", "bytes"])

    counted = keys.mapInArrow(run, "at bigint, rows bigint, bytes bigint").groupBy("at").agg(F.sum("rows"), F.sum("bytes"))
    rows, sizes = np.zeros(len(places) + 1, np.int64), np.zeros(len(places) + 1, np.int64)
    # at most one row per candidate
    for at, n, size in counted.collect():
        rows[at], sizes[at] = n, size
    return list(zip(np.cumsum(rows)[:-1].tolist(), np.cumsum(sizes)[:-1].tolist()))


def borders(keys: DataFrame, n_parts: int, per_shard: int, tolerance: float) -> list[Border]:
    """Where the bytes reach 1/n_parts, 2/n_parts, ... of all, each a stretch without a place to cut it any further.

    Every `per_shard`-th is a shard's border: exact, or as near as `tolerance` (of a shard's bytes); the others, which
    only part the work, are done at an eighth of a part.
    """
    rows, total, least, most = keys.agg(F.count(F.lit(1)), F.sum("_size"), F.min("_k"), F.max("_k")).first()
    low, high = ((int(x) + (1 << 63) << _BITS) for x in (least, most))
    start = Border(low, high + (1 << _BITS), 0, rows, 0, total)
    found = [start] * (n_parts - 1)

    def done(i: int) -> bool:
        x = found[i]
        near = tolerance * total * per_shard / n_parts if (i + 1) % per_shard == 0 else total / n_parts / 8
        return x.high - x.low == 1 or x.rows_high - x.rows_low <= 1 or x.bytes_high - x.bytes_low <= near

    while open_ := [i for i in range(n_parts - 1) if not done(i)]:
        wanted: set[int] = set()
        for i in open_:
            step = found[i].high - found[i].low
            wanted |= {found[i].low + step * f // FAN for f in range(1, FAN)} - {found[i].low}
        places = sorted(wanted)
        counts = below(keys, places)
        reached = [size * n_parts for _, size in counts]
        for i in open_:
            x = found[i]
            at = bisect_right(reached, (i + 1) * total)
            if at and places[at - 1] > x.low:
                n, size = counts[at - 1]
                x = x._replace(low=places[at - 1], rows_low=n, bytes_low=size)
            if at < len(places) and places[at] < x.high:
                n, size = counts[at]
                x = x._replace(high=places[at], rows_high=n, bytes_high=size)
            found[i] = x
    return found


def shard(
    docs: DataFrame, n_shards: int = 8, key: str = "doc_id", text: str = "text", tolerance: float = 0.0
) -> DataFrame:
    """The rows of `docs` with their size in bytes, shard and slot, shards holding equal bytes.

    Rows stand in the order of `key` (an integer; nulls first), those with one key in the order of a hash of their
    content, so shards are stretches of keys and a frequent key is divided among shards. A shard ends at the row
    border that is nearest to its share of all bytes, the lower one on a tie; with a `tolerance` above 0, within that
    part of a share. Slots count up from 0 in that order. The result depends on the rows alone, not on how they are
    laid out.

    A null or empty `text` has size 1, a very long one is a row like others and may exceed a share by itself. Rows
    equal in all columns are interchangeable: a large group of them that lies across a border is counted, not moved,
    and written out again from one row by many tasks. Fewer rows than shards leave shards empty; an empty table gives
    no rows. The columns `size`, `shard` and `slot` replace such columns of `docs`; others go through, whatever their
    names.
    """
    spark = docs.sparkSession
    added = ("size", "shard", "slot")
    columns = [c for c in docs.columns if c not in added]
    docs = docs.select(*columns)
    keyed = docs.select(F.struct(*columns).alias("_row"), *_keyed(docs, key, text))
    keys = stored(keyed.drop("_row"), "keys")
    total = keys.agg(F.coalesce(F.sum("_size"), F.lit(0))).first()[0]
    if not total:
        return docs.select("*", F.lit(0).cast("bigint").alias("size"), F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"))
    per_shard = min(max(1, -(-total // (n_shards * PART_BYTES))), max(1, MOST_PARTS // n_shards))
    n_parts = n_shards * per_shard
    found = borders(keys, n_parts, per_shard, tolerance)

    # a border between copies of one row: how many of them come before it
    cuts, starts, copies = [], [], {}
    shard_starts = []
    for i, x in enumerate(found):
        many, size = x.rows_high - x.rows_low, x.bytes_high - x.bytes_low
        before = (i + 1) * total - x.bytes_low * n_parts
        if x.high - x.low == 1 and many > 1 and size * n_parts > total / 8:
            copies[x.low] = x.rows_low, many
            taken = -((size * n_parts - 2 * before * many) // (2 * size * n_parts))
            place, first, position = x.high, x.rows_high, x.rows_low + taken
        elif 2 * before <= size * n_parts:
            place, first, position = x.low, x.rows_low, x.rows_low
        else:
            place, first, position = x.high, x.rows_high, x.rows_high
        cuts.append(place)
        starts.append(first)
        if (i + 1) % per_shard == 0:
            shard_starts.append(position)
    order = sorted(range(len(cuts)), key=cuts.__getitem__)
    probes, starts = _probes([cuts[i] for i in order]), [0, *[starts[i] for i in order]]
    shard_starts = [0, *np.maximum.accumulate(shard_starts).tolist()] if shard_starts else [0]
    moved_apart = _probes(sorted(copies))

    @F.pandas_udf("int")
    def part_of(k: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        rows = _sortable(k.to_numpy(), a.to_numpy(), b.to_numpy())
        part = np.searchsorted(probes, rows, side="right")
        return pd.Series(np.where(np.isin(rows, moved_apart), -1, part).astype(np.int32))

    def placed(rows: DataFrame, position: Column) -> DataFrame:
        first = F.array(*[F.lit(int(p)).cast("bigint") for p in shard_starts])
        with_place = rows.select("_row", "_size", position.alias("_position"))
        # the last shard that starts at or before the place: empty ones start where the next does
        number = F.size(F.filter(first, lambda p: p <= F.col("_position"))) - 1
        return with_place.select(
            "_row.*", F.col("_size").alias("size"), number.alias("shard"),
            (F.col("_position") - F.get(first, number)).alias("slot"),
        )

    dealt = keyed.withColumn("_part", part_of("_k", "_a", "_b"))
    main = dealt.filter("_part >= 0") if copies else dealt
    main = main.repartitionById(n_parts, F.col("_part")).sortWithinPartitions("_part", "_k", "_a", "_b")
    # a part is a partition, so its rows are counted where they lie
    index = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    here = F.when(F.spark_partition_id() == F.col("_part"), index).otherwise(F.raise_error(F.lit("a part was divided")))
    begin = F.get(F.array(*[F.lit(int(s)).cast("bigint") for s in starts]), F.col("_part"))
    out = placed(main, begin + here)
    if copies:
        known = spark.createDataFrame(list(copies.values()), "_first bigint, _many bigint")
        one = dealt.filter("_part < 0").groupBy("_k", "_a", "_b").agg(F.first("_row").alias("_row"), F.first("_size").alias("_size"))
        one = stored(one, "copied")
        first_of = {p: first for p, (first, _) in copies.items()}
        # at most one row per border
        marks = [(r["_k"], r["_a"], r["_b"]) for r in one.select("_k", "_a", "_b").collect()]
        base = spark.createDataFrame([(*m, first_of[_place(m)]) for m in marks], "_k bigint, _a bigint, _b int, _first bigint")
        each = one.join(base, ["_k", "_a", "_b"]).join(known, "_first")
        chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_many") - 1, F.lit(_CHUNK).cast("bigint")))
        each = each.select("_row", "_size", "_first", "_many", chunk.alias("_chunk")).repartition("_first", "_chunk")
        last = F.least(F.col("_chunk") + (_CHUNK - 1), F.col("_many") - 1)
        each = each.select("_row", "_size", "_first", F.explode(F.sequence("_chunk", last)).alias("_copy"))
        out = out.union(placed(each, F.col("_first") + F.col("_copy")))
    return out


def write(shards: DataFrame, path: str) -> None:
    """One folder per shard, `shard=k`, its files in the order of the slots they hold."""
    shards.write.partitionBy("shard").parquet(path)
