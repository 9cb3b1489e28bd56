"""Near-duplicates by SimHash, found through deletion variants of two half fingerprints.

Two fingerprints that differ in three bits at most differ in one bit at most on one of their halves. Each half
is indexed under its 32 variants with one bit blanked out, so such halves share a variant, and an equality
grouping by variant brings every linked pair together. Within a variant the full distance is verified and a
spanning forest of the links is emitted instead of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from jobmeld.functions.binding import detached
from jobmeld.llm.common import chunks, only, row_keys, stored, without
from jobmeld.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
_HALF = 32
LARGE = 1000  # fingerprints of a variant that are compared without dividing them first
_hash = partial(xxhash.xxh64_intdigest, seed=SEED)
_UNIT_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit i is set where more than half of the shingles' hashes, repeats included, have it; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [_hash(b" ".join(words))]
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = [0, *(ends[:-1] + 1).tolist()]
        hashes = [_hash(line[a:b]) for a, b in zip(starts, ends[shingle - 1 :].tolist())]
    units = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(units[:, k], minlength=256) @ _UNIT_BITS for k in range(8)])
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, r1, r2, fp) of every whole text, fp as a signed 64-bit integer; a null text has no words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in chunks(batch.column(3)):
                found = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
                kept = [batch.column(i).slice(start, len(texts)) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(found)], ["doc_id", "r1", "r2", "fp"])

    narrow = docs.select(
        "doc_id", *row_keys("doc_id", "text"),
        F.col("text").cast("binary").alias("text"),
    )
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, r1 bigint, r2 int, fp bigint")


def variants(fps: DataFrame) -> DataFrame:
    """(variant, fp): 64 rows per fingerprint. The variant holds half, blanked place and the other 31 bits."""
    half = F.when(F.col("v") < _HALF, F.col("fp").bitwiseAND(0xFFFFFFFF)).otherwise(
        F.shiftrightunsigned("fp", _HALF)
    )
    blanked = half.bitwiseAND(F.expr("~shiftleft(1L, v % 32)"))
    return fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(2 * _HALF - 1))).alias("v")).select(
        blanked.bitwiseOR(F.expr("shiftleft(cast(v as bigint), 32)")).alias("variant"), "fp"
    )


def forest(fps: np.ndarray, most: int) -> tuple[list[int], list[int]]:
    """Links that connect whatever fingerprints are connected at `most` bits; one fewer than the members each."""
    a, b, rest = [], [], fps
    while rest.size > 1:
        reached, rest = [rest[0]], rest[1:]
        while reached and rest.size:
            at = reached.pop()
            near = np.bitwise_count(rest ^ at) <= most
            if near.any():
                hits, rest = rest[near], rest[~near]
                a += [int(at)] * len(hits)
                b += hits.tolist()
                reached += list(hits)
    return a, b


def _divided(fps: np.ndarray, low: bool, most: int) -> tuple[list[int], list[int]]:
    """`forest` of a large variant, whose members differ in one bit of their low (or high) half at most.

    On the other half they differ in three bits at most, so on one quarter in one bit at most: members are compared
    where such a quarter agrees but for one blanked bit. Sorting takes the place of most comparisons.
    """
    other = (fps >> np.uint64(_HALF if low else 0)) & np.uint64(0xFFFFFFFF)
    a, b = [], []
    for v in range(_HALF):
        quarter = (other >> np.uint64(16 * (v // 16))) & np.uint64(0xFFFF)
        key = quarter & ~np.uint64(1 << (v % 16))
        order = np.argsort(key, kind="stable")
        cuts = np.flatnonzero(np.diff(key[order])) + 1
        for some in np.split(order, cuts):
            if len(some) > 1:
                x, y = forest(fps[some], most)
                a += x
                b += y
    return a, b


def _links(keys: np.ndarray, fps: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the runs of equal variants.

    Halves that are equal meet under all 32 variants; they are compared under the first one only.
    """
    new = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    starts = np.concatenate([[0], new])
    sizes = np.diff(np.concatenate([starts, [len(keys)]]))
    v = keys[starts] >> 32
    bit = ((fps >> (keys >> 32).astype(np.uint64)) & np.uint64(1)).astype(np.int64)
    ones = np.add.reduceat(bit, starts)
    todo = (sizes > 1) & ((v % _HALF == 0) | ((ones > 0) & (ones < sizes)))
    pairs = starts[todo & (sizes == 2)]
    near = np.bitwise_count(fps[pairs] ^ fps[pairs + 1]) <= most
    a, b = fps[pairs[near]].tolist(), fps[pairs[near] + 1].tolist()
    large = todo & (sizes > 2)
    for at, n, kind in zip(starts[large].tolist(), sizes[large].tolist(), v[large].tolist()):
        some = fps[at : at + n]
        x, y = forest(some, most) if n <= LARGE else _divided(some, kind < _HALF, most)
        a += x
        b += y
    return np.array(a, np.uint64).view(np.int64), np.array(b, np.uint64).view(np.int64)


def links(fps: DataFrame, most: int = MAX_BITS) -> DataFrame:
    """(a, b): links between the distinct fingerprints `fps` that connect what is connected at `most` bits.

    One shuffle of 64 narrow rows per fingerprint, sorted and read as a stream; what a task holds is one batch
    and the fingerprints of one variant, 8 bytes each. A variant of many is divided by the other half, so that
    the comparisons do not grow with the square of its size.
    """
    if most > MAX_BITS:
        raise ValueError(f"two halves with one blanked bit find {MAX_BITS} bits at most")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            keys = batch.column(0).to_numpy()
            fps_ = batch.column(1).to_numpy().view(np.uint64)
            if not len(keys):
                continue
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut or (held and held[0][0][0] != keys[0]):
                ready = [*held, (keys[:cut], fps_[:cut])]
                held = []
                yield batch_of(*_links(*map(np.concatenate, zip(*ready)), most))
            held.append((keys[cut:], fps_[cut:]))
        if held:
            yield batch_of(*_links(*map(np.concatenate, zip(*held)), most))

    def batch_of(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    dealt = variants(fps).repartition("variant").sortWithinPartitions("variant")
    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, most: int = MAX_BITS) -> DataFrame:
    """(doc_id, r1, r2, fingerprint, group, component_id), one row per input row.

    Documents whose fingerprints differ in `most` bits or fewer are linked, whatever their length; texts without words
    share fingerprint zero. `group` names the component by a fingerprint, `component_id` is the smallest doc_id in it,
    null if none has one. Exact copies and repeated rows meet as one fingerprint before the search; nothing is
    collected. A null or empty text has no words; texts are read whole, of any length; an empty table gives no rows;
    columns other than doc_id and text, whatever their names, are not read.
    """
    found = stored(fingerprints(docs, shingle), "fingerprints")
    first = stored(found.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = components(links(first.select("fp"), most))
    named = first.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("group")
    )
    named = stored(named, "groups")
    least = named.groupBy("group").agg(F.min("first_id").alias("component_id"))
    least = least.select(detached(F.col("group")).alias("of"), "component_id")
    known = named.join(least, F.col("group") == F.col("of")).select(F.col("fp").alias("key"), "group", "component_id")
    return found.join(known, F.col("fp") == F.col("key")).select(
        "doc_id", "r1", "r2", hex16(F.col("fp")).alias("fingerprint"), "group", "component_id"
    )


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, one of each group of `found`: its smallest doc_id, then smallest row key.

    `found` is what `near_duplicates` gives for `docs`. Of rows equal in id and text one stays, that with the least
    other columns. Columns are those of `docs`; texts are shuffled only where the rows that go are too many to broadcast.
    """
    found = stored(found.select("doc_id", "r1", "r2", "group"), "duplicates")
    best = found.groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "r1", "r2")).alias("best")
    )
    best = best.select("best.r1", "best.r2")
    keys = stored(found.groupBy("r1", "r2").agg(F.count(F.lit(1)).alias("n")), "row-keys")
    going = keys.join(best, ["r1", "r2"], "left_anti").select("r1", "r2")
    repeated = keys.filter("n > 1").select("r1", "r2")
    single = without(docs, going.union(repeated), "doc_id", "text")
    return single.union(_first_of(docs, repeated.join(best, ["r1", "r2"], "left_semi")))


def _first_of(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """One row of `docs` for each of `keys`, by the order of the columns that have one."""
    fields = [f for f in docs.schema.fields if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]
    order = F.struct(*[F.col(f.name) for f in fields])
    whole = only(docs, keys, "doc_id", "text").select(
        *row_keys("doc_id", "text"), F.struct("*").alias("row"), order.alias("order")
    )
    kept = whole.groupBy("r1", "r2").agg(F.min_by("row", "order").alias("row"))
    return kept.select("row.*")
