"""Token ids as files with constant-time access by document key.

Two tables. `blocks`: raw ids of consecutive documents in ascending key order, with the documents' offsets.
`index`: one minimal perfect hash per hash bucket of keys, whose slots hold a fingerprint of the key and
the place of its document. A key is looked up with one bucket, one slot and one block.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from jobmeld.session import scratch_path

BLOCK_IDS = 1 << 19  # a block ends with the document that fills it
BUCKET_KEYS = 20_000
_BYTES = 1 << 23  # of texts whose runs are encoded together, or one text that holds more
_RUNS = 1 << 17  # whose ids are laid out together, or those of one text
_JOINED, _ASKED = 100, 50  # words that the library gets as one text, and texts at a time
_REMEMBERED = 600_000  # words whose ids a worker keeps
_LETTERS = r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+$"
_NUMBERED = 10_000
_LEVEL_ROOM = 2  # places per key on each level of the hash


class Encoder:
    """The tokenizers library, asked for the distinct runs of a batch only; ids are gathered by their places.

    No token crosses ASCII white space, so a run without it is encoded by itself, and so are stops and commas behind
    a letter or digit. Words of Latin letters go to the library many to a text, in which a token at a word's end
    tells it from the next. Where a vocabulary turns out not to drop white space and case, texts are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values(), default=-1) + 1
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        # the first words met, in Arrow, and where their ids stand
        self.words, self.start, self.size_of = pa.array([], pa.string()), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.pool = np.zeros(0, np.uint32)
        self.separable = self._drops_white_space_and_case()

    def _drops_white_space_and_case(self) -> bool:
        whole = self._ids(["  Ab, cd.\t\nEFG;h i9. \x0bÉtÉ!? "])[0]
        parts = self._ids(["ab", ",", "cd", ".", "efg", ";h", "i9", ".", "ÉtÉ", "!?"])
        words = self._ids(["ab efg été"])[0]
        return whole.tolist() == np.concatenate(parts).tolist() and int(self.ends[words].sum()) == 3

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [
            np.array(e.ids, np.uint32)
            for i in range(0, len(texts), _ASKED)
            for e in self.library.encode_batch_fast(texts[i : i + _ASKED], add_special_tokens=False)
        ]

    def _known(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pool, start, size) of words of Latin letters; those met before come from memory."""
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy()
        new = np.flatnonzero(at < 0)
        asked = words.take(pa.array(new)).to_pylist()
        ids = np.concatenate([*self._ids([" ".join(asked[i : i + _JOINED]) for i in range(0, len(asked), _JOINED)]), np.zeros(0, np.uint32)])
        last = np.flatnonzero(self.ends[ids])
        if len(last) != len(asked):
            raise ValueError("the vocabulary's tokens do not tell where a word ends")
        size, start = np.empty(len(words), np.int32), np.empty(len(words), np.int32)
        held = at >= 0
        size[held], start[held] = self.size_of[at[held]], self.start[at[held]]
        size[new] = np.diff(last, prepend=-1)
        start[new] = len(self.pool) + last + 1 - size[new]
        pool = np.concatenate([self.pool, ids])
        if len(asked) and len(self.words) + len(asked) <= _REMEMBERED:
            self.words = pa.concat_arrays([self.words, pa.array(asked, pa.string())])
            self.start, self.size_of = np.append(self.start, start[new]), np.append(self.size_of, size[new])
            self.pool = pool
        return pool, start, size

    def _pool(self, runs: pa.Array, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of distinct runs one behind the other; where each one's start, and how many they are. `plain` ones are
        words of Latin letters.
        """
        words, others = runs.filter(pa.array(plain)), runs.filter(pa.array(~plain)).to_pylist()
        pool, known_start, known_size = self._known(words)
        apart = self._ids(others)
        size, start = np.empty(len(runs), np.int32), np.empty(len(runs), np.int32)
        size[plain], start[plain] = known_size, known_start
        sizes = np.array([len(x) for x in apart], np.int32)
        size[~plain], start[~plain] = sizes, len(pool) + np.cumsum(sizes) - sizes
        return np.concatenate([pool, *apart]), start, size

    def encode(self, texts: pa.Array, end_id: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of the texts, an `end_id` behind each, and where each text's stop; for some texts at a time.

        Runs are made distinct over all texts, ids are laid out for few of them together, so that little is held at once.
        """
        if not self.separable:
            ids = [np.append(x, np.uint32(end_id)) for x in self._ids(texts.to_pylist())]
            yield np.concatenate([*ids, np.zeros(0, np.uint32)]), np.cumsum([len(x) for x in ids])
            return
        cut = pc.ascii_split_whitespace(texts)
        coded = cut.flatten().dictionary_encode()
        runs, of_run = coded.dictionary, coded.indices.to_numpy()
        core = pc.ascii_rtrim(runs, characters=".,;:!?")
        word = pc.match_substring_regex(core, _LETTERS)
        ends_well = word.to_numpy(zero_copy_only=False).copy()
        ends_well[~ends_well] = pc.match_substring_regex(core.filter(pc.invert(word)), "[0-9A-Za-z]$").to_numpy(zero_copy_only=False)
        core = pc.if_else(pa.array(ends_well), core, runs)
        stripped = pc.not_equal(pc.binary_length(core), pc.binary_length(runs))
        lengths = pc.utf8_length(core.filter(stripped)).to_pylist()
        tail = np.full(len(runs), "", object)
        tail[stripped.to_numpy(zero_copy_only=False)] = [r[n:] for r, n in zip(runs.filter(stripped).to_pylist(), lengths)]
        cores = pc.if_else(word, pc.ascii_lower(core), core).dictionary_encode()
        tails = pa.array(tail, pa.string()).dictionary_encode()

        in_core, in_tail = cores.indices.to_numpy(), tails.indices.to_numpy()
        plain = np.zeros(len(cores.dictionary), bool)
        plain[in_core[word.to_numpy(zero_copy_only=False)]] = True
        pool, start, size = self._pool(cores.dictionary, plain)
        behind, tail_start, tail_size = self._pool(tails.dictionary, np.zeros(len(tails.dictionary), bool))
        # a run's ids: those of what is encoded, and of what stands behind it
        starts = np.stack([start[in_core], (tail_start + len(pool))[in_tail]], 1).ravel()
        sizes = np.stack([size[in_core], tail_size[in_tail]], 1).ravel()
        run_size = size[in_core] + tail_size[in_tail]
        run_start = (np.cumsum(run_size) - run_size).astype(np.int32)
        pool = np.append(_laid_out(np.concatenate([pool, behind]), starts, sizes), np.uint32(end_id))
        last = np.cumsum(pc.list_value_length(cut).to_numpy())
        at = first = 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(last, first + _RUNS, side="right")))
            some, ends = of_run[first : last[stop - 1]], last[at:stop] - first
            # the end id is a piece behind the runs of each text
            piece_size = np.insert(run_size[some], ends, 1)
            ids = _laid_out(pool, np.insert(run_start[some], ends, len(pool) - 1), piece_size)
            yield ids, np.cumsum(piece_size, dtype=np.int64)[ends + np.arange(stop - at)]
            at, first = stop, last[stop - 1]


def _laid_out(pool: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Pieces of `pool` one behind the other."""
    stops = np.cumsum(size, dtype=np.int64)
    total = int(stops[-1]) if len(stops) else 0
    return pool[np.repeat((start - (stops - size)).astype(np.int32), size) + np.arange(total, dtype=np.int32)]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encoded(texts: pa.Array, path: str, end_id: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The ids of whole texts, an `end_id` behind each, and where each text's stop; for some texts at a time, nulls as empty."""
    texts, lib = pc.fill_null(texts, "") if texts.null_count else texts, encoder(path)
    ends, start = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64), 0
    while start < len(texts):
        begun = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, begun + _BYTES, side="right")))
        yield from lib.encode(texts.slice(start, stop - start), end_id)
        pa.default_memory_pool().release_unused()
        start = stop


def _packed(ids: np.ndarray, wide: bool) -> np.ndarray:
    if wide:
        return ids.astype("<u4")
    if len(ids) and int(ids.max()) >= 1 << 16:
        raise ValueError(f"id {int(ids.max())} does not fit 16 bits")
    return ids.astype("<u2")


def _mixed(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    """64 well-mixed bits of a 128-bit key, others on each level."""
    x = a + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % (1 << 64)) * (b | np.uint64(1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash: on each level the keys alone in their place stay, the others go to the next level.

    A key's slot is the number of taken places before its own, over all levels.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        taken = np.concatenate([np.zeros(1, np.int64), *(np.cumsum(x, dtype=np.int64) for x in levels)])
        sizes = [int(x.sum()) for x in levels]
        self.before = np.cumsum([0, *sizes])
        self.ranks = np.split(taken[1:], np.cumsum([len(x) for x in levels])[:-1]) if levels else []

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray) -> PerfectHash:
        levels: list[np.ndarray] = []
        while len(a):
            if len(levels) > 200:
                raise ValueError("two keys share all 128 bits")
            size = max(_LEVEL_ROOM * len(a), 1)
            place = (_mixed(a, b, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(alone)
            rest = ~alone[place]
            a, b = a[rest], b[rest]
        return cls(levels)

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slot of each key; any slot, or -1, for keys the hash was not built from."""
        out, open_ = np.full(len(a), -1, np.int64), np.arange(len(a))
        for k, (bits, rank) in enumerate(zip(self.levels, self.ranks)):
            if not len(open_):
                break
            place = (_mixed(a[open_], b[open_], k) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[place]
            out[open_[hit]] = self.before[k] + rank[place[hit]] - 1
            open_ = open_[~hit]
        return out

    def to_bytes(self) -> tuple[bytes, list[int]]:
        return b"".join(np.packbits(x).tobytes() for x in self.levels), [len(x) for x in self.levels]

    @classmethod
    def from_bytes(cls, data: bytes, sizes: list[int]) -> PerfectHash:
        levels, at = [], 0
        for n in sizes:
            width = -(-n // 8)
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, width, at), count=n).astype(bool))
            at += width
        return cls(levels)


def _blocks(docs: DataFrame, path: str, end_id: int, wide: bool) -> DataFrame:
    """Blocks of sorted documents (doc_id, text): keys, occurrence numbers within the part, offsets within the block, raw ids."""
    kind, arrow = docs.schema["doc_id"].dataType.simpleString(), _arrow_type(docs, "doc_id")
    schema = pa.schema(
        [
            ("part", pa.int32()), ("number", pa.int32()), ("keys", pa.list_(arrow)), ("nth", pa.list_(pa.int64())),
            ("offsets", pa.list_(pa.int64())), ("ids", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, last, again = TaskContext.get().partitionId(), 0, object(), 0
        keys, nth, sizes, ids, held = [], [], [], [], 0

        def block() -> pa.RecordBatch:
            offsets = np.cumsum([0, *sizes]).tolist()
            row = {"part": part, "number": number, "keys": keys, "nth": nth, "offsets": offsets, "ids": b"".join(ids)}
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            names, first = batch.column(0).to_pylist(), 0
            for found, stops in encoded(batch.column(1), path, end_id):
                found, at, n = _packed(found, wide), 0, len(stops)
                while at < n:
                    # up to the document that fills the block
                    begun = int(stops[at - 1]) if at else 0
                    stop = min(int(np.searchsorted(stops, begun + BLOCK_IDS - held)) + 1, n)
                    for key in names[first + at : first + stop]:
                        again = again + 1 if key == last else 0
                        last = key
                        keys.append(key)
                        nth.append(again)
                    sizes += np.diff(stops[at:stop], prepend=begun).tolist()
                    ids.append(found[begun : stops[stop - 1]].tobytes())
                    held += int(stops[stop - 1]) - begun
                    if held >= BLOCK_IDS:
                        yield block()
                        number, keys, nth, sizes, ids, held = number + 1, [], [], [], [], 0
                    at = stop
                first += n
        if keys:
            yield block()

    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"part int, number int, keys array<{kind}>, nth array<bigint>, offsets array<bigint>, ids binary",
    )


_HASHES = ["pmod(xxhash64(doc_id, nth), buckets) as bucket", "xxhash64(nth, doc_id, 1) as a", "xxhash64(doc_id, 2, nth) as b"]


def _before(blocks: DataFrame) -> list[tuple]:
    """(part, key, n) of parts that go on with a key of earlier ones, of which these hold n rows."""
    last = F.struct(F.element_at("keys", -1).alias("key"), (F.element_at("nth", -1) + 1).alias("n"))
    edges = blocks.groupBy("part").agg(
        F.min_by(F.struct(F.element_at("keys", 1).alias("key")), "number").alias("first"), F.max_by(last, "number").alias("last")
    )
    out, held, n = [], None, 0
    # a row per part, which is a task
    for part, first, end in sorted(edges.collect(), key=lambda r: r["part"]):
        going_on = n > 0 and first["key"] == held
        if going_on:
            out.append((part, first["key"], n))
        n = end["n"] + (n if going_on and end["key"] == held else 0)
        held = end["key"]
    return out


def write(docs: DataFrame, path: str, out: str, end_id: int = 1, wide: bool | None = None) -> None:
    """Encode `docs` (doc_id, text) and write the tables `out`/blocks and `out`/index.

    Documents stand in ascending order of doc_id, nulls first; rows that share a doc_id follow one another in the
    order of a hash of their text and are told apart by an occurrence number. `wide` stores 32-bit ids, else 16-bit;
    without it the size of the vocabulary decides, and an id that does not fit raises. A null or empty text has the
    end id only; texts are read whole, of any length; an empty table writes empty ones; other columns, whatever their
    names, are not read. One shuffle of the texts, by ranges of doc_id, hash and place, so that a frequent id or text
    is divided among tasks; blocks are cut from the sorted stream, never from a group.
    """
    spark = docs.sparkSession
    if wide is None:
        wide = max(encoder(path).size, end_id + 1) > 1 << 16
    # texts are dealt out, not ids: dealing by range looks at its input twice
    keyed = docs.select("doc_id", F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_place"), "text")
    ranges = keyed.repartitionByRange("doc_id", "_hash", "_place").drop("_place")
    sorted_ = ranges.sortWithinPartitions("doc_id", "_hash", "text")
    _blocks(sorted_, path, end_id, wide).write.parquet(f"{out}/blocks")

    places = (
        spark.read.parquet(f"{out}/blocks")
        .select("part", "number", F.posexplode("keys").alias("i", "doc_id"), "nth", "offsets")
        .select(
            "part", "number", "doc_id",
            F.element_at("nth", F.col("i") + 1).alias("nth"),
            F.element_at("offsets", F.col("i") + 1).alias("at"),
            F.element_at("offsets", F.col("i") + 2).alias("to"),
        )
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    before = spark.createDataFrame(_before(spark.read.parquet(f"{out}/blocks")), f"part int, _key {kind}, _n bigint")
    going_on = F.when(F.col("doc_id").eqNullSafe(F.col("_key")), F.col("_n")).otherwise(0)
    places = places.join(before, "part", "left").withColumn("nth", F.col("nth") + F.coalesce(going_on, F.lit(0))).drop("_key", "_n")
    buckets = -(-places.count() // BUCKET_KEYS) or 1
    keyed = places.withColumn("buckets", F.lit(buckets)).selectExpr("*", *_HASHES)

    def build(table: pa.Table) -> pa.Table:
        a, b = (table[c].to_numpy().astype(np.uint64) for c in ("a", "b"))
        mph = PerfectHash.build(a, b)
        bits, sizes = mph.to_bytes()
        order = np.argsort(mph.slots(a, b))
        row = {"bucket": table["bucket"][0].as_py(), "buckets": buckets, "bits": bits, "sizes": sizes}
        row["prints"] = (b[order] >> np.uint64(32)).astype("<u4").tobytes()
        for c in ("part", "number", "at", "to"):
            row[c] = table[c].to_numpy()[order].astype("<i8").tobytes()
        return pa.Table.from_pylist([row], index)

    index = pa.schema(
        [("bucket", pa.int64()), ("buckets", pa.int64()), ("bits", pa.binary()), ("sizes", pa.list_(pa.int64()))]
        + [(c, pa.binary()) for c in ("prints", "part", "number", "at", "to")]
    )
    shape = "bucket bigint, buckets bigint, bits binary, sizes array<bigint>, prints binary, part binary, number binary, at binary, to binary"
    narrow = keyed.select("bucket", "a", "b", "part", "number", "at", "to")
    narrow.groupBy("bucket").applyInArrow(build, shape).write.parquet(f"{out}/index")


def locate(spark: SparkSession, out: str, keys: DataFrame) -> DataFrame:
    """(doc_id, nth, part, number, at, to) of the keys (doc_id, nth) that are in the files; others are left out."""
    index = spark.read.parquet(f"{out}/index")
    kind = keys.schema["doc_id"].dataType.simpleString()
    buckets = index.agg(F.max("buckets")).first()[0] or 1

    def find(wanted: pa.Table, blobs: pa.Table) -> pa.Table:
        if not blobs.num_rows or not wanted.num_rows:
            return shape.empty_table()
        row = blobs.to_pylist()[0]
        a, b = (wanted[c].to_numpy().astype(np.uint64) for c in ("a", "b"))
        slots = PerfectHash.from_bytes(row["bits"], row["sizes"]).slots(a, b)
        prints = np.frombuffer(row["prints"], "<u4")
        hit = (slots >= 0) & (prints[np.maximum(slots, 0)] == (b >> np.uint64(32)).astype(np.uint32))
        got = wanted.select(["doc_id", "nth"]).filter(pa.array(hit))
        for c in ("part", "number", "at", "to"):
            got = got.append_column(c, pa.array(np.frombuffer(row[c], "<i8")[slots[hit]]))
        return got.cast(shape)

    numbers = ("nth", "part", "number", "at", "to")
    wanted = keys.select("doc_id", F.col("nth").cast("long").alias("nth"), F.lit(buckets).alias("buckets"))
    wanted = wanted.selectExpr("doc_id", "nth", *_HASHES)
    shape = pa.schema([("doc_id", _arrow_type(keys, "doc_id"))] + [(c, pa.int64()) for c in numbers])
    groups = wanted.groupBy("bucket").cogroup(index.drop("buckets").groupBy("bucket"))
    return groups.applyInArrow(find, f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in numbers))


def _arrow_type(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


def fetch(spark: SparkSession, out: str, keys: DataFrame) -> DataFrame:
    """(doc_id, nth, start, ids) of the keys (doc_id, nth): ids read from the block the index names.

    `start` counts the ids of all documents before; ids are little-endian 32-bit. A block is read once,
    with all its wanted documents.
    """
    blocks = spark.read.parquet(f"{out}/blocks")
    kind = keys.schema["doc_id"].dataType.simpleString()
    wide = blocks.select((F.octet_length("ids") > 2 * F.element_at("offsets", -1)).alias("w")).agg(F.max("w")).first()[0]
    # ids before a block: in earlier parts, a row per part, and in earlier blocks of its part
    numbered = [F.col(c).cast("long").alias(c) for c in ("part", "number")]
    sizes = blocks.select(*numbered, F.element_at("offsets", -1).alias("n"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    ahead = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("ahead"))
    inner = F.sum("n").over(Window.partitionBy("part").orderBy("number")) - F.col("n")
    bases = sizes.select("part", "number", inner.alias("inner")).join(ahead, "part")
    bases = bases.select("part", "number", (F.col("ahead") + F.col("inner")).alias("base"))

    def cut(wanted: pa.Table, found: pa.Table) -> pa.Table:
        if not wanted.num_rows or not found.num_rows:
            return shape.empty_table()
        ids = np.frombuffer(found["ids"][0].as_py(), "<u4" if wide else "<u2")
        spans = zip(wanted["at"].to_pylist(), wanted["to"].to_pylist())
        got = pa.array([ids[i:j].astype("<u4").tobytes() for i, j in spans], pa.binary())
        return wanted.select(["doc_id", "nth", "start"]).append_column("ids", got).cast(shape)

    shape = pa.schema(
        [("doc_id", _arrow_type(keys, "doc_id")), ("nth", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())]
    )
    # the bases join the places, which are narrow, on the keys that the blocks are grouped by
    places = locate(spark, out, keys).join(bases, ["part", "number"])
    places = places.withColumn("start", F.col("base") + F.col("at")).drop("base").groupBy("part", "number")
    payload = blocks.select(*numbered, "ids").groupBy("part", "number")
    return places.cogroup(payload).applyInArrow(cut, f"doc_id {kind}, nth bigint, start bigint, ids binary")


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, nth): a key for each row; rows that share a doc_id are numbered from 0, by many tasks if they are many."""
    counted = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    zero, step = F.lit(0).cast("long"), F.lit(_NUMBERED).cast("long")
    parts = counted.select("doc_id", "n", F.explode(F.sequence(zero, F.col("n") - 1, step)).alias("at")).repartition("doc_id", "at")
    last = F.least(F.col("at") + (_NUMBERED - 1), F.col("n") - 1)
    return parts.select("doc_id", F.explode(F.sequence("at", last)).alias("nth"))


def round_trip(docs: DataFrame, path: str, end_id: int = 1) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every row, from files written and read back by key.

    `start` counts the ids of all rows before, in the order of the files; awkward rows as for `write`.
    """
    spark = docs.sparkSession
    out = scratch_path(spark, "tokens")
    write(docs, path, out, end_id)
    got = fetch(spark, out, occurrences(docs))
    return got.select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
