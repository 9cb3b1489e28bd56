"""Masked pseudo-likelihood of texts under a bidirectional window network.

Every token is predicted from the two tokens on either side: their embeddings go through one hidden layer to a
softmax over token classes, and the word's share of its class in the corpus completes its probability. A
document's score is the sum of these conditional log-probabilities.

The network sees words hashed to a fixed number of buckets, so it has a fixed size whatever the corpus. It is
trained on every token of the corpus: in each round a number of shards that grows with the corpus train from the
same start, and Spark averages the results, weighted by tokens. What a shard holds, and in which order, depends on the
rows alone, so the model is the same on any cluster. The shares come from exact counts of all words, in a table that
grows with the corpus: its most frequent words are broadcast, the others joined to the documents that hold them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from jobmeld.functions.binding import detached
from jobmeld.llm.common import chunks, row_keys, stored
from jobmeld.session import written

BUCKETS = 4096  # 0 stands outside a text
REACH = (-2, -1, 1, 2)
WIDTH, HIDDEN, CLASSES = 8, 16, 64
ROUNDS = 3
BATCH = 4096
RATE = 0.15
_SCALE = 1 << 10  # weighted changes are summed as integers, so that their order does not matter
_BYTES = 1 << 23  # of texts that are split together, or one text that holds more
_WORD = 64  # bytes; a longer word is kept as its digest
_COUNTED = 300_000  # words that a task counts before it hands them on
_FREQUENT, _FREQUENT_BYTES = 1 << 18, 1 << 24  # words that are broadcast, at most
_LOG_SCALE = 1 << 24  # logarithms of counts are summed as integers too
SHARD_TOKENS = 1 << 20  # that a shard trains on, about
_COPIES = 1000


def bucket(word: bytes) -> int:
    return 1 + zlib.crc32(word) % (BUCKETS - 1)


def _short(word: str) -> bytes:
    raw = word.encode()
    return raw if len(raw) <= _WORD else b"\0" + xxhash.xxh3_128_digest(raw)


def _split(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct words, the word at each place, its text): lower-case words between ASCII white space."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = cut.flatten().dictionary_encode()
    places, owners = coded.indices.to_numpy(), np.repeat(np.arange(len(texts)), pc.list_value_length(cut).to_numpy())
    blank = pc.index(coded.dictionary, "").as_py()
    if blank >= 0:
        there = places != blank
        places, owners = places[there], owners[there]
    return [_short(w) for w in coded.dictionary.to_pylist()], places, owners


def _merged(found: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    """One batch (word, n) with each word once."""
    whole = pa.Table.from_batches(found).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])
    return whole.combine_chunks().to_batches() or [found[0].slice(0, 0)]


def _together(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of runs of rows that hold some `_BYTES` together, or one row that holds more; no nulls."""
    texts = pc.fill_null(texts, "")
    ends, start = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64), 0
    while start < len(texts):
        begun = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, begun + _BYTES, side="right")))
        yield start, texts.slice(start, stop - start)
        start = stop


def tokens(docs: DataFrame) -> DataFrame:
    """Two kinds of rows, from one pass over the texts, as a table by round.

    (doc_id, r1, r2, ids): buckets of a text's words, as little-endian 16-bit integers; its round is 0 or more.
    (word, n): how often some texts hold a word, with round -1.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["round", "doc_id", "r1", "r2", "ids", "word", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[pa.RecordBatch] = []
        for batch in batches:
            for start, texts in _together(batch.column(3)):
                words, places, owners = _split(texts)
                own = np.array([bucket(w) for w in words], "<u2")[places]
                ends = np.searchsorted(owners, np.arange(len(texts) + 1)).astype(np.int32)
                ids = pa.BinaryArray.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(2 * ends), pa.py_buffer(own)])
                kept = [batch.column(i).slice(start, len(texts)) for i in range(3)]
                rounds = (np.asarray(kept[1].to_numpy(), np.int64) >> 20) % ROUNDS
                empty = [pa.nulls(len(texts), pa.binary()), pa.nulls(len(texts), pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(rounds, pa.int32()), *kept, ids, *empty], names)
                found.append(pa.RecordBatch.from_arrays(
                    [pa.array(words, pa.binary()), pa.array(np.bincount(places, minlength=len(words)), pa.int64())], ["word", "n"]
                ))
                if sum(map(len, found)) > 2 * _COUNTED:
                    found = _merged(found)
                    if len(found[0]) > _COUNTED:
                        yield counted(found.pop(), batch)
        if found:
            yield counted(_merged(found)[0], batch)

    def counted(words: pa.RecordBatch, like: pa.RecordBatch) -> pa.RecordBatch:
        words = words.filter(pc.greater(words["n"], 0))
        none = [pa.nulls(len(words), t) for t in (*[like.column(i).type for i in range(3)], pa.binary())]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(words), -1, np.int32)), *none, *words.columns], names)

    narrow = docs.select("doc_id", *row_keys("doc_id", "text"), "text")
    rows = narrow.mapInArrow(run, f"round int, doc_id {kind}, r1 bigint, r2 int, ids binary, word binary, n bigint")
    return written(rows, "lm-tokens", "round")


def vocabulary(read: DataFrame) -> DataFrame:
    """(word, n) of every lower-case word of all texts, counted exactly; a table."""
    found = read.filter("round = -1").groupBy("word").agg(F.sum("n").alias("n"))
    return stored(found, "lm-vocabulary")


def frequent(words: DataFrame) -> tuple[int, dict[bytes, int]]:
    """(least count, scaled log count by word) of the words that are broadcast: as many powers of two as have room."""
    kinds = words.groupBy(F.length(F.bin("n")).alias("bits")).agg(
        F.count(F.lit(1)).alias("words"), F.sum(F.octet_length("word")).alias("bytes")
    )
    least, n, size = 1 << 62, 0, 0
    for r in sorted(kinds.collect(), key=lambda r: -r.bits):
        n, size = n + r.words, size + r.bytes
        if n > _FREQUENT or size > _FREQUENT_BYTES:
            break
        least = 1 << (r.bits - 1)
    top = words.filter(F.col("n") >= least).toArrow()
    logs = np.rint(np.log(top["n"].to_numpy()) * _LOG_SCALE).astype(np.int64).tolist()
    return least, dict(zip(top["word"].to_pylist(), logs))


def word_logs(docs: DataFrame, words: DataFrame) -> DataFrame:
    """(r1, r2, n_words, logs): words of each key's rows, and the scaled sum of the logarithms of their counts in `words`.

    Words too rare to be broadcast are shuffled with their documents' keys and meet their counts in a join; none of
    them holds more than a small share of the corpus.
    """
    least, top = frequent(words)
    known = docs.sparkSession.sparkContext.broadcast(top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = known.value.get
        for batch in batches:
            for start, texts in _together(batch.column(2)):
                found, places, owners = _split(texts)
                logs = np.array([find(w, -1) for w in found], np.int64)
                value = logs[places]
                common = value >= 0
                n = np.bincount(owners[common], minlength=len(texts))
                total = np.zeros(len(texts), np.int64)
                np.add.at(total, owners[common], value[common])
                # a rare word once per text, with how often it stands there
                pairs, times = np.unique(owners[~common].astype(np.int64) * len(found) + places[~common], return_counts=True)
                at, which = np.divmod(pairs, max(len(found), 1))
                rows = np.concatenate([np.arange(len(texts)), at]) + start
                keys = [batch.column(i).take(pa.array(rows)) for i in range(2)]
                blank = [pa.array([None] * len(texts) + [found[i] for i in which.tolist()], pa.binary())]
                blank += [pa.array(np.concatenate([n, times]), pa.int64())]
                blank += [pa.array(total.tolist() + [None] * len(at), pa.int64())]
                yield pa.RecordBatch.from_arrays([*keys, *blank], ["r1", "r2", "word", "n", "logs"])

    narrow = docs.select(*row_keys("doc_id", "text"), "text")
    found = stored(narrow.mapInArrow(run, "r1 bigint, r2 int, word binary, n bigint, logs bigint"), "lm-words")
    rare = words.filter(F.col("n") < least).select(
        F.col("word").alias("of"), F.round(F.log("n") * _LOG_SCALE).cast("long").alias("log")
    )
    met = found.filter("word is not null").join(rare, F.col("word") == F.col("of"))
    rows = found.filter("word is null").select("r1", "r2", "n", "logs").union(
        met.select("r1", "r2", "n", F.col("n") * F.col("log"))
    )
    return rows.groupBy("r1", "r2").agg(F.sum("n").alias("n_words"), F.sum("logs").alias("logs"))


@dataclass
class Model:
    """Parameters in one flat vector, the classes with each token's log share of its class, and their tokens."""

    flat: np.ndarray
    class_of: np.ndarray
    log_share: np.ndarray
    class_count: np.ndarray

    def parts(self) -> list[np.ndarray]:
        """Embeddings, hidden weights and bias, output weights and bias, as views."""
        wide = WIDTH * len(REACH)
        shapes = [(BUCKETS, WIDTH), (wide, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,)]
        cuts = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
        return [x.reshape(s) for x, s in zip(np.split(self.flat, cuts), shapes)]


def new_model(counts: np.ndarray) -> Model:
    """Half of the classes hold one of the most frequent tokens each; the others share the rest by equal mass."""
    exact, counts = counts, counts.astype(np.float64) + 1
    order = np.argsort(-counts, kind="stable")
    single = CLASSES // 2
    class_of = np.zeros(BUCKETS, np.int64)
    class_of[order[:single]] = np.arange(single)
    rest = order[single:]
    mass = np.cumsum(counts[rest]) / counts[rest].sum()
    class_of[rest] = single + np.minimum((mass * (CLASSES - single)).astype(np.int64), CLASSES - single - 1)
    totals = np.bincount(class_of, counts, CLASSES)
    size = BUCKETS * WIDTH + WIDTH * len(REACH) * HIDDEN + HIDDEN + HIDDEN * CLASSES + CLASSES
    model = Model(np.zeros(size, np.float32), class_of, np.log(counts / totals[class_of]), np.bincount(class_of, exact, CLASSES))
    rng = np.random.default_rng(7)
    embed, hidden, _, out, bias = model.parts()
    embed[:] = rng.normal(0, 0.3, embed.shape)
    hidden[:] = rng.normal(0, 1 / np.sqrt(len(hidden)), hidden.shape)
    out[:] = rng.normal(0, 0.1, out.shape)
    bias[:] = np.log(np.maximum(totals, 1e-9) / totals.sum())
    return model


def _forward(model: Model, around: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(input, hidden, class log-probabilities) for rows of surrounding tokens."""
    embed, w1, b1, w2, b2 = model.parts()
    x = embed[around].reshape(len(around), -1)
    h = np.tanh(x @ w1 + b1)
    z = h @ w2 + b2
    z -= z.max(1, keepdims=True)
    z -= np.log(np.exp(z).sum(1, keepdims=True))
    return x, h, z


def _lines(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, places, owners): texts one after another with bucket 0 between them, and where their tokens are."""
    texts = [np.frombuffer(x, "<u2") for x in ids]
    pad = np.zeros(2, np.uint16)
    line = np.concatenate([y for t in texts for y in (pad, t)] + [pad]).astype(np.int64)
    sizes = np.array([len(t) for t in texts])
    owners = np.repeat(np.arange(len(texts)), sizes)
    places = np.arange(len(owners)) + 2 * (owners + 1)
    return line, places, owners


def _around(line: np.ndarray, places: np.ndarray) -> np.ndarray:
    return line[places[:, None] + np.array(REACH)]


def train_on(model: Model, ids: list[bytes], state: np.ndarray) -> int:
    """One pass of adaptive gradient steps over the texts' tokens, in place; the number of tokens."""
    line, places, _ = _lines(ids)
    for at in range(0, len(places), BATCH):
        own = places[at : at + BATCH]
        around, wanted = _around(line, own), model.class_of[line[own]]
        x, h, logs = _forward(model, around)
        embed, w1, _, w2, _ = model.parts()
        dz = np.exp(logs)
        dz[np.arange(len(own)), wanted] -= 1
        dz /= len(own)
        dh = (dz @ w2.T) * (1 - h * h)
        dx = (dh @ w1.T).reshape(-1, WIDTH)
        flat = around.ravel()
        de = np.stack([np.bincount(flat, dx[:, k], BUCKETS) for k in range(WIDTH)], 1)
        step = np.concatenate([y.ravel() for y in (de, x.T @ dh, dh.sum(0), h.T @ dz, dz.sum(0))]).astype(np.float32)
        state += step * step
        model.flat -= RATE * step / (np.sqrt(state) + 1e-6)
    return len(places)


def score_texts(model: Model, ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, summed log-probability) of each text."""
    line, places, owners = _lines(ids)
    each = np.empty(len(places))
    for at in range(0, len(places), BATCH):
        own = places[at : at + BATCH]
        wanted = line[own]
        logs = _forward(model, _around(line, own))[2]
        each[at : at + BATCH] = logs[np.arange(len(own)), model.class_of[wanted]] + model.log_share[wanted]
    return np.bincount(owners, minlength=len(ids)), np.bincount(owners, each, len(ids))


def _sums(rows: DataFrame, size: int) -> np.ndarray:
    """A vector of `size` from rows (i, n) that every task emits; one number per place reaches the driver."""
    table = rows.groupBy("i").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[table["i"].to_numpy()] = table["n"].to_numpy()
    return out


def _sparse(values: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(values)
    return pa.RecordBatch.from_arrays([pa.array(at), pa.array(values[at])], ["i", "n"])


def _numbered(texts: DataFrame) -> DataFrame:
    """`texts` (round, r1, r2, ids) with a column `copy`: rows that are equal are numbered, others have 0."""
    again = stored(texts.groupBy("r1", "r2").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1"), "lm-repeated")
    plain = texts.withColumn("copy", F.lit(0).cast("bigint"))
    if again.isEmpty():
        return plain
    # equal rows are counted and made again from one of them, some by each task
    keys = again.select(detached(F.col("r1")).alias("r1"), "r2", "rows")
    one = texts.join(keys, ["r1", "r2"]).groupBy("r1", "r2").agg(*[F.first(c).alias(c) for c in ("round", "ids", "rows")])
    zero, step = F.lit(0).cast("bigint"), F.lit(_COPIES).cast("bigint")
    parts = one.select("*", F.explode(F.sequence(zero, F.col("rows") - 1, step)).alias("at")).repartition("r1", "at")
    copies = F.explode(F.sequence("at", F.least(F.col("at") + (_COPIES - 1), F.col("rows") - 1)))
    return plain.join(keys, ["r1", "r2"], "left_anti").select(plain.columns).union(
        parts.select(*[copies.alias(c) if c == "copy" else F.col(c) for c in plain.columns])
    )


def train(texts: DataFrame) -> Model:
    """A model of all `texts` (round, r1, r2, ids): counts first, then one round after the other.

    A text is trained on in one round and one shard. Shards hold the texts of their hashes in the order of their keys, so
    the model depends on the rows alone: neither on files or tasks, nor on how often one of these is run.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, ids in chunks(batch.column(0)):
                total += np.bincount(np.frombuffer(b"".join(ids), "<u2"), minlength=BUCKETS)
        yield _sparse(total)

    counts = _sums(texts.select("ids").mapInArrow(count, "i bigint, n bigint"), BUCKETS)
    model = new_model(counts)
    size = len(model.flat)
    shards = max(1, int(counts.sum()) // (ROUNDS * SHARD_TOKENS))
    dealt = _numbered(texts).withColumn("shard", F.pmod(F.xxhash64("r1", "r2", "copy"), F.lit(shards)))
    for k in range(ROUNDS):
        start = dealt.sparkSession.sparkContext.broadcast(model)

        def learn(table: pa.Table) -> pa.Table:
            base = start.value
            own = replace(base, flat=base.flat.copy())
            state, seen = np.full(size, 1e-8, np.float32), 0
            ids = table.sort_by([("r1", "ascending"), ("r2", "ascending"), ("copy", "ascending")])["ids"].combine_chunks()
            for _, some in chunks(ids, 1 << 20):
                seen += train_on(own, some, state)
            change = np.rint((own.flat - base.flat).astype(np.float64) * seen * _SCALE).astype(np.int64)
            return pa.Table.from_batches([_sparse(np.append(change, seen))])

        mine = dealt.filter(F.col("round") == k).select("shard", "r1", "r2", "copy", "ids")
        rows = mine.groupBy("shard").applyInArrow(learn, "i bigint, n bigint")
        total = _sums(rows, size + 1)
        if total[-1]:
            model.flat = (model.flat + total[:-1] / (_SCALE * float(total[-1]))).astype(np.float32)
    return model


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_likelihood), one row per row of `docs` (doc_id, text).

    Learns from and scores all rows. A text without words, or null, has 0 tokens, 0.0 and a null mean; repeated rows
    and null ids are rows like others; an empty table gives no rows; other columns, whatever their names, are not
    read. Texts are read whole, of any length; a word of more than 64 bytes is told apart by a digest. Token ids are
    shuffled once per round by shard, so a source or a group of copies is spread over all shards. The network has a
    fixed size and is broadcast; a word's share is its exact count over that of its class.
    """
    spark = docs.sparkSession
    read = tokens(docs)
    texts = read.filter("round >= 0").select("round", "doc_id", "r1", "r2", "ids")
    net = train(texts.drop("doc_id"))
    # the words' own counts, the other half of the shares, are added below
    net.log_share = -np.log(np.maximum(net.class_count, 1))[net.class_of]
    model = spark.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, own in chunks(batch.column(3), 1 << 20):
                n, total = score_texts(model.value, own)
                kept = [batch.column(i).slice(start, len(own)) for i in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(n, pa.int64()), pa.array(total, pa.float64())], ["doc_id", "r1", "r2", "n_tokens", "total"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = texts.select("doc_id", "r1", "r2", "ids").mapInArrow(
        run, f"doc_id {kind}, r1 bigint, r2 int, n_tokens bigint, total double"
    )
    logs = word_logs(docs, vocabulary(read)).select(detached(F.col("r1")).alias("k1"), F.col("r2").alias("k2"), "n_words", "logs")
    scored = scored.join(logs, (F.col("r1") == F.col("k1")) & (F.col("r2") == F.col("k2")), "left")
    # rows with the same key share one sum, of as many times their words
    own = F.col("logs") / F.lit(float(_LOG_SCALE)) * F.col("n_tokens") / F.col("n_words")
    total = F.when(F.col("n_tokens") > 0, F.col("total") + own).otherwise(0.0)
    return scored.select(
        "doc_id", "n_tokens", total.alias("log_likelihood"),
        F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean_log_likelihood"),
    )
