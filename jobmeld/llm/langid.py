"""Language of a text: multinomial naive Bayes over hashed character n-grams.

The class's probability says which of the learnt languages is the nearest, and is 1 for any longer text. Whether a
text is in that language at all is told by its mean log probability per n-gram, against the learnt texts'.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from jobmeld.functions.binding import detached
from jobmeld.llm.common import chunks, row_keys, stored

BITS = 15
ORDERS = 3
BLOCK_LANGS = 64  # in one matrix, which has so many times 2**BITS numbers; more languages are scored matrix by matrix
_CELLS = 1 << 22  # numbers of a text's n-grams under all languages of a block that are held at once
UNKNOWN = "und"
LEAST_FIT = 8.0  # standard deviations below the learnt texts at which the score is halved
_PRIOR_ROWS = 10  # so many texts with a variance of 1 are added to those of a language
_LETTER = regex.compile(r"\p{L}")
_FACTORS = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of the 1- to 3-grams of the lower-case text."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), "<u4")
    total = np.zeros(1 << BITS, np.int64)
    mixed = np.zeros(len(codes), np.uint32)
    for n in range(ORDERS):
        if len(codes) <= n:
            break
        mixed = mixed[: len(codes) - n] + codes[n:] * _FACTORS[n]
        spread = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * n)
        total += np.bincount(spread >> np.uint32(32 - BITS), minlength=1 << BITS)
    at = np.flatnonzero(total)
    return at, total[at]


def learn(docs: DataFrame, text: Column, lang: Column) -> list[tuple[list[str], np.ndarray]]:
    """Blocks of (languages, log probabilities by feature and language) from all rows with a text and a language.

    Each task sums its counts and Spark adds them up, in a table. A row per language and, block by block, a
    number per feature and language of the block reach the driver. Add-one smoothing over the hash buckets; the
    first row has the log priors among all languages.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def summed() -> Iterator[pa.RecordBatch]:
            for lang_, own in sums.items():
                at = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang_]).take(pa.array(np.zeros(len(at), int))), pa.array(at), pa.array(own[at])],
                    ["lang", "feature", "n"],
                )

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for start, texts in chunks(batch.column(1)):
                for lang_, t in zip(langs[start:], texts):
                    if (own := sums.get(lang_)) is None:
                        if len(sums) >= 4 * BLOCK_LANGS:
                            yield from summed()
                            sums.clear()
                        own = sums[lang_] = np.zeros((1 << BITS) + 1, np.int64)
                    at, n = features(t.decode())
                    own[at + 1] += n
                    own[0] += 1
        yield from summed()

    spark = docs.sparkSession
    known = docs.select(lang.alias("lang"), text.alias("text")).filter("lang is not null and text is not null")
    narrow = known.select("lang", F.col("text").cast("binary").alias("text"))
    rows = narrow.mapInArrow(run, "lang string, feature bigint, n bigint")
    rows = stored(rows.groupBy("lang", "feature").agg(F.sum("n").alias("n")), "language-counts")
    texts_of = dict(sorted((r.lang, r.n) for r in rows.filter("feature = 0").select("lang", "n").collect()))
    langs, all_texts = list(texts_of), sum(texts_of.values())
    blocks = []
    for first in range(0, len(langs), BLOCK_LANGS):
        some = langs[first : first + BLOCK_LANGS]
        numbers = spark.createDataFrame(list(enumerate(some)), "at int, lang string")
        table = rows.filter("feature > 0").join(numbers, "lang").select("at", "feature", "n").toArrow()
        counts = np.zeros((1 << BITS, len(some)))
        counts[table["feature"].to_numpy() - 1, table["at"].to_numpy()] = table["n"].to_numpy()
        logs = np.log(counts + 1) - np.log(counts.sum(0) + (1 << BITS))
        prior = np.log(np.array([[texts_of[x] for x in some]]) / max(all_texts, 1))
        blocks.append((some, np.concatenate([prior, logs])))
    return blocks


def classify(texts: list[bytes], langs: list[str], logs: np.ndarray) -> tuple[list[str], list[float]]:
    """Language and probability of each text, scored together as one sparse matrix."""
    return fitted(texts, langs, logs)[:2]


def fitted(
    texts: list[bytes], langs: list[str], logs: np.ndarray
) -> tuple[list[str], list[float], list[float], list[int]]:
    """Language, probability, mean log probability per n-gram in that language, and n-grams of each text."""
    names, best, every, fits, sizes = compared(texts, langs, logs)
    return names, [float(np.exp(b - e)) if n else 0.0 for b, e, n in zip(best, every, sizes)], fits, sizes


def compared(
    texts: list[bytes], langs: list[str], logs: np.ndarray
) -> tuple[list[str], list[float], list[float], list[float], list[int]]:
    """Of each text the best language, its log probability, that of all languages together, its mean per n-gram, n-grams."""
    names, best, every = [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
    fits, sizes = [0.0] * len(texts), [0] * len(texts)
    rows, at, n = [], [], []

    def compare() -> None:
        starts = np.cumsum([0, *map(len, at[:-1])])
        sums = np.add.reduceat(logs[np.concatenate(at) + 1] * np.concatenate(n)[:, None], starts, axis=0)
        total = sums + logs[0]
        first, top = total.argmax(1), total.max(1)
        together = top + np.log(np.exp(total - top[:, None]).sum(1))
        grams = np.array([c.sum() for c in n])
        fit = sums[np.arange(len(rows)), first] / grams
        for i, k, *found in zip(rows, *(x.tolist() for x in (first, top, together, fit, grams))):
            names[i] = langs[k]
            best[i], every[i], fits[i], sizes[i] = found

    held = 0
    for i, t in enumerate(texts):
        text = t.decode()
        if langs and _LETTER.search(text):
            a, c = features(text)
            rows.append(i)
            at.append(a)
            n.append(c)
            held += len(a) * len(langs)
            if held >= _CELLS:
                compare()
                rows, at, n, held = [], [], [], 0
    if rows:
        compare()
    return names, best, every, fits, sizes


def spread(found: DataFrame) -> dict[str, tuple[float, float, float]]:
    """Per language (mean, variance between texts, variance per n-gram) of the texts' mean log probabilities.

    `found` has (lang, fit, grams) of learnt texts. A text of n n-grams varies by the second plus the third over n;
    both follow from the squared distances, summed plainly and by n-grams. One row per language reaches the driver.
    """
    v, n = F.col("fit"), F.col("grams").cast("double")
    sums = {"n": n, "x": 1 / n, "v": v, "vv": v * v, "nv": n * v, "nvv": n * v * v}
    rows = found.groupBy("lang").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(c.cast("decimal(28,9)")).cast("double").alias(k) for k, c in sums.items()],  # in any order the same
    )
    out = {}
    for r in rows.collect():
        mean = r.nv / r.n
        plain = max(r.vv - 2 * mean * r.v + mean * mean * r.rows, 0.0)
        weighted = max(r.nvv - mean * r.nv, 0.0)
        room = r.n * r.x - r.rows**2
        per_gram = max((plain * r.n - weighted * r.rows) / room, 0.0) if room > 1e-6 * r.rows**2 else 0.0
        between = max((weighted - per_gram * r.rows) / r.n, 0.0)
        out[r.lang] = (mean, (r.rows * between + _PRIOR_ROWS) / (r.rows + _PRIOR_ROWS), per_gram)
    return out


def held_out(doc_id: Column) -> Column:
    """The fold that is never learnt from; a row without an id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _scored(narrow: DataFrame, langs: list[str], logs: np.ndarray) -> DataFrame:
    """The rows of `narrow` but their text, and what `compared` says under one block of languages."""
    model = narrow.sparkSession.sparkContext.broadcast((langs, logs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in chunks(batch.column(5), 1 << 20):
                names, *numbers, sizes = compared(texts, *model.value)
                kept = [batch.column(i).slice(start, len(texts)) for i in range(5)]
                found = [pa.array(names), *[pa.array(x, pa.float64()) for x in numbers], pa.array(sizes, pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [*kept, *found],
                    ["doc_id", "r1", "r2", "held_out", "lang", "lang_pred", "best", "every", "fit", "grams"],
                )

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(
        run,
        f"doc_id {kind}, r1 bigint, r2 int, held_out boolean, lang string, lang_pred string, best double, every double, fit double, grams bigint",
    )


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, r1, r2, held_out, lang_pred, score) of every row of `docs` (doc_id, text, lang).

    Learns from rows that are not held out and have a text and a language; only the text enters a prediction. `score`
    is the probability of the language among the learnt ones, times how well the text fits it: near 1 for texts like
    the learnt ones, a half at `LEAST_FIT` standard deviations below them, 0 for other scripts or codes. `und` with
    score 0 where the text is null or has no letter, or nothing was learnt. Equal scores go to the language that sorts
    first. Two passes over the texts, no shuffle of them; the matrix is broadcast, the narrow results are stored while
    the learnt texts' fits are summed. Of more than `BLOCK_LANGS` languages each block takes a pass of its own.
    Repeated rows get equal results, very long texts are read whole, an empty table gives no rows; columns other than
    doc_id, text and lang, whatever their names, are not read.
    """
    blocks = learn(docs.filter(~held_out(F.col("doc_id"))), F.col("text"), F.col("lang"))
    narrow = docs.select(
        "doc_id", *row_keys("doc_id", "text"),
        held_out(F.col("doc_id")).alias("held_out"), F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("binary").alias("text"),
    )
    first, *more = [_scored(narrow, *block) for block in blocks or [([], np.zeros((1, 1)))]]
    found = first.withColumn("share", F.when(F.col("grams") > 0, F.exp(F.col("best") - F.col("every"))).otherwise(0.0))
    if more:
        # rows with the same key have the same text: the best of all blocks for each key
        parts = stored(first, "languages-of-a-block")
        keyed = parts.select("r1", "r2", "lang_pred", "best", "every", "fit")
        for part in more:
            keyed = keyed.union(stored(part, "languages-of-a-block").select(*keyed.columns))
        best = keyed.groupBy("r1", "r2").agg(
            F.min(F.struct((-F.col("best")).alias("worse"), "lang_pred", "fit")).alias("b"), F.collect_set(F.struct("lang_pred", "every")).alias("all")
        )
        together = F.aggregate("all", F.lit(0.0), lambda acc, e: acc + F.exp(e["every"] + F.col("b.worse")))
        best = best.select(
            detached(F.col("r1")).alias("k1"), F.col("r2").alias("k2"), F.col("b.lang_pred").alias("name"), F.col("b.fit").alias("own"), (1 / together).alias("part")
        )
        found = parts.join(best, (F.col("r1") == F.col("k1")) & (F.col("r2") == F.col("k2"))).select(
            "doc_id", "r1", "r2", "held_out", "lang", F.col("name").alias("lang_pred"),
            F.when(F.col("grams") > 0, F.col("part")).otherwise(0.0).alias("share"), F.col("own").alias("fit"), "grams",
        )
    found = stored(found, "languages")
    usual = spread(found.filter("not held_out and lang = lang_pred and grams > 0"))
    known = [x for k, v in sorted(usual.items()) for x in (F.lit(k), F.array(*map(F.lit, v)))]
    of = F.create_map(*known)[F.col("lang_pred")] if known else F.lit(None).cast("array<double>")
    below = (F.col("fit") - of[0]) / F.sqrt(of[1] + of[2] / F.col("grams"))
    fits = F.when(F.col("grams") > 0, 1 / (1 + F.exp(-(below + LEAST_FIT))))
    return found.select(
        "doc_id", "r1", "r2", "held_out", "lang_pred",
        F.when(F.col("grams") > 0, F.col("share") * F.coalesce(fits, F.lit(1.0))).otherwise(0.0).alias("score"),
    )
