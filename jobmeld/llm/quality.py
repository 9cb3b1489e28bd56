"""Quality rules per document, and a verdict on the hosts the documents come from.

Each document's rule failures are counted; failures of any rule are summed by host, and each host's failure rate
is shrunk towards all hosts by a beta prior fitted to their rates. The base rules reject everywhere; the stricter
ones reject unless the document's host fails less often than the corpus for sure.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from jobmeld.functions.binding import detached
from jobmeld.llm.common import chunks, row_keys, stored

BLANKS = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_TOO_MANY = 1 << 21  # three word numbers below this fit in 63 bits


def _repeated(words: list[bytes]) -> int:
    """How many words stand in three-word windows that occur twice or more in the text."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    kinds = len(number)
    if kinds < _TOO_MANY:
        windows = (ids[:-2] * kinds + ids[1:-1]) * kinds + ids[2:]
    else:
        pairs = np.unique(ids[:-2] * kinds + ids[1:-1], return_inverse=True)[1]
        windows = pairs * kinds + ids[2:]
    order = np.argsort(windows)
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(len(words), bool)
    at = np.concatenate([order[1:][same], order[:-1][same]])
    for k in range(3):
        again[at + k] = True
    return int(again.sum())


def count_text(text: bytes) -> tuple[int, int, int, int, int]:
    words = text.split()
    shorter = text.translate(None, BLANKS)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return (
        len(words),
        len(shorter.decode()),
        len(shorter) - len(shorter.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated(words),
    )


def counts(docs: DataFrame, host: str = "source") -> DataFrame:
    """(doc_id, host, r1, r2, the five counts) of every whole text; a null text is an empty one. No shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in chunks(batch.column(4)):
                found = zip(*map(count_text, texts))
                kept = [batch.column(i).slice(start, len(texts)) for i in range(4)]
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(c, pa.int64()) for c in found)], names)

    names = ["doc_id", "host", "r1", "r2", *COUNTS]
    narrow = docs.select(
        "doc_id", F.col(host).alias("host"), *row_keys("doc_id", "text", host), F.col("text").cast("binary").alias("text")
    )
    kinds = {f.name: f.dataType.simpleString() for f in narrow.schema.fields}
    shape = ", ".join([*(f"{c} {kinds[c]}" for c in names[:4]), *(f"{c} bigint" for c in COUNTS)])
    return narrow.mapInArrow(run, shape)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def strict_failed() -> Column:
    """Many symbols, words of odd length, many repeated lines or a fifth of all words repeated."""
    words = F.col("n_words")
    return (
        (10 * F.col("n_symbols") > words)
        | (F.col("word_chars") > 15 * words)
        | (F.col("word_chars") < 2 * words)
        | (20 * F.col("n_dup_lines") > words)
        | (5 * F.col("n_repeat_words") > words)
    )


def shrunk_hosts(outcomes: DataFrame, z: float = 2.0) -> DataFrame:
    """(host, n, failed, rate, sure_rate, most_rate, mean_rate) from `outcomes` (host, failed boolean).

    The prior is the beta distribution with the mean of all rows and the spread of the hosts' rates beyond
    chance, by the method of moments; only its five sums reach the driver. `rate` is a host's posterior mean,
    `sure_rate` and `most_rate` lie `z` posterior standard deviations below and above, and `mean_rate` is the mean
    of all rows. Rows without a host form one host of their own.
    """
    hosts = outcomes.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("failed").cast("long")).alias("failed")
    )
    rows, bad, squares, n_hosts, spread = hosts.agg(
        F.sum("n"), F.sum("failed"), F.sum(F.col("n").cast("double") ** 2), F.count(F.lit(1)),
        F.sum(F.col("failed").cast("double") ** 2 / F.col("n")),
    ).first()
    a, b = beta_prior(rows or 0, bad or 0, squares or 0.0, n_hosts, spread or 0.0)
    up, down = F.col("failed") + a, F.col("n") - F.col("failed") + b
    rate = up / (up + down)
    off = z * F.sqrt(rate * (1 - rate) / (up + down + 1))
    return hosts.withColumns(
        {"rate": rate, "sure_rate": rate - off, "most_rate": rate + off, "mean_rate": F.lit(a / (a + b))}
    )


def beta_prior(rows: int, bad: int, squares: float, hosts: int, spread: float) -> tuple[float, float]:
    """Both parameters; a prior as strong as all rows where the rates differ by chance only."""
    if not rows:
        return 1.0, 1.0
    mean = (bad + 0.5) / (rows + 1)
    noise = mean * (1 - mean)
    room = rows - squares / rows
    beyond = (spread - bad * bad / rows - (hosts - 1) * noise) / room if room > 0 else 0.0
    strength = min(max(noise / beyond - 1, 1.0), float(rows)) if beyond > 0 else float(rows)
    return mean * strength, (1 - mean) * strength


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """(doc_id, r1, r2, counts, base_failed, strict_failed, host_failed, host_trusted, kept), one row per input row.

    A host fails if its `sure_rate` of documents that fail any rule is above the rate of all documents, and is trusted
    if its `most_rate` is below. `kept` is false for what fails the base rules, and for what fails a strict rule and
    comes from a host that is not trusted. Texts are read once; counts go through the shared folder. A document
    without a host belongs to the host of all such. Hosts are joined back one row per host; a hot host's documents are
    split by adaptive execution. A null or empty text has no words and fails; a very long one is read whole; repeated
    rows and null ids are rows like others; an empty table gives no rows. Columns other than doc_id, text and the
    host's, whatever their names, are not read.
    """
    found = stored(counts(docs, host), "quality")
    hosts = shrunk_hosts(found.select("host", (base_failed() | strict_failed()).alias("failed")))
    flagged = _flagged(
        found, hosts, host_failed=F.col("sure_rate") > F.col("mean_rate"), host_trusted=F.col("most_rate") < F.col("mean_rate")
    )
    return flagged.select(
        "doc_id", "r1", "r2", *COUNTS, base_failed().alias("base_failed"), strict_failed().alias("strict_failed"),
        "host_failed", "host_trusted",
        (~base_failed() & (F.col("host_trusted") | ~strict_failed())).alias("kept"),
    )


def _flagged(found: DataFrame, hosts: DataFrame, **flags: Column) -> DataFrame:
    """`found` with each flag of its host; only hosts with a flag are joined."""
    any_flag = F.greatest(*flags.values()) if len(flags) > 1 else next(iter(flags.values()))
    marked = hosts.filter(any_flag).select(
        detached(F.struct("host")).alias("of_host"), *[flag.alias(f"of_{name}") for name, flag in flags.items()]
    )
    joined = found.join(marked, F.struct(found["host"]) == F.col("of_host"), "left")
    return joined.withColumns({name: F.coalesce(f"of_{name}", F.lit(False)) for name in flags})
