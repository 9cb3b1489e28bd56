"""Periodic runs of words, by suffix trees.

Every run has a Lyndon root that is the longest Lyndon word at its place, in one of two opposite orders of the
alphabet. The longest Lyndon word at a place ends where the next smaller suffix starts, which the order of a suffix
tree's leaves tells. These candidates, two per word, are extended to the right and to the left by the longest common
extension: the depth of the lowest common ancestor of two leaves, in the tree of the text or in that of its
reversal. The Euler tour of a tree gives the ancestor's depth as a range minimum, in constant time per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from jobmeld.llm.common import chunks

LEAST_WORDS = 6
LEAST_EXPONENT = 4

Run = tuple[int, int, int]  # start, length, period


class SuffixTree:
    """Ukkonen's tree of `text`, integers from 1 on, with an end mark 0 behind them.

    Node j < n is the leaf of the suffix at j; node n is the root, those above are inner nodes.
    """

    def __init__(self, text: list[int], n_symbols: int):
        text = [*text, 0]
        n, k = len(text), n_symbols + 1
        self.n, self.k = n, k
        start, depth, link, edges = [0] * (n + 1), [0] * (n + 1), {n: n}, {}
        find = edges.get
        node, edge, length, waiting = n, 0, 0, 0
        for i, c in enumerate(text):
            waiting += 1
            last = 0
            while waiting:
                if not length:
                    edge = i
                key = node * k + text[edge]
                child = find(key)
                if child is None:
                    leaf = i - waiting + 1
                    start[leaf] = i
                    edges[key] = leaf
                else:
                    size = i + 1 - start[child] if child < n else depth[child] - depth[node]
                    if length >= size:
                        edge += size
                        length -= size
                        node = child
                        continue
                    begin = start[child]
                    if text[begin + length] == c:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    inner = len(start)
                    start.append(begin)
                    depth.append(depth[node] + length)
                    edges[key] = inner
                    start[child] = begin + length
                    edges[inner * k + text[begin + length]] = child
                    leaf = i - waiting + 1
                    start[leaf] = i
                    edges[inner * k + c] = leaf
                    if last:
                        link[last] = inner
                    last = inner
                    waiting -= 1
                    if node == n and length:
                        length -= 1
                        edge = i - waiting + 1
                    else:
                        node = link.get(node, n)
                    continue
                if last:
                    link[last] = node
                    last = 0
                waiting -= 1
                if node == n and length:
                    length -= 1
                    edge = i - waiting + 1
                else:
                    node = link.get(node, n)
        self._depth = depth
        self._keys = np.fromiter(edges.keys(), np.int64, len(edges))
        self._ends = np.fromiter(edges.values(), np.int64, len(edges))

    def tour(self, backwards: bool = False) -> tuple[list[int], list[int]]:
        """Leaves in the order of the Euler tour, and the depth at which it turns between two of them.

        Children come in the order of their symbols, or the opposite one; the end mark is the first either way.
        """
        parent, symbol = np.divmod(self._keys, self.k)
        if backwards:
            symbol = np.where(symbol > 0, self.k - symbol, 0)
        order = np.argsort(parent * self.k + symbol, kind="stable")
        child = self._ends[order].tolist()
        first = np.searchsorted(parent[order], np.arange(self.n, len(self._depth) + 1)).tolist()
        n, depth = self.n, self._depth
        leaves, turns = [], []
        todo = [(n, -1)]
        push, pop = todo.append, todo.pop
        while todo:
            node, turn = pop()
            if turn >= 0:
                turns.append(turn)
            if node < n:
                leaves.append(node)
                continue
            a, b, d = first[node - n], first[node - n + 1], depth[node]
            for at in range(b - 1, a, -1):
                push((child[at], d))
            # the first child goes on where the tour stands
            push((child[a], -1))
        return leaves, turns


class Extensions:
    """Lengths of the longest common prefix of two suffixes: range minima of the tour's turns."""

    def __init__(self, leaves: list[int], turns: list[int]):
        self.rank = np.empty(len(leaves), np.int64)
        self.rank[leaves] = np.arange(len(leaves))
        level = np.array(turns, np.int32)
        self.levels = [level]
        width = 1
        while 2 * width <= len(turns):
            level = np.minimum(level[:-width], level[width:])
            self.levels.append(level)
            width *= 2

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For places i <> j, each up to the text's end."""
        a, b = self.rank[i], self.rank[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        power = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for p in np.unique(power).tolist():
            at = power == p
            level = self.levels[p]
            out[at] = np.minimum(level[a[at]], level[b[at] - (1 << p)])
        return out


def _next_smaller(rank: list[int]) -> list[int]:
    """For each place the next one with a smaller rank; the last place has the smallest."""
    out, open_ = [0] * len(rank), []
    for i in range(len(rank) - 1, -1, -1):
        here = rank[i]
        while open_ and rank[open_[-1]] > here:
            open_.pop()
        out[i] = open_[-1] if open_ else i
        open_.append(i)
    return out


def runs(text: list[int], n_symbols: int, least: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT) -> list[Run]:
    """All runs with at least `least` symbols and `exponent` (2 or more) periods, by start and period.

    `text` holds integers from 1 to `n_symbols`.
    """
    n = len(text)
    if n < 2:
        return []
    tree = SuffixTree(text, n_symbols)
    leaves, turns = tree.tour()
    right = Extensions(leaves, turns)
    opposite = np.empty(n + 1, np.int64)
    opposite[tree.tour(backwards=True)[0]] = np.arange(n + 1)
    left = Extensions(*SuffixTree(text[::-1], n_symbols).tour())
    start = np.tile(np.arange(n), 2)
    ends = _next_smaller(right.rank.tolist())[:n] + _next_smaller(opposite.tolist())[:n]
    after = np.array(ends, np.int64)
    period = after - start
    to_right = right.of(start, after)
    # n - i is the place before i, read backwards
    to_left = np.where(start > 0, left.of(n - start, n - after), 0)
    length = to_left + period + to_right
    good = (length >= least) & (length >= exponent * period)
    found = np.unique(np.stack([start - to_left, period, length], 1)[good], axis=0)
    return [(a, b, p) for a, p, b in found.tolist()]


def repeating(ids: np.ndarray, doc: np.ndarray, least: int, exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that a run can cover, and the number of the stretch each lies in.

    Each word of a run stands in it `exponent` times or more, so a word that its stretch holds less often belongs
    to no run and parts the stretch, as do the ends of a document. Repeated until every word is frequent enough.
    """
    place, stretch = np.arange(len(ids)), doc
    size = int(ids.max()) + 1 if len(ids) else 1
    while len(place):
        _, which, count = np.unique(stretch * size + ids[place], return_inverse=True, return_counts=True)
        kept = count[which] >= exponent
        if kept.all():
            break
        place, stretch = place[kept], stretch[kept]
        parted = np.ones(len(place), bool)
        parted[1:] = (np.diff(place) > 1) | (np.diff(stretch) > 0)
        stretch = np.cumsum(parted)
        kept = np.bincount(stretch)[stretch] >= least
        place, stretch = place[kept], stretch[kept]
    return place, stretch


def document_runs(
    texts: list[bytes], least: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT
) -> Iterator[tuple[list[bytes], list[Run]]]:
    """Words and runs of every text."""
    words = [t.split() for t in texts]
    sizes = [len(w) for w in words]
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for ws in words for w in ws], np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    place, stretch = repeating(ids, doc, least, exponent)
    first = np.concatenate([[0], np.cumsum(sizes)])
    cuts = np.searchsorted(place, first)
    for d, ws in enumerate(words):
        here = place[cuts[d] : cuts[d + 1]]
        if not len(here):
            yield ws, []
            continue
        # one symbol that occurs nowhere else stands for what lies between two stretches
        part = stretch[cuts[d] : cuts[d + 1]]
        gaps = np.flatnonzero(np.diff(part)) + 1
        symbols, text = np.unique(ids[here], return_inverse=True)
        text = np.insert(text + 1, gaps, len(symbols) + 1 + np.arange(len(gaps)))
        at = np.insert(here - first[d], gaps, -1)
        found = runs(text.tolist(), len(symbols) + len(gaps), least, exponent)
        yield ws, [(int(at[a]), n, p) for a, n, p in found]


def collapsed(words: list[bytes], found: list[Run]) -> bytes:
    """The words without those that a run repeats, joined by blanks: of each run its first period stays."""
    if not found:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in found:
        kept[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])


def _strongest(found: list[Run]) -> Run:
    """The run with the greatest exponent, compared without rounding; the first, then that of the smallest period on a tie."""
    best = found[0]
    for run in found[1:]:
        if run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def find_runs(docs: DataFrame, least: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT) -> DataFrame:
    """(doc_id, n_runs, start, length, period, runs, collapsed) of every whole text.

    Words are maximal runs of other characters than blanks and \\x09 to \\x0D, numbered from 0. A run is a stretch of
    words with smallest period `period` that no neighbouring word extends, of `least` words and `exponent` periods or
    more; `start`, `length` and `period` are those of the run with the most periods, null without one. `runs` lists
    all by start and period, `collapsed` is the text's words without the repeats.

    A null text has no words, nor has one of blanks; a text without runs keeps its words. Rows are taken one by one, so
    repeated ones, ties and null ids do no harm; columns other than doc_id and text are not read. A text is read
    whole; one of a million words that all repeat needs some gigabytes of memory for its trees.
    """
    def answer(ids: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
        cols: list[list] = [[] for _ in range(6)]
        for words, found in document_runs(texts, least, exponent):
            best = _strongest(found) if found else (None, None, None)
            rows = [dict(zip(("start", "length", "period"), run)) for run in found]
            for col, value in zip(cols, (len(found), *best, rows, collapsed(words, found))):
                col.append(value)
        whole = pa.int64()
        run_type = pa.list_(pa.struct([("start", whole), ("length", whole), ("period", whole)]))
        types = [whole, whole, whole, whole, run_type, pa.binary()]
        names = ["doc_id", "n_runs", "start", "length", "period", "runs", "collapsed"]
        return pa.RecordBatch.from_arrays([ids, *[pa.array(c, t) for c, t in zip(cols, types)]], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in chunks(batch.column(1)):
                yield answer(batch.column(0).slice(at, len(texts)), texts)

    narrow = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    out = narrow.mapInArrow(
        run,
        f"doc_id {kind}, n_runs bigint, start bigint, length bigint, period bigint, "
        "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed binary",
    )
    return out.withColumn("collapsed", F.col("collapsed").cast("string"))
