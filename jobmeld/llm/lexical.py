"""Ranked lexical search: a trie of documents per task, searched by branch and bound for every item.

Documents are reduced to the items' terms, ordered from the most to the least frequent one, so that documents with
the same common terms share a path. Every subtree holds the largest count of each term below it and the smallest
length factor m, which bound the score of any document in it; a depth-first search that takes the best child first
leaves out every subtree whose bound the item's list can't lose to any more. Nothing is approximated.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window, functions as F

from jobmeld.llm.common import LOWER, UPPER, stored

TOP = 20
LEAF = 32  # documents in a leaf at most
ENTRIES = 1_000_000  # terms of documents in one trie, about
BLOCK_BYTES = 1 << 22  # text of the items searched for together, or one item that holds more
BLOCK_ITEMS = 2048
_NO_ID = 1 << 63  # behind every id

_OTHER = bytes(c for c in range(128) if not (chr(c).isalnum()))
_TABLE = bytes.maketrans(_OTHER + UPPER.encode(), b" " * len(_OTHER) + LOWER.encode())


def terms(text: bytes) -> list[bytes]:
    """Maximal runs of digits, letters and code points above 127, only A-Z in lower case."""
    return text.translate(_TABLE).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs): every document's number of terms, and its counts of the vocabulary's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found, counts, offsets = [], [], [], [0]
            for text in batch.column(1):
                words = terms(text.as_py() or b"")
                sizes.append(len(words))
                for word, tf in Counter(words).items():
                    at = vocabulary.get(word)
                    if at is not None:
                        found.append(at)
                        counts.append(tf)
                offsets.append(len(found))
            ends = pa.array(offsets, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (found, counts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"]
            )

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return narrow.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, tfs array<int>")


class Trie:
    """Documents in the order of their paths; a node is a stretch of them.

    Arrays by entry (a term of a document): `term`, `gain`. By document: `start` (its first entry), `ids`. By
    node: `lo`, `hi`, `children` (none for a leaf), `least_id`. By pair of a term and a node that has it below:
    `node`, `bound`, those of term t at `first[t]` to `first[t + 1]`.
    """

    def __init__(self, ids: list[int], m: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray, n_terms: int):
        paths = np.lexsort((term, np.repeat(np.arange(len(sizes)), sizes)))
        term, tf = term[paths], tf[paths]
        begin = np.concatenate([[0], np.cumsum(sizes)])
        raw, cuts = term.astype(">u4").tobytes(), (4 * begin).tolist()
        keys = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
        sizes, self.ids, m = sizes[order], [ids[i] for i in order.tolist()], m[order]
        self.start = np.concatenate([[0], np.cumsum(sizes)])
        gather = np.repeat(begin[order] - self.start[:-1], sizes) + np.arange(len(term))
        self.term, tf = term[gather], tf[gather].astype(np.int64)
        self.gain = 10**9 * tf // (1000 * tf + 12 * np.repeat(m, sizes))
        self._grow(self._shared())
        self._bound(tf, m, n_terms)

    def _shared(self) -> np.ndarray:
        """How many terms each document's path shares with the next one's."""
        out, ends = np.zeros(len(self.ids), np.int64), self.start.tolist()
        for i in range(len(self.ids) - 1):
            a, b, c = ends[i : i + 3]
            k = min(b - a, c - b)
            other = self.term[a : a + k] != self.term[b : b + k]
            at = int(other.argmax())
            out[i] = at if other[at] else k
        return out

    def _grow(self, shared: np.ndarray) -> None:
        """Nodes from the root down: a stretch parts where its documents share no more than all of them do."""
        self.lo, self.hi, self.children = [0], [len(self.ids)], [[]]
        todo = [0]
        while todo:
            node = todo.pop()
            lo, hi = self.lo[node], self.hi[node]
            if hi - lo <= LEAF:
                continue
            within = shared[lo : hi - 1]
            parts = [*(lo + 1 + np.flatnonzero(within == within.min())).tolist(), hi]
            begin = lo
            for here, after in zip(parts, [*parts[1:], 0]):
                # neighbouring small subtrees share a leaf
                if after and after - begin <= LEAF:
                    continue
                self.children[node].append(len(self.lo))
                todo.append(len(self.lo))
                self.lo.append(begin)
                self.hi.append(here)
                self.children.append([])
                begin = here

    def _bound(self, tf: np.ndarray, m: np.ndarray, n_terms: int) -> None:
        largest: list = [None] * len(self.lo)
        scratch = np.zeros(n_terms, np.int64)
        for node in range(len(self.lo) - 1, -1, -1):
            if self.children[node]:
                for child in self.children[node]:
                    t, x = largest[child]
                    scratch[t] = np.maximum(scratch[t], x)
            else:
                a, b = self.start[self.lo[node]], self.start[self.hi[node]]
                np.maximum.at(scratch, self.term[a:b], tf[a:b])
            seen = np.flatnonzero(scratch)
            largest[node] = seen, scratch[seen]
            scratch[seen] = 0
        term = np.concatenate([t for t, _ in largest])
        node = np.repeat(np.arange(len(largest)), [len(t) for t, _ in largest])
        order = np.argsort(term, kind="stable")
        most, self.node = np.concatenate([x for _, x in largest])[order], node[order]
        least_m = np.array([m[a:b].min() for a, b in zip(self.lo, self.hi)], np.int64)
        self.least_id = [min(self.ids[a:b]) for a, b in zip(self.lo, self.hi)]
        self.bound = 10**9 * most // (1000 * most + 12 * least_m[self.node])
        self.first = np.searchsorted(term[order], np.arange(n_terms + 1))

    def search(self, weights: list[tuple[int, int]], dense: np.ndarray, best: list[tuple[int, int]], top: int) -> None:
        """Improve `best`, a heap of (score, -id), by the documents of this trie; `dense` is all zeros before and after."""
        bounds = np.zeros(len(self.lo), np.int64)
        for t, w in weights:
            dense[t] = w
            a, b = self.first[t], self.first[t + 1]
            bounds[self.node[a:b]] += w * self.bound[a:b]
        bound = bounds.tolist()
        todo = [0]
        while todo:
            node = todo.pop()
            if not bound[node] or len(best) == top and (bound[node], -self.least_id[node]) <= best[0]:
                continue
            if self.children[node]:
                todo += sorted(self.children[node], key=bound.__getitem__)
                continue
            lo, hi = self.lo[node], self.hi[node]
            a, b = self.start[lo], self.start[hi]
            scores = np.add.reduceat(dense[self.term[a:b]] * self.gain[a:b], self.start[lo:hi] - a)
            least = best[0][0] if len(best) == top else 1
            for i in np.flatnonzero(scores >= least).tolist():
                entry = int(scores[i]), -self.ids[lo + i]
                if len(best) < top:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        for t, _ in weights:
            dense[t] = 0


def _length_factors(sizes: list[int], n_docs: int, n_words: int) -> np.ndarray:
    # Python's integers: 25 * n * N does not fit 64 bits for a long text among many
    return np.array([75 + 25 * n * n_docs // n_words for n in sizes], np.int64)


def best_per_task(
    vecs: DataFrame, rank_of: np.ndarray, queries: list[list[tuple[int, int]]], n_docs: int, n_words: int, top: int
) -> DataFrame:
    """(item, doc_id, score): the best documents of each task for every query (rank, weight).

    A task holds one trie at a time; what its items found so far bounds their search in the next.
    """
    n_terms = int(rank_of.max()) + 1 if len(rank_of) else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in queries]
        dense = np.zeros(n_terms, np.int64)

        def search(held: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(held)
            ids = [_NO_ID if i is None else i for i in table.column(0).to_pylist()]
            m = _length_factors(table.column(1).to_pylist(), n_docs, n_words)
            lists = table.column(2).combine_chunks()
            counts = table.column(3).combine_chunks()
            sizes = lists.value_lengths().to_numpy().astype(np.int64)
            term = rank_of[lists.flatten().to_numpy()]
            trie = Trie(ids, m, sizes, term, counts.flatten().to_numpy(), n_terms)
            for weights, found in zip(queries, best):
                if weights:
                    trie.search(weights, dense, found, top)

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch.column(2).flatten())
            if size >= ENTRIES:
                search(held)
                held, size = [], 0
        if size:
            search(held)
        rows = [(i, None if x == -_NO_ID else -x, s) for i, found in enumerate(best) for s, x in found]
        cols = zip(*rows) if rows else ([], [], [])
        types = [pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["item", "doc_id", "score"])

    return vecs.filter("size(terms) > 0").mapInArrow(run, "item int, doc_id bigint, score bigint")


def _first(df: DataFrame, top: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _search_block(docs: DataFrame, block: list[Row], id_type: str, top: int) -> DataFrame:
    spark = docs.sparkSession
    texts = [Counter(terms((row["text"] or "").encode())) for row in block]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*texts)))}
    vecs = stored(vectors(docs, vocabulary), "vectors")
    n_docs, n_words = vecs.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    # at most one row per term of the block
    for row in vecs.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
        df[row["t"]] = row["count"]
    rank_of = np.empty(len(df), np.int32)
    rank_of[np.lexsort((np.arange(len(df)), -df))] = np.arange(len(df), dtype=np.int32)
    weights = [weight(n_docs, int(x)) for x in df]
    queries = [
        [(int(rank_of[at]), count * weights[at]) for t, count in c.items() if df[at := vocabulary[t]] and weights[at]]
        for c in texts
    ]
    found = best_per_task(vecs, rank_of, queries, n_docs, n_words, top)
    # an item's lists from all tasks meet in two steps, so no group grows with the number of tasks alone
    found = _first(found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(64))), top, "item", "part")
    names = spark.createDataFrame([(i, row["item_id"]) for i, row in enumerate(block)], f"item int, item_id {id_type}")
    ranked = _first(found.drop("part", "rank"), top, "item")
    return ranked.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def blocks(items: DataFrame) -> Iterator[list[Row]]:
    """Items in runs of bounded size, read one after the other."""
    block, size = [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        block.append(row)
        size += len(row["text"] or "")
        if size >= BLOCK_BYTES or len(block) == BLOCK_ITEMS:
            yield block
            block, size = [], 0
    if block:
        yield block


def rank(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's best documents among all, ties by ascending doc_id.

    A term's weight is floor(1000 ln((2N+2)/(2df+1))), a document's gain from it (10^9 tf) div (1000 tf + 12 m) with
    m = 75 + (25 n N) div L. `docs` needs doc_id (an integer) and text, `items` item_id and text; other columns, whatever
    their names, are not read. A null or empty text has no terms: as a document it counts nowhere, as an item it finds
    nothing. A null doc_id ranks behind equal scores. Repeated documents and items count and rank as often as
    they occur. Texts are read whole, of any length. Empty tables give no rows.

    The items are searched in blocks of bounded size, each of which reads all documents; only a block's terms, their
    document counts and the items go through the driver.
    """
    id_type = items.schema["item_id"].dataType.simpleString()
    found = [stored(_search_block(docs, block, id_type, top), "ranked") for block in blocks(items)]
    if not found:
        return docs.sparkSession.createDataFrame([], f"item_id {id_type}, rank int, doc_id bigint, score bigint")
    out = found[0]
    for part in found[1:]:
        out = out.union(part)
    return out
