"""Byte-level BPE: greedy tokens first, merging only where a check of adjacent pairs fails.

A sequence of tokens is what BPE merging gives exactly when every token is what merging gives for its own
bytes and every two neighbours are what merging gives for their joint bytes. So each word is cut greedily
into the longest tokens, all neighbours of a batch are checked at once against the pairs known so far, and
only words with a pair that fails are merged rank by rank.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from jobmeld.llm.common import chunks

# The published split pattern of byte-level BPE vocabularies
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

CACHED_WORDS = 400_000  # words, and runs between blanks, that a worker remembers
SHORT = 48  # longer ones are not remembered, and not cut or merged side by side with others
_PAIR = 1 << 32
_BLANK = re.compile(r"(?<=\S) (?=\S)")


def byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files: itself, or the next free one from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(shifted)}


@functools.cache
def _unsettled() -> np.ndarray:
    """Whether a code point has no category here: libraries of other Unicode versions may class it differently."""
    return np.array([unicodedata.category(chr(c)) == "Cn" for c in range(sys.maxunicode + 1)])


class ByteBpe:
    """One vocabulary file with its caches; lives in a Python worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = byte_chars()
        raw = {t: bytes(map(chars.__getitem__, t)) for t in spec["model"]["vocab"]}
        self.ids = {raw[t]: i for t, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: b for b, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}
        self.longest = max(map(len, self.ids))
        self.single = [self.ids.get(bytes([b])) for b in range(256)]
        self.merges: dict[int, tuple[int, int]] = {}
        self.left, self.right, self.made_at = (np.full(max(self.bytes_of) + 1, -1, np.int64) for _ in range(3))
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            a, b, new = self.ids[raw[a]], self.ids[raw[b]], self.ids[raw[a] + raw[b]]
            if self.made_at[new] >= 0 or a * _PAIR + b in self.merges:
                raise ValueError("two merges make the same token")
            self.merges[a * _PAIR + b] = (rank, new)
            self.left[new], self.right[new], self.made_at[new] = a, b, rank
        self.pair_keys = np.array(sorted(self.merges), np.int64)
        self.pair_ranks = np.array([self.merges[k][0] for k in self.pair_keys.tolist()], np.int64)
        self.made = np.array([new for _, new in sorted(self.merges.values())], np.int64)
        sizes = np.array([len(self.bytes_of.get(i, b"")) for i in range(len(self.left))])
        self.sizes, self.begins = sizes, np.cumsum(sizes) - sizes
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(len(sizes))), np.uint8)
        self._grow_tree()
        self.split = regex.compile(PATTERN)
        self.around = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        self.path = path
        self.words: dict[str, bytes] = {}
        self.runs: dict[str, bytes | None] = {}
        self.alone: dict[int, bool] = {}

    def _grow_tree(self) -> None:
        """All beginnings of tokens as numbered nodes, with the step from node and byte to node as sorted keys."""
        nodes, steps = {b"": 0}, {}
        for token in self.ids:
            for i in range(len(token)):
                if token[: i + 1] not in nodes:
                    nodes[token[: i + 1]] = len(nodes)
                    steps[nodes[token[:i]] << 8 | token[i]] = len(nodes) - 1
        self.step_keys = np.array(sorted(steps), np.int64)
        self.step_to = np.array([steps[k] for k in self.step_keys.tolist()], np.int64)
        self.token_at = np.array([self.ids.get(b, -1) for b in nodes], np.int64)

    @functools.cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def merged(self, word: bytes) -> list[int]:
        """Exact BPE: the pair of lowest rank is merged, the leftmost first, until none is left."""
        ids = [self.single[b] for b in word]
        return self._merged_long(ids) if len(ids) > SHORT else self._merged_short(ids)

    def _merged_short(self, ids: list[int]) -> list[int]:
        get, none = self.merges.get, (1 << 60, -1)
        best = [get(a * _PAIR + b, none) for a, b in zip(ids, ids[1:])]
        while best and (low := min(best)) is not none:
            i = best.index(low)
            ids[i : i + 2] = [low[1]]
            del best[i]
            if i:
                best[i - 1] = get(ids[i - 1] * _PAIR + ids[i], none)
            if i < len(best):
                best[i] = get(ids[i] * _PAIR + ids[i + 1], none)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        heap = []

        def offer(i: int) -> None:
            if i >= 0 and (j := after[i]) >= 0 and (m := self.merges.get(ids[i] * _PAIR + ids[j])):
                heapq.heappush(heap, (m[0], i, ids[i], ids[j], m[1]))

        for i in range(len(ids)):
            offer(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [t for t in ids if t >= 0]

    def merged_many(self, words: list[bytes]) -> list[list[int]]:
        """`merged` for short words side by side: one merge in each word at a time."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        width, none = int(lengths.max()), len(self.pair_keys)
        ids = np.full((len(words), width + 1), -1, np.int64)
        ids[np.arange(width + 1) < lengths[:, None]] = np.array(self.single)[np.frombuffer(b"".join(words), np.uint8)]
        ranks = self.rank_of(ids[:, :-1], ids[:, 1:])
        out: list[list[int]] = [[]] * len(words)
        left, columns = np.arange(len(words)), np.arange(width)
        while len(left):
            i = ranks.argmin(1)
            low = ranks[np.arange(len(left)), i]
            go = low < none
            for w, row, n in zip(left[~go].tolist(), ids[~go].tolist(), lengths[~go].tolist()):
                out[w] = row[:n]
            left, ids, ranks, lengths, i, low = left[go], ids[go], ranks[go], lengths[go] - 1, i[go], low[go]
            at = np.arange(len(left))
            ids[:, :-1] = np.take_along_axis(ids, columns + (columns > i[:, None]), 1)
            ids[at, i], ids[at, lengths] = self.made[low], -1
            ranks[:, :-1] = np.take_along_axis(ranks, columns[:-1] + (columns[:-1] >= i[:, None]), 1)
            ranks[:, -1] = none
            ranks[at, i] = self.rank_of(ids[at, i], ids[at, i + 1])
            inner = at[i > 0]
            ranks[inner, i[inner] - 1] = self.rank_of(ids[inner, i[inner] - 1], ids[inner, i[inner]])
        return out

    def longest_match(self, word: bytes) -> list[int]:
        """The longest token at each place, from left to right."""
        out, at, end, ids, longest = [], 0, len(word), self.ids, self.longest
        while at < end:
            for to in range(min(end, at + longest), at, -1):
                if (t := ids.get(word[at:to])) is not None:
                    out.append(t)
                    at = to
                    break
        return out

    def longest_matches(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """`longest_match` for words side by side: all tokens in order, and the word of each."""
        data = np.frombuffer(b"".join(words) + b"\0", np.uint8).astype(np.int64)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        word = np.arange(len(words))
        start = np.concatenate([[0], ends[:-1]])
        to, node, good, token = start.copy(), np.zeros_like(start), start.copy(), np.zeros_like(start)
        found = []
        while len(word):
            keys = node << 8 | data[to]
            at = np.minimum(np.searchsorted(self.step_keys, keys), len(self.step_keys) - 1)
            on = (self.step_keys[at] == keys) & (to < ends[word])
            node, to = np.where(on, self.step_to[at], 0), to + on
            whole = on & (self.token_at[node] >= 0)
            good, token = np.where(whole, to, good), np.where(whole, self.token_at[node], token)
            if not on.all():
                off = ~on
                found.append((start[off], token[off], word[off]))
                start, to = np.where(off, good, start), np.where(off, good, to)
                keep = on | (good < ends[word])
                word, start, to, node, good, token = (x[keep] for x in (word, start, to, node, good, token))
        starts, tokens, owners = map(np.concatenate, zip(*found))
        order = np.argsort(starts, kind="stable")
        return tokens[order], owners[order]

    def stands(self, token: int) -> bool:
        """Whether merging the token's own bytes gives the token."""
        if (known := self.alone.get(token)) is None:
            known = self.alone[token] = self.merged(self.bytes_of[token]) == [token]
        return known

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; one beyond all ranks where there is none."""
        keys = a * _PAIR + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], len(self.pair_keys))

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the joint bytes of the tokens a and b gives these two, for all pairs at once.

        The merges that made both are taken back from the last one. No merge across the border may come
        before the merge just taken back; between equal pairs the left one came first.
        """
        good = np.ones(len(a), bool)
        at, before = np.arange(len(a)), np.full(len(a), len(self.pair_keys), np.int64)
        while len(at):
            apart = self.rank_of(a, b) >= before
            good[at[~apart]] = False
            made_a, made_b = self.made_at[a], self.made_at[b]
            go = apart & ((made_a >= 0) | (made_b >= 0))
            at, a, b, made_a, made_b = at[go], a[go], b[go], made_a[go], made_b[go]
            first = made_a > made_b
            before = np.where(first, made_a, made_b + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return good

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, little-endian."""
        raw = [w.encode() for w in words]
        out: list[bytes] = [b""] * len(raw)
        short = [i for i, w in enumerate(raw) if len(w) <= SHORT]
        guesses = [(short, *self.longest_matches([raw[i] for i in short]))] if short else []
        for i, w in enumerate(raw):
            if len(w) > SHORT:
                tokens = np.array(self.longest_match(w), np.int64)
                guesses.append(([i], tokens, np.zeros_like(tokens)))
        for which, tokens, owner in guesses:
            failed = self.failing(tokens, owner, len(which))
            ends = 4 * np.cumsum(np.bincount(owner, minlength=len(which)))
            data = tokens.astype("<u4").tobytes()
            for i, a, b in zip(which, [0, *ends[:-1].tolist()], ends.tolist()):
                out[i] = data[a:b]
            again = [which[k] for k in np.flatnonzero(failed).tolist()]
            again.sort(key=lambda i: len(raw[i]))
            for k in range(0, len(again), 2000):  # of like lengths
                part = [raw[i] for i in again[k : k + 2000]]
                exact = self.merged_many(part) if len(part[-1]) <= SHORT else map(self.merged, part)
                for i, ids in zip(again[k : k + 2000], exact):
                    out[i] = np.array(ids, "<u4").tobytes()
        return out

    def failing(self, tokens: np.ndarray, owner: np.ndarray, words: int) -> np.ndarray:
        """Which words have a token that does not stand alone, or two neighbours that are not compatible."""
        failed = np.zeros(words, bool)
        kinds, which = np.unique(tokens, return_inverse=True)
        stands = np.fromiter(map(self.stands, kinds.tolist()), bool, len(kinds))
        failed[owner[~stands[which]]] = True
        inside = owner[:-1] == owner[1:]
        pairs, which = np.unique((tokens[:-1] * _PAIR + tokens[1:])[inside], return_inverse=True)
        good = self.compatible(pairs // _PAIR, pairs % _PAIR)
        failed[owner[:-1][inside][~good[which]]] = True
        return failed

    def pre_tokens(self, text: str) -> list[str]:
        if text.isascii() or not _unsettled()[np.frombuffer(text.encode("utf-32-le"), "<u4")].any():
            return self.split.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def _learn(self, runs: list[str]) -> list[bytes]:
        """The ids of runs of text, by their words; words new to the worker are encoded together."""
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        cut = [[r] if r[1:].isalpha() and r[0] == " " else self.pre_tokens(r) for r in runs]
        new = list(set().union(*cut).difference(self.words))
        fresh = dict(zip(new, self.encode_words(new)))
        self.words.update((w, ids) for w, ids in fresh.items() if len(w) <= SHORT)
        return [b"".join([self.words.get(w) or fresh[w] for w in words]) for words in cut]

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of each text.

        A single blank between two other characters always begins a word, so what lies between such blanks
        is encoded on its own and remembered. A text with other white space next to a blank is cut with more care.
        """
        if len(self.runs) > CACHED_WORDS:
            self.runs.clear()
        known = self.runs
        cut = [t.split(" ") for t in pieces]
        for i, parts in enumerate(cut):
            unseen = set(parts).difference(known)
            if not parts[0] or any(not p or p[0].isspace() or p[-1].isspace() for p in unseen):
                cut[i] = _BLANK.split(pieces[i])
        rest = [parts[1:] for parts in cut]
        new = list(set().union(*rest).difference(known))
        heads = [parts[0] for parts in cut]
        ids = self._learn([*heads, *(" " + p for p in new)])
        fresh = dict(zip(new, ids[len(heads) :]))
        known.update((p, x) for p, x in fresh.items() if len(p) <= SHORT)
        known = known if all(len(p) <= SHORT for p in fresh) else {**known, **fresh}
        return [head + b"".join(map(known.__getitem__, parts)) for head, parts in zip(ids, rest)]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text, little-endian."""
        cut: list[list[bytes | None]] = []
        pieces = []
        for t in texts:
            text, parts, at = t.decode(), [], 0
            for m in self.around.finditer(text):
                pieces.append(text[at : m.start()])
                parts += [None, np.array([self.special[m[0]]], "<u4").tobytes()]
                at = m.end()
            pieces.append(text[at:])
            cut.append([*parts, None])
        ids = iter(self._encode_pieces(pieces))
        return [b"".join(next(ids) if p is None else p for p in parts) for parts in cut]

    def decode(self, texts: list[bytes]) -> list[bytes]:
        """UTF-8 of each decoded text; bytes that are none become the replacement character."""
        ids = np.frombuffer(b"".join(texts), "<u4").astype(np.int64)
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        place = np.arange(int(sizes.sum())) + np.repeat(self.begins[ids] - (ends - sizes), sizes)
        data = self.all_bytes[place].tobytes()
        stops = np.concatenate([[0], ends])[np.cumsum([0, *(len(t) // 4 for t in texts)])].tolist()
        return [data[a:b].decode("utf-8", "replace").encode() for a, b in zip(stops, stops[1:])]


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> ByteBpe:
    return ByteBpe(path)


def encode_decode(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, ids, decoded): ids as little-endian 32-bit integers, and the text they decode to.

    `path` names the vocabulary file on every machine. One row per input row, repeated rows included; a null
    text is the empty one and has no ids; other columns are ignored. No shuffle: texts are cut into words
    where they lie, a few megabytes at a time.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            for start, texts in chunks(batch.column(1)):
                ids = bpe.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(ids)),
                        pa.array(ids, pa.binary()),
                        pa.array(bpe.decode(ids), pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "ids", "decoded"],
                )

    narrow = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, ids binary, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of what `encode_decode` returns."""
    count: Column = (F.octet_length("ids") / 4).cast("long")
    return encoded.select(
        "doc_id",
        count.alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
