"""License notices in texts: exact phrases, and short notices with a few edits.

A notice of which k edits are allowed is cut into k + 1 pieces; any text within k edits of it holds one
piece unchanged. The pieces are found by plain search, and only around them the `regex` library decides
with its bounded-error matching whether, where and with how many edits the notice stands there.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from jobmeld.llm.common import chunks

# Phrases with their labels whose exact places are counted
BASE = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
# Short notices searched with edits, as words in lower case
NOTICES = [
    ("under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person", "mit"),
    ("apache license version 2", "apache-2"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license", "mpl"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("permission to use copy modify and or distribute this software", "isc"),
]
LETTERS_PER_EDIT = 10  # one edit for so many characters of a notice

# byte of a word in lower case, or a blank: words are runs of 0-9, a-z and bytes from 0x80
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


class Notice:
    """One notice: its pieces with their offsets, and the pattern that verifies."""

    def __init__(self, phrase: str, label: str, edits: int):
        self.label, self.length, self.edits = label, len(phrase), edits
        cuts = [i * len(phrase) // (edits + 1) for i in range(edits + 2)]
        self.pieces = [(phrase[a:b], a) for a, b in zip(cuts, cuts[1:])]
        self.pattern = regex.compile(f"(?e)(?:{regex.escape(phrase)}){{e<={edits}}}")

    def windows(self, line: str) -> list[tuple[int, int]]:
        """Stretches outside of which no match can lie, overlapping ones joined."""
        found = []
        for piece, offset in self.pieces:
            at = line.find(piece)
            while at >= 0:
                found.append((max(0, at - offset - self.edits), at - offset + self.length + self.edits))
                at = line.find(piece, at + 1)
        out: list[tuple[int, int]] = []
        for a, b in sorted(found):
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            else:
                out.append((a, b))
        return out

    def matches(self, line: str) -> Iterator[tuple[int, int, int]]:
        """(from, to, edits) of the matches in a line of words."""
        for a, b in self.windows(line):
            for m in self.pattern.finditer(line, a, b):
                yield m.start(), m.end(), sum(m.fuzzy_counts)


@functools.lru_cache(maxsize=8)
def _notices(notices: tuple[tuple[str, str], ...], per_edit: int) -> list[Notice]:
    return [Notice(p, label, len(p) // per_edit) for p, label in notices]


def scan_text(text: bytes, base: Sequence[tuple[str, str]], notices: Sequence[Notice]) -> dict:
    words = words_of(text)
    line = " " + b" ".join(words).decode() + " "
    places, labels, score = [], set(), 0.0
    for phrase, label in base:
        wanted = f" {phrase} "
        at = line.find(wanted)
        while at >= 0:
            places.append(at)
            labels.add(label)
            at = line.find(wanted, at + 1)
    spans, more = [], set(labels)
    for n in notices:
        for a, b, edits in n.matches(line):
            more.add(n.label)
            score = max(score, 1 - edits / n.length)
            first = line.count(" ", 0, a + 1) - 1
            spans.append(
                {"label": n.label, "first": max(first, 0), "last": first + line.count(" ", a + 1, b - 1), "edits": edits}
            )
    return {
        "n_words": len(words),
        "n_base": len(places),
        "first_word": line.count(" ", 0, min(places)) if places else None,
        "last_word": line.count(" ", 0, max(places)) if places else None,
        "base_labels": ",".join(sorted(labels)),
        "labels": ",".join(sorted(more)),
        "score": 1.0 if places else score,
        "spans": spans,
    }


_OUT = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
    "score double, spans array<struct<label: string, first: bigint, last: bigint, edits: bigint>>"
)
_SPAN = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("edits", pa.int64())])
_ARROW = [
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(_SPAN)),
]


def scan(
    docs: DataFrame,
    base: Sequence[tuple[str, str]] = BASE,
    notices: Sequence[tuple[str, str]] = NOTICES,
    letters_per_edit: int = LETTERS_PER_EDIT,
) -> DataFrame:
    """One row per document: counts and first and last place of the base phrases, labels, score, spans.

    Phrases and notices are words in lower case, one blank between them. `spans` has the places of notices as
    first and last word with the number of edits; `score` is 1 with a base phrase, else the highest share of a
    notice's characters without edits, else 0. A null or empty text has no words, no places and empty labels.
    Repeated rows give repeated results; other columns are ignored. No shuffle; whole texts.
    """
    base, wanted = tuple(base), tuple(notices)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _notices(wanted, letters_per_edit)
        for batch in batches:
            schema = pa.schema([("doc_id", batch.schema.field(0).type), *_ARROW])
            for start, texts in chunks(batch.column(1)):
                rows = [scan_text(t, base, known) for t in texts]
                columns = [pa.array([r[name] for r in rows], kind) for name, kind in _ARROW]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(rows)), *columns], schema=schema)

    narrow = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return narrow.mapInArrow(run, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, {_OUT}")
