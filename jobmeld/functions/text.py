"""Text clean-up as column expressions.

Everything is native Catalyst except two functions Spark has no counterpart for, which run as
Arrow UDFs: Unicode composition and the full HTML entity table. Both return a text that needs no
work as it is; measured on whole documents, testing for that in Spark first costs more than the trip.
"""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Unicode white space, as a regex class body (Java's \s is ASCII only)
WS = r"\s\x1c-\x1f\x85\p{Z}"


def _composed(t):
    return t if t is None or t.isascii() else unicodedata.normalize("NFKC", t)


def _resolved(t):
    return t if t is None else html.unescape(t)


@F.pandas_udf(T.StringType())
def compose(s: pd.Series) -> pd.Series:
    """NFKC form of a text."""
    return pd.Series([_composed(t) for t in s], dtype=object)


@F.pandas_udf(T.StringType())
def unescape(s: pd.Series) -> pd.Series:
    """HTML entities resolved, all of the HTML 5 table."""
    return pd.Series([_resolved(t) for t in s], dtype=object)


def trim_ws(col: Column) -> Column:
    return F.regexp_replace(col, f"^[{WS}]+|[{WS}]+$", "")


def squeeze(col: Column) -> Column:
    """Every run of white space becomes one blank."""
    return F.regexp_replace(col, f"[{WS}]+", " ")


def fold_text(col: Column) -> Column:
    """Composed, single-blanked, trimmed, lower case (NRM2)."""
    return F.lower(F.trim(squeeze(compose(col))))


def remove_brackets(col: Column) -> Column:
    """Drop `( … )` segments with the blanks around them (NRM3)."""
    return trim_ws(F.regexp_replace(col, rf"[{WS}]*\(.*?\)[{WS}]*", ""))


def clean_html(col: Column) -> Column:
    """Entities resolved, list items as dashes, breaks as newlines; other tags stay (NRM5)."""
    text = unescape(col)
    for tag, plain in (("<li>", "- "), ("</li>", "\n"), ("<br>", "\n")):
        text = F.replace(text, F.lit(tag), F.lit(plain))
    return text


def clean_html_or_blank(col: Column) -> Column:
    """`clean_html`, null as blank, trimmed (NRM6)."""
    return trim_ws(clean_html(F.coalesce(col, F.lit(""))))


def clean_text(col: Column) -> Column:
    """White space collapsed and trimmed, null as blank (NRM7, NRM8)."""
    return F.trim(squeeze(F.coalesce(col, F.lit(""))))


def strip_controls(col: Column) -> Column:
    """Without the CR, LF and TAB characters that break a JSON parse (NRM9)."""
    return F.translate(col, "\r\n\t", "")


def first_filled(*cols: Column) -> Column:
    """The first column that is neither null nor blank, else the last one (NRM17)."""
    *heads, last = cols
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in heads], last)


def join_filled(arr: Column, sep: str) -> Column:
    """Array entries that are not blank, joined (NRM16)."""
    return F.array_join(F.filter(arr, lambda s: s.isNotNull() & (trim_ws(s) != "")), sep)


def drop_tokens(arr: Column, prefix: str) -> Column:
    """Array without blanks, nulls and entries that start with `prefix` (FLT8)."""
    return F.filter(arr, lambda s: s.isNotNull() & (s != "") & ~s.startswith(prefix))


def headcount(arr: Column, unit: str = "nhân viên") -> Column:
    """Company size out of free-text pieces: the last piece that names the unit, without it (NRM13)."""
    hits = F.filter(arr, lambda s: s.contains(unit))
    last = F.try_element_at(hits, F.lit(-1))
    return F.coalesce(trim_ws(F.replace(trim_ws(last), F.lit(unit), F.lit(""))), F.lit(""))


def months_text(json: Column, path: str, unknown: str = "Không rõ", unit: str = "tháng") -> Column:
    """Experience that is an object with months, a plain string, or absent (NRM14)."""
    return months_of(F.try_parse_json(json), path, unknown, unit)


def months_of(doc: Column, path: str, unknown: str = "Không rõ", unit: str = "tháng") -> Column:
    """`months_text` of a parsed document."""
    kind = F.schema_of_variant(F.try_variant_get(doc, path, "variant"))
    months = F.try_variant_get(doc, f"{path}.monthsOfExperience", "string")
    usable = months.isNotNull() & ~months.isin("0", "", "0.0", "false")
    return (
        F.when(kind == "STRING", F.try_variant_get(doc, path, "string"))
        .when(usable, F.concat_ws(" ", months, F.lit(unit)))
        .otherwise(F.lit(unknown))
    )


def list_or_text(doc: Column, path: str, sep: str = ", ") -> Column:
    """A JSON list joined to one string; any other value as it is (NRM15)."""
    items = F.try_variant_get(doc, path, "array<string>")
    return F.when(items.isNotNull(), F.array_join(items, sep)).otherwise(
        F.try_variant_get(doc, path, "string")
    )


def opening_hours(specs: Column) -> Column:
    """`array<struct<dayOfWeek: array<string>, opens, closes>>` to a map day -> 'opens - closes' (NRM18).

    A day named twice keeps its last entry.
    """
    def text(part: Column) -> Column:
        return F.coalesce(part, F.lit("None"))

    pairs = F.flatten(
        F.transform(
            specs,
            lambda s: F.transform(
                F.coalesce(s["dayOfWeek"], F.array().cast("array<string>")),
                lambda d: F.struct(
                    d.alias("key"), F.concat(text(s["opens"]), F.lit(" - "), text(s["closes"])).alias("value")
                ),
            ),
        )
    )
    last = F.filter(
        pairs,
        lambda p, i: ~F.exists(
            F.slice(pairs, i + 2, F.greatest(F.size(pairs) - i - 1, F.lit(0))),
            lambda q: q["key"] == p["key"],
        ),
    )
    return F.map_from_entries(last)


def pluck(arr: Column, field: str) -> Column:
    """One field of every struct in an array, null as blank (NRM19)."""
    return F.transform(arr, lambda s: F.coalesce(s[field], F.lit("")))


def words(col: Column) -> Column:
    """Lower-case text reduced to words with one blank between them and at both ends."""
    return F.concat(
        F.lit(" "), F.trim(F.regexp_replace(F.lower(col), r"[^\p{L}\p{M}\p{N}]+", " ")), F.lit(" ")
    )


def joined(parts: Sequence[Column], sep: str) -> Column:
    """Columns joined, nulls skipped (FN3)."""
    return F.concat_ws(sep, *parts)
