"""Ids out of URLs, and link resolution."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from jobmeld.functions.binding import bind


def strip_slashes(col: Column) -> Column:
    """Without trailing slashes, null as blank (NRM10)."""
    return F.regexp_replace(F.coalesce(col, F.lit("")), "/+$", "")


def last_segment(col: Column) -> Column:
    """What follows the last slash (NRM11)."""
    return F.substring_index(col, "/", -1)


def page_id(col: Column) -> Column:
    """Last segment without `.html` (NRM11)."""
    return F.replace(last_segment(col), F.lit(".html"), F.lit(""))


def dash_id(col: Column) -> Column:
    """Token after the last dash of the last segment (NRM11)."""
    return F.substring_index(last_segment(col), "-", -1)


def dotted_id(col: Column, index: int) -> Column:
    """Dotted token by position, negative from the end: -2 is the one before the extension (NRM11, FN12)."""
    return F.try_element_at(F.split(col, r"\."), F.lit(index))


def first_token(col: Column) -> Column:
    """Last segment up to its first dot (NRM11)."""
    return F.substring_index(last_segment(col), ".", 1)


def resolve(base: Column, link: Column) -> Column:
    """Absolute form of a link found on page `base` (NRM12).

    Handles absolute, scheme-relative, root-relative, query-only, fragment-only and path-relative
    links, with `.` and `..` segments.
    """
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    page = F.regexp_replace(base, "#.*$", "")
    plain = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.coalesce(
        F.nullif(F.regexp_extract(plain, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/]*(/(?:.*/)?)", 1), F.lit("")), F.lit("/")
    )

    def on_site(target: Column) -> Column:
        tail = F.regexp_extract(target, r"([?#].*)$", 1)
        path = F.substring(target, F.lit(1), F.length(target) - F.length(tail))
        return F.concat(origin, F.when(path.rlike(r"/\.\.?(/|$)"), _without_dots(path)).otherwise(path), tail)

    return (
        F.when(link.isNull() | (link == ""), base)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("#"), F.concat(page, link))
        .when(link.startswith("?"), F.concat(plain, link))
        .when(link.startswith("/"), bind(link, on_site))
        .otherwise(bind(F.concat(folder, link), on_site))
    )


def _without_dots(path: Column) -> Column:
    """Fold `.` and `..` segments of an absolute path."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    kept = F.aggregate(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(s))),
    )
    closing = F.when(last.isin(".", "..") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.lit("/"), F.array_join(kept, "/"), closing)
