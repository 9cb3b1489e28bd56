"""Matching raw companies to master companies on equal keys, one to one.

A pair counts only if the raw company has exactly one candidate and that candidate, among the raw
companies left after this first test, has exactly one. When each side has one row per id, a raw
company's candidates are the master rows with its key, so the rule comes down to: the key occurs
once on either side. Counting both sides per key in one aggregate finds these pairs without ever
building the pairs of a frequent key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from jobmeld.functions.binding import detached
from jobmeld.functions.predicates import filled_key
from jobmeld.operators.dedupe import keep_first


class Matcher(NamedTuple):
    name: str
    keys: tuple[str, ...]
    code: int


# Matchers in run order, with the code that ranks them (larger is better)
MATCHERS = [
    Matcher("name", ("name",), 40000),
    Matcher("domain", ("domain",), 30000),
    Matcher("street_name", ("street", "name"), 35000),
    Matcher("ward_province_name", ("ward", "province", "name"), 38000),
    Matcher("name_domain", ("name", "domain"), 39000),
    Matcher("province_street", ("province", "street"), 45000),
    Matcher("ward_province_street", ("ward", "province", "street"), 47500),
]
BY_NAME = {m.name: m for m in MATCHERS}

# match key -> column on either side
RAW_KEYS = {
    "name": "company_only_name",
    "domain": "company_domain",
    "street": "street",
    "ward": "ward",
    "province": "province",
}
MASTER_KEYS = {
    "name": "standard_name",
    "domain": "domain",
    "street": "street",
    "ward": "ward",
    "province": "province",
}
_PARTS = ["_k1", "_k2", "_k3"]


def mutual_unique(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Pairs whose left id has one candidate and whose right id then has one left id (AGG1, AGG2)."""
    one = (
        pairs.groupBy(left)
        .agg(F.count(right).alias("_n"), F.min(right).alias(right))
        .filter("_n = 1")
    )
    return (
        one.groupBy(right)
        .agg(F.count(left).alias("_n"), F.min(left).alias(left))
        .filter("_n = 1")
        .select(left, right)
    )


def key_entries(df: DataFrame, matchers: Sequence[Matcher], columns: Mapping[str, str]) -> Column:
    """A record's keys, one per usable matcher: method code and key parts.

    Keys with a blank part are left out, so blanks never match one another.
    """
    def entry(m: Matcher) -> Column:
        parts = [F.col(columns[k]).cast("string") for k in m.keys]
        # the padding carries no information: a method always fills the same number of parts
        padded = parts + [F.lit("")] * (len(_PARTS) - len(parts))
        return F.when(
            filled_key(*parts),
            F.struct(F.lit(m.code).alias("method"), *[p.alias(n) for p, n in zip(padded, _PARTS)]),
        )

    usable = [m for m in matchers if all(columns.get(k) in df.columns for k in m.keys)]
    if not usable:
        raise ValueError("no matcher has all its key columns")
    return F.filter(F.array(*[entry(m) for m in usable]), lambda e: e.isNotNull())


def _keyed(df: DataFrame, ident: str, out: str, matchers: Sequence[Matcher], columns: Mapping[str, str]) -> DataFrame:
    """One narrow row per record and key: method code, key parts, id."""
    return df.select(F.col(ident).cast("string").alias(out), F.inline(key_entries(df, matchers, columns)))


def candidates(
    raw: DataFrame,
    master: DataFrame,
    matchers: Sequence[Matcher] = MATCHERS,
    raw_keys: Mapping[str, str] = RAW_KEYS,
    master_keys: Mapping[str, str] = MASTER_KEYS,
    raw_id: str = "company_id",
    master_id: str = "corporate_number",
) -> DataFrame:
    """One-to-one pairs of all `matchers`: company_id, corporate_number, identify_method (IDR1-IDR8).

    Each table is read once and all matchers share one shuffle. `raw` must have one row per
    `raw_id` and `master` one per `master_id`; see `match_repeated` for tables that do not.
    """
    left = _keyed(raw, raw_id, "company_id", matchers, raw_keys)
    right = _keyed(master, master_id, "corporate_number", matchers, master_keys)
    both = left.unionByName(right, allowMissingColumns=True)
    return (
        both.groupBy("method", *_PARTS)
        .agg(
            F.count("company_id").alias("_l"),
            F.count("corporate_number").alias("_r"),
            F.min("company_id").alias("company_id"),
            F.min("corporate_number").alias("corporate_number"),
        )
        .filter("_l = 1 AND _r = 1")
        .select("company_id", "corporate_number", F.col("method").alias("identify_method"))
    )


def match(raw: DataFrame, master: DataFrame, matcher: Matcher | str, as_of: Column, **kw) -> DataFrame:
    """One matcher's pairs in identity-map form; the raw side is reduced to one row per id (IDR8)."""
    m = BY_NAME[matcher] if isinstance(matcher, str) else matcher
    rid = kw.get("raw_id", "company_id")
    pairs = candidates(keep_first(raw, [rid]), master, [m], **kw)
    return stamp(pairs, as_of)


def stamp(pairs: DataFrame, as_of: Column) -> DataFrame:
    return pairs.select(
        "company_id",
        "corporate_number",
        "identify_method",
        as_of.alias("updated_at"),
        as_of.alias("created_at"),
    )


def candidate_counts(
    raw: DataFrame,
    master: DataFrame,
    on: Sequence[tuple[str, str]],
    raw_id: str = "company_id",
    master_id: str = "corporate_number",
) -> DataFrame:
    """Equi join on one or more columns: raw id, number of candidates, the smallest one (JN1, JN2, AGG1).

    An id may have several rows on either side. The master side is first reduced to one row per key,
    so the join adds no rows however many candidates a key has.
    """
    keys = [f"_j{i}" for i in range(len(on))]
    per_key = (
        master.filter(filled_key(*[F.col(r) for _, r in on]))
        .groupBy(*[F.col(r).alias(k) for k, (_, r) in zip(keys, on)])
        .agg(F.count(master_id).alias("_c"), F.min(master_id).alias(master_id))
        .select(*[detached(F.col(k)).alias(k) for k in keys], "_c", master_id)
    )
    left = raw.filter(filled_key(*[F.col(l) for l, _ in on])).select(
        raw_id, *[F.col(l).alias(k) for k, (l, _) in zip(keys, on)]
    )
    return (
        left.join(per_key, keys)
        .groupBy(raw_id)
        .agg(F.sum("_c").alias("candidates"), F.min(master_id).alias(master_id))
    )


def match_repeated(
    raw: DataFrame,
    master: DataFrame,
    on: Sequence[tuple[str, str]],
    raw_id: str = "company_id",
    master_id: str = "corporate_number",
) -> DataFrame:
    """The one-to-one rule for tables where an id may have several rows (AGG2)."""
    return (
        candidate_counts(raw, master, on, raw_id, master_id)
        .filter("candidates = 1")
        .groupBy(master_id)
        .agg(F.count(raw_id).alias("_n"), F.min(raw_id).alias(raw_id))
        .filter("_n = 1")
        .select(raw_id, master_id)
    )
