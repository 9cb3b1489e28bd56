"""The identity map: which source company is which master company, and how it was found.

Map and candidate tables have columns company_id, corporate_number, identify_method, updated_at,
created_at, and hold every company_id and every corporate_number at most once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobmeld.functions.predicates import text_hash
from jobmeld.operators.matching import MATCHERS, Matcher
from jobmeld.session import cut_lineage, written

COLUMNS = ["company_id", "corporate_number", "identify_method", "updated_at", "created_at"]


def better_only(cand: DataFrame, held: DataFrame) -> DataFrame:
    """Candidates whose corporate_number no equal-or-better method holds already (JN4, IDR10).

    A hash anti join on the number with the method as residual condition.
    """
    h = held.select(F.col("corporate_number").alias("_corp"), F.col("identify_method").alias("_held"))
    return cand.join(
        h, (F.col("corporate_number") == F.col("_corp")) & (F.col("identify_method") <= F.col("_held")), "left_anti"
    )


def overlaps(held: DataFrame, cand: DataFrame) -> DataFrame:
    """Pairs of map rows and candidates that share the company or the number (JN8).

    The disjunction is written as two equi joins, the second without the pairs of the first, since
    one join on `a OR b` has no hash or merge form.
    """
    d = held.select(*[F.col(c).alias(f"d_{c}") for c in COLUMNS[:3]])
    s = cand.select(*[F.col(c).alias(f"s_{c}") for c in COLUMNS[:3]])
    by_id = d.join(s, F.col("d_company_id") == F.col("s_company_id"))
    by_corp = d.join(
        s,
        (F.col("d_corporate_number") == F.col("s_corporate_number"))
        & (F.col("d_company_id") != F.col("s_company_id")),
    )
    return by_id.unionByName(by_corp)


def merge(held: DataFrame, cand: DataFrame, conflict: str = "parity") -> DataFrame:
    """Merge one method's candidates into the map (IDR10, IDR11, JN8).

    1. A candidate is dropped when an equal-or-better method holds its corporate_number.
    2. A map row with the same company and no better method takes the candidate's values and keeps
       its created_at.
    3. Else a map row whose corporate_number a candidate claims for another company is deleted.
    4. A candidate that met no map row is inserted. With `conflict="replace"`, so is one that met a
       row only by corporate_number; with "parity" it is not.

    Two aggregates in sequence, first per corporate_number, then per company, decide all of it.
    Both inputs are read once and no group has more than two rows.
    """
    if conflict not in ("parity", "replace"):
        raise ValueError(f"unknown conflict rule {conflict!r}")
    row = F.struct(*COLUMNS)

    # who holds and who claims a corporate_number
    sides = (
        held.select("corporate_number", row.alias("d"))
        .unionByName(cand.select("corporate_number", row.alias("s")), allowMissingColumns=True)
        .groupBy("corporate_number")
        .agg(F.max("d").alias("d"), F.max("s").alias("s"))
        .select(
            "d",
            F.expr("CASE WHEN s.identify_method <= d.identify_method THEN NULL ELSE s END").alias("s"),
        )
        .select("d", "s", F.expr("coalesce(d.company_id != s.company_id, false)").alias("clash"))
    )
    # then what each company has on either side
    d_side, s_side = (F.struct(F.col(c).alias("row"), F.col("clash")) for c in ("d", "s"))
    entries = F.array(
        F.struct(F.col("d.company_id").alias("company_id"), d_side.alias("d"), _null_like(s_side).alias("s")),
        F.struct(F.col("s.company_id").alias("company_id"), _null_like(d_side).alias("d"), s_side.alias("s")),
    )
    per_company = (
        sides.select(F.inline(F.filter(entries, lambda e: e["company_id"].isNotNull())))
        .groupBy("company_id")
        .agg(F.max("d").alias("d"), F.max("s").alias("s"))
    )
    takes = F.expr("coalesce(s.row.identify_method >= d.row.identify_method, false)")
    inserts = F.col("d").isNull() if conflict == "replace" else F.col("d").isNull() & ~F.col("s.clash")
    updated = F.struct(*[F.col(f"{'d' if c == 'created_at' else 's'}.row.{c}").alias(c) for c in COLUMNS])
    result = (
        F.when(takes, updated)
        .when(F.col("d").isNotNull() & ~F.col("d.clash"), F.col("d.row"))
        .when(inserts, F.col("s.row"))
    )
    return per_company.select(result.alias("r")).filter("r IS NOT NULL").select("r.*")


def _null_like(col: Column) -> Column:
    """Null of the type of `col`."""
    return F.when(F.lit(False), col)


def cascade(
    held: DataFrame | None,
    cands: DataFrame,
    matchers: Sequence[Matcher] = MATCHERS,
    conflict: str = "parity",
    checkpoint: bool = True,
) -> DataFrame:
    """Merge the candidates of all matchers into the map, in run order (IDR9).

    `cands` holds all matchers' pairs. It is written out once by method, as each step reads its share
    of it. Each step adds two shuffles of the (narrow) map to a straight chain, which is cut half way.
    """
    if checkpoint:
        cands = written(cands, "candidates", "identify_method")
    for i, m in enumerate(matchers):
        step = cands.filter(F.col("identify_method") == m.code)
        held = step if held is None else merge(held, step, conflict)
        if checkpoint and i == len(matchers) // 2:
            held = cut_lineage(held)
    return held


def mint(
    company: DataFrame,
    media: str,
    name_key: str = "company_only_name",
    ident: str = "company_id",
    blank: str = "own",
) -> DataFrame:
    """Fill corporate_number where it is null: the hash of the name key (IDR12, FLT6).

    A company without a name key gets the hash of its source and id (`blank="own"`), or the hash of
    the empty string that all such companies share (`blank="shared"`).
    """
    key = F.coalesce(F.col(name_key).cast("string"), F.lit(""))
    minted = text_hash(F.col(name_key))
    if blank == "own":
        own = F.sha2(F.concat_ws("\x1f", F.lit(media), F.col(ident).cast("string")), 256)
        minted = F.when(F.trim(key) == "", own).otherwise(minted)
    if "corporate_number" in company.columns:
        number = F.coalesce(F.col("corporate_number"), minted)
    else:
        number = minted
    return company.withColumn("corporate_number", number)
