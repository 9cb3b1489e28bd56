"""Joins that attach company identity to companies and jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobmeld.functions.binding import detached


def attach_number(company: DataFrame, idmap: DataFrame, ident: str = "company_id") -> DataFrame:
    """Left join to the identity map, which has one row per company (JN3, PRJ4, PRJ5)."""
    ids = idmap.select(F.col("company_id").alias("_id"), "corporate_number")
    return company.join(ids, F.col(ident).cast("string") == F.col("_id"), "left").drop("_id")


def company_lookup(master: DataFrame, id_column: str, key: str = "company_id") -> DataFrame:
    """One master company per source company id: the one with the smallest number (AGG3).

    Number, name and province come from the same row.
    """
    return (
        master.filter(F.col(id_column).isNotNull())
        .groupBy(F.col(id_column).cast("string").alias(key))
        .agg(F.min(F.struct("corporate_number", "company_name", "province")).alias("_m"))
        .select(
            detached(F.col(key)).alias(key),
            F.col("_m.corporate_number").alias("corporate_number"),
            F.col("_m.company_name").alias("master_company_name"),
            F.col("_m.province").alias("province"),
        )
    )


def attach_company(jobs: DataFrame, lookup: DataFrame, job_key: str, key: str = "company_id") -> DataFrame:
    """Inner join of jobs to their company; jobs of unknown companies fall out (JN5).

    The lookup has one row per company. Whether it is small enough to broadcast is for Spark to
    measure; where it is not, a company with very many jobs is split by adaptive skew handling.
    """
    side = lookup.withColumnRenamed(key, "_company")
    clash = [c for c in ("province",) if c in jobs.columns]
    return jobs.drop(*clash).join(side, F.col(job_key).cast("string") == F.col("_company")).drop("_company")
