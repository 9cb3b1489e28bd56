"""Registry shared by the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobmeld.session import scratch_path
from jobmeld.sources.store import SnapshotStore

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

AS_OF = "2024-01-01 00:00:00"
LATER = "2024-02-01 00:00:00"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where there is one, the SQL that gives the same rows."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is there already")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def store(spark: SparkSession, label: str) -> SnapshotStore:
    return SnapshotStore(spark, scratch_path(spark, label))


def when(text: str = AS_OF) -> Column:
    return F.lit(text).cast("timestamp")
