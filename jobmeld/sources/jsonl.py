"""JSON Lines in and out: source files, feed export, dated landing."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

CORRUPT = "_corrupt_record"


class MissingOutput(RuntimeError):
    """An expected output is absent or empty."""


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One record per line (SRC1, SRC2).

    With a schema there is no inference pass, and lines that do not parse are kept in
    `_corrupt_record` instead of being lost.
    """
    reader = spark.read.option("multiLine", False).option("mode", "PERMISSIVE")
    if schema is None:
        return reader.json(path)
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if CORRUPT not in schema.names:
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return reader.option("columnNameOfCorruptRecord", CORRUPT).schema(schema).json(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Feed export, one UTF-8 JSON object per line (SNK5)."""
    df.write.mode(mode).option("encoding", "UTF-8").option("ignoreNullFields", False).json(path)


def dated(df: DataFrame, spider: str, at: Column) -> DataFrame:
    """Stamp records with `crawl_timestamp` and the landing folder's year, month and day (SNK4)."""
    return df.select(
        "*",
        at.alias("crawl_timestamp"),
        F.lit(spider).alias("spider"),
        F.date_format(at, "yyyy").alias("year"),
        F.date_format(at, "MM").alias("month"),
        F.date_format(at, "dd").alias("day"),
    )


def land_dated(df: DataFrame, root: str, spider: str, at: Column) -> None:
    """Append below `root/year=…/month=…/day=…/spider=…` as JSON Lines (SNK4).

    Rows are brought together by day, so that not every task writes a file for every day; adaptive
    execution splits a day that holds much more than the others.
    """
    days = dated(df, spider, at).hint("rebalance", "year", "month", "day")
    days.write.mode("append").partitionBy("year", "month", "day", "spider").json(root)


def require_output(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """The output at `path`; raises when it is missing or holds no row (SNK6)."""
    try:
        df = spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        raise MissingOutput(f"output {path} not found") from e
    if not df.columns or df.isEmpty():
        raise MissingOutput(f"output {path} is empty")
    return df
