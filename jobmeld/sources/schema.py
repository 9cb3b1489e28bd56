"""Schema creation, evolution and alignment between a table and an incoming batch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T


class SchemaConflict(ValueError):
    """Same column name, different types."""


def all_nullable(schema: T.StructType, extra: Mapping[str, T.DataType] | None = None) -> T.StructType:
    """The schema with every top-level field nullable, plus `extra` columns (SC1, SC4)."""
    fields = [T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields]
    fields += [T.StructField(n, t, True) for n, t in (extra or {}).items() if n not in schema.names]
    return T.StructType(fields)


def empty_like(
    spark: SparkSession, schema: T.StructType, extra: Mapping[str, T.DataType] | None = None
) -> DataFrame:
    """An empty frame with the nullable form of `schema`: what a table holds before its first batch."""
    return spark.createDataFrame([], all_nullable(schema, extra))


def missing_columns(have: DataFrame, want: DataFrame) -> list[str]:
    """Columns of `want` that `have` lacks, in the order of `want` (SET1)."""
    known = set(have.columns)
    return [c for c in want.columns if c not in known]


def typed_null(dtype: T.DataType) -> Column:
    return F.lit(None).cast(dtype)


def evolve(dest: DataFrame, src: DataFrame) -> DataFrame:
    """`dest` with the columns only `src` has, as nulls of the source type (SC2).

    Columns are only added. A shared column whose type differs raises `SchemaConflict`.
    """
    for name in dest.columns:
        if name in src.columns:
            a, b = dest.schema[name].dataType, src.schema[name].dataType
            if a.simpleString() != b.simpleString():
                raise SchemaConflict(f"{name}: {a.simpleString()} in table, {b.simpleString()} in batch")
    added = [typed_null(src.schema[c].dataType).alias(c) for c in missing_columns(dest, src)]
    return dest.select("*", *added)


def backfill(src: DataFrame, dest: DataFrame) -> DataFrame:
    """`src` in the column layout of `dest`, columns it lacks filled with typed nulls (SC3)."""
    known = set(src.columns)
    return src.select(
        *[F.col(c) if c in known else typed_null(dest.schema[c].dataType).alias(c) for c in dest.columns]
    )


def conform(df: DataFrame, schema: T.StructType, lost: Observation | None = None) -> DataFrame:
    """Exactly the columns of `schema`; values that do not fit its type become null.

    `lost` counts these values per column in the pass that computes the frame: `lost.get` after its first action.
    """
    known = {f.name: f.dataType for f in df.schema.fields}
    cols, cast = [], []
    for f in schema.fields:
        if f.name not in known:
            cols.append(typed_null(f.dataType).alias(f.name))
        elif known[f.name] == f.dataType:
            cols.append(F.col(f.name))
        else:
            cols.append(_fit(F.col(f.name), known[f.name], f.dataType).alias(f.name))
            cast.append(f.name)
    if lost is None:
        return df.select(*cols)
    flags = {c: F.col(c).isNotNull().alias(f"_had{i}") for i, c in enumerate(cast)}
    both = df.select(*cols, *flags.values())
    gone = [F.count_if(F.col(f"_had{i}") & F.col(c).isNull()).alias(c) for i, c in enumerate(cast)]
    observed = both.observe(lost, *(gone or [F.lit(0).alias("_none")]))
    return observed.select(*schema.names)


def _fit(col: Column, have: T.DataType, want: T.DataType) -> Column:
    """Cast between the shapes one master column takes in different sources."""
    to_array, from_array = isinstance(want, T.ArrayType), isinstance(have, T.ArrayType)
    if to_array and not from_array:
        return F.when(col.isNotNull(), F.array(col.try_cast(want.elementType)))
    if from_array and not to_array:
        if isinstance(have.elementType, (T.StructType, T.MapType, T.ArrayType)):
            return F.to_json(col).try_cast(want)
        return F.when(col.isNotNull(), F.concat_ws(", ", col.cast("array<string>"))).try_cast(want)
    if isinstance(have, (T.StructType, T.MapType)) and isinstance(want, T.StringType):
        return F.to_json(col)
    return col.try_cast(want)


def consolidate(frames: Sequence[DataFrame]) -> DataFrame:
    """All sources in one frame, columns matched by name (SET2)."""
    first, *others = frames
    for df in others:
        first = first.unionByName(df, allowMissingColumns=True)
    return first


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, number of rows, number of filled values; a single pass (SC5, AGG4)."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    stats = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(df.schema[c].dataType.simpleString()).alias("column_type"),
                F.col("_rows").alias("row_count"),
                F.col(c).alias("filled_count"),
            )
            for c in df.columns
        ]
    )
    return counts.select(F.inline(stats))


def preview(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first `n` rows by a stated order (LIM1)."""
    return df.orderBy(*order).limit(n)
