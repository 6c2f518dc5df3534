"""Column statistics and value counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import is_float, quoted, without_nan


def null_counts(df: DataFrame) -> DataFrame:
    """One row: NULLs in every column. NaN is not NULL."""
    return df.agg(*[F.count_if(quoted(c).isNull()).alias(c) for c in df.columns])


def nan_counts(df: DataFrame) -> DataFrame:
    """One row: NaN values in every floating-point column."""
    floats = [f.name for f in df.schema if is_float(f.dataType)]
    return df.agg(*[F.count_if(F.isnan(quoted(c))).alias(c) for c in floats])


def numeric_stats(df: DataFrame, column: str) -> DataFrame:
    """One row: ``mean``, ``stddev``, ``min``, ``max``, NaN left out."""
    value = without_nan(quoted(column))
    return df.agg(
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("stddev"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )


def value_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(quoted(column)).alias("min"), F.max(quoted(column)).alias("max"))


SKETCH_ERROR = 0.05  # relative standard deviation of the sketch, its default


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """One row: distinct non-NULL values of each column, exact or by sketch."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(quoted(c)).alias(f"unique_{c}") for c in columns])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, in order of the value."""
    return df.groupBy(quoted(column)).agg(F.count(F.lit(1)).alias("count")).orderBy(quoted(column))


def column_summary(df: DataFrame) -> DataFrame:
    """One row per column: ``position``, ``column``, ``type``, ``non_null``."""
    one = df.agg(*[F.count(quoted(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    lines = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f"c{i}").alias("non_null"),
        )
        for i, f in enumerate(df.schema)
    ]
    return one.select(F.inline(F.array(*lines)))
