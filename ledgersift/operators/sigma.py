"""Three-sigma bounds, as a report and as a filter.

Both compare rows with statistics of the whole table. The statistics are a
scalar subquery: Spark computes the one row, puts it into the filter and
shares a common shuffle between the two uses. No join is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import quoted, without_nan


def bounds(value: Column, k: float = 3.0) -> Column:
    """Aggregate: struct ``mean, stddev, lower, upper``.

    The bounds are NULL where the deviation is NULL, NaN or 0, that is
    where it cannot tell rows apart.
    """
    mean, sd = F.avg(value), F.stddev_samp(value)
    usable = (sd > 0) & ~F.isnan(sd)
    return F.struct(
        mean.alias("mean"),
        sd.alias("stddev"),
        F.when(usable, mean - k * sd).alias("lower"),
        F.when(usable, mean + k * sd).alias("upper"),
    )


def sigma_trim(df: DataFrame, column: str, k: float = 3.0) -> DataFrame:
    """Rows within ``mean ± k·stddev`` of the rows given, bounds included.

    All rows stay when there is no usable deviation.
    """
    value = quoted(column)
    stats = df.agg(bounds(value, k).alias("b")).scalar()
    return df.filter(stats["upper"].isNull() | value.between(stats["lower"], stats["upper"]))


def sigma_report_bounds(df: DataFrame, column: str, k: float = 3.0, floor: float | None = 0.0) -> Column:
    """Scalar struct ``lower, upper`` of the report form: NaN left out, the
    lower bound raised to ``floor``."""
    found = df.agg(bounds(without_nan(quoted(column)), k).alias("b"))
    lower = F.col("b.lower") if floor is None else F.greatest(F.col("b.lower"), F.lit(floor))
    lower = F.when(F.col("b.lower").isNotNull(), lower)
    return found.select(F.struct(lower.alias("lower"), F.col("b.upper").alias("upper"))).scalar()


def is_outside(value: Column, limits: Column) -> Column:
    return (value > limits["upper"]) | (value < limits["lower"])


def sigma_outliers(df: DataFrame, column: str, k: float = 3.0, floor: float | None = 0.0) -> DataFrame:
    """Rows strictly outside the report bounds."""
    limits = sigma_report_bounds(df, column, k, floor)
    return df.filter(is_outside(without_nan(quoted(column)), limits))


def sigma_summary(df: DataFrame, column: str, k: float = 3.0, floor: float | None = 0.0) -> DataFrame:
    """One row: ``lower``, ``upper``, ``outliers``, ``rows``, ``share``."""
    limits = sigma_report_bounds(df, column, k, floor)
    outside = is_outside(without_nan(quoted(column)), limits)
    counted = df.agg(F.count_if(outside).alias("outliers"), F.count(F.lit(1)).alias("rows"))
    return counted.select(
        limits["lower"].alias("lower"),
        limits["upper"].alias("upper"),
        "outliers",
        "rows",
        F.try_divide(F.col("outliers"), F.col("rows")).alias("share"),
    )
