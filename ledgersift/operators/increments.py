"""Statistics of a table that grows by days, from what each day left behind.

A day leaves one row of count, mean and sum of squared deviations (m2), and one
of sketches of its distinct values. Rows of any days merge, in any order, so
that bounds and distinct counts of the whole need no earlier day again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import quoted, without_nan

SKETCH_BITS = 12  # 2**12 registers: a relative error of 1.6 percent


def moments(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """``n, mean, m2, low, high`` of a column for each group; NaN is left out."""
    value = without_nan(quoted(column)).cast("double")
    n = F.count(value)
    return df.groupBy(*[quoted(c) for c in by]).agg(
        n.alias("n"),
        F.avg(value).alias("mean"),
        F.coalesce(F.var_pop(value) * n, F.lit(0.0)).alias("m2"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    )


def merged_moments(parts: DataFrame) -> DataFrame:
    """One row for rows of ``moments``, as if all values had come together.

    The squared deviations of the parts add up, and those of their means from
    the common one. Means are taken from a first guess, so that large values
    with small deviations keep their digits.
    """
    held = F.col("n") > 0
    guess = parts.filter(held).agg(F.avg("mean").alias("g")).scalar()
    away = F.when(held, F.col("mean") - guess)
    total = parts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.sum(F.col("n") * away).alias("s1"),
        F.sum(F.col("n") * away * away).alias("s2"),
        F.coalesce(F.sum("m2"), F.lit(0.0)).alias("inner"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
    off = F.try_divide("s1", "n")
    return total.select("n", (guess + off).alias("mean"), F.coalesce(F.col("inner") + F.col("s2") - F.col("n") * off * off, F.lit(0.0)).alias("m2"), "low", "high")


def merged_bounds(parts: DataFrame, k: float = 3.0) -> DataFrame:
    """One row ``mean, stddev, lower, upper``, as the trim takes them: bounds
    are NULL where the deviation is NULL, NaN or 0."""
    sd = F.when(F.col("n") > 1, F.sqrt(F.greatest(F.col("m2"), F.lit(0.0)) / (F.col("n") - 1)))
    usable = (F.col("stddev") > 0) & ~F.isnan("stddev")
    return (
        merged_moments(parts)
        .select("mean", sd.alias("stddev"))
        .select("*", F.when(usable, F.col("mean") - k * F.col("stddev")).alias("lower"), F.when(usable, F.col("mean") + k * F.col("stddev")).alias("upper"))
    )


def trim_by(df: DataFrame, column: str, bounds: DataFrame) -> DataFrame:
    """Rows within given bounds, a one-row table; all of them without bounds."""
    limits = bounds.select(F.struct("lower", "upper")).scalar()
    return df.filter(limits["upper"].isNull() | quoted(column).between(limits["lower"], limits["upper"]))


def sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), bits: int = SKETCH_BITS) -> DataFrame:
    """A sketch of each column's distinct values for each group, to be stored."""
    return df.groupBy(*[quoted(c) for c in by]).agg(*[F.hll_sketch_agg(_sketchable(df, c), F.lit(bits)).alias(c) for c in columns])


def _sketchable(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType.typeName()
    return quoted(column) if kind in ("integer", "long", "string", "binary") else quoted(column).cast("string")


def merged_distinct(parts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row of distinct counts, by sketch, over rows of ``sketches``."""
    return parts.agg(*[F.hll_sketch_estimate(F.hll_union_agg(quoted(c))).alias(f"unique_{c}") for c in columns])
