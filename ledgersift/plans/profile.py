"""The profile of a raw transaction table as one tall table of numbers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.columns import is_float, quoted, without_nan
from ..operators.checks import standard_checks, with_clock_skew
from ..operators.dedupe import duplicate_counts
from ..operators.sigma import is_outside, sigma_report_bounds
from ..sources.typed import typed_copy

KEY = "transaction_id"
AMOUNT = "tx_amount"
DAYS = "tx_time_days"
COUNTED = ("customer_id", "terminal_id", "tx_fraud", "tx_fraud_scenario")
LISTED = ("tx_fraud", "tx_fraud_scenario")
SKEW = "seconds_diff"


def profile_text(spark: SparkSession, paths: str | Sequence[str], out: str, as_of: Column | None = None, top: int = 10, ntz: bool = False) -> DataFrame:
    """The profile of text, written to ``out`` and read again. The text is
    parsed once, into a typed copy that all scans read and that is gone
    afterwards."""
    with typed_copy(spark, paths, ntz) as copy:
        found = profile(copy.rows, as_of, top)
        found.write.parquet(out)
    return spark.read.schema(found.schema).parquet(out)


def profile(df: DataFrame, as_of: Column | None = None, top: int = 10) -> DataFrame:
    """Table ``check``, ``metric``, ``value``.

    Five scans, however many numbers: the three-sigma bounds, all row
    checks and statistics, the duplicates, the value counts, and the
    distinct counts.
    """
    duplicates = duplicate_counts(df, KEY).select("surplus_rows", "repeated_keys")
    parts = [_scalars(df, as_of), _tall(duplicates, "duplicates"), *_values(df, top)]
    return reduce(DataFrame.unionByName, parts)


def _tall(one: DataFrame, check: str) -> DataFrame:
    """A one-row table with a line per column."""
    return _lines(one, [(check, c, c) for c in one.columns])


def _lines(one: DataFrame, names: list[tuple[str, str, str]]) -> DataFrame:
    """A one-row table as lines ``check, metric, value``, given as triples
    of check, metric and column."""
    lines = ", ".join(f"'{check}', '{metric}', CAST(`{column}` AS DOUBLE)" for check, metric, column in names)
    return one.selectExpr(f"stack({len(names)}, {lines}) AS (check, metric, value)")


def _scalars(df: DataFrame, as_of: Column | None) -> DataFrame:
    amount = without_nan(quoted(AMOUNT))
    wanted: list[tuple[str, str, Column]] = [("table", "rows", F.count(F.lit(1)))]
    wanted += [("nulls", c, F.expr(f"count_if(`{c}` IS NULL)")) for c in df.columns]
    floats = [f.name for f in df.schema if is_float(f.dataType)]
    wanted += [("nan", c, F.expr(f"count_if(isnan(`{c}`))")) for c in floats]
    wanted += [("checks", name, F.count_if(test)) for name, test in standard_checks(as_of).items()]
    wanted += [
        (AMOUNT, "mean", F.avg(amount)),
        (AMOUNT, "stddev", F.stddev_samp(amount)),
        (AMOUNT, "min", F.min(amount)),
        (AMOUNT, "max", F.max(amount)),
        (DAYS, "min", F.min(quoted(DAYS))),
        (DAYS, "max", F.max(quoted(DAYS))),
    ]
    limits = sigma_report_bounds(df, AMOUNT)
    wanted.append(("outliers", "outliers", F.count_if(is_outside(amount, limits))))
    one = df.agg(*[agg.alias(f"m{i}") for i, (_, _, agg) in enumerate(wanted)])
    one = one.select(
        "*",
        limits["lower"].alias("lower"),
        limits["upper"].alias("upper"),
        F.try_divide(F.col(f"m{len(wanted) - 1}"), F.col("m0")).alias("share"),
    )
    names = [(check, metric, f"m{i}") for i, (check, metric, _) in enumerate(wanted)]
    return _lines(one, [*names, *[("outliers", n, n) for n in ("lower", "upper", "share")]])


def _values(df: DataFrame, top: int) -> list[DataFrame]:
    """Value counts, the commonest clock differences, distinct counts.

    The few values of the small columns are counted jointly in one scan.
    Each single count is a sum over that result, whose shuffle is shared, and
    their distinct counts come from there too.
    """
    keys = [*LISTED, SKEW]
    joint = with_clock_skew(df).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    single = {k: joint.groupBy(k).agg(F.sum("count").alias("count")) for k in keys}
    single[SKEW] = single[SKEW].orderBy(F.col("count").desc(), SKEW).limit(top)
    many = df.agg(*[F.count_distinct(quoted(c)).alias(c) for c in COUNTED if c not in keys])
    # The count is always above 0. Reading it keeps the plan of ``joint`` the
    # same as elsewhere, so that its shuffle is shared.
    seen = {c: F.when(F.col("count") > 0, quoted(c)) for c in COUNTED if c in keys}
    few = joint.agg(*[F.count_distinct(v).alias(c) for c, v in seen.items()])
    return [*[_count_lines(single[k], k) for k in keys], _tall(many, "distinct"), _tall(few, "distinct")]


def _count_lines(counts: DataFrame, column: str) -> DataFrame:
    value = F.coalesce(quoted(column).cast("string"), F.lit("NULL"))
    return counts.select(
        F.lit(column).alias("check"), value.alias("metric"), F.col("count").cast("double").alias("value")
    )
