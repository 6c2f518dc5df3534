"""Row checks: named predicates, counted together in one pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import clock_skew


def negative(name: str) -> Column:
    return F.col(name) < 0


def zero(name: str) -> Column:
    return F.col(name) == 0


def positive(name: str) -> Column:
    return F.col(name) > 0


def scenario_without_fraud() -> Column:
    """A scenario is named though the row is not marked as fraud."""
    return (F.col("tx_fraud") == 0) & (F.col("tx_fraud_scenario") != 0)


def in_future(ts: str = "tx_datetime", as_of: Column | None = None) -> Column:
    """Later than the start of ``as_of``, today by default: rows later on
    that very day count too."""
    return F.col(ts) > (F.current_date() if as_of is None else as_of)


def standard_checks(as_of: Column | None = None) -> dict[str, Column]:
    return {
        "negative_amount": negative("tx_amount"),
        "zero_amount": zero("tx_amount"),
        "negative_customer": negative("customer_id"),
        "zero_customer": zero("customer_id"),
        "future_dates": in_future(as_of=as_of),
        "scenario_without_fraud": scenario_without_fraud(),
    }


def count_checks(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One row with one count per check."""
    return df.agg(*[F.count_if(test).alias(name) for name, test in checks.items()])


def check(df: DataFrame, name: str, test: Column) -> DataFrame:
    """One row ``check, rows`` for a single check."""
    return df.agg(F.count_if(test).alias("rows")).select(F.lit(name).alias("check"), "rows")


def with_clock_skew(df: DataFrame, ts: str = "tx_datetime", seconds: str = "tx_time_seconds") -> DataFrame:
    return df.withColumn("seconds_diff", clock_skew(F.col(ts), F.col(seconds)))


def clock_skew_top(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most frequent clock differences; the smaller one first on a tie."""
    counts = with_clock_skew(df).groupBy("seconds_diff").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.col("count").desc(), F.col("seconds_diff")).limit(n)
