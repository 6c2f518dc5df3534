"""Counts over days and hours."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import percent


def _dated(df: DataFrame, ts: str, flag: str) -> DataFrame:
    return df.filter(F.col(ts).isNotNull() & F.col(flag).isNotNull())


def fraud_by_day(df: DataFrame, ts: str = "tx_datetime", flag: str = "tx_fraud") -> DataFrame:
    """Per day: ``date`` (text), ``total``, ``fraud``, ``fraud_percent``."""
    days = _dated(df, ts, flag).groupBy(F.date_format(ts, "yyyy-MM-dd").alias("date"))
    counted = days.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(flag) == 1).alias("fraud"))
    share = percent(F.col("fraud"), F.col("total")).alias("fraud_percent")
    return counted.select("date", "total", "fraud", share).orderBy("date")


def tx_by_hour(df: DataFrame, ts: str = "tx_datetime", flag: str = "tx_fraud") -> DataFrame:
    """Rows per hour of day; hours without rows are left out."""
    hours = _dated(df, ts, flag).groupBy(F.hour(ts).alias("hour"))
    return hours.agg(F.count(F.lit(1)).alias("count")).orderBy("hour")
