"""The transaction, feature and entity tables, derived from ``events``.

Every event becomes a transaction. Defects are added on top by rules on
the event number: wrong values in place, and further copies of some rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import pin_timezone

NTZ = "timestamp_ntz"

# The copy rules, name and condition.
COPY_RULES = {
    "full": "event_id % 50 = 0",
    "earlier": "event_id % 41 = 0",
    "later": "event_id % 43 = 0",
    "tie": "event_id % 47 = 0",
}
# The origin of tx_time_seconds is 2024-01-01 00:00:00.
ORIGIN_SECONDS = 1704067200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_timezone(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def tx_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions with defects, from one scan of ``events``.

    Each event is repeated once per copy rule that applies to it; the name
    of the rule then decides what the copy changes.
    """
    applied = ", ".join(f"CASE WHEN {test} THEN '{rule}' END" for rule, test in COPY_RULES.items())
    return (
        table(spark, sf_dir, "events")
        .selectExpr(
            "*",
            "CAST(date_trunc('second', ts) AS TIMESTAMP_NTZ) AS at",
            """CASE WHEN user_id = 0 THEN value * 50
                    WHEN event_id % 89 = 0 THEN -value
                    WHEN event_id % 83 = 0 THEN 0D
                    ELSE value END AS amount""",
            f"explode(array_compact(array('base', {applied}))) AS copy",
        )
        .selectExpr("*", f"unix_timestamp(at) - {ORIGIN_SECONDS} AS since", "event_type = 'error' AS error")
        .selectExpr(
            "event_id AS transaction_id",
            """CASE copy WHEN 'earlier' THEN at - INTERVAL 1 HOUR
                         WHEN 'later' THEN at + INTERVAL 1 HOUR
                         ELSE at END AS tx_datetime""",
            "user_id AS customer_id",
            "CASE WHEN event_id % 97 <> 0 THEN event_id % 500 END AS terminal_id",
            """CASE copy WHEN 'earlier' THEN -abs(amount) - 1
                         WHEN 'tie' THEN abs(amount) + 5
                         ELSE amount END AS tx_amount""",
            "since + IF(event_id % 103 = 0, 60, 0) AS tx_time_seconds",
            "CAST(floor(since / 86400D) AS INT) AS tx_time_days",
            "IF(error, 1, 0) AS tx_fraud",
            """CASE WHEN error THEN CAST(1 + event_id % 3 AS INT)
                    WHEN event_id % 101 = 0 THEN 2 ELSE 0 END AS tx_fraud_scenario""",
        )
    )


def driver_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user and day: shares of purchases and non-errors, and events.
    A day's row carries the time at which the day is over."""
    day = F.date_trunc("day", "ts").cast(NTZ)
    events = F.count(F.lit(1))
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("driver_id"), day.alias("day"))
        .agg(
            (F.count_if(F.col("event_type") == "purchase") / events).alias("conv_rate"),
            (1 - F.count_if(F.col("event_type") == "error") / events).alias("acc_rate"),
            events.cast("int").alias("avg_daily_trips"),
        )
        .select(
            "driver_id",
            (F.col("day") + F.expr("INTERVAL 1 DAY")).cast(NTZ).alias("event_timestamp"),
            (F.col("day") + F.expr("INTERVAL 25 HOURS")).cast(NTZ).alias("created"),
            "conv_rate",
            "acc_rate",
            "avg_daily_trips",
        )
    )


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per purchase: who and when."""
    purchases = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return purchases.select(
        F.col("event_id").alias("entity_id"),
        F.col("user_id").alias("driver_id"),
        F.col("ts").alias("event_timestamp"),
    )


def orders_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and their worth per customer and day, moved by 8400 days so that
    they reach into the time of the events."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.col("o_custkey").alias("driver_id"),
            (F.col("o_orderdate") + F.expr("INTERVAL 8400 DAYS")).cast(NTZ).alias("event_timestamp"),
        )
        .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("spent"))
    )
