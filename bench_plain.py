"""Straightforward forms of headline queries, to compare with: one action
per number, statistics fetched to the driver and put back as constants."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ledgersift.workload.tables import tx_raw

ORDER = ["tx_datetime", "customer_id", "terminal_id", "tx_amount"]


def _noop(df):
    df.write.format("noop").mode("overwrite").save()


def _clean(customer_first: bool):
    def run(spark, folder):
        first = Window.partitionBy("transaction_id").orderBy(*ORDER)
        df = tx_raw(spark, folder).dropna().dropDuplicates()
        df = df.withColumn("n", F.row_number().over(first)).filter("n = 1").drop("n").filter("tx_amount > 0")
        if customer_first:
            df = df.filter("customer_id > 0")
        m, s = df.agg(F.avg("tx_amount"), F.stddev("tx_amount")).first()
        df = df.filter(F.col("tx_amount").between(m - 3 * s, m + 3 * s))
        _noop(df if customer_first else df.filter("customer_id > 0"))

    return run


def _profile(spark, folder):
    df = tx_raw(spark, folder).cache()
    n = df.count()
    df.select(*[F.count_if(F.col(c).isNull()) for c in df.columns]).collect()
    df.exceptAll(df.dropDuplicates()).count()
    df.groupBy("transaction_id").count().filter("count > 1").count()
    for test in ("tx_amount < 0", "tx_amount = 0", "customer_id < 0", "customer_id = 0"):
        df.filter(test).count()
    m, s = df.agg(F.avg("tx_amount"), F.stddev("tx_amount")).first()
    assert df.filter((F.col("tx_amount") > m + 3 * s) | (F.col("tx_amount") < max(0, m - 3 * s))).count() <= n
    df.filter(F.col("tx_datetime") > F.lit("2024-01-15")).count()
    skew = F.unix_timestamp("tx_datetime") - F.col("tx_time_seconds")
    df.groupBy(skew.alias("d")).count().orderBy(F.desc("count")).limit(10).collect()
    df.agg(F.min("tx_time_days"), F.max("tx_time_days")).collect()
    for c in ("customer_id", "terminal_id", "tx_fraud", "tx_fraud_scenario"):
        df.select(F.count_distinct(c)).collect()
    for c in ("tx_fraud", "tx_fraud_scenario"):
        df.groupBy(c).count().orderBy(c).collect()
    df.filter("tx_fraud = 0 AND tx_fraud_scenario <> 0").count()
    df.unpersist()


PLAIN = {"clean_pipeline_a": _clean(False), "clean_pipeline_b": _clean(True), "prof_all_checks": _profile}
