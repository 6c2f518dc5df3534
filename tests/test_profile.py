import os
from unittest import mock

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgersift.functions.columns import is_unparsable, percent
from ledgersift.operators import checks, stats, trends
from ledgersift.plans.profile import profile, profile_text
from ledgersift.sources import typed
from ledgersift.sources.transactions import TRANSACTION_SCHEMA
from ledgersift.workload.tables import tx_raw
from test_clean import table, tx


def values(df):
    return {(r.check, r.metric): r.value for r in df.collect()}


def test_null_and_nan_are_counted_apart(spark):
    df = table(spark, [tx(1), tx(2, amount=float("nan")), tx(3, amount=None)])
    assert stats.null_counts(df).first().tx_amount == 1
    assert stats.nan_counts(df).first().tx_amount == 1
    found = values(profile(df))
    assert found["nulls", "tx_amount"] == found["nan", "tx_amount"] == 1
    assert found["tx_amount", "mean"] == found["tx_amount", "max"] == 10.0


def test_future_means_after_the_start_of_the_day(spark):
    day = F.lit(datetime(2024, 1, 2))
    times = [datetime(2024, 1, 1, 23), datetime(2024, 1, 2), datetime(2024, 1, 2, 0, 0, 1)]
    df = table(spark, [tx(i, at=t) for i, t in enumerate(times)])
    assert checks.check(df, "future", checks.in_future(as_of=day)).first().rows == 1
    assert checks.check(df, "future", checks.in_future()).first().rows == 0
    ahead = table(spark, [tx(1, at=datetime(2999, 1, 1))])
    assert checks.check(ahead, "future", checks.in_future()).first().rows == 1


def test_consistency_looks_one_way_only(spark):
    df = table(spark, [tx(1, fraud=0, scenario=2), tx(2, fraud=1, scenario=0), tx(3, fraud=None, scenario=2)])
    assert checks.check(df, "c", checks.scenario_without_fraud()).first().rows == 1


def test_negative_and_zero_customers(spark):
    df = table(spark, [tx(1, customer=-1), tx(2, customer=0), tx(3)])
    found = checks.count_checks(df, checks.standard_checks()).first()
    assert (found.negative_customer, found.zero_customer) == (1, 1)


def test_profile_of_nothing(spark):
    found = values(profile(table(spark, [])))
    assert found["table", "rows"] == 0
    assert found["duplicates", "surplus_rows"] == 0
    assert found["tx_amount", "mean"] is None


def test_profile_lists_null_values(spark):
    found = values(profile(table(spark, [tx(1, fraud=None), tx(2)])))
    assert found["tx_fraud", "NULL"] == found["tx_fraud", "0"] == 1
    assert found["distinct", "tx_fraud"] == 1


def test_profile_of_text_parses_once(spark, tmp_path):
    source = tmp_path / "in.txt"
    line = "{n},2024-01-01 10:00:00,1,1,{a},36000,0,0,0\n"
    source.write_text("# head\n" + "".join(line.format(n=n % 50, a=n % 7) for n in range(200)) + "9,never,1,1,5,36000,0,0,0\n")
    scans, original = [], typed.read_transactions

    def spy(*args, **kwargs):
        scans.append(args)
        return original(*args, **kwargs)

    with mock.patch.object(typed, "read_transactions", spy), typed.typed_copy(spark, str(source)) as copy:
        report = profile(copy.rows)
        plan = report._jdf.queryExecution().executedPlan().toString()
        found = values(report)
        assert "csv" not in plan.lower() and "FileScan parquet" in plan
        folder = copy.path
    assert len(scans) == 1 and not os.path.exists(folder)
    assert found["table", "rows"] == 201 and found["nulls", "tx_datetime"] == 1
    assert found == values(profile_text(spark, str(source), str(tmp_path / "out")))


def test_rows_and_rejects_are_all_lines(spark, tmp_path):
    good = "{n},2024-01-01 10:00:00,1,1,5,36000,0,0,0\n"
    (tmp_path / "a.txt").write_text(good.format(n=1) + "2,never,1,1,5,36000,0,0,0\n" + good.format(n=3))
    (tmp_path / "b.txt").write_text("4,2024-01-01\n" + good.format(n=5))
    with typed.typed_copy(spark, str(tmp_path / "*.txt")) as copy:
        assert sorted(r.transaction_id for r in copy.readable.collect()) == [1, 3, 5]
        assert copy.rows.count() == 5
        rejects = sorted((r.file.rsplit("/", 1)[-1], r.line) for r in copy.rejects.collect())
    assert rejects == [("a.txt", "2,never,1,1,5,36000,0,0,0"), ("b.txt", "4,2024-01-01")]
    with typed.typed_copy(spark, []) as copy:
        assert copy.rows.count() == copy.rejects.count() == 0


def test_approximate_counts_are_near(spark, sf):
    raw = tx_raw(spark, sf["sf0.01"])
    columns = ["customer_id", "terminal_id", "tx_fraud", "tx_fraud_scenario"]
    exact = stats.distinct_counts(raw, columns).first()
    near = stats.distinct_counts(raw, columns, approximate=True).first()
    for e, n in zip(exact, near):
        assert n == pytest.approx(e, rel=0.15)


def test_unparsable_timestamps(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("bad",), (None,), ("2024-13-01 00:00:00",)], "t string")
    assert df.filter(is_unparsable(F.col("t"))).count() == 2


def test_skew_top_breaks_ties_by_value(spark):
    rows = [(1, datetime(2024, 1, 1), 1, 1, 1.0, s, 0, 0, 0) for s in (5, 3, 3, 4)]
    base = 1704067200  # 2024-01-01 00:00:00 UTC
    found = [tuple(r) for r in checks.clock_skew_top(spark.createDataFrame(rows, TRANSACTION_SCHEMA), 2).collect()]
    assert [(d - base, n) for d, n in found] == [(-3, 2), (-5, 1)]


def test_trends_skip_rows_without_time_or_flag(spark):
    rows = [tx(1, at=None), tx(2, fraud=None), tx(3, fraud=1), tx(4), tx(5)]
    df = table(spark, rows)
    assert [tuple(r) for r in trends.fraud_by_day(df).collect()] == [("2024-01-01", 3, 1, 33.33)]
    assert [tuple(r) for r in trends.tx_by_hour(df).collect()] == [(0, 3)]


def test_percent_of_nothing_is_null(spark):
    assert spark.range(1).select(percent(F.lit(0), F.lit(0))).first()[0] is None


def test_column_summary(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, `b c` string")
    found = [tuple(r) for r in stats.column_summary(df).orderBy("position").collect()]
    assert found == [(0, "a", "int", 2), (1, "b c", "string", 1)]
