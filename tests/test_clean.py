from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgersift.operators.sigma import sigma_outliers, sigma_summary, sigma_trim
from ledgersift.plans.clean import CUSTOMER_FIRST, SIGMA_FIRST, clean, clean_report, drop_incomplete
from ledgersift.sources.transactions import TRANSACTION_SCHEMA


def tx(number, amount=10.0, customer=1, at=datetime(2024, 1, 1), terminal=1, fraud=0, scenario=0):
    return (number, at, customer, terminal, amount, 0, 0, fraud, scenario)


def table(spark, rows):
    return spark.createDataFrame(rows, TRANSACTION_SCHEMA)


def numbers(df):
    return sorted(r.transaction_id for r in df.collect())


def test_null_and_nan_rows_go(spark):
    df = table(spark, [tx(1), tx(2, amount=float("nan")), tx(3, amount=None), tx(4, terminal=None)])
    assert numbers(drop_incomplete(df)) == [1]
    assert [r.rows_out for r in clean_report(df).orderBy("step_no").collect()] == [4, 1, 1, 1, 1, 1, 1]


@pytest.mark.parametrize("order", [SIGMA_FIRST, CUSTOMER_FIRST])
def test_one_row_has_no_deviation_and_stays(spark, order):
    assert numbers(clean(table(spark, [tx(1)]), order)) == [1]


def test_equal_amounts_have_deviation_zero_and_stay(spark):
    df = table(spark, [tx(i) for i in range(1, 6)])
    assert numbers(clean(df)) == [1, 2, 3, 4, 5]


def test_empty_and_all_removed(spark):
    assert clean(table(spark, [])).count() == 0
    assert [r.rows_out for r in clean_report(table(spark, [])).collect()] == [0] * 7
    gone = table(spark, [tx(1, amount=-1.0), tx(2, amount=0.0), tx(3, customer=0)])
    assert clean(gone, CUSTOMER_FIRST).count() == 0
    assert clean_report(gone, CUSTOMER_FIRST).orderBy("step_no").collect()[-1].removed_share == 1


def test_a_bad_first_row_removes_the_transaction(spark):
    df = table(spark, [tx(1, amount=-5.0, at=datetime(2024, 1, 1)), tx(1, at=datetime(2024, 1, 2)), tx(2)])
    assert numbers(clean(df)) == [2]


def test_time_ties_are_broken_by_the_other_columns(spark):
    rows = [tx(1, amount=a, customer=c) for a, c in [(5.0, 2), (7.0, 1), (6.0, 1)]]
    for given in (rows, rows[::-1]):
        assert [(r.customer_id, r.tx_amount) for r in clean(table(spark, given)).collect()] == [(1, 6.0)]


def test_the_orders_differ(spark):
    """A large amount without customer widens the bounds only while it is there."""
    rows = [tx(i, amount=10.0 + i % 3) for i in range(1, 60)]
    rows += [tx(100, amount=40.0), tx(101, amount=5000.0, customer=0)]
    df = table(spark, rows)
    assert 100 in numbers(clean(df, SIGMA_FIRST))
    assert 100 not in numbers(clean(df, CUSTOMER_FIRST))


def test_unknown_step(spark):
    with pytest.raises(ValueError, match="unknown"):
        clean(table(spark, []), ["amount", "sgima"])


def test_trim_bounds_are_inclusive(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 2, 4)], "v double")
    # mean 2, deviation 2: with k=1 the bounds are exactly 0 and 4.
    assert sigma_trim(df, "v", k=1).count() == 3
    assert sigma_outliers(df, "v", k=1).count() == 0


def test_report_lower_bound_is_raised_to_zero(spark):
    df = spark.createDataFrame([(float(v),) for v in (-1, 1, 3)], "v double")
    assert [r.v for r in sigma_outliers(df, "v").collect()] == [-1.0]
    assert sigma_outliers(df, "v", floor=None).count() == 0
    found = sigma_summary(df, "v").first()
    assert (found.lower, found.upper, found.outliers, found.rows) == (0.0, 7.0, 1, 3)


def test_nan_does_not_spoil_the_report(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (float("nan"),), (None,)], "v double")
    found = sigma_summary(df, "v").first()
    assert (found.upper, found.outliers, found.rows) == (5.0, 0, 5)


def test_no_deviation_means_no_outliers(spark):
    df = spark.createDataFrame([(-1.0,)], "v double")
    assert sigma_outliers(df, "v").count() == 0
    assert sigma_summary(df, "v").first().lower is None
    assert sigma_trim(df.union(df.select(F.lit(float("nan")))), "v").count() == 2
