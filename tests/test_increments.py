"""Statistics merged over days against those of the whole."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from ledgersift.operators.increments import merged_bounds, merged_distinct, merged_moments, moments, sketches, trim_by
from ledgersift.operators.sigma import sigma_trim


def table(spark, rows):
    return spark.createDataFrame(rows, "day int, v double")


@pytest.mark.parametrize("offset", [0.0, 1e9])
def test_merged_moments_by_brute_force(spark, offset):
    rng = random.Random(3)
    rows = [(rng.randrange(12), offset + rng.gauss(rng.randrange(3), 2)) for _ in range(800)]
    rows += [(1, None), (2, math.nan), (20, None), (None, offset + 1.0), (7, offset)]
    values = [v for _, v in rows if v is not None and not math.isnan(v)]
    got = merged_moments(moments(table(spark, rows), "v", ["day"])).first()
    assert got.n == len(values) and (got.low, got.high) == (min(values), max(values))
    assert got.mean == pytest.approx(statistics.fmean(values), rel=1e-12)
    assert got.m2 == pytest.approx(statistics.variance([v - offset for v in values]) * (len(values) - 1), rel=1e-6)


def test_days_come_in_any_order_and_merge_again(spark):
    rows = [(d, float(d * k % 17)) for d in range(9) for k in range(d + 1)]
    parts = moments(table(spark, rows), "v", ["day"])
    weeks = [merged_moments(parts.filter(w)).select("n", "mean", "m2", "low", "high") for w in ("day < 4", "day >= 4")]
    twice, once = merged_moments(weeks[1].unionByName(weeks[0])).first(), merged_moments(parts).first()
    assert twice.n == once.n and twice.m2 == pytest.approx(once.m2) and twice.mean == pytest.approx(once.mean)


def test_a_new_day_moves_the_bounds_as_the_whole_would(spark, tmp_path):
    rng = random.Random(5)
    rows = [(d, rng.gauss(10, 1) if rng.random() < 0.97 else 60.0) for d in range(10) for _ in range(60)]
    store = str(tmp_path / "days")
    for first, last in ((0, 6), (7, 9)):  # each run reads its own days only
        new = [r for r in rows if first <= r[0] <= last]
        moments(table(spark, new), "v", ["day"]).write.mode("append").parquet(store)
    whole = table(spark, rows)
    kept = trim_by(whole, "v", merged_bounds(spark.read.parquet(store)))
    assert sorted(r.v for r in kept.collect()) == sorted(r.v for r in sigma_trim(whole, "v").collect())
    assert kept.count() < len(rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, 4.0)], [(1, 4.0), (2, 4.0)]])
def test_no_bounds_without_a_deviation(spark, rows):
    df = table(spark, rows)
    limits = merged_bounds(moments(df, "v", ["day"]))
    found = limits.first()
    assert found.lower is None and found.upper is None
    assert trim_by(df, "v", limits).count() == len(rows)


def test_sketches_merge_over_days(spark, tmp_path):
    df = spark.range(40_000).select((F.col("id") % 7).alias("day"), (F.col("id") % 9000).alias("a"), F.col("id").cast("string").alias("b"), (F.col("id") % 3 == 0).alias("c"), F.lit(None).cast("int").alias("d"))
    store = str(tmp_path / "sketches")
    sketches(df, ["a", "b", "c", "d"], ["day"]).write.parquet(store)
    got = merged_distinct(spark.read.parquet(store), ["a", "b", "c", "d"]).first()
    assert got.unique_a == pytest.approx(9000, rel=0.05) and got.unique_b == pytest.approx(40_000, rel=0.05)
    assert got.unique_c == 2 and got.unique_d == 0
