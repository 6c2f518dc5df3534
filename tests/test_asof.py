"""The as-of join against brute force, whole and in slices."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgersift.operators import asof
from ledgersift.operators.asof import HIT, asof_join, within_ttl
from ledgersift.operators.heavy import SkewPolicy

WHOLE = SkewPolicy(enabled=False)
SLICED = SkewPolicy(heavy_rows=100, max_keys=3)  # more keys are heavy than may be set apart
ONE_HEAVY = SkewPolicy(heavy_rows=300, max_keys=3, broadcast_bytes=20)
START = datetime(2024, 3, 30)


def made(seed, n=1500):
    """Key 0 holds a third of all rows; much of it falls on one instant."""
    rng = random.Random(seed)

    def key():
        return 0 if rng.random() < 0.34 else rng.choice([None, *range(1, 12)])

    def time():
        if rng.random() < 0.3:
            return START + timedelta(hours=40)
        return START + timedelta(minutes=rng.randrange(4000))

    rows = [(i, key(), None if rng.random() < 0.02 else time()) for i in range(n)]
    rows += [rows[0]] * 50
    features = [(key(), None if rng.random() < 0.02 else time(), rng.randrange(4), rng.random()) for _ in range(n // 2)]
    features += [(0, START + timedelta(hours=40), 3, 0.25)] * 300
    return rows, features


def brute(rows, features):
    out = []
    for number, key, time in rows:
        fits = [
            (f[1], f[2], f[3])
            for f in features
            if key is not None and time is not None and f[0] == key and f[1] is not None and f[1] <= time
        ]
        out.append((number, *(max(fits) if fits else (None, None, None))))
    return sorted(out, key=str)


def joined(spark, rows, features, policy, kind="timestamp_ntz", max_age=None):
    left = spark.createDataFrame(rows, f"id int, k int, t {kind}").repartition(5)
    right = spark.createDataFrame(features, f"k int, ft {kind}, c int, v double").repartition(4)
    return asof_join(left, right, ["k"], "t", "ft", ["v"], ["c"], policy, max_age)


def result(df):
    return sorted(((r.id, *(r[HIT] or (None, None, None))) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("policy", [WHOLE, SLICED, ONE_HEAVY], ids=["whole", "sliced", "one"])
def test_equals_brute_force(spark, seed, policy):
    rows, features = made(seed)
    assert result(joined(spark, rows, features, policy)) == brute(rows, features)


@pytest.mark.parametrize("policy", [WHOLE, SLICED], ids=["whole", "sliced"])
def test_zoned_times_over_a_clock_change(spark, policy):
    rows, features = made(4)
    before = spark.conf.get("spark.sql.session.timeZone")
    plain = result(joined(spark, rows, features, WHOLE))
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        assert result(joined(spark, rows, features, policy, "timestamp")) == plain
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("max_keys", [3, 1], ids=["apart", "all"])
def test_no_group_outgrows_a_task(spark, monkeypatch, max_keys):
    """Ten times the rows are ten times the ranges, none of them larger."""
    seen, original = [], asof._sliced

    def spy(line, ks, n):
        seen.append((n, original(line, ks, n)))
        return seen[-1][1]

    monkeypatch.setattr(asof, "_sliced", spy)
    policy = SkewPolicy(heavy_rows=1500, max_keys=max_keys)
    for n in (6000, 60_000):
        rows, features = made(5, n)
        found = joined(spark, rows, features, policy)
        assert found.count() == len(rows)
        line = seen[-1][1]
        assert line.groupBy("__slice", "__k0").count().agg(F.max("count")).first()[0] <= policy.heavy_rows
    assert seen[1][0] > 8 * seen[0][0]


def test_the_plan_compares_no_ranges(spark):
    rows, features = made(5, 6000)
    found = joined(spark, rows, features, SkewPolicy(heavy_rows=1500))
    text = found._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in text.splitlines() if "Join" in line]
    assert joins and not any("<" in line.replace("<=>", "") or ">" in line.replace("<=>", "") for line in joins)


def test_columns_and_several_keys(spark):
    left = spark.createDataFrame([(1, "x", START, "keep")], "a int, b string, t timestamp_ntz, `odd name` string")
    right = spark.createDataFrame(
        [(1, "x", START, 1), (1, "y", START, 2)], "a int, b string, ft timestamp_ntz, v int"
    )
    for policy in (WHOLE, SkewPolicy(heavy_rows=1)):
        found = asof_join(left, right, ["a", "b"], "t", "ft", ["v"], policy=policy)
        assert found.columns == ["a", "b", "t", "odd name", HIT]
        assert found.first()[HIT].v == 1


def test_ttl_edge(spark):
    ttl = timedelta(hours=1)
    rows = [(1, 1, START), (2, 1, START + ttl), (3, 1, START + ttl + timedelta(microseconds=1)), (4, 2, START)]
    df = joined(spark, rows, [(1, START, 0, 1.0)], WHOLE)
    valid = df.filter(within_ttl(F.col("t"), F.col(f"{HIT}.time"), ttl))
    assert sorted(r.id for r in valid.collect()) == [1, 2]
    always = df.filter(within_ttl(F.col("t"), F.col(f"{HIT}.time"), None))
    assert sorted(r.id for r in always.collect()) == [1, 2, 3]


def test_nothing_on_either_side(spark):
    rows, features = made(6, n=60)
    assert result(joined(spark, [], features, SLICED)) == []
    assert result(joined(spark, rows, [], SLICED)) == brute(rows, [])


@pytest.mark.parametrize("policy", [WHOLE, SLICED, ONE_HEAVY, SkewPolicy()], ids=["whole", "sliced", "one", "usual"])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_max_age(spark, policy, kind):
    rows, features = made(7, n=500)
    rows, age = rows[:60], timedelta(hours=2)
    by_row = {r[0]: r[2] for r in rows}
    expected = [
        (n, *((t, c, v) if t is not None and t >= by_row[n] - age else (None, None, None)))
        for n, t, c, v in brute(rows, features)
    ]
    assert result(joined(spark, rows, features, policy, kind, age)) == sorted(expected, key=str)


def test_features_out_of_reach_are_not_shuffled(spark, tmp_path):
    day = timedelta(days=1)
    facts = [(k, START + d * day, float(d)) for k in range(20) for d in range(20)]
    path = str(tmp_path / "facts")
    spark.createDataFrame(facts, "k int, ft timestamp_ntz, v double").write.parquet(path)
    rows = spark.createDataFrame([(3, START + 10 * day), (4, START + 11 * day)], "k int, t timestamp_ntz")
    df = asof_join(rows, spark.read.parquet(path), ["k"], "t", "ft", ["v"], max_age=2 * day)
    assert sorted(r[HIT].v for r in df.collect()) == [10.0, 11.0]
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(ft,2024-04-10" in text and "GreaterThanOrEqual(ft,2024-04-07" in text
    assert "LeftSemi, BuildRight" in text


def test_tasks_follow_rows_and_not_ranges(spark, monkeypatch):
    """Ranges of a few rows, thousands of them, are dealt out by few tasks."""
    seen, original = [], asof._sliced

    def spy(line, ks, n):
        seen.append((n, line.rdd.getNumPartitions(), original(line, ks, n)))
        return seen[-1][2]

    monkeypatch.setattr(asof, "_sliced", spy)
    rows, features = made(8, 12_000)
    found = joined(spark, rows, features, SkewPolicy(heavy_rows=20))
    # The policy without ranges is compared with brute force above.
    assert result(found) == result(joined(spark, rows, features, WHOLE))
    ranges, tasks, line = seen[0]
    assert ranges > 1000 and tasks == 1
    assert line.groupBy("__slice").count().where("count > 40").count() == 0
    assert line.select("__slice").distinct().count() > 400
