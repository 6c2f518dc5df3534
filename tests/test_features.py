import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from ledgersift.operators.heavy import SkewPolicy, heavy_keys
from ledgersift.operators.lookup import lookup_join, with_group_max
from ledgersift.plans.driver_features import driver_catalog
from ledgersift.plans.feature_model import Catalog, OnDemandView, Source
from ledgersift.plans.features import get_historical, get_online, latest_entities, materialize
from test_dedupe import bag

T0 = datetime(2024, 5, 1)
SCHEMA = "driver_id long, event_timestamp timestamp, created timestamp, conv_rate float, acc_rate float, avg_daily_trips int"
ALL = [
    "driver_stats:conv_rate",
    "driver_stats:acc_rate",
    "driver_stats:avg_daily_trips",
    "driver_activity:event_timestamp",
    "driver_activity:created",
    "activity_score:activity_score",
]


def fact(driver, day, conv=0.5, acc=0.25, trips=4, created=0):
    return (driver, T0 + timedelta(days=day), T0 + timedelta(days=created), conv, acc, trips)


def catalog(spark, facts, **ttl):
    table = spark.createDataFrame(facts, SCHEMA)
    return driver_catalog(Source("s", "event_timestamp", table=table, created="created"), **ttl)


def asked(spark, *rows):
    return spark.createDataFrame([(d, T0 + timedelta(days=t)) for d, t in rows], "driver_id long, event_timestamp timestamp")


def test_all_features_as_of_a_time(spark):
    views = catalog(spark, [fact(1, 0), fact(1, 40, conv=0.75, trips=8), fact(2, 0)])
    out = get_historical(asked(spark, (1, 10), (1, 50), (2, 35), (3, 1)), ALL, views)
    assert out.columns[:2] == ["driver_id", "event_timestamp"]
    found = {(r.driver_id, r.event_timestamp): r for r in out.collect()}
    mean = (4 + 8 + 4) / 3
    first = found[1, T0 + timedelta(days=10)]
    assert first.activity_score__activity_score == pytest.approx(0.25 + 0.25 * mean / 4)
    assert first.driver_activity__event_timestamp == T0
    later = found[1, T0 + timedelta(days=50)]
    assert later.activity_score__activity_score == pytest.approx(0.5625 + 0.25 * mean / 8)
    # 35 days: within the 365 days of one view, past the 30 days of the other.
    old = found[2, T0 + timedelta(days=35)]
    assert old.driver_stats__conv_rate == 0.5
    assert old.driver_activity__created is None
    none = found[3, T0 + timedelta(days=1)]
    assert none.driver_stats__conv_rate is None and none.activity_score__activity_score is None


def test_types_are_as_declared(spark):
    out = get_historical(asked(spark, (1, 1)), ALL, catalog(spark, [fact(1, 0)]))
    types = [f.dataType for f in out.schema][2:]
    assert types == [
        T.FloatType(), T.FloatType(), T.IntegerType(), T.TimestampType(), T.TimestampType(), T.DoubleType(),
    ]


def test_score_depends_on_the_rows_asked_for_together(spark):
    views = catalog(spark, [fact(1, 0, trips=2), fact(2, 0, trips=6)])
    alone = get_historical(asked(spark, (1, 1)), ALL[-1:], views).first()
    both = get_historical(asked(spark, (1, 1), (2, 1)), ALL[-1:], views).filter("driver_id = 1").first()
    assert alone.activity_score__activity_score == pytest.approx(0.5)
    assert both.activity_score__activity_score == pytest.approx(0.75)


def test_zero_trips_give_null(spark):
    views = catalog(spark, [fact(1, 0, trips=0)])
    assert get_historical(asked(spark, (1, 1)), ALL[-1:], views).first()[2] is None


def test_views_one_by_one_equal_views_together(spark):
    rng = random.Random(9)
    views = catalog(spark, [fact(rng.randrange(5), rng.randrange(60), rng.random()) for _ in range(80)])
    rows = asked(spark, *{(rng.randrange(6), rng.randrange(90)) for _ in range(120)})
    together = get_historical(rows, ALL[:5], views)
    apart = get_historical(get_historical(rows, ALL[:3], views), ALL[3:5], views)
    assert bag(together) == bag(apart.select(together.columns))


def test_every_request_picks_the_same_of_equal_rows(spark):
    views = catalog(spark, [fact(1, 0, conv=0.9, acc=0.1), fact(1, 0, conv=0.2, acc=0.8)])
    rows = asked(spark, (1, 1))
    both = get_historical(rows, ALL[:2], views).first()
    alone = get_historical(rows, ALL[1:2], views).first()
    assert alone.driver_stats__acc_rate == both.driver_stats__acc_rate == pytest.approx(0.1)
    assert materialize(views.view("driver_stats"), T0, T0, spark).first().acc_rate == pytest.approx(0.1)


def test_equal_times_take_the_one_created_last(spark):
    facts = [fact(1, 0, conv=0.9, created=1), fact(1, 0, conv=0.1, created=2)]
    for rows in (facts, facts[::-1]):
        views = catalog(spark, rows)
        out = get_historical(asked(spark, (1, 1)), ALL[:1], views).first()
        assert out.driver_stats__conv_rate == pytest.approx(0.1)
        newest = materialize(views.view("driver_stats"), T0, T0, spark).first()
        assert newest.conv_rate == pytest.approx(0.1)


def test_materialize_bounds_are_inclusive(spark):
    views = catalog(spark, [fact(1, 0), fact(1, 5, conv=0.6), fact(1, 6), fact(2, -1)])
    view = views.view("driver_stats")
    out = materialize(view, T0, T0 + timedelta(days=5), spark).collect()
    assert [(r.driver_id, r["__found_at"]) for r in out] == [(1, T0 + timedelta(days=5))]
    assert materialize(view, T0 + timedelta(days=7), T0 + timedelta(days=8), spark).count() == 0


def test_online_lookup(spark):
    views = catalog(spark, [fact(1, 0), fact(2, 20, trips=8)])
    snapshots = {n: materialize(v, T0, T0 + timedelta(days=30), spark) for n, v in views.views.items()}
    rows = spark.createDataFrame([{"driver_id": d} for d in (1, 2, 2, 3)], "driver_id long")
    found = get_online(rows, ALL, views, snapshots).orderBy("driver_id").collect()
    assert [r.driver_stats__avg_daily_trips for r in found] == [4, 8, 8, None]
    assert found[0].activity_score__activity_score == pytest.approx(0.25 + 0.25 * (20 / 3) / 4)
    # Day 35: the activity of driver 1 has outlived its 30 days.
    late = get_online(rows, ALL, views, snapshots, as_of=F.lit(T0 + timedelta(days=35))).orderBy("driver_id").collect()
    assert late[0].driver_activity__created is None
    assert late[0].driver_stats__avg_daily_trips == 4
    assert late[1].driver_activity__event_timestamp == T0 + timedelta(days=20)


def test_bad_references(spark):
    views = catalog(spark, [fact(1, 0)])
    rows = asked(spark, (1, 1))
    with pytest.raises(ValueError):
        get_historical(rows, ["conv_rate"], views)
    with pytest.raises(KeyError, match="no view"):
        get_historical(rows, ["other:conv_rate"], views)
    with pytest.raises(KeyError, match="no feature"):
        get_historical(rows, ["driver_stats:created"], views)


def test_on_demand_output_must_match_its_declaration(spark):
    views = catalog(spark, [fact(1, 0)])
    stats = views.view("driver_stats")
    declared = T.StructType([T.StructField("x", T.DoubleType())])
    rows = asked(spark, (1, 1))
    for made, error in (({"y": F.lit(1.0)}, ValueError), ({"x": F.lit("text")}, TypeError)):
        bad = Catalog([stats], [OnDemandView("d", (stats,), declared, lambda df, made=made: made)])
        with pytest.raises(error):
            get_historical(rows, ["d:x"], bad)
    with pytest.raises(ValueError, match="differ"):
        Catalog([stats, stats])


def test_a_function_from_table_to_table_gives_the_same(spark):
    rng = random.Random(2)
    facts = [fact(k, d, conv=rng.random(), acc=rng.random(), trips=rng.randrange(4)) for k in range(6) for d in range(4)]
    rows = asked(spark, *[(rng.randrange(8), rng.randrange(5)) for _ in range(40)])
    one, two = (driver_catalog(catalog(spark, facts).view("driver_stats").source, batch=b) for b in (False, True))
    plain, batch = (get_historical(rows, ["activity_score:activity_score", "driver_stats:conv_rate"], c) for c in (one, two))
    assert plain.columns == batch.columns and bag(plain) == bag(batch)
    # What was looked up is read again, not looked up again.
    text = batch._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in text and "Window" in plain._jdf.queryExecution().optimizedPlan().toString()


def test_a_table_function_keeps_its_rows_columns(spark):
    views = catalog(spark, [fact(1, 0)])
    stats = views.view("driver_stats")
    declared = T.StructType([T.StructField("x", T.DoubleType())])
    rows = asked(spark, (1, 1))
    for made in (lambda df: df.select(F.lit(1.0).alias("x")), lambda df: df.withColumns({"x": F.lit(1.0), "y": F.lit(2.0)}), lambda df: df):
        bad = Catalog([stats], [OnDemandView("d", (stats,), declared, made)])
        with pytest.raises(ValueError, match="must keep"):
            get_historical(rows, ["d:x"], bad)
    late = OnDemandView("d", (stats,), declared, lambda df: df.withColumn("x", F.lit("text")))
    with pytest.raises(TypeError):
        get_historical(rows, ["d:x"], Catalog([stats], [late]))


def test_a_source_may_be_a_path(spark, tmp_path):
    path = str(tmp_path / "stats.parquet")
    spark.createDataFrame([fact(1, 0)], SCHEMA).write.parquet(path)
    views = driver_catalog(Source("s", "event_timestamp", path=path))
    assert get_historical(asked(spark, (1, 1)), ALL, views).first().driver_stats__conv_rate == 0.5


def test_latest_entities(spark):
    table = spark.createDataFrame([fact(2, 1), fact(1, 3), fact(1, 2), fact(3, 0), fact(4, 0)], SCHEMA)
    found = [tuple(r) for r in latest_entities(table, ["driver_id"], "event_timestamp", 3).collect()]
    assert found == [(1, T0 + timedelta(days=3)), (2, T0 + timedelta(days=1)), (3, T0)]


def test_heavy_keys_are_found_and_bounded(spark):
    df = spark.createDataFrame([(1,)] * 50 + [(None,)] * 40 + [(2,)] * 30 + [(3,)] * 3, "k int")
    assert [r.k for r in heavy_keys(df, ["k"], SkewPolicy(heavy_rows=10))] == [1, None, 2]
    assert [r.k for r in heavy_keys(df, ["k"], SkewPolicy(heavy_rows=10, max_keys=2))] == [1, None]
    assert heavy_keys(df, ["k"], SkewPolicy(heavy_rows=1, enabled=False)) == []


@pytest.mark.parametrize(
    "policy",
    [
        SkewPolicy(),
        SkewPolicy(enabled=False),
        SkewPolicy(broadcast_bytes=30),
        SkewPolicy(broadcast_bytes=30, heavy_rows=10),
        SkewPolicy(broadcast_bytes=30, heavy_rows=1),
    ],
)
def test_lookup_join_equals_left_join(spark, policy):
    rng = random.Random(4)
    rows = [(i, 7 if i % 3 == 0 else rng.choice([None, *range(12)])) for i in range(400)]
    left = spark.createDataFrame(rows, "i int, k int").repartition(4)
    table = spark.createDataFrame([(k, f"v{k}") for k in range(0, 12, 2)] + [(7, None)], "k int, v string")
    assert bag(lookup_join(left, table, ["k"], policy)) == bag(left.join(table, "k", "left"))
    top = dict(left.groupBy("k").agg(F.max("i")).collect())
    out = with_group_max(left, ["k"], "i", "top", policy)
    assert out.columns == ["i", "k", "top"]
    assert all(r.top == (top[r.k] if r.k is not None else None) for r in out.collect())
    assert out.count() == 400


def test_a_wide_table_is_not_broadcast_for_its_few_keys(spark):
    rows = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    wide = spark.createDataFrame([(1, "x" * 5000), (2, "y" * 5000), (3, "z")], "k int, v string")
    policy = SkewPolicy(broadcast_bytes=2000)
    for table, broadcast in ((wide, False), (wide.selectExpr("k", "left(v, 3) AS v"), True)):
        found = lookup_join(rows, table, ["k"], policy)
        assert ("ResolvedHint" in found._jdf.queryExecution().analyzed().toString()) == broadcast
        assert sorted((r.k or 0, (r.v or "")[:1]) for r in found.collect()) == [(0, ""), (1, "x"), (2, "y")]
