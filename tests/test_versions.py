"""Versioned tables and the snapshots that grow in them."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from ledgersift.plans.feature_model import Entity, FeatureView, Source
from ledgersift.plans.features import materialize, read_snapshot, write_snapshot
from ledgersift.sources.transactions import write_clean
from ledgersift.sources.versions import VersionConflict, current, publish, read_current, versions

DAY = timedelta(days=1)
START = datetime(2024, 1, 1)


def numbers(spark, root):
    return sorted(r.id for r in read_current(spark, root).collect())


def test_readers_see_old_or_new(spark, tmp_path):
    root = str(tmp_path / "table")
    assert current(spark, root) is None
    with pytest.raises(FileNotFoundError):
        read_current(spark, root)
    publish(spark.range(3), root)
    planned = read_current(spark, root)  # before the next two versions
    publish(spark.range(5).withColumn("part", F.col("id") % 2), root, ["part"])
    publish(spark.range(7), root)
    assert planned.count() == 3 and numbers(spark, root) == list(range(7))
    publish(spark.range(1), root)
    assert [v.number for v in versions(spark, root)] == [4, 3, 2]
    assert len([p for p in (tmp_path / "table").iterdir() if p.name.startswith("v-")]) == 3


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path / "table")
    publish(spark.range(3), root)
    bad = spark.range(4, numPartitions=4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        publish(bad, root)
    assert numbers(spark, root) == [0, 1, 2] and current(spark, root).number == 1
    assert len([p for p in (tmp_path / "table").iterdir() if p.name.startswith("v-")]) == 1


def test_of_two_writers_one_fails(spark, tmp_path):
    root = str(tmp_path / "table")
    first = publish(spark.range(3), root)
    publish(spark.range(4), root, after=first)
    with pytest.raises(VersionConflict):
        publish(spark.range(5), root, after=first)
    with pytest.raises(VersionConflict):  # the other one publishes while this one writes
        publish(spark.range(6), root, write=lambda df, path: (df.write.parquet(path), publish(spark.range(9), root)))
    assert numbers(spark, root) == list(range(9))


def test_an_unfinished_marker_is_not_read(spark, tmp_path):
    root = str(tmp_path / "table")
    publish(spark.range(3), root)
    (tmp_path / "table" / "_versions" / "000000000002").touch()
    assert numbers(spark, root) == [0, 1, 2]
    publish(spark.range(4), root)  # its number is left to the writer that claimed it
    assert numbers(spark, root) == [0, 1, 2, 3] and current(spark, root).number == 3


def test_write_clean_versioned(spark, tmp_path):
    root = str(tmp_path / "clean")
    for n in (2, 4):
        write_clean(spark.range(n).withColumn("day", F.lit(1)), root, ["day"], versioned=True)
    assert numbers(spark, root) == [0, 1, 2, 3]


def view(spark, rows, extra=()):
    table = spark.createDataFrame(rows, "k int, t timestamp_ntz, made timestamp_ntz, v double")
    schema = T.StructType([T.StructField("v", T.DoubleType()), *extra])
    return FeatureView("view", Entity("k", ("k",)), schema, Source("s", "t", table=table, created="made"))


def rows_of(df):
    return sorted((r.k if r.k is not None else -1, r.v, r["__found_at"]) for r in df.collect())


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1), (1, 1, 0, 2, 0)])
def test_ranges_in_any_order_give_what_one_range_gives(spark, tmp_path, order):
    rows = [(k, START + d * DAY + timedelta(hours=k % 3), START + (d + m) * DAY, float(100 * k + 10 * d + m)) for k in range(8) for d in range(0, 9, 1 + k) for m in range(1 + k % 2)]
    rows += [(None, START + DAY, START, 7.0), (3, None, START, 8.0)]
    own, root = view(spark, rows), str(tmp_path / "snapshot")
    for part in order:
        write_snapshot(own, START + 3 * part * DAY, START + (3 * part + 3) * DAY, root, spark)
    whole = rows_of(materialize(own, START, START + 9 * DAY, spark))
    assert rows_of(read_snapshot(own, root, spark)) == whole
    assert current(spark, root).number == len(order)


def test_late_older_rows_do_not_win(spark, tmp_path):
    root = str(tmp_path / "snapshot")
    write_snapshot(view(spark, [(1, START + DAY, START, 1.0)]), START, START + 2 * DAY, root, spark)
    late = view(spark, [(1, START, START + 9 * DAY, 2.0), (2, START, START, 3.0)])
    write_snapshot(late, START, START + 2 * DAY, root, spark)
    corrected = view(spark, [(1, START + DAY, START + DAY, 4.0)])
    assert [r[1] for r in rows_of(read_snapshot(late, root, spark))] == [1.0, 3.0]
    write_snapshot(corrected, START, START + 2 * DAY, root, spark)
    assert [r[1] for r in rows_of(read_snapshot(late, root, spark))] == [4.0, 3.0]


def test_another_shape_is_refused(spark, tmp_path):
    root = str(tmp_path / "snapshot")
    write_snapshot(view(spark, [(1, START, START, 1.0)]), START, START + DAY, root, spark)
    other = Source("s", "t", table=spark.createDataFrame([(1, START, "x")], "k int, t timestamp_ntz, v string"))
    wrong = FeatureView("view", Entity("k", ("k",)), T.StructType([T.StructField("v", T.StringType())]), other)
    with pytest.raises(ValueError, match="holds"):
        write_snapshot(wrong, START, START + DAY, root, spark)
    assert current(spark, root).number == 1
