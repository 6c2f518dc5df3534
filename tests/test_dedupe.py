import collections
import random

from pyspark.sql import Window, functions as F

from ledgersift.operators import dedupe


def bag(df):
    return collections.Counter(tuple(r) for r in df.collect())


def some_rows(spark, n=2000, seed=3):
    """A third of the rows are copies of one row, another third share a key."""
    rng = random.Random(seed)
    rows = [(7, 1, 2.0)] * (n // 3) + [(8, rng.randrange(50), None) for _ in range(n // 3)]
    rows += [(rng.randrange(20), rng.choice([None, *range(5)]), rng.choice([None, 0.5, 1.5])) for _ in range(n // 3)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k int, t int, v double").repartition(6)


def test_by_key_is_the_first_row_of_the_window(spark):
    df = some_rows(spark)
    first = F.row_number().over(Window.partitionBy("k").orderBy("t", "v"))
    expected = df.withColumn("n", first).filter("n = 1").drop("n")
    assert bag(dedupe.dedupe_by_key(df, ["k"], ["t"])) == bag(expected)


def test_full_before_key_changes_nothing(spark):
    df = some_rows(spark)
    once = dedupe.dedupe_by_key(dedupe.dedupe_full(df), ["k"], ["t"])
    assert bag(dedupe.dedupe_by_key(df, ["k"], ["t"])) == bag(once)


def test_difference_equals_except_all(spark):
    left, right = some_rows(spark, seed=1), some_rows(spark, n=900, seed=2)
    assert bag(dedupe.multiset_except(left, right)) == bag(left.exceptAll(right))
    assert dedupe.multiset_except(right, right).count() == 0


def test_surplus_rows(spark):
    df = some_rows(spark)
    expected = bag(df.exceptAll(df.dropDuplicates()))
    assert bag(dedupe.surplus_rows(df)) == expected
    assert dedupe.surplus_count(df).first()[0] == sum(expected.values())


def test_a_large_group_of_copies_is_written_in_pieces(spark):
    counted = spark.createDataFrame([("a", 2501), ("b", 1), ("c", 0), ("d", 1000)], f"v string, {dedupe.COPIES} long")
    out = dedupe._repeat(counted, ["v"], piece_rows=100)
    assert bag(out) == {("a",): 2501, ("b",): 1, ("d",): 1000}


def test_duplicate_counts(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1), (None, 1), (None, 1)], "k int, v int")
    found = dedupe.duplicate_counts(df, "k").first()
    assert tuple(found) == (6, 4, 2, 2)
    assert tuple(dedupe.duplicate_counts(df.limit(0), "k").first()) == (0, 0, 0, 0)
    assert bag(dedupe.repeated_keys(df, ["k"])) == {(1, 3): 1, (None, 2): 1}
