"""Duplicates: removing, counting and listing them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import quoted

COPIES = "__copies"
PIECE = "__piece"


def dedupe_full(df: DataFrame) -> DataFrame:
    """One of each distinct row. Copies are merged before the shuffle."""
    return df.dropDuplicates()


def dedupe_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key, by ``order`` and then by every other column.

    The tie-breakers make the survivor the same on every run. It is an
    aggregate, the least of the ordered rows, so a key with very many rows
    shrinks to one row per input partition before the shuffle.
    """
    order = list(order)
    rest = [c for c in df.columns if c not in order and c not in keys]
    least = F.min(F.struct(*[quoted(c) for c in order + rest])).alias("__least")
    first = df.groupBy(*[quoted(k) for k in keys]).agg(least)
    picked = {c: F.col("__least")[c].alias(c) for c in order + rest}
    return first.select(*[picked.get(c, quoted(c)) for c in df.columns])


def copies(df: DataFrame) -> DataFrame:
    """Each distinct row once, with the number of times it occurs."""
    return df.groupBy(*[quoted(c) for c in df.columns]).agg(F.count(F.lit(1)).alias(COPIES))


def surplus_rows(df: DataFrame) -> DataFrame:
    """Every copy beyond the first of each distinct row."""
    return _repeat(copies(df).withColumn(COPIES, F.col(COPIES) - 1), df.columns)


def multiset_except(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` less those of ``right``, counting copies.

    Both sides are counted down in one aggregation, whose rows are small
    whatever the number of copies; only the result is written out again.
    """
    signed = left.withColumn(COPIES, F.lit(1)).unionByName(right.withColumn(COPIES, F.lit(-1)))
    net = signed.groupBy(*[quoted(c) for c in left.columns]).agg(F.sum(COPIES).alias(COPIES))
    return _repeat(net, left.columns)


def _repeat(counted: DataFrame, columns: Sequence[str], piece_rows: int = 100_000) -> DataFrame:
    """Each row as often as its count says.

    A large count is cut into pieces that are spread over the tasks, so
    no task writes out a large group of copies alone.
    """
    pieces = (
        counted.filter(F.col(COPIES) > 0)
        .withColumn(PIECE, F.explode(F.sequence(F.lit(0), F.expr(f"({COPIES} - 1) div {piece_rows}"))))
        .repartition(PIECE, *[quoted(c) for c in columns])
    )
    length = F.least(F.lit(piece_rows), F.col(COPIES) - F.col(PIECE) * piece_rows)
    copy = F.explode(F.sequence(F.lit(1), length)).alias("__copy")
    return pieces.select(*[quoted(c) for c in columns], copy).drop("__copy")


def duplicate_counts(df: DataFrame, key: str) -> DataFrame:
    """One row: ``rows``, ``distinct_rows``, ``surplus_rows``, ``repeated_keys``.

    Whole rows are counted first and the keys from those counts, so the
    table is scanned once and the second shuffle carries two numbers per key.
    """
    per_key = (
        copies(df)
        .groupBy(quoted(key))
        .agg(F.sum(COPIES).alias("n"), F.count(F.lit(1)).alias("d"))
    )
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("d"), F.lit(0)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("n") - F.col("d")), F.lit(0)).alias("surplus_rows"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
    )


def surplus_count(df: DataFrame) -> DataFrame:
    """One row: how many copies stand beyond the first."""
    return copies(df).agg(F.coalesce(F.sum(F.col(COPIES) - 1), F.lit(0)).alias("surplus_rows"))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    counts = df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("count"))
    return counts.filter(F.col("count") > 1)
