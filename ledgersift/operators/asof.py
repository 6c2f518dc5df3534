"""Point-in-time join: for each row, the newest feature row not after it.

Rows and features go into one table, sorted by key and time, and the last
feature is carried forward: one shuffle, one sort, no pairs. A window needs
all rows of its group in one task, so the group must not be a whole heavy
key. The time lines of heavy keys are therefore dealt out in ranges, sorted by
key and place, as many as keep a range within a task, and each range starts
with seeds, the newest feature before it. Tasks follow the rows, not the
ranges: one deals out as many small ranges as it has rows for.

* A place on the time line is ``(time, spread)``. Features have spread -1,
  rows a number from 0 on that depends on the row and its input partition.
  Features therefore come before all rows of the same instant, and even a
  single instant with very many rows can be cut.
* Features of heavy keys are first reduced to one per instant.
* Spark cuts the ranges where the data's own distribution says. What it has
  dealt is written to the scratch folder, so that all parts of the plan, and
  tasks run again, see the same ranges.

Rows with a NULL key or time match nothing and are set apart.

Features no row can find are left out before the shuffle: those later than
all rows, too old for all rows, and, when the rows have few distinct keys,
those of other keys. The times become filters of the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row, Window, functions as F, types as T

from ..functions.columns import quoted, time_literal
from ..session import scratch_dir
from .heavy import (
    COUNT,
    DEFAULT_POLICY,
    SkewPolicy,
    distinct_keys,
    heavy_keys,
    key_table,
    only_heavy,
    row_bytes,
    without_heavy,
)

HIT = "__hit"
TASK_ROWS = 200_000  # tasks that deal out ranges need not have fewer rows
FEATURE = -1
USUAL = -1  # the range of what is not dealt out


def within_ttl(row_time: Column, feature_time: Column, ttl: timedelta | None) -> Column:
    """True where a feature found as of ``row_time`` is not older than ``ttl``."""
    if not ttl:
        return feature_time.isNotNull()
    return feature_time >= row_time - F.lit(ttl)


def asof_join(
    rows: DataFrame,
    features: DataFrame,
    keys: Sequence[str],
    row_time: str,
    feature_time: str,
    columns: Sequence[str],
    tie_breakers: Sequence[str] = (),
    policy: SkewPolicy = DEFAULT_POLICY,
    max_age: timedelta | None = None,
    layout: Layout | None = None,
) -> DataFrame:
    """All columns of ``rows`` and a struct ``__hit``: the time and ``columns``
    of the newest feature row with ``feature_time <= row_time``, or NULL.
    One older than ``max_age`` does not count. Unless the policy is off, ``rows``
    are read for their extent first and must be the same when read again. Time
    lines of heavy keys are written to the scratch folder;
    ``layout`` gives what was counted before, for joins with several sources.

    Of feature rows at one instant the greatest counts, compared by
    ``tie_breakers`` and then by the remaining columns.
    """
    keys = list(keys)
    time_type = rows.schema[row_time].dataType
    ks = [f"__k{i}" for i in range(len(keys))]
    named_keys = [quoted(k).alias(a) for k, a in zip(keys, ks)]

    when = quoted(feature_time).cast(time_type)
    rest = [c for c in dict.fromkeys([*tie_breakers, *columns]) if c != feature_time]
    hit = F.struct(when.alias("time"), *[quoted(c).alias(c) for c in rest])
    known = features.select(*named_keys, when.alias("__t"), hit.alias(HIT)).dropna(subset=[*ks, "__t"])
    asked = rows.select(
        *named_keys,
        quoted(row_time).alias("__t"),
        F.struct(*[quoted(c).alias(c) for c in rows.columns]).alias("__row"),
    )
    # Rows that can match nothing are neither shuffled nor sorted.
    unmatched = reduce(or_, [F.col(c).isNull() for c in [*ks, "__t"]])
    alone, asked = asked.filter(unmatched), asked.filter(~unmatched)
    layout = layout or lay_out(rows, keys, row_time, [(features, feature_time, max_age)], policy)
    known = layout.within_reach(known, max_age)
    line = _line(known, asked, ks)
    if layout.heavy:
        table = None if layout.many_heavy else key_table(known, ks, layout.heavy)
        apart = lambda df, pick: df if table is None else pick(df, table, ks)
        one_per_instant = apart(known, only_heavy).groupBy(*ks, "__t").agg(F.max(HIT).alias(HIT))
        line = _dealt(_line(one_per_instant, apart(asked, only_heavy), ks), ks, layout.tasks)
        line = _sliced(line, ks, layout.slices)
        if table is not None:
            line = line.unionByName(_line(without_heavy(known, table, ks), without_heavy(asked, table, ks), ks))
    # NULL sorts first, so a feature (no row) precedes the rows of its instant.
    so_far = (
        Window.partitionBy(*ks, "__slice")
        .orderBy("__t", F.col("__row").isNotNull(), HIT)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = line.withColumn(HIT, F.last(HIT, ignorenulls=True).over(so_far))
    found = carried.filter(F.col("__row").isNotNull())
    if max_age:
        found = found.withColumn(HIT, F.when(within_ttl(F.col("__t"), F.col(f"{HIT}.time"), max_age), F.col(HIT)))
    nothing = F.lit(None).cast(found.schema[HIT].dataType).alias(HIT)
    return found.select("__row.*", HIT).unionAll(alone.select("__row.*", nothing))


@dataclass(frozen=True)
class Layout:
    """What is known of rows and features before they are joined.

    first, last  extent of the rows' times; NULL without rows
    near         the rows' keys, to be broadcast; None if there are too many
    heavy        keys whose time lines are dealt out in ranges
    many_heavy   there may be more of them: all keys are
    slices       into how many ranges
    tasks        by how many tasks
    """

    first: Column | None = None
    last: Column | None = None
    near: DataFrame | None = None
    heavy: Sequence[Row] = ()
    many_heavy: bool = False
    slices: int = 1
    tasks: int = 1

    def within_reach(self, known: DataFrame, max_age: timedelta | None) -> DataFrame:
        """The features some row may find."""
        t = F.col("__t")
        if self.last is not None:
            known = known.filter(t <= self.last)
            if max_age:
                known = known.filter(t >= self.first - F.lit(max_age))
        if self.near is not None:
            known = known.join(F.broadcast(self.near), self.near.columns, "left_semi")
        return known


def lay_out(
    rows: DataFrame,
    keys: Sequence[str],
    row_time: str,
    sources: Sequence[tuple[DataFrame, str, timedelta | None]],
    policy: SkewPolicy = DEFAULT_POLICY,
) -> Layout:
    """Counted once for rows and all sources (features, their time, the oldest
    that counts) that are joined to them by these keys.

    One aggregation over keys and times of the rows gives their extent, and
    how large a broadcast of the keys would be. A second one, over rows and the
    features within reach, gives the heavy keys.
    """
    if not policy.enabled:
        return Layout()
    ks = [f"__k{i}" for i in range(len(keys))]
    named = [quoted(k).alias(a) for k, a in zip(keys, ks)]
    dtype = rows.schema[row_time].dataType
    asked = rows.select(*named, quoted(row_time).alias("__t")).dropna()
    wire, back = _wire(dtype)
    t = F.col("__t")
    per_key = asked.groupBy(*ks).agg(F.min(t).alias("first"), F.max(t).alias("last"))
    size = F.sum(row_bytes(per_key.select(*ks)).cast("long"))
    extent = per_key.agg(
        F.coalesce(size, F.lit(0)).alias("bytes"), wire(F.min("first")).alias("first"), wire(F.max("last")).alias("last")
    ).first()
    first, last = (back(_literal(extent[n], dtype)) for n in ("first", "last"))
    near = distinct_keys(asked, ks) if extent["bytes"] <= policy.broadcast_bytes else None
    layout = Layout(first, last, near)
    times = asked
    for features, feature_time, max_age in sources:
        known = features.select(*named, quoted(feature_time).cast(dtype).alias("__t")).dropna()
        times = times.unionByName(layout.within_reach(known, max_age))
    heavy = heavy_keys(times, ks, policy)
    if not heavy:
        return layout
    many = len(heavy) == policy.max_keys
    total = times.count() if many else sum(row[COUNT] for row in heavy)
    slices, tasks = (-(-2 * total // n) for n in (policy.heavy_rows, max(policy.heavy_rows, TASK_ROWS)))
    return replace(layout, heavy=heavy, many_heavy=many, slices=slices, tasks=tasks)


def _line(known: DataFrame, asked: DataFrame, ks: Sequence[str]) -> DataFrame:
    """Features and rows in one table. The partition number keeps copies of a
    row apart; it is the same when a task is run again, unlike a random number
    after a shuffle."""
    spread = F.pmod(F.xxhash64("__row") + F.spark_partition_id() * 97, F.lit(2**62))
    rows = asked.select(*ks, "__t", "__row", spread.alias("__spread"), F.lit(USUAL).alias("__slice"))
    facts = known.select(*ks, "__t", HIT, F.lit(FEATURE).cast("long").alias("__spread"), F.lit(USUAL).alias("__slice"))
    return facts.unionByName(rows, allowMissingColumns=True)


def _dealt(line: DataFrame, ks: Sequence[str], tasks: int) -> DataFrame:
    """The time lines dealt to tasks in ranges, each sorted."""
    place = [*ks, "__t", "__spread"]
    return line.repartitionByRange(tasks, *place).sortWithinPartitions(*place)


def _sliced(line: DataFrame, ks: Sequence[str], n: int) -> DataFrame:
    """The time lines, dealt and sorted, in about ``n`` ranges, each key of a
    range with the newest feature of the ranges before it.

    A range has less than twice the average number of rows. Seeds are at most
    one for each range and key in it; a key is in as many ranges as its rows
    fill, but for two.
    """
    spark, path = line.sparkSession, scratch_dir(line.sparkSession, "asof")
    # The number of the task, and below it that of the row within the task.
    placed = line.withColumn("__slice", F.monotonically_increasing_id())
    placed.write.option("compression", "zstd").parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    rows = max(1, 2 * -(-placed.count() // n) - 1)
    row = F.col("__slice").bitwiseAND(F.lit(2**33 - 1))
    placed = placed.withColumn("__slice", F.col("__slice") - row + F.floor(row / rows))
    before = Window.partitionBy(*ks).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    seeds = (
        placed.groupBy(*ks, "__slice")
        .agg(F.max(HIT).alias(HIT))
        .withColumn(HIT, F.last(HIT, ignorenulls=True).over(before))
        .filter(F.col(HIT).isNotNull())
        .withColumns({"__t": F.col(f"{HIT}.time"), "__spread": F.lit(FEATURE).cast("long")})
    )
    return placed.unionByName(seeds, allowMissingColumns=True)


def _wire(dtype: T.DataType):
    """How times travel to the driver and back without a zone in between."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros, F.timestamp_micros
    return (lambda c: c), (lambda c: c)


def _literal(value, dtype: T.DataType) -> Column:
    """A value that came over the wire, without the zone of this process."""
    return F.lit(value) if isinstance(dtype, T.TimestampType) else time_literal(value, dtype)
