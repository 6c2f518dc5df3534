"""Left join against a table that is unique on the key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import quoted
from .heavy import (
    DEFAULT_POLICY,
    SkewPolicy,
    distinct_keys,
    heavy_keys,
    key_table,
    measured_bytes,
    only_heavy,
    without_heavy,
)


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    policy: SkewPolicy = DEFAULT_POLICY,
    same_keys: bool = False,
) -> DataFrame:
    """``rows`` left join ``table`` on ``keys``; ``table`` has one row per key.

    Where the distinct keys of ``rows`` measure little, only their rows of
    ``table`` are needed, at most one each. If those measure little too, they
    are broadcast: nothing is shuffled, and a large table is not sorted for a
    handful of rows. What counts is bytes, so that a wide table is not
    broadcast for its few keys. ``same_keys`` says that ``table`` holds no
    other keys anyway.

    Else the rows of heavy keys meet a broadcast part of ``table``, at most one
    row per heavy key. All others take the ordinary join, for which Spark picks
    the strategy by size, and which leaves a table bucketed by the keys where
    it is.
    """
    keys = list(keys)
    if policy.enabled:
        wanted = distinct_keys(rows, keys)
        if measured_bytes(wanted) <= policy.broadcast_bytes:
            part = table if same_keys else table.join(F.broadcast(wanted), keys, "left_semi")
            if measured_bytes(part) <= policy.broadcast_bytes:
                return rows.join(F.broadcast(part), keys, "left")
    heavy = heavy_keys(rows, keys, policy)
    if not heavy:
        return rows.join(table, keys, "left")
    few = key_table(rows, keys, heavy)
    usual = without_heavy(rows, few, keys).join(table, keys, "left")
    small = F.broadcast(only_heavy(table, few, keys))
    return usual.unionByName(only_heavy(rows, few, keys).join(small, keys, "left"))


def with_group_max(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    alias: str,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Every row with the maximum of ``column`` over its group.

    Aggregated first and joined back, rather than a window: the window
    would hold a whole group in one task.
    """
    top = df.groupBy(*[quoted(k) for k in keys]).agg(F.max(quoted(column)).alias(alias))
    joined = lookup_join(df, top, keys, policy, same_keys=True)
    return joined.select(*[quoted(c) for c in df.columns], quoted(alias))
