"""Heavy keys: found by counting, held in a table of bounded size.

A key that holds a large share of the rows would put that share into one
task of any join or window on the key. The operators that need one task
per key therefore ask here first. The answer is at most ``max_keys`` keys,
whatever the data: those with the most rows. By the pigeonhole principle a
key that is not among them holds less than ``1 / max_keys`` of all rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from ..functions.columns import quoted


@dataclass(frozen=True)
class SkewPolicy:
    """When a key counts as heavy, and what may be broadcast.

    ``heavy_rows``       a key with fewer rows is never heavy; rows of one key a task should have at most
    ``max_keys``         how many keys may be set apart as heavy
    ``broadcast_bytes``  measured size up to which keys, or the table rows they need, are broadcast
    ``enabled``          False skips the counting passes
    """

    heavy_rows: int = 2_000_000
    max_keys: int = 4096
    broadcast_bytes: int = 16 * 2**20
    enabled: bool = True


DEFAULT_POLICY = SkewPolicy()
COUNT = "__rows"


def heavy_keys(df: DataFrame, keys: Sequence[str], policy: SkewPolicy = DEFAULT_POLICY) -> list[Row]:
    """The heavy keys of ``df`` with their row counts, NULL keys included.

    One aggregation over the key columns alone, combined before the
    shuffle, then a top-k. At most ``policy.max_keys`` rows are collected.
    """
    if not policy.enabled:
        return []
    counts = df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias(COUNT))
    return (
        counts.filter(F.col(COUNT) >= policy.heavy_rows)
        .orderBy(F.col(COUNT).desc(), *[quoted(k) for k in keys])
        .limit(policy.max_keys)
        .collect()
    )


def row_bytes(df: DataFrame) -> Column:
    """Size of a row when broadcast: eight bytes a value, and its letters."""
    parts = []
    for field in df.schema:
        c = quoted(field.name)
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            parts.append(8 + F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            parts.append(8 + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)))
        else:
            parts.append(F.lit(8))
    return reduce(add, parts)


def measured_bytes(df: DataFrame) -> int:
    """What the rows would take in a broadcast, by one aggregation."""
    return df.agg(F.sum(row_bytes(df).cast("long"))).first()[0] or 0


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*[quoted(k) for k in keys]).dropna().distinct()


def key_table(df: DataFrame, keys: Sequence[str], heavy: Sequence[Row]) -> DataFrame:
    """The heavy keys as a table, of at most ``max_keys`` rows."""
    fields = [T.StructField(k, df.schema[k].dataType) for k in keys]
    return df.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in heavy], T.StructType(fields))


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(and_, [left[f"`{k}`"].eqNullSafe(right[f"`{k}`"]) for k in keys])


def only_heavy(df: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is in the bounded ``table``; no shuffle."""
    small = F.broadcast(table)
    return df.join(small, _same(df, small, keys), "left_semi")


def without_heavy(df: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in the bounded ``table``; no shuffle."""
    small = F.broadcast(table)
    return df.join(small, _same(df, small, keys), "left_anti")
