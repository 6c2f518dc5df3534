"""Counting 64-bit keys over a whole corpus, asked and answered in blocks.

The rows of a packed table are batches of documents; a batch has a column of
keys, eight bytes each. Every batch sends each of its distinct keys once, to the
bucket that owns that range of keys, together with how often it has it. A
bucket adds up, and answers each batch in the order in which it asked. The
answer is one byte a key, or nine with the least owner.

A key that stands in a third of all documents is still one entry a batch, so
no bucket grows with it; the number of buckets follows the number of keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersift.llm.common import U64, split_rows

ASKED = "bucket long, batch long, keys binary, counts binary, least binary"
ANSWERED = "batch long, bucket long, counts binary, least binary"
MOST = 255  # counts above are not told apart


def pack(df: DataFrame, work: Callable[[pa.Table], dict[str, list]], fields: str, text: str = "text", limit: int = 1 << 20) -> DataFrame:
    """``work`` over batches of rows, each giving one packed row. Adds a number
    for the batch. Keep the result before use: the numbers hold for one run."""

    def run(batches: Iterator[pa.RecordBatch]):
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for rows in split_rows(pa.Table.from_batches([batch]), text, limit):
                yield pa.record_batch({"batch": pa.array([number], pa.int64())} | {k: pa.array([v], pa.int64() if isinstance(v, int) else pa.binary()) for k, v in work(rows).items()})
                number += 1

    return df.mapInArrow(run, f"batch long, {fields}")


def tally(packed: DataFrame, least: bool = False, keys_per_bucket: int = 1 << 19) -> DataFrame:
    """Answers to all batches: how often each distinct key occurs (at most
    ``MOST``) and, if wanted, the least owner. ``packed`` has batch, n (number
    of keys), keys and, for ``least``, owners."""
    total = packed.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-total // keys_per_bucket))

    def ask(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for k in range(batch.num_rows):
                keys = np.frombuffer(batch["keys"][k].as_py(), U64)
                if not len(keys):
                    continue
                distinct, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
                counts = np.minimum(counts, MOST).astype(np.uint8)
                lowest = None
                if least:
                    lowest = np.full(len(distinct), np.iinfo(np.int64).max)
                    np.minimum.at(lowest, inverse, np.frombuffer(batch["owners"][k].as_py(), np.int64))
                bucket = ((distinct >> U64(32)) * U64(buckets)) >> U64(32)
                edges = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(distinct)]
                yield pa.record_batch(
                    {
                        "bucket": bucket[edges[:-1]].astype(np.int64),
                        "batch": pa.array([batch["batch"][k].as_py()] * (len(edges) - 1), pa.int64()),
                        "keys": pa.array([distinct[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)], pa.binary()),
                        "counts": pa.array([counts[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)], pa.binary()),
                        "least": pa.array([lowest[a:b].tobytes() if least else b"" for a, b in zip(edges, edges[1:], strict=False)], pa.binary()),
                    }
                )

    def answer(rows: pa.Table) -> pa.Table:
        parts = rows["keys"].to_pylist()
        keys = np.frombuffer(b"".join(parts), U64)
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        group = np.empty(len(keys), np.int64)
        group[order] = np.repeat(np.arange(len(first)), np.diff(first, append=len(keys)))
        counts = np.frombuffer(b"".join(rows["counts"].to_pylist()), np.uint8)
        total = np.minimum(np.add.reduceat(counts[order].astype(np.int64), first), MOST).astype(np.uint8)[group]
        edges = np.cumsum([0, *(len(p) // 8 for p in parts)])
        lowest = np.minimum.reduceat(np.frombuffer(b"".join(rows["least"].to_pylist()), np.int64)[order], first)[group] if least else None
        spans = list(zip(edges, edges[1:], strict=False))
        return pa.table(
            {
                "batch": rows["batch"],
                "bucket": rows["bucket"],
                "counts": pa.array([total[a:b].tobytes() for a, b in spans], pa.binary()),
                "least": pa.array([lowest[a:b].tobytes() if least else b"" for a, b in spans], pa.binary()),
            }
        )

    wanted = packed.select("batch", "keys", *(["owners"] if least else []))
    return wanted.mapInArrow(ask, ASKED).groupBy("bucket").applyInArrow(answer, ANSWERED)


def told(packed: DataFrame, answers: DataFrame, work: Callable[[dict, np.ndarray, np.ndarray], pa.Table], schema: str) -> DataFrame:
    """``work(batch, counts, least)`` for each batch; both arrays are in the
    order of the batch's keys, and empty for a batch that has none."""

    def one(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _none(schema)
        row = {name: left[name][0].as_py() for name in left.column_names}
        right = right.sort_by("bucket")
        _, inverse = np.unique(np.frombuffer(row["keys"], U64), return_inverse=True)
        counts = np.frombuffer(b"".join(right["counts"].to_pylist()), np.uint8)[inverse]
        lowest = np.frombuffer(b"".join(right["least"].to_pylist()), np.int64)
        return work(row, counts, lowest[inverse] if len(lowest) else lowest)

    return packed.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(one, schema)


def _none(schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({name: pa.array([], kinds[kind]) for name, kind in fields})
