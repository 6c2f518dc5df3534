"""Shared helpers: scratch tables, column handling, arrays over batches of texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersift.session import scratch_dir

SPACES = " \t\n\x0b\x0c\r"
U64 = np.uint64
LONG_WORD = 64  # bytes; shorter ones have too few letters for a pair that collides by design
# Odd multipliers of polynomial hashes and of the finishing steps.
BASE = 0x9E3779B97F4A7C15
STEP = 0xD6E8FEB86659FD93


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared scratch folder and read again: later
    steps neither repeat the work nor depend on an executor that is lost."""
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few(small: DataFrame, limit: int = 16 << 20) -> DataFrame:
    """A kept table with long and binary columns, to be broadcast in a join if
    its rows measure at most ``limit`` bytes; else as it is, to be shuffled."""
    sizes = [F.coalesce(F.length(c), F.lit(0)) if kind == "binary" else F.lit(16) for c, kind in small.dtypes]
    measured = small.agg(F.sum(sum(sizes, F.lit(16)))).first()[0] or 0
    return F.broadcast(small) if measured <= limit else small


def without(df: DataFrame, *names: str) -> DataFrame:
    """The rows without columns of these names, in whatever case."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def plus(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    """The schema with fields added; a field of the same name is replaced."""
    names = {f.name.lower() for f in fields}
    return T.StructType([f for f in schema.fields if f.name.lower() not in names] + list(fields))


def map_batches(df: DataFrame, work: Callable[[pa.Table], Iterator[pa.Table]], schema: T.StructType, text: str | None = None, limit: int = 1 << 21) -> DataFrame:
    """``work`` over Arrow tables of a partition's rows, each holding some two
    million bytes of the column ``text`` (a longer text is a table by itself)."""

    def run(batches):
        for batch in batches:
            whole = pa.Table.from_batches([batch])
            for part in split_rows(whole, text, limit) if text else [whole]:
                for out in work(part):
                    yield from out.to_batches()

    return df.mapInArrow(run, schema)


def split_rows(rows: pa.Table, text: str, limit: int) -> Iterator[pa.Table]:
    import pyarrow.compute as pc

    if rows.num_rows == 0:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(rows[text]), 0)).astype(np.int64) + 64
    group = np.cumsum(sizes) // limit
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), rows.num_rows]
    for a, b in zip(edges, edges[1:], strict=False):
        yield rows.slice(a, b - a)


def pour(rows: pa.Table, fields: dict[str, pa.Array], types: dict[str, pa.DataType] | None = None) -> pa.Table:
    """The table with columns set; a column of the same name, in any case, goes."""
    taken = {n.lower() for n in fields}
    keep = [c for c in rows.column_names if c.lower() not in taken]
    out = rows.select(keep)
    for name, values in fields.items():
        out = out.append_column(name, values if isinstance(values, (pa.Array, pa.ChunkedArray)) else pa.array(values, (types or {}).get(name)))
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits after which every output bit depends on all of ``x``."""
    x = (x ^ (x >> U64(32))) * U64(STEP)
    x = (x ^ (x >> U64(29))) * U64(BASE)
    return x ^ (x >> U64(32))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**0 … base**(n-1) modulo 2**64, and their inverses."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        inverse = pow(base, -1, 1 << 64)
        up, down = np.full(size, base, U64), np.full(size, inverse, U64)
        up[0] = down[0] = 1
        _POWERS[base] = (np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64))
    up, down = _POWERS[base]
    return up[:n], down[:n]


def prefix_hash(values: np.ndarray, base: int) -> np.ndarray:
    """Running sums from which ``span_hash`` gets the hash of any span."""
    up, _ = powers(base, len(values) + 1)
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[: len(values)], dtype=U64, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[start:end], the same wherever those values stand."""
    _, down = powers(base, len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(U64))


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(BASE))
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a batch of texts.

    hashes: 64 bits a word; first: per text the number of its first word, and
    the number of all words at the end.
    """

    def __init__(self, texts: list, lower: bool = False):
        data = [(t.encode() if isinstance(t, str) else t or b"") for t in texts]
        raw = np.frombuffer(b" ".join(data) + b" ", np.uint8)
        space = _IS_SPACE[raw]
        edge = np.diff(np.concatenate(([True], space)).astype(np.int8))
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        at = np.cumsum([0, *(len(d) + 1 for d in data)])
        self.first = np.searchsorted(start, at)
        sums = prefix_hash((_LOWER if lower else _BYTE)[raw], BASE)
        self.hashes = span_hash(sums, start, end, BASE)
        # Sums of products modulo 2**64 can be made to collide by long words,
        # whatever the base; a digest cannot.
        for k in np.flatnonzero(end - start > LONG_WORD).tolist():
            word = raw[start[k] : end[k]].tobytes()
            self.hashes[k] = int.from_bytes(blake2b(word.lower() if lower else word, digest_size=8).digest(), "little")

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def window_hashes(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` values that lie within one text, and
    the number of each window's first value."""
    n = np.diff(first)
    spare = np.maximum(n - width + 1, 0)
    start = np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(spare)[:-1])), spare) + np.arange(spare.sum())
    sums = prefix_hash(mix(hashes), STEP)
    return span_hash(sums, start, start + width, STEP), start


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of spans, sorted, touching ones joined."""
    if len(start) == 0:
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate(([True], start[1:] > reach[:-1]))
    return start[new], reach[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(start) - 1]))]


def crc_fold(column: str):
    """crc32 of the id written in digits, modulo 5."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5
