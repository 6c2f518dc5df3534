"""Repeated lines, found in a sharded minimal perfect hash index.

Lines are hashed once. Distinct hashes are counted by documents, dealt to
shards by hash, and each shard becomes a minimal perfect hash over its keys
with three arrays in slot order: fingerprint, number of documents, largest id.
Documents then send their hashes to the shards and read the arrays; lines
themselves never move, and no hash is joined with another.

A shard's arrays are a few bytes a key and the number of shards follows the
number of keys. A shard asked for a very frequent line gets copies of its
arrays, as many as its questions need.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersift.llm.common import SPACES, U64, kept, map_batches, mix, plus, without

UPPER = {c: c + 32 for c in range(65, 91)}


def line_key(line: str, min_chars: int) -> bytes | None:
    """16 bytes for a line that counts, None for one that is too short."""
    key = line.strip(SPACES)
    if len(key) < min_chars:
        return None
    return blake2b(key.encode().lower(), digest_size=16).digest()


class PerfectHash:
    """Maps n distinct 16-byte keys to 0 … n-1.

    Level by level, keys that fall alone into a cell of a bit array stay
    there; the others go on to the next level. A key's slot is the number of
    bits set before its own.
    """

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.base = np.concatenate(([0], np.cumsum(sizes)))
        self.rank = np.concatenate(([0], np.cumsum(bits, dtype=np.int64)))

    @staticmethod
    def cell(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys[:, 0] ^ mix(keys[:, 1] + U64(level * 2 + 1))) % U64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, bits, left, level = [], [], keys, 0
        while len(left):
            size = 2 * len(left) + 1
            at = cls.cell(left, level, size)
            held = np.bincount(at, minlength=size)
            sizes.append(size)
            bits.append(held == 1)
            left, level = left[held[at] > 1], level + 1
        return cls(np.array(sizes, np.int64), np.concatenate(bits) if bits else np.zeros(0, bool))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 or any slot for keys it was not built from."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = self.base[level] + self.cell(keys[left], level, size)
            hit = self.bits[at]
            out[left[hit]] = self.rank[at[hit]]
            left = left[~hit]
        return out


def as_keys(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), U64).reshape(-1, 2)


INDEX = T.StructType(
    [T.StructField("shard", T.LongType())]
    + [T.StructField(n, T.BinaryType()) for n in ("sizes", "bits", "prints", "counts", "last")]
    + [T.StructField("asked", T.LongType())]
)


def _build(rows: pa.Table) -> pa.Table:
    keys = as_keys(rows["key"])
    index = PerfectHash.build(keys)
    order = np.argsort(index.slots(keys))
    n_docs = np.asarray(rows["n_docs"])[order]
    last = rows["last"].fill_null(np.iinfo(np.int64).min).to_numpy()[order]
    return pa.table(
        {
            "shard": pa.array([rows["shard"][0].as_py()], pa.int64()),
            "sizes": [index.sizes.tobytes()],
            "bits": [np.packbits(index.bits).tobytes()],
            "prints": [(keys[order, 1] >> U64(32)).astype(np.uint32).tobytes()],
            "counts": [np.minimum(n_docs, 2**32 - 1).astype(np.uint32).tobytes()],
            "last": [last.tobytes()],
            "asked": pa.array([int(n_docs.sum())], pa.int64()),
        }
    )


def line_index(lines: DataFrame, keys_per_shard: int = 1 << 16) -> DataFrame:
    """Index over (key, id) rows, one row for each document and key."""
    counted = kept(lines.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("last")), "line-counts")
    shards = max(1, -(-counted.count() // keys_per_shard))
    dealt = counted.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    return kept(dealt.groupBy("shard").applyInArrow(_build, INDEX), "line-index").withColumn("shards", F.lit(shards))


def probe(lines: DataFrame, index: DataFrame, shards: int, min_docs: int, asked_per_task: int) -> DataFrame:
    """(id, key) of the lines to drop: keys in ``min_docs`` documents or more,
    in documents other than the one with the largest id."""
    parts = index.withColumn("parts", F.ceil(F.col("asked") / asked_per_task))
    busy = parts.where("parts > 1").select("shard", "parts")
    asked = (
        lines.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
        .join(busy, "shard", "left")
        .withColumn("part", F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("id"), F.col("parts"))))
        .drop("parts")
    )
    copies = parts.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts", "asked", "shards")

    def answer(questions: pa.Table, arrays: pa.Table) -> pa.Table:
        if not questions.num_rows or not arrays.num_rows:
            return pa.table({"id": pa.array([], pa.int64()), "key": pa.array([], pa.binary())})
        a = {n: arrays[n][0].as_py() for n in ("sizes", "bits", "prints", "counts", "last")}
        sizes = np.frombuffer(a["sizes"], np.int64)
        index = PerfectHash(sizes, np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=int(sizes.sum())).astype(bool))
        prints, counts, last = (np.frombuffer(a[n], t) for n, t in (("prints", np.uint32), ("counts", np.uint32), ("last", np.int64)))
        keys = as_keys(questions["key"])
        at = index.slots(keys)
        known = (at >= 0) & (prints[at] == (keys[:, 1] >> U64(32)))
        ids = questions["id"].fill_null(np.iinfo(np.int64).min).to_numpy()
        hit = known & (counts[at] >= min_docs) & (last[at] != ids)
        return questions.select(["id", "key"]).filter(pa.array(hit))

    return asked.groupBy("shard", "part").cogroup(copies.groupBy("shard", "part")).applyInArrow(answer, "id long, key binary")


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
    keys_per_shard: int = 1 << 16,
    asked_per_task: int = 1 << 20,
) -> DataFrame:
    """The documents without the lines that many of them share.

    A text is split at ``\\n``. A line's key is the line without white space at
    its ends, A-Z in lower case. Keys of at least ``min_chars`` code points in
    at least ``min_docs`` documents lose all their lines, save in the document
    with the largest id. Adds n_lines and n_dropped; columns of those names
    are replaced, all others kept.

    A null text stays null and counts as one empty line, as does an empty
    one. Repeated rows are documents of their own; those that share the largest
    id all keep the line. A null id is smaller than any other. No rows in, no
    rows out.
    """
    ids = F.col(id_col).cast("long")

    def read(rows: pa.Table):
        out_id, out_key = [], []
        for i, text in zip(rows["id"].to_pylist(), rows["text"].to_pylist(), strict=True):
            found = {line_key(line, min_chars) for line in (text or "").split("\n")} - {None}
            out_key += found
            out_id += [i] * len(found)
        yield pa.table({"id": pa.array(out_id, pa.int64()), "key": pa.array(out_key, pa.binary())})

    texts = docs.select(ids.alias("id"), F.col(text_col).cast("string").alias("text"))
    lines = kept(map_batches(texts, read, T.StructType([T.StructField("id", T.LongType()), T.StructField("key", T.BinaryType())]), "text"), "lines")
    index = line_index(lines, keys_per_shard)
    first = index.select("shards").first()
    shards = first[0] if first else 1
    drops = probe(lines, index.drop("shards"), shards, min_docs, asked_per_task)
    drops = drops.distinct().groupBy(F.col("id").alias("_drop_id")).agg(F.collect_list("key").alias("_drop"))

    def cut(rows: pa.Table):
        texts, n_lines, n_dropped = [], [], []
        for text, drop in zip(rows[text_col].to_pylist(), rows["_drop"].to_pylist(), strict=True):
            lines = (text or "").split("\n")
            stay = lines
            if drop:
                gone = set(drop)
                stay = [line for line in lines if line_key(line, min_chars) not in gone]
                text = "\n".join(stay)
            texts.append(text)
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
        done = rows.drop_columns(["_drop"])
        done = done.set_column(done.column_names.index(text_col), text_col, pa.array(texts, pa.string()))
        yield done.append_column("n_lines", pa.array(n_lines, pa.int64())).append_column("n_dropped", pa.array(n_dropped, pa.int64()))

    base = without(docs, "n_lines", "n_dropped", "_drop", "_drop_id").withColumn(text_col, F.col(text_col).cast("string"))
    schema = plus(base.schema, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()))
    joined = base.join(drops, ids.eqNullSafe(F.col("_drop_id")), "left").drop("_drop_id")
    return map_batches(joined, cut, schema, text_col)
