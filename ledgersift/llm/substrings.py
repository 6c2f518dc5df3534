"""Repeated byte strings, found in suffix-sorted shards.

Every string of the given length has one anchor: the place in it where a hash
of the next bytes is least. Equal strings have equal anchors, so anchors are
counted over the corpus, and only the surroundings of anchors that occur twice
are looked at again. They are dealt to shards by anchor, where equal strings
meet, and each shard is suffix-sorted by induction. Strings of the given
length that are repeated share it as a prefix with a neighbour in that order.
An anchor whose surroundings exceed a shard is not sorted: its strings are
counted over the corpus by two hashes.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersift.llm.blocks import pack, tally, told
from ledgersift.llm.common import _BYTE, BASE, U64, few, kept, map_batches, merged, mix, plus, prefix_hash, span_hash, without
from ledgersift.llm.induce import suffix_order
from ledgersift.llm.recompress import SPANS, per_text, row_keys

OTHER = 0xC2B2AE3D27D4EB4F  # odd multiplier of a second hash
GRAM = 64  # bytes hashed at an anchor, at most a sixth of the length sought


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` values in a row."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    size = -(-len(values) // width) * width
    padded = np.full(size, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    block = padded.reshape(-1, width)
    up = np.minimum.accumulate(block, axis=1).ravel()
    down = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(down[:n], up[width - 1 : width - 1 + n])


def anchors(data: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each anchor of the texts: text, hash of its bytes, and the starts
    [a, b) of the strings it belongs to, counted within the text."""
    gram = min(GRAM, max(1, length // 6))
    size = np.array([len(d) for d in data], np.int64)
    first = np.concatenate(([0], np.cumsum(size)))
    raw = np.frombuffer(b"".join(data), np.uint8)
    none = np.zeros(0, np.int64)
    if len(raw) < length:
        return none, none.astype(U64), none, none
    sums = prefix_hash(_BYTE[raw], BASE)
    at = np.arange(len(raw) - gram + 1)
    hashes = span_hash(sums, at, at + gram, BASE)
    # The leftmost of equal hashes wins: the place fills the lower half.
    least = sliding_least((hashes & U64(0xFFFFFFFF00000000)) | at.astype(U64), length - gram + 1)
    place = (least & U64(0xFFFFFFFF)).astype(np.int64)
    spare = np.maximum(size - length + 1, 0)
    start = np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(spare)[:-1])), spare) + np.arange(spare.sum())
    text = np.repeat(np.arange(len(size)), spare)
    if not len(start):
        return none, none.astype(U64), none, none
    place = place[start]
    head = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (text[1:] != text[:-1]))))
    tail = np.concatenate((head[1:], [len(start)])) - 1
    return text[head], hashes[place[head]], start[head] - first[text[head]], start[tail] - first[text[head]] + 1


def repeated_starts(parts: list[bytes], anchor: np.ndarray, again: np.ndarray, length: int, budget: int) -> list[np.ndarray]:
    """For each part, which starts of strings of ``length`` bytes are repeated,
    in another place or, where ``again`` says so, in a copy of the part.

    A part that is the only one with its anchor has its strings in its own
    copies alone, and needs no place in the order.
    """
    _, group, kinds = np.unique(anchor, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(kinds[group] > 1)
    flags = [np.full(len(p) - length + 1, bool(a)) for p, a in zip(parts, again, strict=True)]
    if len(shared):
        for k, flag in zip(shared, _sorted_starts([parts[k] for k in shared], length, budget), strict=True):
            flags[k] |= flag
    return flags


def _sorted_starts(parts: list[bytes], length: int, budget: int) -> list[np.ndarray]:
    size = np.array([len(p) for p in parts], np.int64)
    first = np.concatenate(([0], np.cumsum(size + 1)))[:-1]
    text = np.frombuffer(b"\x00".join(parts), np.uint8).astype(np.int32) + 1
    text[first[1:] - 1] = 0
    order, lcp = suffix_order(text, length, budget)
    alike = lcp >= length
    # A separator can be shared as well; strings over it do not count.
    flag = np.zeros(len(text) + 1, bool)
    flag[order[alike]] = True
    flag[order[np.flatnonzero(alike) - 1]] = True
    return [flag[f : f + s - length + 1] for f, s in zip(first, size, strict=True)]


def _spans(flag: np.ndarray, length: int) -> bytes:
    """The bytes [start, end) covered by the flagged starts."""
    edge = np.diff(np.concatenate(([0], flag.astype(np.int8), [0])))
    return np.stack((np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + length - 1), axis=1).astype(np.int64).tobytes()


def by_heat(parts: DataFrame, shard_bytes: int) -> tuple[DataFrame, DataFrame]:
    """The parts of anchors that fit a shard, and those of all others."""
    heat = parts.groupBy("anchor").agg(F.sum(F.length("bytes")).alias("size")).where(F.col("size") > shard_bytes).select("anchor")
    heat = few(kept(heat, "hot-anchors"))
    return parts.join(heat, "anchor", "left_anti"), parts.join(heat, "anchor")


def hot_repeats(parts: DataFrame, length: int) -> DataFrame:
    """(anchor, part, spans) of the parts of hot anchors, in whatever task they are.

    Their strings are not sorted but counted over the corpus by a 64-bit
    hash, and those that occur twice by another: repeated are those that do by
    both.
    """

    def starts(sizes: np.ndarray) -> np.ndarray:
        """Where the strings start among the joined bytes of the parts."""
        first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        spare = sizes - length + 1
        return np.repeat(first - (np.cumsum(spare) - spare), spare) + np.arange(spare.sum())

    def hashes(data: bytes, start: np.ndarray, base: int) -> np.ndarray:
        raw = np.frombuffer(data, np.uint8)
        return span_hash(prefix_hash(_BYTE[raw] if base == BASE else mix(_BYTE)[raw], base), start, start + length, base)

    def find(rows: pa.Table) -> dict:
        data = rows["bytes"].to_pylist()
        sizes, whole = np.array([len(d) for d in data], np.int64), b"".join(data)
        keys = hashes(whole, starts(sizes), BASE)
        again = np.asarray(rows["n"]) > 1
        return {"n": len(keys), "anchors": np.asarray(rows["anchor"], np.int64).tobytes(), "parts": b"".join(rows["part"].to_pylist()), "again": again.tobytes(), "sizes": sizes.tobytes(), "texts": whole, "keys": keys.tobytes()}

    fields = "n long, anchors binary, parts binary, again binary, sizes binary"
    packed = kept(pack(parts, find, f"{fields}, texts binary, keys binary", "bytes"), "hot-strings")

    def check(row: dict, counts: np.ndarray, _) -> pa.Table:
        left = np.flatnonzero(counts > 1)
        keys = hashes(row["texts"], starts(np.frombuffer(row["sizes"], np.int64))[left], OTHER)
        out = {"batch": [row["batch"]], "n": [len(left)], **{c: [row[c]] for c in ("anchors", "parts", "again", "sizes")}, "left": [left.astype(np.int32).tobytes()], "keys": [keys.tobytes()]}
        return pa.table({c: pa.array(v, pa.int64() if c in ("batch", "n") else pa.binary()) for c, v in out.items()})

    again = kept(told(packed, tally(packed), check, f"batch long, {fields}, left binary, keys binary"), "hot-strings-again")

    def flags(row: dict, counts: np.ndarray, _) -> pa.Table:
        spare = np.frombuffer(row["sizes"], np.int64) - length + 1
        flag = np.repeat(np.frombuffer(row["again"], bool), spare)
        flag[np.frombuffer(row["left"], np.int32)[counts > 1]] = True
        spans = [_spans(f, length) for f in np.split(flag, np.cumsum(spare)[:-1])]
        parts = [row["parts"][k : k + 16] for k in range(0, len(row["parts"]), 16)]
        out = pa.table({"anchor": np.frombuffer(row["anchors"], np.int64), "part": pa.array(parts, pa.binary()), "spans": pa.array(spans, pa.binary())})
        return out.filter(pa.array([len(x) > 0 for x in spans]))

    return told(again, tally(again), flags, "anchor long, part binary, spans binary")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, shard_bytes: int = 1 << 20, budget: int = 64 << 20) -> DataFrame:
    """(_row, spans): for each text the bytes [start, end) covered by a string of
    ``length`` bytes that also starts elsewhere."""
    texts = row_keys(docs, id_col, text_col).select("_row", F.col(text_col).cast("string").alias("text"))
    # Rows alike in id and text share a number; they are told apart by counting them.
    fields = "n long, row_ids binary, keys binary, texts binary, starts binary, ends binary"

    def find(rows: pa.Table) -> dict:
        text, keys, a, b = anchors([(t or "").encode() for t in rows["text"].to_pylist()], length)
        return {"n": len(keys), "row_ids": np.asarray(rows["_row"], np.int64).tobytes(), "keys": keys.tobytes(), "texts": text.astype(np.int32).tobytes(), "starts": a.astype(np.int64).tobytes(), "ends": (b - a).astype(np.int32).tobytes()}

    packed = kept(pack(texts, find, fields), "anchors")

    def twice(row: dict, counts: np.ndarray, _) -> pa.Table:
        use = counts >= 2
        text, ids = np.frombuffer(row["texts"], np.int32)[use], np.frombuffer(row["row_ids"], np.int64)
        a = np.frombuffer(row["starts"], np.int64)[use]
        found = np.stack((a, a + np.frombuffer(row["ends"], np.int32)[use], np.frombuffer(row["keys"], np.int64)[use]), axis=1)
        cut = np.flatnonzero(np.diff(text, prepend=-1))
        parts = [part.tobytes() for part in np.split(found, cut[1:])] if len(cut) else []
        return pa.table({"_key": pa.array(ids[text[cut]], pa.int64()), "spans": pa.array(parts, pa.binary())})

    found = kept(told(packed, tally(packed), twice, "_key long, spans binary").dropDuplicates(["_key"]), "anchor-spans")

    def segments(rows: pa.Table):
        """A row for each anchor and text; the bytes once in a batch."""
        out = {name: [] for name in ("anchor", "part", "_row", "start", "bytes")}
        seen = set()
        for row, text, spans in zip(rows["_row"].to_pylist(), rows["text"].to_pylist(), rows["spans"].to_pylist(), strict=True):
            data = (text or "").encode()
            for a, b, key in np.frombuffer(spans, np.int64).reshape(-1, 3).tolist():
                piece = data[a : b + length - 1]
                part = blake2b(piece, digest_size=16).digest()
                out["anchor"].append(key)
                out["part"].append(part)
                out["_row"].append(row)
                out["start"].append(a)
                out["bytes"].append(None if (key, part) in seen else piece)
                seen.add((key, part))
        yield pa.table(out, schema=pa.schema([("anchor", pa.int64()), ("part", pa.binary()), ("_row", pa.int64()), ("start", pa.int64()), ("bytes", pa.binary())]))

    asked = texts.join(found, F.col("_row") == F.col("_key")).drop("_key")
    schema = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("part", T.BinaryType()), T.StructField("_row", T.LongType()), T.StructField("start", T.LongType()), T.StructField("bytes", T.BinaryType())])
    pieces = kept(map_batches(asked, segments, schema, "text", 1 << 20), "segments")
    parts = kept(pieces.groupBy("anchor", "part").agg(F.count(F.lit(1)).alias("n"), F.max("bytes").alias("bytes")), "parts")
    parts, hot = by_heat(parts, shard_bytes)
    total = parts.agg(F.sum(F.length("bytes"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))

    def order(rows: pa.Table) -> pa.Table:
        flags = repeated_starts(rows["bytes"].to_pylist(), np.asarray(rows["anchor"]), np.asarray(rows["n"]) > 1, length, budget)
        spans = [_spans(flag, length) for flag in flags]
        out = pa.table({"anchor": rows["anchor"], "part": rows["part"], "spans": pa.array(spans, pa.binary())})
        return out.filter(pa.array([len(s) > 0 for s in spans]))

    sorted_ = parts.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).groupBy("shard").applyInArrow(order, "anchor long, part binary, spans binary")
    if not hot.isEmpty():
        sorted_ = sorted_.union(hot_repeats(hot, length))
    hits = pieces.select("anchor", "part", "_row", "start").join(kept(sorted_, "repeats"), ["anchor", "part"]).select("_row", "start", "spans")

    def gather(batches):
        """Spans of a text, in order of start, as they come from a sorted partition."""
        who, held = None, []
        for batch in batches:
            done = []
            for row, start, spans in zip(batch["_row"].to_pylist(), batch["start"].to_pylist(), batch["spans"].to_pylist(), strict=True):
                if row != who:
                    if held:
                        done.append((who, np.concatenate(held)))
                    who, held = row, []
                held.append(np.frombuffer(spans, np.int64).reshape(-1, 2) + start)
                if len(held) > 1024:
                    held = [np.stack(merged(*np.concatenate(held).T), axis=1)]
            yield from _texts(done)
        if held:
            yield from _texts([(who, np.concatenate(held))])

    return hits.repartition("_row").sortWithinPartitions("_row", "start").mapInArrow(gather, "_row long, spans binary")


def _texts(done: list):
    if done:
        spans = [np.stack(merged(*s.T), axis=1).astype(np.int64) for _, s in done]
        text = np.repeat(np.arange(len(done)), [len(s) for s in spans])
        both = np.concatenate(spans)
        out = per_text(np.array([k for k, _ in done], np.int64), text, both[:, 0], both[:, 1])
        yield from out.rename_columns(["_row", "spans"]).to_batches()


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, shard_bytes: int = 1 << 20, budget: int = 64 << 20) -> DataFrame:
    """The documents without byte strings that stand twice in the corpus.

    Each byte covered by a string of ``length`` bytes that also starts anywhere
    else, in this or another row, goes; judged on the input. Adds kept_bytes
    (binary: what is left, which may cut a letter), n_bytes, n_removed and
    removed_spans in bytes of the input; columns of those names are replaced,
    the text stays as it was.

    A null text has no bytes, as has an empty one. Rows alike in all columns
    are repeats of each other. Strings are compared by their bytes within a
    shard; copies of a whole segment are told by a 128-bit hash, and the strings of an
    anchor whose surroundings exceed ``shard_bytes`` by two of 64 bits.
    """
    spans = repeated_spans(docs, id_col, text_col, length, shard_bytes, budget).withColumnRenamed("_row", "_key")
    added = [T.StructField("kept_bytes", T.BinaryType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("removed_spans", SPANS)]
    base = row_keys(without(docs, *[f.name for f in added], "_key", "_row", "_id", "spans").withColumn(text_col, F.col(text_col).cast("string")), id_col, text_col).drop("_id")
    joined = base.join(spans, F.col("_row") == F.col("_key"), "left").drop("_row", "_key")
    schema = plus(without(base, "_row").schema, *added)

    def cut(rows: pa.Table):
        left, n_bytes, n_removed, removed = [], [], [], []
        for text, packed in zip(rows[text_col].to_pylist(), rows["spans"].to_pylist(), strict=True):
            data = (text or "").encode()
            gone = np.frombuffer(packed or b"", np.int64).reshape(-1, 2).tolist()
            edges = [0, *(x for span in gone for x in span), len(data)]
            left.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            n_bytes.append(len(data))
            n_removed.append(sum(b - a for a, b in gone))
            removed.append([{"start": a, "end": b} for a, b in gone])
        done = rows.drop_columns(["spans"]).append_column("kept_bytes", pa.array(left, pa.binary()))
        done = done.append_column("n_bytes", pa.array(n_bytes, pa.int64())).append_column("n_removed", pa.array(n_removed, pa.int64()))
        yield done.append_column("removed_spans", pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))))

    return map_batches(joined, cut, schema, text_col)
