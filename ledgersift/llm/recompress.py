"""Long passages shared by documents, found by recompression.

Words are named by hashes. In each round every run of one symbol, then every
pair of a left and a right symbol, gets a new symbol, named by a hash of what
it stands for: equal parts get equal names wherever they are, without a table
of names to share. Each symbol knows how far around it the text has decided
that it stands there. Two equal passages agree in all symbols decided within
them, so a window that holds such a symbol which occurs nowhere else is not
repeated. What is left is verified window by window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersift.llm.blocks import pack, tally, told
from ledgersift.llm.common import STEP, U64, Words, kept, map_batches, merged, mix, plus, prefix_hash, span_hash, without

NOBODY = np.iinfo(np.int64).min


def symbols(hashes: np.ndarray, first: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols after some rounds, and the words [lo, hi) that decide each.

    ``first`` parts the words into texts. Where a text's edge has a say, the
    deciding part reaches one word over it.
    """
    n = np.diff(first)
    text = np.repeat(np.arange(len(n)), n)
    sym = mix(hashes + U64(1))
    lo = np.arange(len(sym))
    hi = lo + 1
    for level in range(rounds):
        if len(sym) == 0:
            break
        # Runs.
        same = np.zeros(len(sym), bool)
        same[1:] = (sym[1:] == sym[:-1]) & (text[1:] == text[:-1])
        head = np.flatnonzero(~same)
        length = np.diff(head, append=len(sym))
        tail = head + length - 1
        lo, hi = _with_left(lo, hi, head, text, first), _with_right(lo, hi, tail, text, first)
        sym, text = sym[head], text[head]
        sym = np.where(length > 1, mix(sym * U64(STEP) + length.astype(U64) * U64(2 * level + 3)), sym)
        # Pairs.
        left = (mix(sym + U64(level)) & U64(1)).astype(bool)
        pair = np.zeros(len(sym), bool)
        pair[:-1] = left[:-1] & ~left[1:] & (text[1:] == text[:-1])
        second = np.concatenate(([False], pair[:-1]))
        here = np.arange(len(sym))
        new_lo = np.where(left | second, lo, _with_left(lo, hi, here, text, first))
        new_hi = np.where(left & ~pair, _with_right(lo, hi, here, text, first), hi)
        at = np.flatnonzero(pair)
        sym = sym.copy()
        sym[at] = mix(mix(sym[at]) * U64(STEP) + sym[at + 1] + U64(2 * level + 2))
        new_lo[at], new_hi[at] = np.minimum(lo[at], lo[at + 1]), np.maximum(hi[at], hi[at + 1])
        stay = ~second
        sym, text, lo, hi = sym[stay], text[stay], new_lo[stay], new_hi[stay]
    return sym, lo, hi


def _with_left(lo, hi, at, text, first):
    """Least of what decides symbol ``at`` and its left neighbour."""
    before = np.maximum(at - 1, 0)
    inside = (at > 0) & (text[before] == text[at])
    return np.where(inside, np.minimum(lo[at], lo[before]), first[text[at]] - 1)


def _with_right(lo, hi, at, text, first):
    after = np.minimum(at + 1, len(hi) - 1)
    inside = (at + 1 < len(hi)) & (text[after] == text[at])
    return np.where(inside, np.maximum(hi[at], hi[after]), first[text[at] + 1] + 1)


def open_windows(first: np.ndarray, lo: np.ndarray, hi: np.ndarray, lone: np.ndarray, width: int) -> np.ndarray:
    """Of all words, those where a window starts that holds no lone symbol."""
    size = int(first[-1])
    step = np.zeros(size + 2, np.int64)
    a, b = np.maximum(hi[lone] - width, 0), np.minimum(lo[lone], size - 1) + 1
    use = b > a
    np.add.at(step, a[use], 1)
    np.add.at(step, b[use], -1)
    free = np.cumsum(step[:size]) == 0
    n = np.diff(first)
    free &= np.arange(size) + width <= np.repeat(first[1:], n)
    return free


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans [start, end) of true values."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def row_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Adds _id and _row; rows with equal id and text share a _row."""
    text = F.col(text_col).cast("string")
    return docs.withColumn("_id", F.coalesce(F.col(id_col).cast("long"), F.lit(NOBODY))).withColumn("_row", F.xxhash64(id_col, text))


def per_text(row_ids: np.ndarray, text: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Table:
    """Spans, numbered within their texts, as one row of bytes for each text."""
    if not len(text):
        return pa.table({"_key": pa.array([], pa.int64()), "spans": pa.array([], pa.binary())})
    cut = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
    spans = np.stack((start, end), axis=1).astype(np.int64)
    parts = [spans[a:b].tobytes() for a, b in zip(cut, [*cut[1:], len(text)], strict=True)]
    return pa.table({"_key": pa.array(row_ids[text[cut]], pa.int64()), "spans": pa.array(parts, pa.binary())})


def shared_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50, rounds: int = 5) -> DataFrame:
    """(_row, spans): for each text the words [start, end) that are covered by
    a window which also starts in a document with a smaller id."""
    texts = row_keys(docs, id_col, text_col).select("_id", "_row", F.col(text_col).cast("string").alias("text"))
    fields = "n long, row_ids binary, first binary, keys binary, lo binary, hi binary"

    def parse(rows: pa.Table) -> dict:
        words = Words(rows["text"].to_pylist())
        sym, lo, hi = symbols(words.hashes, words.first, rounds)
        # Texts without a window have nothing to ask, nor have symbols that no window holds.
        use = hi - lo <= width
        ids = np.asarray(rows["_row"], np.int64)
        return {"n": int(use.sum()), "row_ids": ids.tobytes(), "first": words.first.astype(np.int64).tobytes(), "keys": sym[use].tobytes(), "lo": lo[use].astype(np.int32).tobytes(), "hi": (hi - lo)[use].astype(np.uint8).tobytes()}

    packed = kept(pack(texts, parse, fields), "symbols")

    def candidates(row: dict, counts: np.ndarray, _) -> pa.Table:
        first, ids = np.frombuffer(row["first"], np.int64), np.frombuffer(row["row_ids"], np.int64)
        lo = np.frombuffer(row["lo"], np.int32).astype(np.int64)
        hi = lo + np.frombuffer(row["hi"], np.uint8)
        start, end = runs(open_windows(first, lo, hi, counts < 2, width))
        return _by_text(ids, first, start, end)

    open_at = told(packed, tally(packed), candidates, "_key long, spans binary")
    open_at = kept(open_at.dropDuplicates(["_key"]), "open-windows")

    def verify(rows: pa.Table) -> dict:
        words = Words(rows["text"].to_pylist())
        at = [np.frombuffer(s, np.int64).reshape(-1, 2) + f for s, f in zip(rows["spans"].to_pylist(), words.first[:-1], strict=True)]
        spans = np.concatenate(at) if at else np.zeros((0, 2), np.int64)
        size = spans[:, 1] - spans[:, 0]
        start = np.repeat(spans[:, 0] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        keys = span_hash(prefix_hash(mix(words.hashes), STEP), start, start + width, STEP)
        text = np.searchsorted(words.first, start, "right") - 1
        owners = np.asarray(rows["_id"], np.int64)[text] if len(start) else np.zeros(0, np.int64)
        return {"n": len(keys), "row_ids": np.asarray(rows["_row"], np.int64).tobytes(), "first": words.first.astype(np.int64).tobytes(), "keys": keys.tobytes(), "owners": owners.tobytes(), "lo": start.astype(np.int32).tobytes()}

    asked = texts.join(open_at, F.col("_row") == F.col("_key")).drop("_key")
    windows = kept(pack(asked, verify, "n long, row_ids binary, first binary, keys binary, owners binary, lo binary"), "windows")

    def covered(row: dict, _, lowest: np.ndarray) -> pa.Table:
        first, ids = np.frombuffer(row["first"], np.int64), np.frombuffer(row["row_ids"], np.int64)
        start = np.frombuffer(row["lo"], np.int32).astype(np.int64)[lowest < np.frombuffer(row["owners"], np.int64)]
        text = np.searchsorted(first, start, "right") - 1
        # Windows of one text only are joined: texts are pulled apart by a gap.
        s, e = merged(start + text, start + text + width)
        text = np.searchsorted(first + np.arange(len(first)), s, "right") - 1
        return per_text(ids, text, s - text - first[text], e - text - first[text])

    found = told(windows, tally(windows, least=True), covered, "_key long, spans binary")
    return found.dropDuplicates(["_key"]).select(F.col("_key").alias("_row"), "spans")


def _by_text(ids: np.ndarray, first: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Table:
    """Spans of words cut at the edges of texts, one row for each text."""
    if not len(start):
        return per_text(ids, np.zeros(0, np.int64), start, end)
    edges = np.unique(np.concatenate((start, first[(first > start[0]) & (first < end[-1])])))
    stop = np.concatenate((edges[1:], end[-1:]))
    span = np.searchsorted(start, edges, "right") - 1
    stop = np.minimum(stop, end[span])
    use = edges < stop
    edges, stop = edges[use], stop[use]
    text = np.searchsorted(first, edges, "right") - 1
    return per_text(ids, text, edges - first[text], stop - first[text])


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50, rounds: int = 5) -> DataFrame:
    """The documents without passages that stand in an earlier one.

    Words are ``[^\\x20\\x09-\\x0D]+``. A window is ``width`` consecutive words
    of one document; each word covered by a window that also starts in a
    document with a smaller id goes, judged on the input. The text becomes the
    words that stay, joined by one space. Adds n_words, n_removed and
    removed_spans, in words of the input; columns of those names are replaced.

    A null text stays null and has no words; an empty one stays empty. Rows
    with one id remove nothing from each other. A null id is smaller than any
    other. Passages are compared by 64-bit hashes of 50 words: texts that
    differ are taken for equal with a chance of 2**-64 a pair.
    """
    spans = shared_passages(docs, id_col, text_col, width, rounds).withColumnRenamed("_row", "_key")
    added = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("removed_spans", SPANS)]
    base = row_keys(without(docs, *[f.name for f in added], "_key", "_row", "_id", "spans").withColumn(text_col, F.col(text_col).cast("string")), id_col, text_col).drop("_id")
    joined = base.join(spans, F.col("_row") == F.col("_key"), "left").drop("_row", "_key")
    schema = plus(without(base, "_row").schema, *added)

    def cut(rows: pa.Table):
        texts, n_words, n_removed, removed = [], [], [], []
        for text, packed in zip(rows[text_col].to_pylist(), rows["spans"].to_pylist(), strict=True):
            words = (text or "").encode().split()
            gone = np.frombuffer(packed or b"", np.int64).reshape(-1, 2).tolist()
            n_words.append(len(words))
            n_removed.append(sum(b - a for a, b in gone))
            removed.append([{"start": a, "end": b} for a, b in gone])
            for a, b in reversed(gone):
                del words[a:b]
            texts.append(None if text is None else b" ".join(words).decode())
        done = rows.drop_columns(["spans"])
        done = done.set_column(done.column_names.index(text_col), text_col, pa.array(texts, pa.string()))
        done = done.append_column("n_words", pa.array(n_words, pa.int64())).append_column("n_removed", pa.array(n_removed, pa.int64()))
        yield done.append_column("removed_spans", pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))))

    return map_batches(joined, cut, schema, text_col)
