"""Toxicity of a text from vectors of letter n-grams and a linear softmax.

A word's vector is the mean of the vectors of its letter n-grams, so that a
misspelling nobody has seen shares most of them with the word it stands for.
The mean over a window of words goes through a linear softmax, and a text
scores as its worst window does. Vectors and softmax are trained jointly; a
text's label reaches its windows in proportion to how much they stand out,
evenly at first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersift.llm.common import BASE, U64, few, map_batches, plus, without

GRAMS = (3, 4, 5, 6)  # with one space before and after a word
BITS = 17  # of the hashed n-grams' numbers
DIM = 8
WINDOW = 5  # words
CHUNK = 1 << 18  # bytes in one set of arrays
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_FOLD = np.arange(256, dtype=U64)
_FOLD[65:91] += U64(32)
_FOLD[_SPACE] = 32


def joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of texts with spaces around each, and where each begins; the end last."""
    data = [b" " + (t or "").encode() for t in texts]
    at = np.cumsum([0, *map(len, data)])
    return np.frombuffer(b"".join(data) + b" ", np.uint8), at


def grams(raw: np.ndarray, a: int, b: int):
    """For the n-grams of words that end at bytes a to b: place and number.

    An n-gram lies in one word with the spaces around it. What comes out
    depends on the bytes before a, never on where the chunk begins."""
    reach = max(GRAMS)
    low = max(0, a - reach)
    part = raw[low:b]
    x, space = _FOLD[part], _SPACE[part]
    # Places since the space before; a space counts to the word before it.
    at = np.arange(len(part))
    last = np.maximum.accumulate(np.where(space, at, -reach - 1))
    behind = np.concatenate(([-reach - 1], last[:-1]))
    room = at - np.where(space, behind, last)
    inside = ~space | (room > 1)
    gram = x.copy()
    for n in range(2, reach + 1):
        gram = np.concatenate((gram[:1], gram[:-1])) * U64(257) + x
        if n in GRAMS:
            fits = np.flatnonzero(inside & (room >= n - 1) & (at >= a - low) & (at >= n - 1))
            yield fits + low, (((gram[fits] + U64(n)) * U64(BASE)) >> U64(64 - BITS)).astype(np.int32)


def word_numbers(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte the number of the word it is in, or that ends before it;
    and where each word begins."""
    space = _SPACE[raw]
    begins = ~space & np.concatenate(([True], space[:-1]))
    return np.cumsum(begins, dtype=np.int32) - 1, np.flatnonzero(begins)


def windows(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means over all windows of words, texts' windows in a row; the number of
    each text's first window, and its width: the whole of a shorter text. A
    text without words has one empty window."""
    n = np.diff(first)
    width = np.clip(n, 1, WINDOW)
    count = np.maximum(n - width + 1, 1)
    edge = np.cumsum(count) - count
    sums = np.concatenate(([0.0], np.cumsum(values)))
    start = np.repeat(first[:-1] - edge, count) + np.arange(count.sum())
    end = np.minimum(start + np.repeat(width, count), len(values))
    empty = np.repeat(n == 0, count)
    return np.where(empty, 0.0, (sums[end] - sums[np.minimum(start, len(values))]) / np.repeat(width, count)), edge, width


@dataclass
class Model:
    vectors: np.ndarray  # n-gram numbers x DIM
    softmax: np.ndarray  # 2 x DIM
    bias: np.ndarray  # 2

    def odds(self) -> np.ndarray:
        """What each n-gram adds to class 1 against class 0."""
        return (self.vectors.astype(np.float64) @ (self.softmax[1] - self.softmax[0])).astype(np.float32)


def text_scores(odds: np.ndarray, bias: float, texts: list[str | None]) -> np.ndarray:
    """Probability of class 1 for each text; 0 without words. Arrays are made
    for a chunk of bytes at a time, however long a text is."""
    raw, at = joined(texts)
    number, begins = word_numbers(raw)
    total, count = np.zeros(len(begins)), np.zeros(len(begins))
    for a in range(0, len(raw), CHUNK):
        b = min(a + CHUNK, len(raw))
        lo, hi = max(number[a], 0), number[b - 1] + 1
        for place, gram in grams(raw, a, b):
            own = number[place] - lo
            total[lo:hi] += np.bincount(own, odds[gram], hi - lo)
            count[lo:hi] += np.bincount(own, minlength=hi - lo)
    first = np.searchsorted(begins, at)
    means, edge, _ = windows(total / np.maximum(count, 1), first)
    worst = np.maximum.reduceat(means, edge) + bias if len(texts) else means
    return np.where(np.diff(first) == 0, 0.0, 1 / (1 + np.exp(-np.clip(worst, -30, 30))))


def train(texts: list[str], toxic: np.ndarray, rounds: int = 100, rate: float = 0.15, seed: int = 11) -> Model:
    """Vectors and softmax by Adam over all texts at once.

    Steps are damped where slopes are small, so that n-grams of one text do
    not move as far as those that many texts share. Both labels weigh the
    same."""
    rng = np.random.default_rng(seed)
    softmax = rng.normal(0, 1, (2, DIM)) / np.sqrt(DIM)
    model = Model(np.zeros((1 << BITS, DIM)), softmax, np.zeros(2))
    toxic = np.asarray(toxic, bool)
    if len(texts) == 0 or toxic.all() or not toxic.any():
        share = (toxic.sum() + 0.5) / (len(texts) + 1) if len(texts) else 0.0
        model.bias = np.array([0.0, np.log(share / (1 - share)) if share else -30.0])
        return model
    # A word's n-grams are those of its spelling: each spelling is held once.
    place: dict[bytes, int] = {}
    kind = np.array([place.setdefault(w, len(place)) for t in texts for w in (t or "").encode().lower().split()], np.int32)
    first = np.cumsum([0, *(len((t or "").encode().split()) for t in texts)])
    raw = np.frombuffer(b" " + b" ".join(place) + b" ", np.uint8)
    number, _ = word_numbers(raw)
    found = [(number[p], g) for a in range(0, len(raw), CHUNK) for p, g in grams(raw, a, min(a + CHUNK, len(raw)))]
    owner, gram = (np.concatenate([f[k] for f in found]).astype(np.int32) for k in (0, 1))
    size = np.bincount(owner, minlength=len(place))

    weight = np.where(toxic, 0.5 / toxic.sum(), 0.5 / (~toxic).sum())
    params = [model.vectors, model.softmax, model.bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    n_words = np.diff(first)
    for k in range(1, rounds + 1):
        ahead = model.softmax[1] - model.softmax[0]
        odds = np.einsum("ij,j->i", model.vectors, ahead)
        word_odds = np.bincount(owner, odds[gram], len(place)) / np.maximum(size, 1)
        means, edge, width = windows(word_odds[kind], first)
        count = np.diff([*edge, len(means)])
        high = np.maximum.reduceat(means, edge)
        share = np.exp(means - np.repeat(high, count))
        share /= np.repeat(np.add.reduceat(share, edge), count)
        said = np.add.reduceat(share * means, edge) + model.bias[1] - model.bias[0]
        wrong = weight * (1 / (1 + np.exp(-np.clip(said, -30, 30))) - toxic)
        # Back to windows, to the words in them, to spellings, to n-grams.
        per_window = np.repeat(wrong / width, count) * share
        start = np.repeat(first[:-1] - edge, count) + np.arange(len(means))
        lives = np.repeat(n_words > 0, count)
        turns = np.bincount(start[lives], per_window[lives], len(kind) + 1) - np.bincount((start + np.repeat(width, count))[lives], per_window[lives], len(kind) + 1)
        per_word = np.bincount(kind, np.cumsum(turns)[:-1], len(place)) / np.maximum(size, 1)
        per_gram = np.bincount(gram, per_word[owner], 1 << BITS)
        toward = np.einsum("ij,i->j", model.vectors, per_gram)
        slopes = [per_gram[:, None] * ahead + 1e-6 * model.vectors, np.stack([-toward, toward]), np.array([-wrong.sum(), wrong.sum()])]
        for p, slope, (m, v) in zip(params, slopes, moments, strict=True):
            m += 0.1 * (slope - m)
            v += 0.02 * (slope**2 - v)
            usual = np.sqrt(v / (1 - 0.98**k))
            p -= rate * (m / (1 - 0.9**k)) / (usual + 0.1 * usual.max() + 1e-12)
    return model


def fit(docs: DataFrame, labels: DataFrame, learn: Column, text_col: str = "text", id_col: str = "doc_id", label_col: str = "toxic", sample_docs: int = 2000, sample_bytes: int = 1 << 22) -> Model:
    """Train on a sample of labelled rows for which ``learn``, a condition on
    the labels' columns, holds: at most about ``sample_docs`` of each label,
    drawn by a hash of the id, of ``sample_bytes`` together; texts longer than
    a sixteenth of that are not drawn. Half of the bytes are each label's own;
    what one has no rows for goes to the other, so that a rare label is not
    thinned for the sake of a common one.

    Labels other than 0 and 1, and null ids, are not used; of several labels
    of an id the highest counts, of several texts the least.
    """
    told = labels.where(learn & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_toxic"))
    sizes = {r[0]: r[1] for r in told.groupBy("_toxic").count().collect()}
    share = {k: min(1.0, sample_docs / n) for k, n in sizes.items()}
    draw = lambda salt: F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit(salt)), F.lit(1_000_000)) / 1_000_000
    drawn = told.where(draw("rows") < F.when(F.col("_toxic") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0)))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).where(F.octet_length("_text") <= sample_bytes // 16)
    rows = texts.join(few(drawn), "_id").groupBy("_id").agg(F.min("_text").alias("_text"), F.max("_toxic").alias("_toxic"))
    whole = {r[0]: r[1] for r in rows.groupBy("_toxic").agg(F.sum(F.octet_length("_text"))).collect()}
    room = {k: max(sample_bytes / 2, sample_bytes - whole.get(1 - k, 0)) / max(n, 1) for k, n in whole.items()}
    rows = rows.where(draw("bytes") < F.when(F.col("_toxic") == 1, room.get(1, 0.0)).otherwise(room.get(0, 0.0)))
    got = sorted(zip(*(c.to_pylist() for c in rows.select("_id", "_text", "_toxic").toArrow().columns), strict=True))
    return train([t for _, t, _ in got], np.array([x for *_, x in got]))


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.3) -> DataFrame:
    """Adds score, 0 to 1, and predicted: 1 where it is at least ``least``.

    Only the text is read, all of it. A text that is null, empty or white
    space scores 0. Repeated rows get equal answers;
    columns of the added names are replaced, all others kept.
    """
    odds, bias = model.odds(), float(model.bias[1] - model.bias[0])

    def work(rows: pa.Table):
        score = text_scores(odds, bias, rows[text_col].to_pylist())
        out = rows.append_column("score", pa.array(score))
        yield out.append_column("predicted", pa.array((score >= least).astype(np.int32)))

    base = without(docs, "score", "predicted").withColumn(text_col, F.col(text_col).cast("string"))
    schema = plus(base.schema, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()))
    return map_batches(base, work, schema, text_col, 1 << 19)
