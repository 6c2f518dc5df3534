"""Language of a text by error-correcting output codes.

Each language has a codeword of +1 and -1. For every bit a binary classifier
over hashed byte n-grams tells the languages with +1 from those with -1. A
text's bits are read from the classifiers, and decoding takes the codeword
with the least loss, each bit weighted by how reliable its classifier is.
A text whose two best codewords lie close together is flagged as ambiguous.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersift.llm.common import BASE, U64, map_batches, plus, without

LETTER = re.compile(r"[^\W\d_]")
BITS = 14  # of the hashed feature numbers
GRAMS = (2, 3, 4)
CHUNK = 1 << 19  # bytes of text in one set of arrays
PAD = b" " * max(GRAMS)
CUT = max(GRAMS) - 1


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n rows of +1 and -1: for up to six languages all ways to part them in
    two, else the most distant of random codes."""
    if n <= 1:
        return np.ones((n, 1), np.int8)
    if n <= 6:
        ways = np.arange(1, 2 ** (n - 1))
        rows = [np.ones(len(ways), np.int8)]
        rows += [np.where((ways >> i) & 1, -1, 1).astype(np.int8) for i in range(n - 1)]
        return np.stack(rows)
    rng = np.random.default_rng(seed)
    length = int(10 * np.ceil(np.log2(n)))
    best, far = None, -1
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], np.int8), (n, length))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        agree = code.astype(int) @ code.T
        apart = ((code.shape[1] - agree) // 2 + np.eye(n, dtype=int) * 10**6).min()
        if apart > far:
            best, far = code, apart
    return best


def features(raw: np.ndarray) -> np.ndarray:
    """Feature number of the n-grams that end at each byte, a row for each n.
    Letters are folded by the bit that tells A-Z from a-z in ASCII."""
    upper = (raw >= 65) & (raw <= 90)
    x = np.where(upper, raw | 32, raw).astype(U64)
    out, gram = [], x.copy()
    for n in range(2, max(GRAMS) + 1):
        gram = np.concatenate((gram[:1], gram[:-1])) * U64(257) + x
        if n in GRAMS:
            out.append(((gram + U64(n)) * U64(BASE)) >> U64(64 - BITS))
    return np.stack(out).astype(np.int32)


def _spans(texts: list):
    """Chunks of texts: (raw bytes, starts). A longer text is split, at the
    same places whatever stands around it. The grams that end in a piece's
    first bytes reach into what stands before and are not counted."""
    data, starts, size = [], [], 0
    for text in texts:
        raw = PAD + (text or "").encode()
        for at in range(0, len(raw), CHUNK):
            piece = raw[at : at + CHUNK]
            if size and size + len(piece) > CHUNK:
                yield np.frombuffer(b"".join(data), np.uint8), np.array(starts)
                data, starts, size = [], [], 0
            starts.append(size)
            data.append(piece)
            size += len(piece)
    if starts:
        yield np.frombuffer(b"".join(data), np.uint8), np.array(starts)


def _owners(texts: list) -> list[int]:
    """The text of each start that ``_spans`` gives, in order."""
    return [i for i, t in enumerate(texts) for _ in range(0, len((t or "").encode()) + len(PAD), CHUNK)]


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # features x bits
    scale: np.ndarray  # usual size of each bit's margin
    trust: np.ndarray  # weight of each bit in decoding

    def margins(self, texts: list) -> np.ndarray:
        """Mean weight over a text's n-grams, for each bit."""
        total = np.zeros((len(texts), self.weights.shape[1]))
        grams = np.zeros(len(texts))
        owners, at = np.array(_owners(texts), np.int64), 0
        for raw, starts in _spans(texts):
            summed = np.zeros((len(raw), self.weights.shape[1]), np.float32)
            for row in features(raw):
                summed += self.weights[row]
            for k in range(CUT):
                summed[np.minimum(starts + k, len(raw) - 1)] = 0
            who = owners[at : at + len(starts)]
            np.add.at(total, who, np.add.reduceat(summed, starts, axis=0))
            np.add.at(grams, who, np.diff([*starts, len(raw)]) - CUT)
            at += len(starts)
        return total / np.maximum(grams, 1)[:, None]

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Loss of each language's codeword, from 0 on."""
        z = np.clip(margins / self.scale, -20, 20)
        plus_loss, minus_loss = np.log1p(np.exp(-2 * z)), np.log1p(np.exp(2 * z))
        up = (self.code > 0) * self.trust
        down = (self.code < 0) * self.trust
        return (plus_loss @ up.T + minus_loss @ down.T) / self.trust.sum()


def fit(docs: DataFrame, train: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample_docs: int = 5000) -> Model:
    """Fit on a sample of at most about ``sample_docs`` labelled rows a
    language, drawn by a hash of the id. Counts of n-grams are summed by
    Spark; the driver gets one number for each feature and language."""
    texts = docs.where(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = {r[0]: r[1] for r in texts.groupBy(lang_col).count().collect()}
    languages = sorted(sizes)
    code = codewords(len(languages))
    if not languages:
        return Model([], code, np.zeros((2**BITS, 1), np.float32), np.ones(1), np.ones(1))
    rate = F.lit(1.0)
    for lang, n in sizes.items():
        rate = F.when(F.col(lang_col) == lang, F.lit(min(1.0, sample_docs / n))).otherwise(rate)
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("sample")), F.lit(1_000_000)) / 1_000_000
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sample = texts.where(draw < rate).select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    place = {lang: k for k, lang in enumerate(languages)}

    def count(batches):
        seen = np.zeros((len(languages), 2**BITS), np.int64)
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), [place[x] for x in batch.column(1).to_pylist()]
            owners, at = _owners(texts), 0
            for raw, starts in _spans(texts):
                found = features(raw)
                ends = [*starts[1:], len(raw)]
                for a, b, who in zip(starts, ends, owners[at : at + len(starts)], strict=True):
                    seen[langs[who]] += np.bincount(found[:, a + CUT : b].ravel(), minlength=2**BITS)
                at += len(starts)
        lang, feature = np.nonzero(seen)
        yield pa.record_batch({"lang": lang.astype(np.int32), "feature": feature.astype(np.int32), "n": seen[lang, feature]})

    few = sample.coalesce(max(1, min(spread, 16)))
    rows = few.mapInArrow(count, "lang int, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow()
    counts = np.full((len(languages), 2**BITS), 0.5)
    counts[rows["lang"].to_numpy(), rows["feature"].to_numpy()] += rows["n"].to_numpy()
    share = counts / counts.sum(axis=1, keepdims=True)
    weights = np.zeros((2**BITS, code.shape[1]), np.float32)
    for b in range(code.shape[1]):
        up, down = code[:, b] > 0, code[:, b] < 0
        if up.any() and down.any():
            weights[:, b] = np.log(share[up].mean(axis=0)) - np.log(share[down].mean(axis=0))
    model = Model(languages, code, weights, np.ones(code.shape[1]), np.ones(code.shape[1]))

    def judge(batches):
        n, size, wrong = 0, np.zeros(code.shape[1]), np.zeros(code.shape[1])
        for batch in batches:
            m = model.margins(batch.column(0).to_pylist())
            want = code[[place[x] for x in batch.column(1).to_pylist()]]
            n, size, wrong = n + len(m), size + np.abs(m).sum(axis=0), wrong + (m * want <= 0).sum(axis=0)
        yield pa.record_batch({"bit": np.arange(len(size), dtype=np.int32), "n": np.full(len(size), n), "size": size, "wrong": wrong})

    said = few.mapInArrow(judge, "bit int, n long, size double, wrong double").groupBy("bit").agg(F.sum("n"), F.sum("size"), F.sum("wrong")).orderBy("bit").collect()
    n = np.array([r[1] for r in said], float)
    model.scale = np.maximum(np.array([r[2] for r in said]) / np.maximum(n, 1), 1e-6)
    error = (np.array([r[3] for r in said]) + 1) / (n + 2)
    model.trust = np.maximum(np.log((1 - error) / error), 0.05)
    return model


def predict(docs: DataFrame, model: Model, text_col: str = "text", close: float = 0.05) -> DataFrame:
    """Adds lang_pred, score (0 to 1) and lang_ambiguous.

    Only the text is read. A text that is null or has no letter is ``und``
    with score 0, as is every text of a model without languages. Ambiguous:
    the losses of the two best languages are less than ``close`` apart; with
    equal losses the first language in alphabetical order is taken. Columns of
    the added names are replaced; repeated rows get equal answers.
    """

    def work(rows: pa.Table):
        texts = rows[text_col].to_pylist()
        known = [bool(t and model.languages and LETTER.search(t)) for t in texts]
        loss = model.losses(model.margins(texts)) if model.languages else np.zeros((len(texts), 1))
        best = loss.argmin(axis=1)
        share = np.exp(-4 * (loss - loss.min(axis=1, keepdims=True)))
        score = 1 / share.sum(axis=1)
        near = np.sort(loss, axis=1)
        tight = near[:, 1] - near[:, 0] < close if loss.shape[1] > 1 else np.zeros(len(texts), bool)
        out = rows.append_column("lang_pred", pa.array([model.languages[b] if k else "und" for b, k in zip(best, known, strict=True)], pa.string()))
        out = out.append_column("score", pa.array(np.where(known, score, 0.0)))
        yield out.append_column("lang_ambiguous", pa.array(np.array(known, bool) & tight))

    base = without(docs, "lang_pred", "score", "lang_ambiguous").withColumn(text_col, F.col(text_col).cast("string"))
    schema = plus(base.schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("lang_ambiguous", T.BooleanType()))
    return map_batches(base, work, schema, text_col)
