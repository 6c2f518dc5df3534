"""Toxicity: features and scores by brute force, held-out rows, edge cases."""

import random
import re

import numpy as np
import pytest

from ledgersift.llm import toxicity as X
from ledgersift.llm.queries import QUERIES

CLEAN = "the a red green blue river stone walks over under slowly house tree cloud"
BAD = ["idiot", "moron", "scum"]


def made(n, seed, share=0.4):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = rng.choices(CLEAN.split(), k=rng.randrange(1, 60))
        toxic = rng.random() < share
        for _ in range(2 * toxic):
            words.insert(rng.randrange(len(words) + 1), rng.choice(BAD))
        out.append((" ".join(words), int(toxic)))
    return out


@pytest.fixture(scope="module")
def model():
    rows = made(400, 1)
    return X.train([t for t, _ in rows], np.array([x for _, x in rows]))


def plain_score(model, text):
    """The same, word by word and n-gram by n-gram."""
    odds = model.odds().astype(float)
    words = re.split(rb"[\x20\x09-\x0d]+", (text or "").encode())
    scores = []
    for w in filter(None, words):
        w = b" " + bytes(c + 32 if 65 <= c <= 90 else c for c in w) + b" "
        found = []
        for n in X.GRAMS:
            for i in range(len(w) - n + 1):
                h = 0
                for c in w[i : i + n]:
                    h = h * 257 + c
                found.append(odds[((((h + n) * X.BASE) % 2**64) >> (64 - X.BITS))])
        scores.append(sum(found) / len(found))
    if not scores:
        return 0.0
    width = min(X.WINDOW, len(scores))
    means = [sum(scores[i : i + width]) / width for i in range(len(scores) - width + 1)]
    return 1 / (1 + np.exp(-(max(means) + model.bias[1] - model.bias[0])))


TEXTS = [None, "", " \t\n", "a", "idiot", "What an IDIOT\x0bis  this\tone ", "éä 中文 \U0001f600", "x" * 500, "the river " * 30 + "scum", "a b c d e f g"]


def test_scores_by_brute_force(model, monkeypatch):
    texts = TEXTS + [t for t, _ in made(30, 2)]
    expected = [plain_score(model, t) for t in texts]
    for chunk in (1 << 18, 64, 7):  # however a text is cut into arrays
        monkeypatch.setattr(X, "CHUNK", chunk)
        got = X.text_scores(model.odds(), float(model.bias[1] - model.bias[0]), texts)
        assert np.allclose(got, expected, atol=1e-9)


def test_held_out_and_misspelt(model):
    score = lambda texts: X.text_scores(model.odds(), float(model.bias[1] - model.bias[0]), texts)
    rows = made(300, 3)
    said = score([t for t, _ in rows]) >= 0.3
    assert np.mean(said == [x == 1 for _, x in rows]) > 0.99
    misspelt = ["the red idiiot walks slowly over", "a mo­ron by the river".replace("­", "o"), "green scumm under the house"]
    assert (score(misspelt) > score(["the red walks slowly over stone"] * 3)).all()


def test_one_class_or_none():
    for toxic, low, high in (([], 0, 0.01), ([0, 0, 0], 0, 0.2), ([1, 1, 1], 0.8, 1)):
        model = X.train(["a b"] * len(toxic), np.array(toxic))
        got = X.text_scores(model.odds(), float(model.bias[1] - model.bias[0]), ["a b", None])
        assert low <= got[0] <= high and got[1] == 0


def test_query_on_held_out_rows(spark, sf):
    found = QUERIES["op12_toxicity"](spark, sf["sf0.1"]).collect()
    assert len(found) == spark.read.parquet(f"{sf['sf0.1']}/documents.parquet").count()
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf['sf0.1']}/labels.parquet").collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    held = [(r.predicted, label[r.doc_id]) for r in found if r.held_out and r.doc_id in label]
    toxic = [p for p, x in held if x == 1]
    clean = [p for p, x in held if x == 0]
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.05


def test_edges(spark, model):
    rows = [(1, "What an idiot", 7.0, "u"), (1, "What an idiot", 7.0, "u"), (None, None, None, None), (3, "", 1.0, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, SCORE double, word string")
    found = X.score_toxicity(docs, model).collect()
    assert sorted((r.word or "", r.predicted) for r in found) == [("", 0), ("u", 1), ("u", 1), ("x", 0)]
    assert "SCORE" not in found[0].asDict()
    assert X.score_toxicity(docs.limit(0), model).collect() == []


def test_fit_on_odd_labels(spark):
    rows = [(k, t) for k, (t, _) in enumerate(made(60, 5))]
    docs = spark.createDataFrame([*rows, (None, "idiot"), (2, None)], "doc_id long, text string")
    labels = [(k, x) for k, (_, x) in enumerate(made(60, 5))] + [(0, None), (None, 1), (1, 5), (99, 1)]
    told = spark.createDataFrame(labels * 2, "doc_id long, toxic int")
    from pyspark.sql import functions as F

    model = X.fit(docs, told, F.lit(True))
    assert model.odds().any()
    assert not X.fit(docs, told.limit(0), F.lit(True)).odds().any()
    assert not X.fit(docs.limit(0), told, F.lit(True)).odds().any()


def test_bytes_are_shared_by_label(spark, monkeypatch):
    drawn = []
    monkeypatch.setattr(X, "train", lambda texts, toxic: drawn.append((texts, toxic)))
    from pyspark.sql import functions as F

    def fit(n, toxic_bytes, clean_bytes):
        docs = spark.createDataFrame([(k, "x" * (toxic_bytes if k < 40 else clean_bytes)) for k in range(n)], "doc_id long, text string")
        X.fit(docs, docs.select("doc_id", (F.col("doc_id") < 40).cast("int").alias("toxic")), F.lit(True), sample_bytes=20000)
        texts, toxic = drawn.pop()
        sizes = np.array([len(x) for x in texts])
        return toxic.sum(), (toxic == 0).sum(), sizes[toxic == 1].sum(), sizes[toxic == 0].sum()

    toxic, _, rare, common = fit(440, 50, 200)  # the rare label's 2,000 bytes stay, the other gets the rest
    assert toxic == 40 and rare == 2000 and 12000 < common < 24000
    _, clean, common, rare = fit(60, 1000, 100)
    assert clean == 20 and rare == 2000 and 12000 < common < 24000
    _, _, left, right = fit(440, 1000, 100)  # 40,000 bytes each: half each
    assert 5000 < left < 15000 and 5000 < right < 15000
    assert fit(60, 100, 100)[:2] == (40, 20)  # all fits
