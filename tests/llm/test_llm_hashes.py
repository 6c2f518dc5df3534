"""Texts made to defeat sums of products modulo 2**64."""

import numpy as np
import pytest

from ledgersift.llm.common import Words
from ledgersift.llm.ngrams import keep_one, near_duplicates
from ledgersift.llm.recompress import dedup_passages


def mirrored(n, a, b):
    """A Thue-Morse word and the one with its letters exchanged."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join(b if x else a for x in bits), "".join(a if x else b for x in bits)


@pytest.mark.parametrize("size", [65, 256, 1024, 2048, 4096])
@pytest.mark.parametrize("lower", [False, True])
def test_words_differ(size, lower):
    one, two = mirrored(size, "x", "y")
    hashes = Words([f"{one} {two} {one.upper()}"], lower).hashes
    assert len(np.unique(hashes)) == (2 if lower else 3)


def test_different_texts_stay_apart(spark):
    pairs = [mirrored(1024 * (1 + k % 4), *"abcdefghijkl"[2 * k : 2 * k + 2]) for k in range(6)]
    texts = [" ".join(p[side] for p in pairs) for side in (0, 1)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.component_id for r in near_duplicates(docs).collect()) == [0, 1]
    assert keep_one(docs).count() == 2
    long = spark.createDataFrame([(k, " ".join([t] * 9)) for k, t in enumerate(texts)], "doc_id long, text string")
    assert [r.n_removed for r in dedup_passages(long).collect()] == [0, 0]
