"""Groups of near copies larger than a task: whole components, rows that do not
grow with the square of the group."""

import random

from pyspark.sql import functions as F

import ledgersift.llm.ngrams as ngrams
from ledgersift.llm.ngrams import near_duplicates


def linked(a, b, percent):
    both = len(a & b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def brute(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = t.split()
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}
    ids, label = sorted(sets), {i: i for i in sets}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for x, a in enumerate(ids):
        for b in ids[:x]:
            if linked(sets[a], sets[b], percent):
                ra, rb = top(a), top(b)
                label[max(ra, rb)] = min(ra, rb)
    return {i: top(i) for i in ids}


def copies(rng, n):
    """Copies of one text with so many words changed that links are on the edge."""
    base = [f"w{k}" for k in range(120)]
    for i in range(n):
        words = base[:]
        for k in rng.sample(range(120), rng.randrange(0, 7)):
            words[k] = rng.choice(["x", "y", f"u{i}"])
        yield i, " ".join(words)


def test_a_large_group_on_the_edge(spark):
    rng = random.Random(8)
    rows = list(copies(rng, 260))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = brute(rows, 4, 85)
    assert 1 < len(set(wanted.values())) < 200
    found = near_duplicates(docs, width=4, percent=85, block_sets=24)
    assert {r.id: r.component_id for r in found.collect()} == wanted


def test_rows_dealt_follow_the_members(spark, monkeypatch):
    """A class of a large group is dealt once a block, not once a signature."""
    block, seen = 50, {}
    whole = ngrams.kept

    def watched(df, label):
        out = whole(df, label)
        seen[label] = out.count()
        return out

    monkeypatch.setattr(ngrams, "kept", watched)
    rows = list(copies(random.Random(9), 400))
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=4, percent=85, block_sets=block)
    assert found.agg(F.count("*")).first()[0] == 400
    # Links that go on connect; they are not all pairs.
    assert 0 < seen["hub-links"] <= seen["hub-postings"]
    assert seen["last-links"] < 400 * 400 / block
