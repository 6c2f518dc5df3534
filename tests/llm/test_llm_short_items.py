"""Benchmark items: short ones unchanged at word edges, and nothing missed."""

import random
import re

from ledgersift.llm.contamination import Finder, best_match, budget, find_benchmark, plain
from ledgersift.llm.queries import QUERIES


def test_short_items_stand_between_word_edges(spark):
    bench = spark.createDataFrame([(1, "What is 2+2?"), (2, "Paris"), (3, "  "), (4, "PARIS "), (5, ""), (None, "rome")], "item_id long, text string")
    rows = ["So: what  is\n2+2? Four", "what is 22", "Comparisons of cities", "(Paris)", "parish, then paris", None, "Rome", "paris"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.doc_id: [tuple(h) for h in r.benchmark_hits] for r in find_benchmark(docs, bench).collect()}
    assert found[0] == [(1, 0, len("so: what is 2+2?"))]
    assert found[1] == found[2] == found[5] == found[6] == []
    assert found[3] == [(2, 0, 6), (4, 0, 6)]
    assert found[4] == [(2, 0, 18), (4, 0, 18)]
    assert found[7] == [(2, 0, 5), (4, 0, 5)]


def test_short_items_by_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        items = [(k, plain("".join(rng.choice("ab ") for _ in range(rng.randrange(1, 7)))) or "a") for k in range(4)]
        text = plain("".join(rng.choice("ab ") for _ in range(40)))
        got = Finder(items, 0.5, 40).find(text)
        wanted = [(k, 0) for k, item in items if re.search(rf"(?<![ab]){item}(?![ab])", text)]
        assert [(k, d) for k, d, _ in got] == wanted
        assert all(text[:end].endswith(dict(items)[k]) for k, _, end in got)


def test_no_item_of_the_table_is_missed(spark, sf):
    """Every item against every text, without pieces."""
    items = [(r.item_id, plain(r.text)) for r in spark.read.parquet(f"{sf['sf0.001']}/benchmark.parquet").collect()]
    texts = {r.doc_id: plain(r.text) for r in spark.read.parquet(f"{sf['sf0.001']}/documents.parquet").collect()}
    found = {r.doc_id: list(r.item_ids) for r in QUERIES["op9_decontamination"](spark, sf["sf0.001"]).collect()}
    assert found.keys() == texts.keys()
    for doc_id, text in texts.items():
        near = [i for i, item in items if best_match(item, text)[0] <= budget(len(item), 0.08)]
        assert sorted(found[doc_id]) == sorted(near)
