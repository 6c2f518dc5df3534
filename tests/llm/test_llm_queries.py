"""The operators' queries against SQL, over whole tables."""

import pytest

from compare import assert_same, connect
from ledgersift.llm.oracle import ORACLE
from ledgersift.llm.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf["sf0.01"])


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(name, spark, sf, con):
    assert assert_same(QUERIES[name](spark, sf["sf0.01"]), con, ORACLE[name]) > 0


def test_a_query_each():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_language_of_held_out_documents(spark, sf):
    found = QUERIES["op7_language_id"](spark, sf["sf0.01"])
    docs = spark.read.parquet(f"{sf['sf0.01']}/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 100
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_pieces_give_texts_back(spark, sf):
    found = QUERIES["op2_sentencepiece"](spark, sf["sf0.01"])
    assert found.count() == found.where("round_trip and n_pieces > 0").count() == 1000


def test_token_counts_by_brute_force(spark, sf):
    from ledgersift.llm.wordpiece import VOCABULARY
    from test_llm_texts import greedy, vocabulary

    initial, inner = vocabulary(VOCABULARY)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf['sf0.001']}/documents.parquet").collect()}
    seen: dict = {}
    for r in QUERIES["op8_token_counts"](spark, sf["sf0.001"]).collect():
        words = texts[r.doc_id].encode().split()
        assert r.n_words == len(words)
        for w in words:
            if w not in seen:
                seen[w] = greedy(w, initial, inner)
        assert r.n_tokens == sum(seen[w] for w in words)


def test_decontamination_by_brute_force(spark, sf):
    """Whole items, which is what the table holds, are found; nothing else is."""
    from ledgersift.llm.contamination import best_match, budget, plain

    items = [(r.item_id, plain(r.text)) for r in spark.read.parquet(f"{sf['sf0.001']}/benchmark.parquet").collect()]
    texts = {r.doc_id: plain(r.text) for r in spark.read.parquet(f"{sf['sf0.001']}/documents.parquet").collect()}
    for r in QUERIES["op9_decontamination"](spark, sf["sf0.001"]).collect():
        text = texts[r.doc_id]
        exact = [i for i, t in items if t in text]
        assert set(exact) <= set(r.item_ids)
        assert r.contaminated == bool(r.item_ids)
        for i, d in zip(r.item_ids, r.distances):
            item = dict(items)[i]
            assert best_match(item, text)[0] == d <= budget(len(item), 0.08)
