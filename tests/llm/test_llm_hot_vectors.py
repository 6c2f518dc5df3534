"""Large groups of near copies: links are whole, and no task holds a group."""

import numpy as np

from ledgersift.llm import vectors
from ledgersift.llm.vectors import dedup_vectors, graph_pairs, unit


def groups(seed, sizes, dim=64, noise=0.008):
    rng = np.random.default_rng(seed)
    return unit(np.concatenate([rng.normal(size=dim) / dim**0.5 + rng.normal(0, noise, (n, dim)) for n in sizes]).tolist())


def test_groups_larger_than_the_candidates_are_whole():
    for seed in range(2):
        x = groups(seed, [250, 250, 250, 250] + [1] * 50)
        i, j = graph_pairs(x, 0.98)
        a, b = np.nonzero(np.triu(x @ x.T >= 0.98, 1))
        assert sorted(zip(i.tolist(), j.tolist())) == list(zip(a.tolist(), b.tolist()))


def test_a_group_larger_than_a_shard(spark):
    x = groups(4, [300, 80] + [1] * 120, dim=16, noise=0.025)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)] + [(900, x[3].tolist(), 1)]
    full = np.concatenate((x, x[3:4]))
    alike = full @ full.T >= 0.98
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: r.n_links for r in dedup_vectors(table, shard_rows=40, least_recall=1.0).collect()}
    ids = [r[0] for r in rows]
    assert [found[i] for i in ids] == [int(alike[k].sum()) - 1 for k in range(len(ids))]


def test_vectors_of_a_part_are_looked_up_side_by_side(monkeypatch):
    """By the graph alone, some hundred vectors a search: one by one they took
    most of the operator's time."""
    rng = np.random.default_rng(6)
    x = groups(6, [300, 40] + [1] * 500)
    x = unit(np.concatenate((x, x[340:] + rng.normal(0, 0.008, (500, 64)))).tolist())
    a, b = np.nonzero(np.triu(x @ x.T >= 0.98, 1))
    calls, search = [], vectors.in_range

    def spy(*args):
        calls.append(1)
        return search(*args)

    def never(*_):
        raise AssertionError("compared without the graph")

    monkeypatch.setattr(vectors, "in_range", spy)
    monkeypatch.setattr(vectors, "exact_pairs", never)
    i, j = graph_pairs(x, 0.98)
    assert sorted(zip(i.tolist(), j.tolist())) == list(zip(a.tolist(), b.tolist()))
    assert len(calls) < len(x) / 100


def test_a_round_of_few_nodes_finds_the_same():
    x = groups(7, [200, 30] + [1] * 100)
    edges, start = vectors.flat_graph(x), np.arange(len(x))[:, None]
    whole, cut = (set(zip(*(v.tolist() for v in vectors.in_range(x, edges, start, x, 0.9, at_once=k)))) for k in (8192, 300))
    assert whole >= set(zip(*(v.tolist() for v in np.nonzero(x @ x.T >= 0.98)))) and whole == cut
