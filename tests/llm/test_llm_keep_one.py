"""Which rows stay of near copies: decided for each row, ids null or repeated."""

import random
from collections import Counter

from ledgersift.llm.ngrams import keep_one, near_duplicates
from test_llm_copies import brute_sets, documents, near


def words(rng, n=60):
    return [rng.choice("abcdefghij") + rng.choice("klmnopqrst") + rng.choice("uvwxyz") for _ in range(n)]


def brute_keep(rows, width, percent):
    """How many rows of each text stay, and the least id of each component."""
    keyed = [(k, t) for k, (_, t) in enumerate(rows)]
    component = {k: c for k, _, c in brute_sets(keyed, width, percent)}
    empty = {k for k, n, _ in brute_sets(keyed, width, percent) if n == 0}
    groups: dict = {}
    for k in range(len(rows)):
        if k not in empty:
            groups.setdefault(component[k], []).append(k)
    ids = [min((rows[k][0] for k in g if rows[k][0] is not None), default=None) for g in groups.values()]
    return Counter(ids), [rows[k] for k in empty], [{rows[k] for k in g} for g in groups.values()]


def test_clean_documents_stay_whatever_their_id(spark):
    rng = random.Random(3)
    base = [words(rng) for _ in range(12)]
    rows = [(None, " ".join(b)) for b in base[:5]]  # no id, all different
    rows += [(7, " ".join(b)) for b in base[5:8]]  # one id, all different
    rows += [(k, near(rng, base[8], 1)) for k in (20, 21, 20)] + [(None, near(rng, base[8], 1))]
    rows += [(None, " ".join(base[9]))] * 3 + [(None, near(rng, base[9], 1))]
    rows += [(30, " ".join(base[10]))] * 2
    rows += [(40, ""), (40, ""), (None, None), (None, " \n"), (41, None)]
    for width in (4, 5):
        found = [(r.doc_id, r.text) for r in keep_one(documents(spark, [(*r, 1) for r in rows], ", _mark int"), width=width, percent=70).collect()]
        ids, empty, groups = brute_keep(rows, width, 70)
        said = [r for r in found if (r[1] or "").split()]
        assert Counter(i for i, _ in said) == ids
        assert sorted((r for r in found if not (r[1] or "").split()), key=str) == sorted(empty, key=str)
        assert all(sum(r in g for r in said) == 1 for g in groups)
        again = keep_one(documents(spark, rows[::-1]), width=width, percent=70).collect()
        assert sorted(map(tuple, again), key=str) == sorted(found, key=str)
    assert keep_one(documents(spark, [])).collect() == []


def test_near_copies_without_an_id_link(spark):
    """A chain 1 - null - null - 2 whose middle rows are no exact copies."""
    rng = random.Random(5)
    text = words(rng, 80)
    chain = []
    for i in (1, None, None, 2):
        chain.append((i, " ".join(text)))
        text = text[1:] + words(rng, 1)
        text = text[1:] + words(rng, 1)
    rows = [*chain, (None, " ".join(words(rng)))]
    for block in (512, 2):
        found = near_duplicates(documents(spark, rows), width=4, percent=90, block_sets=block)
        got = sorted([(r.id, r.n_shingles, r.component_id) for r in found.collect()], key=str)
        assert got == brute_sets(rows, 4, 90)
        assert [c for _, _, c in got].count(1) == 4
