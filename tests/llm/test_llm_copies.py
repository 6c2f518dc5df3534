"""Edge cases of the operators on copies: passages, strings, sets, vectors."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgersift.llm.graph import components
from ledgersift.llm.induce import LetterQueues, suffix_order
from ledgersift.llm.ngrams import Likeness, near_duplicates, shingle_sets, tree_links
from ledgersift.llm.recompress import dedup_passages, open_windows, symbols
from ledgersift.llm.substrings import anchors, dedup_substrings, sliding_least
from ledgersift.llm.vectors import audit_recall, dedup_vectors, near_vectors


def documents(spark, rows, extra=""):
    return spark.createDataFrame(rows, f"doc_id long, text string{extra}")


# Passages.


def brute_passages(rows, width):
    first: dict = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    key = lambda i: -(2**63) if i is None else i
    for i, w in split:
        for k in range(len(w) - width + 1):
            h = tuple(w[k : k + width])
            first[h] = min(first.get(h, key(i)), key(i))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < key(i):
                gone[k : k + width] = [True] * width
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=str)


def varied(rng, pool, n):
    words: list[str] = []
    while len(words) < n:
        words += rng.choice(pool) if rng.random() < 0.4 else [rng.choice("abcdefgh")]
    return " ".join(words[:n])


def test_passages_by_brute_force(spark):
    rng = random.Random(2)
    pool = [[rng.choice("abcd") for _ in range(rng.randrange(8, 40))] for _ in range(6)]
    rows = [(i, varied(rng, pool, rng.randrange(0, 120))) for i in range(60)]
    rows += [(61, "x " * 90), (62, "x " * 70), (63, "x " * 9), (64, None), (65, ""), (66, rows[5][1]), (66, rows[5][1]), (None, rows[7][1])]
    for width, rounds in ((10, 2), (25, 4)):
        found = dedup_passages(documents(spark, rows), width=width, rounds=rounds)
        got = sorted([(r.doc_id, r.n_words, r.n_removed, r.text or "") for r in found.collect()], key=str)
        assert got == brute_passages(rows, width)


def test_passages_clashes_and_empty(spark):
    docs = documents(spark, [(2, "a b", "q"), (1, None, "r")], ", n_words string")
    found = {r.doc_id: r for r in dedup_passages(docs).collect()}
    assert found[2].n_words == 2 and found[1].text is None and found[1].n_words == 0
    assert dedup_passages(docs.limit(0)).collect() == []


@given(st.lists(st.integers(0, 3), min_size=30, max_size=80), st.lists(st.integers(0, 3), max_size=20), st.lists(st.integers(0, 3), max_size=20))
@settings(max_examples=150, deadline=None)
def test_equal_parts_have_equal_inner_symbols(part, before, after):
    """What is decided within a part is the same wherever the part stands."""
    seen = []
    for left, right in (([], after), (before, []), (after, before)):
        words = np.array([*left, *part, *right], np.uint64)
        first = np.array([0, len(words)])
        sym, lo, hi = symbols(words, first, 3)
        at = len(left)
        inner = (lo >= at + 1) & (hi <= at + len(part) - 1)
        seen.append(sorted(zip((lo[inner] - at).tolist(), (hi[inner] - at).tolist(), sym[inner].tolist())))
        assert open_windows(first, lo, hi, np.zeros(len(sym), bool), 10).sum() == max(0, len(words) - 9)
    assert seen[0] == seen[1] == seen[2]


# Strings.


def suffixes(text, cap):
    order = sorted(range(len(text)), key=lambda i: text[i:])
    lcp = [0]
    for a, b in zip(order, order[1:]):
        k = 0
        while k < cap and a + k < len(text) and b + k < len(text) and text[a + k] == text[b + k]:
            k += 1
        lcp.append(k)
    return order, lcp


@given(st.lists(st.integers(0, 3), min_size=1, max_size=120), st.sampled_from([64, 1 << 20]))
@settings(max_examples=200, deadline=None)
def test_suffix_order_by_brute_force(text, budget):
    order, lcp = suffix_order(np.array(text), 500, budget)
    assert (order.tolist(), lcp.tolist()) == suffixes(text, 500)


def test_suffix_order_of_a_long_repeating_text():
    text = np.array(([1, 2, 1, 3] * 700 + [2, 2, 2] * 900 + [1] * 3000) * 2)
    order, lcp = suffix_order(text, 50, 4096)
    words = [tuple(text[i : i + 50].tolist()) for i in order]
    assert words == sorted(words) and sorted(order.tolist()) == list(range(len(text)))
    for k in range(1, len(order), 97):
        same = next((j for j, (x, y) in enumerate(zip(words[k - 1], words[k])) if x != y), min(len(words[k - 1]), len(words[k])))
        assert lcp[k] == same


def test_queues_spill_and_keep_order():
    queues = LetterQueues(2, budget=100)
    for k in range(50):
        queues.push(k % 2, np.arange(10) + 10 * k, np.full(10, k))
    assert queues.file is not None
    got = np.concatenate([p for p, _ in queues.pull(1)])
    assert got.tolist() == [x + 10 * k for k in range(1, 50, 2) for x in range(10)]


@given(st.lists(st.integers(0, 9), min_size=1, max_size=60), st.integers(1, 12))
@settings(max_examples=100, deadline=None)
def test_sliding_least(values, width):
    got = sliding_least(np.array(values, np.uint64), width).tolist()
    assert got == [min(values[k : k + width]) for k in range(len(values) - width + 1)]


def test_every_string_has_one_anchor():
    rng = random.Random(4)
    data = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 300))) for _ in range(8)] + [b"a" * 200]
    text, keys, a, b = anchors(data, 40)
    for k, d in enumerate(data):
        own = [(x, y) for t, x, y in zip(text, a, b) if t == k]
        assert [s for x, y in own for s in range(x, y)] == list(range(max(0, len(d) - 39)))


def brute_strings(rows, length):
    seen: dict = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for _, d in data:
        for k in range(len(d) - length + 1):
            seen[d[k : k + length]] = seen.get(d[k : k + length], 0) + 1
    out = []
    for i, d in data:
        gone = bytearray(len(d))
        for k in range(len(d) - length + 1):
            if seen[d[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        runs = sum(1 for k in range(len(d)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(d), sum(gone), runs, bytes(c for c, g in zip(d, gone) if not g)))
    return sorted(out, key=str)


def test_strings_by_brute_force(spark):
    rng = random.Random(6)
    letters = "abcé"
    pool = ["".join(rng.choice(letters) for _ in range(rng.randrange(20, 90))) for _ in range(5)]
    make = lambda: "".join(rng.choice(pool) if rng.random() < 0.3 else "".join(rng.choice(letters) for _ in range(25)) for _ in range(rng.randrange(0, 8)))
    rows = [(i, make()) for i in range(40)]
    rows += [(50, "ab" * 120), (51, "z" * 90), (52, None), (53, ""), (54, rows[3][1]), (54, rows[3][1]), (None, "q" * 30)]
    for length, shard in ((40, 4 << 20), (30, 500)):
        found = dedup_substrings(documents(spark, [(*r, 1) for r in rows], ", n_bytes int"), length=length, shard_bytes=shard, budget=1000)
        got = sorted([(r.doc_id, r.n_bytes, r.n_removed, len(r.removed_spans), bytes(r.kept_bytes)) for r in found.collect()], key=str)
        assert got == brute_strings(rows, length)
    assert dedup_substrings(documents(spark, [])).collect() == []


# Sets.


def brute_sets(rows, width, percent):
    def grams(t):
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode().split()
        return {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()

    sets = [(i, grams(t)) for i, t in rows]
    label = list(range(len(sets)))
    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                old, new = label[x], label[y]
                label = [new if v == old else v for v in label]
    out = []
    for k, (i, s) in enumerate(sets):
        group = [sets[j][0] for j in range(len(sets)) if label[j] == label[k] and sets[j][0] is not None]
        out.append((i, len(s), min(group) if group else None))
    return sorted(out, key=str)


def near(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = rng.choice("uvwxyz")
    return " ".join(words)


def test_sets_by_brute_force(spark):
    rng = random.Random(8)
    bases = [[rng.choice("abcdefghij") + rng.choice("klmnop") for _ in range(rng.randrange(5, 90))] for _ in range(8)]
    rows = [(i, near(rng, rng.choice(bases), rng.randrange(0, 4))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " \n"), (203, "One"), (204, "one"), (205, "one two three"), (206, "one two three"), (207, "a b c d " * 400), (150, rows[0][1]), (None, rows[1][1])]
    for width, percent, block in ((4, 85, 512), (4, 85, 3), (5, 80, 16)):
        found = near_duplicates(documents(spark, rows), width=width, percent=percent, block_sets=block)
        got = sorted([(r.id, r.n_shingles, r.component_id) for r in found.collect()], key=str)
        assert got == brute_sets(rows, width, percent)
    assert near_duplicates(documents(spark, [])).collect() == []


@given(st.lists(st.sets(st.integers(0, 14), min_size=1), max_size=12), st.lists(st.sets(st.integers(0, 14), min_size=1), min_size=1, max_size=6), st.sampled_from([60, 85]))
@settings(max_examples=200, deadline=None)
def test_tree_by_brute_force(stored, asked, percent):
    arrays = lambda sets: [np.array(sorted(s), np.uint64) for s in sets]
    sizes = lambda sets: np.array([len(s) for s in sets], np.int64)
    apart = np.ones((len(stored), len(asked)), bool)
    got = tree_links(arrays(stored), arrays(asked), sizes(stored), sizes(asked), apart, Likeness(percent))
    assert sorted(got) == [(i, j) for i, a in enumerate(stored) for j, b in enumerate(asked) if 100 * len(a & b) >= percent * len(a | b)]


@given(st.integers(1, 400), st.sampled_from([60, 80, 85, 90]))
def test_signatures_suffice(n, percent):
    """Similar sets share at least one signature, in the worst of cases."""
    like = Likeness(percent)
    for m in range(like.least(n), n + 1):
        need = like.need(n, m)
        if need > m:
            continue
        # Shown: the least hashes. Common ones come last, and their order is free.
        both = min(like.shown(n) - (n - need), like.shown(m) - (m - need), need)
        assert both >= 1
        assert int(like.signatures(np.int64(n))) > like.shown(n) - both
        assert int(like.signatures(np.int64(m))) > like.shown(m) - both


def test_sets_of_short_texts():
    values, first = shingle_sets(["a b c d e", "A B", "", None, "b b b b b b"], 4)
    assert np.diff(first).tolist() == [2, 1, 0, 0, 1]


def test_components_of_a_long_chain(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 102), (7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(41)} | {100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# Vectors.


def test_vectors_by_brute_force(spark):
    rng = np.random.default_rng(9)
    rows, x = [], []
    for i in range(600):
        base = x[rng.integers(len(x))] + rng.normal(0, 0.02, 16) if x and rng.random() < 0.4 else rng.normal(0, 1, 16)
        x.append(base)
        rows.append((i, [float(v) for v in base], int(i % 3)))
    rows += [(700, rows[4][1], 1), (701, rows[4][1], 1), (702, rows[4][1], None), (703, None, 1), (704, [], 1), (705, [0.0] * 16, 1), (706, [float("nan")] + [1.0] * 15, 1), (707, [None] + [1.0] * 15, 1), (708, rows[4][1][:8], 1), (None, rows[4][1], 1)]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, kept int")
    bad = {703, 704, 705, 706, 707, None}
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, lab in rows if i not in bad and lab is not None}
    label = {i: lab for i, _, lab in rows}
    want = {i: {j for j in unit if j != i and label[i] == label[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98} for i in unit}
    found = {r.vec_id: r for r in dedup_vectors(table, shard_rows=60).collect()}
    assert len(found) == len(rows)
    total = sum(map(len, want.values()))
    got = sum(found[i].n_links for i in want)
    assert total > 100 and 0.9 * total <= got <= total
    assert all(found[i].n_links == 0 and found[i].kept for i in bad - {None})
    assert found[702].n_links == 0 and found[701].component_id <= 4
    assert all(r.kept == (r.component_id == r.vec_id) for i, r in found.items() if i is not None)
    links, members = near_vectors(table, shard_rows=60)
    assert audit_recall(table, links, members) >= 0.9
    assert dedup_vectors(table.limit(0)).collect() == []
