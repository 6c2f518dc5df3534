"""The prefix trie against a plain one, in one shard and in many."""

import random
from collections import defaultdict
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgersift.llm.prefix_trie import Parentheses, as_rows, keys, least_of_ranges, prefix_trie, shared, turn_paths, with_shared_openings


def plain_trie(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    whole = {}
    for c, ts in own.items():
        h = crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        whole[c] = own.get(base, [])[:h] + ts[h:]
    members = defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    out = []
    below = {}
    for node in sorted(members, key=len, reverse=True):
        words = len(node[-1][1].replace("\x0b", " ").replace("\x0c", " ").split()) if node else 0
        leaves = sum(below[k][0] for k in kids[node]) or 1
        saved = (len(members[node]) - 1) * words + sum(below[k][1] for k in kids[node])
        below[node] = leaves, saved
        ends = ",".join(str(c) for c in members[node] if len(whole[c]) == len(node))
        parent = members[node[:-1]][0] if node else None
        out.append((members[node][0], len(node), parent, len(members[node]), len(kids[node]), leaves, saved, sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def table(spark, rows, extra=""):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string" + extra)


def trie(turns, **options):
    return prefix_trie(as_rows(with_shared_openings(turn_paths(turns))), **options)


def found(turns, **options):
    return sorted((tuple(r) for r in trie(turns, **options).collect()), key=str)


def made(n, seed):
    rng = random.Random(seed)
    texts = ["hello there", "yes", "", "no  way\tthen", "a b c d"]
    rows = []
    for c in range(n):
        for k in range(rng.choice([0, 1, 2, 3, 5, 9])):
            rows.append((c, k, rng.choice(["user", "assistant"]), rng.choice(texts[: 2 + c % 4])))
    return rows


@pytest.mark.parametrize("shard_nodes", [1 << 14, 40, 1])
def test_by_brute_force(spark, shard_nodes):
    rows = made(150, 4)
    # Copies of one conversation, a third of all, and a long one.
    rows += [(1000 + 20 * c, k, "user", f"same {k}") for c in range(60) for k in range(4)]
    rows += [(5000, k, "user", f"long {k % 7}") for k in range(90)]
    rows += [(-7, 0, "user", "minus"), (-27, 0, "user", "minus")]
    assert found(table(spark, rows), shard_nodes=shard_nodes) == plain_trie(rows)


def test_edges(spark):
    rows = [(3, None, None, None), (3, 0, "user", "x"), (3, 0, "user", "x"), (3, 0, "assistant", "x"), (None, 0, "user", "gone"), (4, 1, "user", "é \x0b 中文 z"), (20, 5, None, "t" * 50_000)]
    assert found(table(spark, rows)) == plain_trie(rows)
    clashing = table(spark, [(*r, 1, "p") for r in rows], ", depth int, path string")
    assert found(clashing) == plain_trie(rows)
    assert found(table(spark, [])) == []
    assert found(table(spark, [(None, 1, "user", "x")])) == []
    # Roles and texts that read alike when put together are different turns.
    rows = [(0, 0, "a", "bc"), (20, 0, "ab", "c"), (40, 0, "", "abc")]
    assert found(table(spark, rows)) == plain_trie(rows)


def test_a_conversation_without_turns(spark):
    rows = [(c, 0, "user", "only") for c in range(21, 40)]
    got = found(table(spark, rows))
    assert got == plain_trie(rows)
    assert any(r[1] == 0 and r[7] != sha256(b"").hexdigest() for r in got)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 12), min_size=1, max_size=200))
def test_parentheses(depths):
    bits, open_now = [], 0
    for d in depths:
        while open_now > d:
            bits.append(0)
            open_now -= 1
        bits.append(1)
        open_now += 1
    bits += [0] * open_now
    stack, close = [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            close[stack.pop()] = i
    tree = Parentheses(np.array(bits, np.uint8))
    assert tree.findclose(tree.opens).tolist() == [close[i] for i in tree.opens.tolist()]


def test_deep_and_wide_parentheses():
    for bits in ([1] * 5000 + [0] * 5000, [1] + [1, 0] * 5000 + [0]):
        tree = Parentheses(np.array(bits, np.uint8))
        assert (tree.excess[tree.findclose(tree.opens)] == tree.excess[tree.opens] - 1).all()


def test_small_parts():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 99, 300)
    a = rng.integers(0, 299, 500)
    b = np.minimum(a + rng.integers(1, 200, 500), 300)
    assert least_of_ranges(x, a, b).tolist() == [int(x[i:j].min()) for i, j in zip(a, b, strict=True)]
    p = bytes(range(64))
    assert [shared(p, p), shared(p, p[:32]), shared(p, p[:20] + b"\xff" * 44), shared(b"", p)] == [4, 2, 1, 0]
    assert len(keys(p)) == 5 and keys(p)[:3] == keys(p[:32])
