"""The trie of conversations' openings, as balanced parentheses in shards.

A conversation is the sequence of its turns' digests. Distinct sequences are
dealt out in ranges of their order, so that a shard's sequences form a trie
whose nodes are one string of parentheses, in preorder. A tree of least
excesses over its blocks finds where each node closes; ranks of leaf pairs and
running sums then say what a whole subtree holds. Only the nodes of a shard's
first and last sequence can go on in other shards: these spines, with sums of
what hangs from them, are sequences again and meet in fewer shards, until one
is left.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import md5, sha256
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgersift.llm.common import few, kept

WORD = r"[^\x20\x09-\x0D]+"
WIDTH = 16  # bytes of a turn's digest
NO_ENDS = sha256(b"").hexdigest()
NONE = np.iinfo(np.int64).max
ENTRY = "struct<depth: int, convs: long, low: long, leaves: long, saved: long, children: long, ends: string>"
SUMS = ("convs", "leaves", "saved", "children")
ROWS = f"path binary, words array<int>, entries array<{ENTRY}>"
NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, node_key binary, parent_key binary"


class Parentheses:
    """Balanced parentheses, 1 opens and 0 closes, with the least excess of
    every block and of every pair of blocks, up to the whole."""

    BLOCK = 64

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        excess = np.cumsum(2 * bits.astype(np.int64) - 1)
        blocks = 1 << max(0, (-(-len(bits) // self.BLOCK) - 1).bit_length())
        self.excess = np.full(blocks * self.BLOCK, NONE)
        self.excess[: len(bits)] = excess
        self.least = [self.excess.reshape(blocks, self.BLOCK).min(axis=1)]
        while len(self.least[-1]) > 1:
            self.least.append(self.least[-1].reshape(-1, 2).min(axis=1))
        self.opens = np.flatnonzero(bits)

    def _first(self, block: np.ndarray, after: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """First place in a block, behind ``after``, with an excess of at most
        ``goal``; -1 if there is none."""
        out = np.empty(len(block), np.int64)
        column = np.arange(self.BLOCK)
        for a in range(0, len(block), 4096):
            some = slice(a, a + 4096)
            place = block[some, None] * self.BLOCK + column
            fits = (self.excess[place] <= goal[some, None]) & (place > after[some, None])
            out[some] = np.where(fits.any(axis=1), block[some] * self.BLOCK + fits.argmax(axis=1), -1)
        return out

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """Where what opens at these places closes."""
        goal = self.excess[at] - 1
        close = self._first(at // self.BLOCK, at, goal)
        left = np.flatnonzero(close < 0)
        node, level = at[left] // self.BLOCK, np.zeros(len(left), np.int64)
        found = np.full(len(left), -1)
        climbing = np.arange(len(left))
        for k, least in enumerate(self.least):  # up, until the right neighbour goes low enough
            beside = np.minimum(node[climbing] + 1, len(least) - 1)
            hit = (node[climbing] % 2 == 0) & (node[climbing] + 1 < len(least)) & (least[beside] <= goal[left[climbing]])
            found[climbing[hit]], level[climbing[hit]] = beside[hit], k
            climbing = climbing[~hit]
            node[climbing] //= 2
        for k in range(len(self.least) - 1, 0, -1):  # and down to its first block that does
            down = np.flatnonzero(level == k)
            child = 2 * found[down]
            found[down] = np.where(self.least[k - 1][child] <= goal[left[down]], child, child + 1)
            level[down] = k - 1
        close[left] = self._first(found, at[left], goal[left])
        return close


def least_of_ranges(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Least of values[start:end], from tables of the least of 1, 2, 4 … values."""
    tables = [values]
    while 2 << (len(tables) - 1) <= len(values):
        half = 1 << (len(tables) - 1)
        tables.append(np.minimum(tables[-1][:-half], tables[-1][half:]))
    size = np.frexp((end - start).astype(np.float64))[1] - 1
    out = np.empty(len(start), np.int64)
    for k, own in enumerate(tables):
        some = size == k
        out[some] = np.minimum(own[start[some]], own[end[some] - (1 << k)])
    return out


def shared(a: bytes, b: bytes) -> int:
    """Number of turns two sequences begin with alike."""
    n = min(len(a), len(b)) // WIDTH
    if a[: n * WIDTH] == b[: n * WIDTH]:
        return n
    differ = np.frombuffer(a, np.uint8, n * WIDTH) != np.frombuffer(b, np.uint8, n * WIDTH)
    return int(differ.argmax()) // WIDTH


def keys(path: bytes) -> list[bytes]:
    """A key for each opening of a sequence, the empty one first."""
    so_far, out = md5(), []
    for at in range(0, len(path) + 1, WIDTH):
        out.append(so_far.digest())
        so_far.update(path[at : at + WIDTH])
    return out


class Shard:
    """The trie of sorted rows: (path, words of its turns, entries)."""

    def __init__(self, rows: Iterable[tuple[bytes, list[int], list[dict]]]):
        steps, stack, parent, depth, words, last = [], [], [], [], [], b""
        self.digests: list[bytes] = []
        self.held = {name: [] for name in SUMS} | {"low": []}
        self.ends: dict[int, str] = {}
        self.first = self.last = None
        for path, own, entries in rows:
            same = shared(last, path) if stack else -1
            steps += [len(stack) - 1 - same, len(path) // WIDTH - same]
            del stack[same + 1 :]
            for d in range(same + 1, len(path) // WIDTH + 1):
                parent.append(stack[-1] if stack else -1)
                depth.append(d)
                words.append(own[d - 1] if d else 0)
                self.digests.append(path[(d - 1) * WIDTH : d * WIDTH] if d else b"")
                stack.append(len(parent) - 1)
            for name, values in self.held.items():
                values.extend([NONE if name == "low" else 0] * (len(parent) - len(values)))
            for e in entries:
                k = stack[e["depth"]]
                for name in SUMS:
                    self.held[name][k] += e[name]
                self.held["low"][k] = min(self.held["low"][k], e["low"])
                if e["ends"]:
                    self.ends[k] = e["ends"]
            last = path
            here = (path, own, list(stack))
            self.first, self.last = self.first or here, here
        steps.append(len(stack))
        bits = np.repeat(np.arange(len(steps)) % 2, steps).astype(np.uint8)
        self.parent, self.depth, self.words = (np.array(x, np.int64) for x in (parent, depth, words))
        self.held = {name: np.array(x, np.int64) for name, x in self.held.items()}
        self.tree = Parentheses(bits)

    def all_keys(self) -> list[bytes]:
        """The key of every node, from the digests on the way to it."""
        states: list = []
        for d, up in zip(self.digests, self.parent.tolist(), strict=True):
            state = states[up].copy() if up >= 0 else md5()
            state.update(d)
            states.append(state)
        return [s.digest() for s in states]

    def settle(self, whole: bool) -> None:
        """What the subtrees hold of the nodes that no other shard can have;
        all nodes, if this shard is the ``whole`` trie."""
        n, tree, held = len(self.parent), self.tree, self.held
        self.spine = np.zeros(n, bool)
        if not whole:
            for *_, nodes in (self.first, self.last):
                self.spine[nodes] = True
        own = ~self.spine
        start, opens = np.arange(n), tree.opens
        close = tree.findclose(opens)
        end = start + (close - opens + 1) // 2
        span = lambda x: (s := np.concatenate(([0], np.cumsum(x))))[end] - s[start]
        self.n_convs = span(held["convs"])
        self.low = least_of_ranges(held["low"], start, end)
        self.n_children = held["children"] + np.bincount(self.parent[self.parent >= 0], minlength=n)
        # Pairs () are leaves, but for nodes whose children settled before.
        pair = np.zeros(len(tree.bits), np.int64)
        pair[opens] = (close == opens + 1) & (held["children"] == 0) & own
        rank = np.cumsum(pair)
        self.n_leaves = rank[close] - rank[opens] + pair[opens] + span(held["leaves"])
        self.saved = span(np.where(own, (self.n_convs - 1) * self.words, 0) + held["saved"])

    def nodes(self, keyed: bool) -> pa.Table:
        """Settled nodes. The key of a node is given if ``keyed``, that of its
        parent where the parent is on a spine."""
        own, key_of = np.flatnonzero(~self.spine), self.all_keys() if keyed else []
        parent = self.parent[own]
        inside = (parent >= 0) & ~self.spine[np.maximum(parent, 0)]
        named: dict[int, bytes] = {}
        for path, _, nodes in (self.first, self.last):
            named |= dict(zip(nodes, keys(path), strict=True))
        by_key = [None if i or p < 0 else named[p] for i, p in zip(inside.tolist(), parent.tolist(), strict=True)]
        return pa.table(
            {
                "conv_id": self.low[own],
                "depth": self.depth[own],
                "parent_conv_id": pa.array(np.where(inside, self.low[np.maximum(parent, 0)], 0), mask=~inside),
                "n_convs": self.n_convs[own],
                "n_children": self.n_children[own],
                "n_leaves": self.n_leaves[own],
                "saved_tokens": self.saved[own],
                "ends_sha256": pa.array([self.ends.get(k, NO_ENDS) for k in own.tolist()], pa.string()),
                "node_key": pa.array([key_of[k] for k in own.tolist()] if keyed else [None] * len(own), pa.binary()),
                "parent_key": pa.array(by_key, pa.binary()),
            }
        )

    def spines(self) -> Iterator[dict]:
        """The first and the last sequence, with what hangs from their nodes.
        A node that both have is told with the first."""
        tops = np.flatnonzero(~self.spine & (self.parent >= 0) & self.spine[np.maximum(self.parent, 0)])
        above, n = self.parent[tops], len(self.parent)
        now = {name: self.held[name].copy() for name in (*SUMS, "low")}
        for name, values in (("convs", self.n_convs), ("leaves", self.n_leaves), ("saved", self.saved), ("children", np.ones(n, np.int64))):
            np.add.at(now[name], above, values[tops])
        np.minimum.at(now["low"], above, self.low[tops])
        told: set[int] = set()
        for path, words, nodes in (self.first, self.last) if self.last[0] != self.first[0] else (self.first,):
            entries = [{"depth": d, "ends": self.ends.get(k, ""), **{name: int(v[k]) for name, v in now.items()}} for d, k in enumerate(nodes) if k not in told]
            told.update(nodes)
            yield {"path": path, "words": words, "entries": entries}


def _settled(rows: DataFrame, shards: int, keyed: bool) -> DataFrame:
    """Nodes that settle in shards of sorted rows, and rows of the spines."""
    whole = shards == 1
    entry = pa.struct([("depth", pa.int32()), *((x, pa.int64()) for x in ("convs", "low", "leaves", "saved", "children")), ("ends", pa.string())])
    row = pa.schema([("path", pa.binary()), ("words", pa.list_(pa.int32())), ("entries", pa.list_(entry))])

    def work(batches):
        def stream():
            for batch in batches:
                for r in batch.to_pylist():
                    yield bytes(r["path"]), r["words"], r["entries"]

        shard = Shard(stream())
        if shard.first is None:
            return
        shard.settle(whole)
        nodes = shard.nodes(keyed)
        for field in row:
            nodes = nodes.append_column(field.name, pa.nulls(nodes.num_rows, field.type))
        yield from nodes.to_batches()
        if not whole:
            spines = pa.Table.from_pylist(list(shard.spines()), row)
            yield from pa.table([pa.nulls(spines.num_rows, f.type) for f in nodes.schema][: -len(row)] + spines.columns, names=nodes.column_names).to_batches()

    dealt = rows.coalesce(1) if whole else rows.repartitionByRange(shards, "path")
    return dealt.sortWithinPartitions("path").mapInArrow(work, f"{NODES}, {ROWS}")


def prefix_trie(paths: DataFrame, shard_nodes: int = 1 << 14) -> DataFrame:
    """One row for each node of the trie of some sequences.

    Takes conv_id, path (digests of 16 bytes, in a row, as hex) and words (a
    number for each turn), one row for each conversation. Gives conv_id, the
    least member; depth; parent_conv_id, null for the root; n_convs;
    n_children; n_leaves; saved_tokens; ends_sha256. A node's members are the
    conversations that begin with it; saved_tokens sums (members - 1) * words
    of its last turn over its subtree. No rows, no nodes. A shard has some
    ``shard_nodes`` nodes, or eight times the longest sequence.
    """
    ending = _ends(paths)
    whole = paths.groupBy(F.md5("path").alias("key")).agg(F.min(F.struct("path", "words")).alias("one"))
    entry = F.struct(
        F.size("one.words").alias("depth"), F.col("n").alias("convs"), "low", *(F.lit(0).cast("long").alias(x) for x in ("leaves", "saved", "children")), F.col("ends")
    )
    rows = kept(whole.join(ending, "key").select(F.unhex("one.path").alias("path"), F.col("one.words").alias("words"), F.array(entry).cast(f"array<{ENTRY}>").alias("entries")), "trie-rows")
    level, found = 0, []
    while True:
        total, longest = rows.agg(F.sum(F.size("words") + 1), F.max(F.size("words") + 1)).first()
        if not total:
            break
        shards = -(-total // max(shard_nodes, 8 * longest))
        out = kept(_settled(rows, shards, keyed=level > 0), f"trie-{level}")
        found.append(out.where(F.col("conv_id").isNotNull()).drop("path", "words", "entries"))
        if shards == 1:
            break
        rows, level = out.where(F.col("path").isNotNull()).select("path", "words", "entries"), level + 1
    told = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    spark = paths.sparkSession
    nodes = found[0] if found else spark.createDataFrame([], NODES)
    if level:
        above = found[1]
        for more in found[2:]:
            above = above.unionByName(more)
        above = kept(above, "trie-spines")
        named = few(above.select(F.col("node_key").alias("parent_key"), F.col("conv_id").alias("named")))
        nodes = nodes.unionByName(above).join(named, "parent_key", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "named"))
    return nodes.select(*told)


def _ends(paths: DataFrame) -> DataFrame:
    """For each distinct sequence: key, n conversations, the least of them, and
    the digest of all, ascending. Ids are dealt by their order, so that those of
    one sequence lie in many tasks; a digest reads strings of a batch's ids one
    after the other and holds none."""

    def told(rows, names):
        columns = list(zip(*rows, strict=True)) or [()] * 4
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=names)

    def strings(batches):
        for batch in batches:
            key, conv = batch["key"].to_pylist(), batch["conv_id"].to_pylist()
            edges = [k for k in range(1, len(key)) if key[k] != key[k - 1]]
            out = [(key[a], conv[a], b - a, ",".join(map(str, conv[a:b]))) for a, b in pairwise([0, *edges, len(key)]) if a < b]
            yield told(out, ["key", "low", "n", "said"])

    def digests(batches):
        key, low, n, state = None, None, 0, None
        made: list[tuple] = []
        for batch in batches:
            for r in zip(*(batch[c].to_pylist() for c in ("key", "low", "n", "said")), strict=True):
                if r[0] != key:
                    if key is not None:
                        made.append((key, low, n, state.hexdigest()))
                    key, low, n, state = r[0], r[1], 0, sha256()
                state.update((("," if n else "") + r[3]).encode())
                n += r[2]
            yield told(made, ["key", "low", "n", "ends"])
            made = []
        if key is not None:
            yield told([(key, low, n, state.hexdigest())], ["key", "low", "n", "ends"])

    own = paths.select(F.md5("path").alias("key"), "conv_id")
    said = own.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(strings, "key string, low long, n long, said string")
    return said.repartition("key").sortWithinPartitions("key", "low").mapInArrow(digests, "key string, low long, n long, ends string")


def turn_paths(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each conversation: conv_id and turns, an array of (digest,
    words) in order.

    Rows are ordered by turn, nulls first, then role, then text; repeated rows
    are turns of their own. A null role or text is empty. Rows with a null id
    belong to no conversation and are left out. Other columns are not used. A
    conversation is held as its digests, not as its texts.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), said(role_col).alias("role"), said(text_col).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    digest = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"))
    placed = rows.select("conv_id", F.row_number().over(order).alias("place"), digest.alias("digest"), F.regexp_count("text", F.lit(WORD)).alias("words"))
    one = F.sort_array(F.collect_list(F.struct("place", "digest", "words")))
    return placed.groupBy("conv_id").agg(F.transform(one, lambda x: F.struct(x["digest"].alias("digest"), x["words"].alias("words"))).alias("turns"))


def with_shared_openings(paths: DataFrame, period: int = 20, most: int = 4) -> DataFrame:
    """Conversations whose first h turns are those of conversation c - c %
    period, as far as it has them; the rest are their own after the first h.
    h is crc32 of the id in digits, modulo ``most``. A conversation may be left
    without turns. What is handed on is less than ``most`` turns, to less than
    twice ``period`` conversations."""
    c = F.col("conv_id")
    lead = paths.where(c % period == 0).select(c.alias("base"), F.slice("turns", 1, most - 1).alias("lead"))
    h = (F.crc32(c.cast("string").cast("binary")) % most).cast("int")
    own = paths.withColumn("base", c - c % period).withColumn("h", h).join(lead, "base", "left")
    taken = F.slice(F.coalesce("lead", F.expr("slice(turns, 1, 0)")), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return own.select("conv_id", F.concat(taken, rest).alias("turns"))


def as_rows(paths: DataFrame) -> DataFrame:
    """What ``prefix_trie`` takes, from conversations with their turns."""
    path = F.array_join(F.transform("turns", lambda x: x["digest"]), "")
    return paths.select("conv_id", path.alias("path"), F.transform("turns", lambda x: x["words"]).alias("words"))
