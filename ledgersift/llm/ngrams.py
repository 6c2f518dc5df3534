"""Documents whose word n-gram sets are nearly equal, by a prefix-tree join.

Equal sets are one class. A class shows the part of its set with the least
hashes; two sets that are similar enough share a known number of those. How
often each is shown is counted over the corpus, and the rarest of them become
signatures: similar sets have a signature in common. Of the classes that meet
another by a signature, whole sets are counted and signed in the same way:
sets of which too little occurs twice go, the others meet by their rarest.

Classes with a common signature meet in groups. In a group the sets are
ordered by one order of all their n-grams, common ones first, and stored in a
tree. Walking the tree, the overlaps with all sets on the other side are
carried along, so that equal beginnings are counted once; a subtree is left when
too few n-grams remain for any of them.

Groups connected by signatures are mostly small and meet as a whole. In a group
too large for one task each signature's classes first meet the one among them
that shares most, their hub. What is then connected needs no more comparison.
Where classes of one signature are still apart, those of all signatures of the
same hub meet each other once, in blocks; of what is found there, only as many
links go on as connect the same classes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersift.llm.blocks import pack, tally, told
from ledgersift.llm.common import STEP, U64, Words, few, kept, map_batches, mix, prefix_hash, span_hash, window_hashes, without
from ledgersift.llm.graph import components, roots


@dataclass(frozen=True)
class Likeness:
    """Linked: 100 * intersection >= percent * union."""

    percent: int = 85

    def least(self, n):
        """Least overlap of a set of n with any set linked to it."""
        return -(-self.percent * n // 100)

    def need(self, n, m):
        """Least overlap of linked sets of n and m."""
        return -(-self.percent * (n + m) // (100 + self.percent))

    def shown(self, n):
        """How many of n hashes, the least ones, are shown."""
        return np.minimum(n, 2 * (n - self.least(n)) + 1)

    def signatures(self, n):
        """How many of the shown hashes, in any order common to all, suffice."""
        smaller = self.least(n)
        return self.shown(n) - np.minimum(self.shown(n), smaller - self.least(smaller) + 1) + 1


def shingle_sets(texts: list, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, first): each text's distinct hashes in order, one text after
    the other. A text with fewer than ``width`` words has one, its words."""
    words = Words(texts, lower=True)
    hashes, start = window_hashes(words.hashes, words.first, width)
    text = np.searchsorted(words.first, start, "right") - 1
    n = words.counts()
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        sums = prefix_hash(mix(words.hashes), STEP)
        own = span_hash(sums, words.first[short], words.first[short + 1], STEP)
        hashes, text = np.concatenate((hashes, own)), np.concatenate((text, short))
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    hashes, text = hashes[new], text[new]
    return hashes, np.searchsorted(text, np.arange(len(n) + 1))


def classes_of(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A number for each set; equal sets have equal numbers."""
    sums = np.concatenate((np.zeros(1, U64), np.cumsum(mix(values ^ U64(STEP)), dtype=U64)))
    other = np.concatenate((np.zeros(1, U64), np.cumsum(mix(mix(values)), dtype=U64)))
    a, b = sums[first[1:]] - sums[first[:-1]], other[first[1:]] - other[first[:-1]]
    return (mix(mix(a + U64(1)) + b) + np.diff(first).astype(U64)).astype(np.int64)


def tree_links(stored: list[np.ndarray], asked: list[np.ndarray], sizes: np.ndarray, asked_sizes: np.ndarray, apart: np.ndarray, like: Likeness) -> list[tuple[int, int]]:
    """(stored, asked) pairs that are linked, among those that ``apart`` allows.

    Sizes are of the whole sets; the arrays may leave out n-grams that only
    one set has.
    """
    every = np.concatenate([*stored, *asked]) if stored or asked else np.zeros(0, U64)
    vocabulary, inverse, seen = np.unique(every, return_inverse=True, return_counts=True)
    rank = np.empty(len(vocabulary), np.int64)
    rank[np.argsort(-seen, kind="stable")] = np.arange(len(vocabulary))
    use = seen > 1
    ranks, at = rank[inverse], 0
    parts = []
    for values in [*stored, *asked]:
        own = ranks[at : at + len(values)]
        parts.append(np.sort(own[use[inverse[at : at + len(values)]]]))
        at += len(values)
    paths, other = parts[: len(stored)], parts[len(stored) :]
    held = np.zeros((int(use.sum()), len(asked)), np.uint8)
    for k, own in enumerate(other):
        held[own, k] = 1
    # Lexicographic order of the paths, and what each shares with the one before.
    order = sorted(range(len(paths)), key=lambda k: paths[k].astype(">i8").tobytes())
    common = [0]
    for a, b in zip(order, order[1:], strict=False):
        n = min(len(paths[a]), len(paths[b]))
        differ = np.flatnonzero(paths[a][:n] != paths[b][:n])
        common.append(int(differ[0]) if len(differ) else n)
    found = []
    stack = [(0, np.zeros(len(asked), np.int64))]
    skip_depth = None  # set while in a subtree that was left
    for i, k in enumerate(order):
        path = paths[k]
        if skip_depth is not None:
            if common[i] >= skip_depth:
                continue
            skip_depth = None
        while stack[-1][0] > common[i]:
            stack.pop()
        # Nodes of this path: where later paths branch off.
        depth, overlap = stack[-1]
        branches, low, j = [], len(path), i + 1
        while j < len(order) and common[j] > depth:
            if common[j] < low:
                low = common[j]
                branches.append((low, j))
            j += 1
        for to, _ in reversed(branches):
            overlap = overlap + held[path[depth:to]].sum(axis=0, dtype=np.int64)
            depth = to
            stack.append((depth, overlap))
            end = i + 1
            while end < len(order) and common[end] >= depth:
                end += 1
            below = order[i:end]
            rest = max(len(paths[x]) for x in below) - depth
            least = like.need(asked_sizes, int(sizes[below].min()))
            if (overlap + rest < least).all():
                skip_depth = depth
                break
        if skip_depth is not None:
            continue
        could = (overlap + len(path) - depth >= like.need(asked_sizes, int(sizes[k]))) & apart[k]
        who = np.flatnonzero(could)
        if len(who):
            total = overlap[who] + held[np.ix_(path[depth:], who)].sum(axis=0, dtype=np.int64)
            found += [(k, int(q)) for q in who[total >= like.need(asked_sizes[who], int(sizes[k]))]]
    return found


PAIR = "a long, b long"
MEET = T.StructType([T.StructField(n, T.LongType()) for n in ("g", "h", "k", "side", "cls", "component", "n")] + [T.StructField("values", T.BinaryType())])


def _meet(like: Likeness):
    """Links of the classes of one block: as many as connect what is linked."""

    def work(rows: pa.Table) -> pa.Table:
        side = np.asarray(rows["side"])
        cls, part, size = (np.asarray(rows[c]) for c in ("cls", "component", "n"))
        values = [np.frombuffer(v, U64) for v in rows["values"].to_pylist()]
        a = np.flatnonzero(side != 1)  # 0: on both sides, 1 asked, 2 stored
        b = np.flatnonzero(side != 2)
        apart = part[a][:, None] != part[b][None, :]
        less, more = np.minimum(size[a][:, None], size[b][None, :]), np.maximum(size[a][:, None], size[b][None, :])
        apart &= less >= like.least(more)
        pairs = tree_links([values[k] for k in a], [values[k] for k in b], size[a], size[b], apart, like) if len(a) and len(b) and apart.any() else []
        i, j = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
        root = roots(len(cls), a[i], b[j])
        own = np.flatnonzero(root != np.arange(len(cls)))
        return pa.table({"a": cls[own], "b": cls[root[own]]})

    return work


def _large_groups(postings: DataFrame, sets: DataFrame, like: Likeness, block_sets: int, block_values: int) -> DataFrame:
    """Links among classes of groups too large to meet in one place.

    The classes of each signature meet its hub, the one among them that shares
    most. Where that leaves classes of one signature apart, they meet in blocks:
    those of all signatures of a hub together, so that a class that has many of
    them is dealt out once, or, if that takes fewer rows, each signature's.
    """
    zero = F.lit(0).cast("long")
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / block_sets), F.ceil(F.sum("n") / block_values)).alias("parts")

    weight = postings.groupBy("cls").agg(F.count(F.lit(1)).alias("weight"))
    met = postings.groupBy("token").agg(F.count(F.lit(1)).alias("met"), F.sum(F.xxhash64("cls").cast("decimal(38,0)")).alias("who")).where("met > 1")
    # Tokens met by the very same classes are one.
    tokens = met.groupBy("met", "who").agg(F.min("token").alias("token")).select("token")
    postings = kept(postings.join(tokens, "token").join(weight, "cls"), "large-postings")
    hubs = postings.groupBy("token").agg(F.max(F.struct("weight", "cls"))["cls"].alias("hub"))
    postings = kept(postings.join(hubs, "token").select("token", "hub", "cls", "n"), "hub-postings")

    pairs = postings.where("cls <> hub").select("hub", "cls", "n").distinct()
    per_hub = pairs.groupBy("hub").agg(parts)
    others = pairs.drop("n").join(per_hub, "hub").select(F.col("hub").alias("g"), zero.alias("h"), F.pmod(F.xxhash64("cls"), F.col("parts")).alias("k"), F.lit(2).cast("long").alias("side"), "cls", F.col("cls").alias("component"))
    centres = per_hub.select(F.col("hub").alias("g"), zero.alias("h"), F.explode(F.sequence(zero, F.col("parts") - 1)).alias("k"), F.lit(1).cast("long").alias("side"), F.col("hub").alias("cls"), F.col("hub").alias("component"))
    rows = others.unionByName(centres).join(sets, "cls").select(*MEET.names)
    first = kept(rows.groupBy("g", "k").applyInArrow(_meet(like), PAIR), "hub-links")

    labels = components(first)
    placed = kept(postings.join(labels, postings["cls"] == labels["node"], "left").select("token", "hub", "cls", "n", F.coalesce("component", "cls").alias("component")), "placed")
    per_token = placed.groupBy("token", "hub").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("sets"), parts).where("lo <> hi").select("token", "hub", "sets", "parts")
    per_token = kept(per_token, "open")
    open_ = placed.join(per_token.select("token"), "token", "left_semi")
    together = open_.select("hub", "cls", "component", "n").distinct()
    per_hub = together.groupBy("hub").agg(F.count(F.lit(1)).alias("sets"), parts)
    per_hub = per_hub.join(per_token.groupBy("hub").agg(F.sum(F.expr("sets * parts")).alias("singly")), "hub")
    fewer = F.col("sets") * F.col("parts") <= F.col("singly")
    by_hub = together.join(per_hub.where(fewer).select("hub", "parts"), "hub").select(F.col("hub").alias("g"), "parts", "cls", "component", zero.alias("one"))
    single = per_token.select("token", "hub", "parts").join(per_hub.where(~fewer).select("hub"), "hub", "left_semi").select("token", "parts")
    by_token = open_.join(single, "token").select(F.col("token").alias("g"), "parts", "cls", "component", F.lit(1).cast("long").alias("one"))
    apart = by_hub.unionByName(by_token).withColumn("own", F.pmod(F.xxhash64("cls"), F.col("parts")))
    apart = apart.withColumn("with", F.explode(F.sequence(zero, F.col("parts") - 1)))
    side = F.when(F.col("own") == F.col("with"), 0).when(F.col("own") < F.col("with"), 1).otherwise(2).cast("long")
    apart = apart.select("g", "one", F.least("own", "with").alias("h"), F.greatest("own", "with").alias("k"), side.alias("side"), "cls", "component")
    last = apart.join(sets, "cls").select("one", *MEET.names).groupBy("one", "g", "h", "k").applyInArrow(_meet(like), PAIR)
    return first.union(kept(last, "last-links"))


def _marks(columns: list) -> list:
    """Two numbers that tell rows apart by these columns."""
    return [F.xxhash64(*columns).alias("mark"), F.xxhash64(F.lit(1), *columns).alias("mark2")]


def _rooted(texts: DataFrame, width: int, percent: int, block_sets: int, block_values: int) -> DataFrame:
    """(id, mark, mark2, n, cls, root) for each of the rows (id, text, mark,
    mark2): linked classes have the same root. Rows are told by their marks,
    which are never null, so that rows without an id link like all others."""
    like = Likeness(percent)

    def show(rows: pa.Table) -> dict:
        values, first = shingle_sets(rows["text"].to_pylist(), width)
        n = np.diff(first)
        cls = classes_of(values, first)
        shown = like.shown(n)
        at = np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(shown)[:-1])), shown) + np.arange(shown.sum())
        ids = rows["id"]
        marks = {c: np.asarray(rows[m]).astype(np.int64).tobytes() for c, m in (("marks", "mark"), ("marks2", "mark2"))}
        return {"n": int(shown.sum()), **marks, "ids": np.asarray(ids.fill_null(0)).astype(np.int64).tobytes(), "no_id": np.asarray(ids.is_null()).astype(np.uint8).tobytes(), "sizes": n.astype(np.int64).tobytes(), "classes": cls.tobytes(), "keys": values[at].tobytes()}

    packed = kept(pack(texts, show, "n long, marks binary, marks2 binary, ids binary, no_id binary, sizes binary, classes binary, keys binary"), "shown")

    def unpack(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                none = np.frombuffer(batch["no_id"][k].as_py(), np.uint8).astype(bool)
                ids, mark, mark2, n, cls = (np.frombuffer(batch[c][k].as_py(), np.int64) for c in ("ids", "marks", "marks2", "sizes", "classes"))
                yield pa.record_batch({"id": pa.array(ids, mask=none), "mark": mark, "mark2": mark2, "n": n, "cls": cls})

    members = packed.select("ids", "no_id", "marks", "marks2", "sizes", "classes").mapInArrow(unpack, "id long, mark long, mark2 long, n long, cls long")

    def sign(row: dict, counts: np.ndarray, _) -> pa.Table:
        n, cls, keys = np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["classes"], np.int64), np.frombuffer(row["keys"], U64)
        shown, most = like.shown(n), like.signatures(n)
        text = np.repeat(np.arange(len(n)), shown)
        order = np.lexsort((keys, counts, text))
        place = np.arange(len(keys)) - np.repeat(np.concatenate(([0], np.cumsum(shown)[:-1])), shown)
        use = order[(place < most[text]) & (counts[order] > 1)]
        said = np.split(keys[use], np.flatnonzero(np.diff(text[use])) + 1) if len(use) else []
        who = np.unique(text[use])
        return pa.table({"cls": cls[who], "n": n[who], "tokens": pa.array([x.tobytes() for x in said], pa.binary())})

    # Equal sets say the same; one row for each class is left.
    signed = kept(told(packed, tally(packed), sign, "cls long, n long, tokens binary").dropDuplicates(["cls"]), "signed")

    def post(batches):
        for batch in batches:
            tokens = [np.frombuffer(t, np.int64) for t in batch["tokens"].to_pylist()]
            sizes = [len(t) for t in tokens]
            yield pa.record_batch({"token": np.concatenate(tokens) if tokens else np.zeros(0, np.int64), "cls": np.repeat(np.asarray(batch["cls"]), sizes), "n": np.repeat(np.asarray(batch["n"]), sizes)})

    postings = kept(signed.select("cls", "n", "tokens").mapInArrow(post, "token long, cls long, n long"), "postings")
    met = postings.groupBy("token").agg(F.count(F.lit(1)).alias("met")).where("met > 1").select("token")
    wanted = postings.join(met, "token").select("cls").distinct()
    reps = members.join(wanted, "cls").groupBy("cls").agg(F.min(F.struct("mark", "mark2")).alias("m")).select("m.mark", "m.mark2")
    kept_reps = kept(reps, "representatives")
    reps = few(kept_reps)
    # Rows alike in their marks are one before a shuffle; a broadcast moves none.
    asked = texts.drop("id") if reps is not kept_reps else texts.drop("id").dropDuplicates(["mark", "mark2"])

    def whole(rows: pa.Table) -> dict:
        values, first = shingle_sets(rows["text"].to_pylist(), width)
        n = np.diff(first)
        cls = classes_of(values, first)
        one = np.unique(cls, return_index=True)[1]
        keys = [values[first[k] : first[k + 1]] for k in one]
        return {"n": int(n[one].sum()), "classes": cls[one].tobytes(), "sizes": n[one].astype(np.int64).tobytes(), "keys": np.concatenate(keys).tobytes() if keys else b""}

    candidates = kept(pack(asked.join(reps, ["mark", "mark2"]), whole, "n long, classes binary, sizes binary, keys binary"), "candidates")

    def sign_again(row: dict, counts: np.ndarray, _) -> pa.Table:
        """Whole sets: those of which enough is shared at all, signed by their rarest."""
        n, cls, keys = np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["classes"], np.int64), np.frombuffer(row["keys"], U64)
        text = np.repeat(np.arange(len(n)), n)
        common = counts > 1
        enough = np.bincount(text[common], minlength=len(n)) >= like.least(n)
        order = np.lexsort((keys, counts, text))
        place = np.arange(len(keys)) - np.repeat(np.cumsum(n) - n, n)
        use = order[(place <= (n - like.least(n))[text]) & common[order] & enough[text]]
        first = np.concatenate(([0], np.cumsum(n)))
        who = np.flatnonzero(enough & (np.bincount(text[use], minlength=len(n)) > 0))
        tokens = np.split(keys[use], np.flatnonzero(np.diff(text[use])) + 1) if len(use) else []
        values = [keys[first[k] : first[k + 1]][common[first[k] : first[k + 1]]] for k in who]
        return pa.table({"cls": cls[who], "n": n[who], "tokens": pa.array([x.tobytes() for x in tokens], pa.binary()), "values": pa.array([x.tobytes() for x in values], pa.binary())})

    sets = kept(told(candidates, tally(candidates), sign_again, "cls long, n long, tokens binary, values binary").dropDuplicates(["cls"]), "sets")
    postings = kept(sets.select("cls", "n", "tokens").mapInArrow(post, "token long, cls long, n long"), "postings")
    sets = sets.drop("tokens")
    lead = postings.groupBy("token").agg(F.min("cls").alias("lead"))
    grouped = components(postings.join(lead, "token").select(F.col("cls").alias("a"), F.col("lead").alias("b")).where("a <> b"))
    wanted = sets.select("cls", "n").join(grouped, F.col("cls") == F.col("node")).select("cls", "n", F.col("component").alias("g"))
    bound = wanted.groupBy("g").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("size")).withColumn("small", F.expr(f"sets <= {block_sets} and size <= {block_values}"))
    wanted = kept(wanted.join(bound.select("g", "small"), "g"), "grouped")

    zero = F.lit(0).cast("long")
    together = wanted.where("small").select("g", zero.alias("h"), zero.alias("k"), zero.alias("side"), "cls", F.col("cls").alias("component"))
    links = kept(together.join(sets, "cls").select(*MEET.names).groupBy("g").applyInArrow(_meet(like), PAIR), "links")
    large = wanted.where("not small").select("cls")
    if not large.isEmpty():
        links = links.union(_large_groups(postings.join(large, "cls"), sets, like, block_sets, block_values))
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    labels = components(links).withColumnRenamed("node", "cls").withColumnRenamed("component", "root")
    return members.join(labels, "cls", "left").withColumn("root", F.coalesce("root", "cls"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 85, block_sets: int = 512, block_values: int = 1 << 18) -> DataFrame:
    """(id, n_shingles, component_id), one row for each document.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; a set holds the
    distinct ``width``-word shingles, or with fewer words the whole sequence as
    one. Documents link when 100 * intersection >= ``percent`` * union.
    component_id is the least id that links lead to. A text that is null or has
    no word has an empty set and is linked with nothing: its component is its
    own id. Repeated rows come out as often as they come in. A null id counts as
    larger than all others: its component is another id or, alone, null.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rooted = _rooted(texts.select("id", "text", *_marks(["id", "text"])), width, percent, block_sets, block_values)
    least = rooted.where("n > 0").groupBy("root").agg(F.min("id").alias("lowest"))
    out = rooted.join(least, "root", "left")
    return out.select("id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("lowest")).otherwise(F.col("id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 85, block_sets: int = 512, block_values: int = 1 << 18) -> DataFrame:
    """One row of each component; rows without words all stay.

    Decided for each row by its text, never by its id: different documents that
    share an id, or have none, all stay. Of a component the row with the
    least id stays, null being larger than all others; among those the one
    whose columns have the least hash. Of rows alike in all columns one stays.
    """
    docs = without(docs, "_mark", "_mark2")
    # Maps have no hash.
    columns = [F.to_json(F.struct(c)) if "map<" in kind or "variant" in kind else F.col(c) for c, kind in ((f"`{c}`", k) for c, k in docs.dtypes)]
    own = {"id": F.col(id_col).cast("long"), "text": F.col(text_col).cast("string")}
    texts = docs.select(*[c.alias(n) for n, c in own.items()], *_marks(columns))
    rooted = _rooted(texts, width, percent, block_sets, block_values)
    first = rooted.where("n > 0").groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark", "mark2")).alias("m"))
    stay = first.select(F.col("m.mark").alias("_mark"), F.col("m.mark2").alias("_mark2"))
    said = F.coalesce(own["text"].rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    marked = docs.withColumns(dict(zip(("_mark", "_mark2"), _marks(columns), strict=True)))
    one = marked.where(said).dropDuplicates(["_mark", "_mark2"]).join(stay, ["_mark", "_mark2"], "left_semi")
    return one.drop("_mark", "_mark2").unionByName(docs.where(~said))
