"""Near copies among vectors, by searching robust-pruned neighbour graphs.

Vectors of one label are dealt to overlapping shards, each to its nearest two
of some centres. In every shard a flat graph is built: a vector's out-edges are
pruned so that none is much nearer to another kept neighbour than to the vector
itself. Every vector is then looked up from its own node and spread ones by
greedy search, which goes on around what it finds as long as that lies within a
widened range; where queries compared with all show that links were missed, the
shard is searched exactly. A shard too large for a task is split into parts, and
different parts are compared in blocks. Pairs are verified in double precision
and counted in the first shard that both vectors share.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersift.llm.common import kept, without
from ledgersift.llm.graph import components, roots

WIDER = 0.08  # searches go on among vectors this much below the bound


def usable(column: str):
    """Whether a vector has only finite components, and not only zeros."""
    v = F.col(column)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0)


def unit(rows: list) -> np.ndarray:
    x = np.array(rows, np.float64)
    # Scaled first, so that neither large nor tiny components overflow.
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centres(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Mean directions of k groups of unit vectors."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norm > 0, sums / np.maximum(norm, 1e-12), c)
    return c


def pruned(x: np.ndarray, nodes: np.ndarray, near: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Out-edges of some nodes: the nearest candidate, then the nearest of those
    that are not ``alpha`` times nearer to one already taken. A row of ``near``
    for each node; the node itself in it, or as an edge, stands for none."""
    out = np.repeat(nodes[:, None], degree, axis=1)
    around = x[near]
    apart = 2 - 2 * (around @ x[nodes][:, :, None])[:, :, 0]
    apart[near == nodes[:, None]] = np.inf
    order = np.argsort(apart, axis=1, kind="stable")
    near, apart = np.take_along_axis(near, order, 1), np.take_along_axis(apart, order, 1)
    around = np.take_along_axis(around, order[:, :, None], 1)
    left, row = np.isfinite(apart), np.arange(len(nodes))
    for k in range(degree):
        some = left[row].any(axis=1)
        row = row[some]
        if not len(row):
            break
        if not some.all():
            around, apart = around[some], apart[some]
        best = left[row].argmax(axis=1)
        taken = near[row, best]
        out[row, k] = taken
        covered = alpha * alpha * (2 - 2 * (around @ x[taken][:, :, None])[:, :, 0]) <= apart
        covered[np.arange(len(row)), best] = True
        left[row] &= ~covered
    return out


def _rows(size: np.ndarray, fill: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Lists of some sizes, one after the other, as rows filled up to the longest."""
    out = np.repeat(fill[:, None], max(1, size.max(initial=0)), axis=1)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)] = values
    return out


def flat_graph(x: np.ndarray, degree: int = 24, alpha: float = 1.2, candidates: int = 64, rows: int = 256) -> np.ndarray:
    """Adjacency lists of a shard, a row for each node, filled up with the node
    itself. Candidates of a node are its nearest and a few far ones; edges go
    both ways, pruned. Some far edges are kept whatever the near ones are, so
    that a large group of near copies is not cut off."""
    n = len(x)
    far = np.random.default_rng(n).integers(0, n, (n, 8))
    near = np.empty((n, degree), np.int64)
    take = min(candidates, n)
    for a in range(0, n, rows):
        nodes = np.arange(a, min(a + rows, n))
        some = np.argpartition(-(x[nodes] @ x.T), take - 1, axis=1)[:, :take]
        some = np.sort(np.concatenate((some, far[nodes]), axis=1), axis=1)
        some[:, 1:] = np.where(some[:, 1:] == some[:, :-1], nodes[:, None], some[:, 1:])
        near[nodes] = pruned(x, nodes, some, degree, alpha)
    nodes = np.arange(n)
    both = np.unique(np.concatenate((np.repeat(nodes, degree) * n + near.ravel(), near.ravel() * n + np.repeat(nodes, degree))))
    size = np.bincount(both // n, minlength=n)
    first = np.cumsum(size) - size
    wide, lists = np.flatnonzero(size > 2 * degree), {}
    # Nodes of like numbers of edges together, and few of those with many.
    wide = wide[np.argsort(size[wide], kind="stable")]
    while len(wide):
        some = wide[-max(1, rows * candidates // int(size[wide[-1]])) :]
        wide = wide[: -len(some)]
        values = np.concatenate([both[first[k] : first[k] + size[k]] % n for k in some])
        lists |= dict(zip(some.tolist(), pruned(x, some, _rows(size[some], some, values), 2 * degree, alpha)))
    edges = np.concatenate([lists[k] if k in lists else both[first[k] : first[k] + size[k]] % n for k in range(n)])
    edges = _rows(np.where(size > 2 * degree, 2 * degree, size), nodes, edges)
    return np.concatenate((edges, far[:, :4]), axis=1)


def in_range(x: np.ndarray, edges: np.ndarray, start: np.ndarray, query: np.ndarray, bound: float, beam: int = 32, step: int = 8, at_once: int = 8192) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) for nodes whose product with a query is at least ``bound``.
    Greedy searches from the nodes ``start``, side by side, each with a beam
    of which the best ``step`` go on at once, and all that lies in range. Of
    both, at most ``at_once`` nodes are looked around in a round."""
    m, n = len(query), len(x)
    seen, tag = np.zeros(m * n, bool), np.empty(m * n, np.int32)
    ids, score, open_ = np.zeros((m, beam), np.int64), np.full((m, beam), -np.inf, x.dtype), np.zeros((m, beam), bool)
    hits, todo = [], (np.zeros(0, np.int64), np.zeros(0, np.int64))
    who, node = np.repeat(np.arange(m), start.shape[1]), start.ravel()
    while len(who):
        new = np.flatnonzero(~seen[who * n + node])
        place = who[new] * n + node[new]
        tag[place] = np.arange(len(place))
        new = new[tag[place] == np.arange(len(place))]
        who, node = who[new], node[new]
        seen[who * n + node] = True
        alike = np.einsum("ij,ij->i", x[node], query[who])
        hit = alike >= bound
        hits.append((who[hit], node[hit]))
        if len(who):
            # What lies in range is closed in the beam and goes on by itself.
            told = _rows(np.bincount(who, minlength=m), np.full(m, -1), np.arange(len(who)))
            ids = np.concatenate((ids, node[told]), axis=1)
            score = np.concatenate((score, np.where(told >= 0, alike[told], -np.inf)), axis=1)
            open_ = np.concatenate((open_, (told >= 0) & ~hit[told]), axis=1)
            best = np.argpartition(-score, beam - 1, axis=1)[:, :beam]
            ids, score, open_ = (np.take_along_axis(v, best, 1) for v in (ids, score, open_))
        best = np.argpartition(np.where(open_, -score, np.inf), step - 1, axis=1)[:, :step]
        row, k = np.nonzero(np.take_along_axis(open_, best, 1))
        open_[row, best[row, k]] = False
        from_, at = np.concatenate((row, todo[0], who[hit])), np.concatenate((ids[row, best[row, k]], todo[1], node[hit]))
        todo = from_[at_once:], at[at_once:]
        order = np.argsort(from_[:at_once], kind="stable")
        who, node = np.repeat(from_[order], edges.shape[1]), edges[at[order]].ravel()
    return np.concatenate([w for w, _ in hits]), np.concatenate([v for _, v in hits])


def _vectors(column) -> np.ndarray:
    return unit([np.frombuffer(v, np.float64) for v in column.to_pylist()])


def exact_pairs(x: np.ndarray, y: np.ndarray, bound: float, rows: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j) with a product of x[i] and y[j] of at least ``bound``."""
    found = [np.nonzero(x[a : a + rows] @ y.T >= bound) for a in range(0, len(x), rows)]
    return np.concatenate([i + k * rows for k, (i, _) in enumerate(found)]), np.concatenate([j for _, j in found])


def graph_pairs(x: np.ndarray, bound: float, least: float = 0.999, audited: int = 64, rows: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Pairs i < j of a part, by its graph. Each vector is looked up from its
    own node, the medoid and spread ones. Spread queries are compared with all
    of the part; where the share found is below ``least``, all are."""
    n = len(x)
    # Single precision finds the way; what is found is verified in double.
    rough = x.astype(np.float32)
    edges = flat_graph(rough)
    entries = np.append(np.linspace(0, n - 1, min(n, 4)).astype(np.int64), (x @ x.mean(axis=0)).argmax())
    found = []
    for a in range(0, n, rows):
        own = np.arange(a, min(a + rows, n))
        start = np.concatenate((own[:, None], np.repeat(entries[None], len(own), axis=0)), axis=1)
        i, j = in_range(rough, edges, start, rough[own], bound - WIDER)
        i = own[i]
        # Verified in blocks, so that large groups are not copied whole.
        use = np.concatenate([np.einsum("ij,ij->i", x[i[k : k + 65536]], x[j[k : k + 65536]]) >= bound for k in range(0, len(i), 65536)]) & (i != j)
        found.append((i[use], j[use]))
    i, j = (np.concatenate(v) for v in zip(*found))
    some = np.unique(np.linspace(0, n - 1, min(n, max(audited, n // 100))).astype(np.int64))
    true = int((x[some] @ x.T >= bound).sum()) - len(some)
    if np.isin(i, some).sum() < least * true:
        i, j = exact_pairs(x, x, bound)
    else:
        i, j = np.concatenate((i, j)), np.concatenate((j, i))
    both = np.unique(i[i < j] * n + j[i < j])
    return both // n, both % n


def met_before(shard: int, near: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether pairs also share a shard of a lower number, where they count."""
    out = np.zeros(len(i), bool)
    for a in range(near.shape[1]):
        lower = near[i, a] < shard
        for b in range(near.shape[1]):
            out |= lower & (near[i, a] == near[j, b])
    return out


def _find(bound: float, pairs: bool):
    """Links of one part of a shard, or between two of its parts: as they are,
    or their number at each vector and one vector that they lead to."""

    def work(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("id")
        ids, x, side, copies = np.asarray(rows["id"]), _vectors(rows["vector"]), np.asarray(rows["side"]), np.asarray(rows["copies"])
        shard, near = rows["c"][0].as_py(), np.array(rows["near"].to_pylist(), np.int64)
        if (side == 0).all():
            i, j = graph_pairs(x, bound)
        else:
            a, b = np.flatnonzero(side == 1), np.flatnonzero(side == 2)
            i, j = exact_pairs(x[a], x[b], bound) if len(a) and len(b) else (a[:0], b[:0])
            i, j = a[i], b[j]
        new = ~met_before(shard, near, i, j)
        i, j = i[new], j[new]
        if pairs:
            return pa.table({"a": np.minimum(ids[i], ids[j]), "b": np.maximum(ids[i], ids[j])})
        others = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
        root, use = ids[roots(len(ids), i, j)], others > 0
        return pa.table({"label": rows["label"].filter(pa.array(use)), "id": ids[use], "others": others[use].astype(np.int64), "root": root[use]})

    return work


PAIRS, SUMS = "a long, b long", "label string, id long, others long, root long"


def _links(reps: DataFrame, sizes: dict, bound: float, width: int, pairs: bool, shard_rows: int, sample_rows: int, most_centres: int) -> DataFrame:
    """Links found in the shards of the ``width`` nearest centres, as PAIRS or
    SUMS. Shards of more than twice ``shard_rows`` are split into parts, each
    of which meets itself and each other one in a task."""
    total = sum(sizes.values())
    # Some vectors of the sample for each centre.
    sample_rows = max(sample_rows, min(4 * most_centres, 4 * total // shard_rows))
    draw = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < F.lit(min(1.0, sample_rows / max(total, 1)) * 1_000_000)
    sample: dict[str, list] = {}
    for r in reps.where(draw).select("label", "vector").collect():
        sample.setdefault(r[0], []).append(np.frombuffer(r[1], np.float64))
    fitted = {}
    for label, n in sizes.items():
        some, k = sample.get(label), min(most_centres, -(-n // shard_rows))
        # With as many shards a vector as centres, one shard does.
        fitted[label] = centres(unit(some), k, 8 if k <= 1024 else 0) if some and k > width else None

    def deal(batches):
        for batch in batches:
            labels = np.array(batch["label"].to_pylist(), object)
            for label in dict.fromkeys(labels):
                rows = batch.filter(pa.array(labels == label))
                near = np.zeros((rows.num_rows, width), np.int64)
                if fitted.get(label) is not None:
                    # Numbers that repeat stand for fewer centres than asked for.
                    best = np.argsort(-(_vectors(rows["vector"]) @ fitted[label].T), axis=1, kind="stable")[:, :width]
                    near = np.sort(np.concatenate((best, np.repeat(best[:, :1], width - best.shape[1], axis=1)), axis=1), axis=1)
                lists = pa.array(near.tolist(), pa.list_(pa.int64()))
                for k in range(width):
                    own = (near[:, k] != near[:, k - 1]) if k else np.ones(len(near), bool)
                    yield pa.record_batch([*rows.columns, pa.array(near[:, k]), lists], names=[*rows.schema.names, "c", "near"]).filter(pa.array(own))

    kinds = "id long, label string, vector binary, copies long, c long, near array<long>"
    shards = kept(reps.select("id", "label", "vector", "copies").mapInArrow(deal, kinds), "shards")
    parts = shards.groupBy("label", "c").agg(F.ceil(F.count(F.lit(1)) / (2 * shard_rows)).alias("parts"))
    zero = F.lit(0).cast("long")
    each = shards.join(parts, ["label", "c"]).withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts"))).withColumn("with", F.explode(F.sequence(zero, F.col("parts") - 1)))
    side = F.when(F.col("own") == F.col("with"), 0).when(F.col("own") < F.col("with"), 1).otherwise(2).cast("long")
    tasks = each.select("label", "c", F.least("own", "with").alias("h"), F.greatest("own", "with").alias("k"), side.alias("side"), "id", "copies", "near", "vector")
    return tasks.groupBy("label", "c", "h", "k").applyInArrow(_find(bound, pairs), PAIRS if pairs else SUMS)


def _shortfall(reps: DataFrame, sums: DataFrame, bound: float, least: float, audited: int) -> list[str]:
    """Labels of which less than ``least`` of the true links was found, judged
    by the ids divisible by 100, at most about ``audited`` of them."""
    asked = reps.where("id % 100 = 0")
    n = asked.count()
    asked = kept(asked.where(F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(1_000_000)) < F.lit(min(1.0, audited / max(n, 1)) * 1_000_000)).select("id", "label", "vector"), "audited")
    queries: dict[str, list] = {}
    for r in asked.collect():
        queries.setdefault(r[1], []).append((r[0], np.frombuffer(r[2], np.float64)))
    queries = {label: (np.array([i for i, _ in q]), unit([v for _, v in q])) for label, q in queries.items()}

    def compare(batches):
        for batch in batches:
            labels = np.array(batch["label"].to_pylist(), object)
            for label in dict.fromkeys(labels):
                if label in queries:
                    rows = batch.filter(pa.array(labels == label))
                    ids, x = queries[label]
                    alike = (x @ _vectors(rows["vector"]).T >= bound) & (ids[:, None] != np.asarray(rows["id"])[None, :])
                    yield pa.record_batch({"label": pa.array([label] * len(ids), pa.string()), "id": pa.array(ids), "true": pa.array(alike @ np.asarray(rows["copies"]))})

    true = reps.mapInArrow(compare, "label string, id long, true long").groupBy("label", "id").agg(F.sum("true").alias("true"))
    got = sums.groupBy("label", "id").agg(F.sum("others").alias("got"))
    told = true.join(got, ["label", "id"], "left").groupBy("label").agg(F.sum("true").alias("true"), F.sum(F.coalesce("got", F.lit(0))).alias("got"))
    return [r[0] for r in told.where(F.col("got") < F.lit(least) * F.col("true")).select("label").collect()]


def _prepared(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame, dict]:
    """(representatives, members, sizes of the labels)."""
    v = F.col(vector_col)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), v.cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable("v"))
    # Vectors of different lengths cannot be compared.
    rows = rows.select("id", F.concat_ws("/", "label", F.size("v")).alias("label"), "v", F.md5(F.array_join(F.col("v").cast("array<string>"), ",")).alias("same"))
    groups = rows.groupBy("label", "same").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    members = kept(rows.select("id", "label", "same").join(groups, ["label", "same"]).select("id", "rep", "copies"), "members")

    def packed(batches):
        for batch in batches:
            yield pa.record_batch([batch["id"], batch["label"], pa.array([np.array(x, np.float64).tobytes() for x in batch["v"].to_pylist()], pa.binary()), batch["copies"]], names=["id", "label", "vector", "copies"])

    reps = rows.join(groups.select(F.col("rep").alias("id"), "label", "same", "copies"), ["id", "label", "same"]).select("id", "label", "v", "copies").dropDuplicates(["id", "label"])
    reps = kept(reps.mapInArrow(packed, "id long, label string, vector binary, copies long"), "vectors")
    sizes = {r[0]: r[1] for r in reps.groupBy("label").count().collect()}
    return reps, members, sizes


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", bound: float = 0.98, shard_rows: int = 1000, sample_rows: int = 20_000, most_centres: int = 1 << 16) -> tuple[DataFrame, DataFrame]:
    """(links, members). links: pairs a < b of representatives found with a
    cosine of ``bound`` or more; members: id, rep, copies for each usable vector.

    Equal vectors of a label are one; the least id represents them. Centres are
    fitted on a sample of about ``sample_rows`` vectors, or four a centre; every
    vector is dealt to shards. A label has one centre for each ``shard_rows``
    vectors, at most ``most_centres``.
    """
    reps, members, sizes = _prepared(vectors, id_col, vector_col, label_col)
    found = _links(reps, sizes, bound, 2, True, shard_rows, sample_rows, most_centres)
    return kept(found.distinct(), "links"), members


def linked_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, bound: float, shard_rows: int = 1000, sample_rows: int = 20_000, most_centres: int = 1 << 16, least_recall: float = 0.99, audited: int = 2000) -> tuple[DataFrame, DataFrame]:
    """(sums, members). sums: for representatives the rows linked to them, in
    one or more rows, and one representative that links lead to.

    Labels whose audit falls below ``least_recall`` are searched again with
    twice as many shards a vector, in the end all in one.
    """
    reps, members, sizes = _prepared(vectors, id_col, vector_col, label_col)
    width, todo, done = 2, sizes, None
    while True:
        some = reps if todo is sizes else reps.where(F.col("label").isin(list(todo)))
        sums = kept(_links(some, todo, bound, width, False, shard_rows, sample_rows, most_centres), "sums")
        short = [k for k in _shortfall(some, sums, bound, least_recall, audited) if min(most_centres, -(-sizes[k] // shard_rows)) > width]
        good = sums.where(~F.col("label").isin(short)) if short else sums
        done = good if done is None else done.union(good)
        if not short:
            return done, members
        width, todo = 2 * width, {k: sizes[k] for k in short}


def dedup_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", bound: float = 0.98, **settings) -> DataFrame:
    """The vectors with n_links, component_id and kept.

    Two vectors link when their labels are equal and not null and the cosine
    found is at least ``bound``. component_id is the least id that links lead
    to; kept marks it. Vectors that are null, empty, zero, or hold a null or
    non-finite component link with nothing, nor do vectors of different lengths
    or rows with a null id. Rows that repeat an id count as one vector if they are
    equal. Columns of the added names are replaced.
    """
    sums, members = linked_vectors(vectors, id_col, vector_col, label_col, bound, **settings)
    linked = sums.groupBy(F.col("id").alias("a")).agg(F.sum("others").alias("others"))
    roots_ = components(sums.select(F.col("id").alias("a"), F.col("root").alias("b")))
    each = members.join(linked, members["rep"] == linked["a"], "left").join(roots_, members["rep"] == roots_["node"], "left")
    each = each.select(F.col("id").alias("_vec"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")).dropDuplicates(["_vec"])
    base = without(vectors, "n_links", "component_id", "kept", "_vec")
    key = F.col(id_col).cast("long")
    out = base.join(each, key == F.col("_vec"), "left").drop("_vec")
    out = out.withColumn("n_links", F.coalesce("n_links", F.lit(0)).cast("long")).withColumn("component_id", F.coalesce("component_id", key))
    return out.withColumn("kept", F.coalesce(F.col("component_id") == key, F.lit(True)))


def audit_recall(vectors: DataFrame, links: DataFrame, members: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", bound: float = 0.98) -> float:
    """Share of the true links of every hundredth id that were found. The
    queries are compared with all rows of their label, in blocks."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v")).where(usable("v") & F.col("label").isNotNull() & F.col("id").isNotNull())
    queries = rows.where("id % 100 = 0").groupBy("label", F.pmod(F.xxhash64("id"), F.lit(64)).alias("part")).agg(F.collect_list(F.struct("id", "v")).alias("queries"))

    def compare(batches):
        for batch in batches:
            a, b = [], []
            ids, v = batch["id"].to_pylist(), batch["v"].to_pylist()
            for i, x, asked in zip(ids, v, batch["queries"].to_pylist(), strict=True):
                asked = [q for q in asked if q["id"] != i and len(q["v"]) == len(x)]
                if asked:
                    near = unit([q["v"] for q in asked]) @ unit([x])[0]
                    for k in np.flatnonzero(near >= bound):
                        a.append(min(i, asked[k]["id"]))
                        b.append(max(i, asked[k]["id"]))
            yield pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    true = rows.join(queries, "label").mapInArrow(compare, "a long, b long").distinct()
    rep = members.select(F.col("id"), F.col("rep"))
    named = true.join(rep.toDF("a", "ra"), "a").join(rep.toDF("b", "rb"), "b")
    named = named.select("a", "b", F.least("ra", "rb").alias("x"), F.greatest("ra", "rb").alias("y"))
    hit = named.join(links.toDF("x", "y").withColumn("hit", F.lit(1)), ["x", "y"], "left")
    n, got = hit.agg(F.count(F.lit(1)), F.sum(F.when((F.col("x") == F.col("y")) | F.col("hit").isNotNull(), 1).otherwise(0))).first()
    return 1.0 if not n else got / n

