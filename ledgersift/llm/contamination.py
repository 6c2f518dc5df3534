"""Benchmark items inside documents, with a budget of edits.

An item with a budget of e edits is split into e + 1 pieces: where it stands
in a text with at most e edits, one piece stands there unchanged. One
automaton finds all pieces of all items; around each hit Myers' bit-parallel
algorithm gives the edit distance. A short item has no budget and counts only
where it stands unchanged, from one word edge to another.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersift.llm.common import map_batches, without


def plain(text: str | None) -> str:
    """Lower case, every run of white space one space, none at the ends."""
    return " ".join((text or "").lower().split())


def budget(length: int, edits: float) -> int:
    return int(length * edits)


def pieces(item: str, n: int) -> list[tuple[int, str]]:
    """The item in n pieces of nearly equal length, each with its offset."""
    cuts = [len(item) * k // n for k in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def best_match(item: str, text: str, masks: dict[str, int] | None = None) -> tuple[int, int]:
    """Least edit distance of the item to any part of the text, and where the
    first such part ends. Bit k of the columns stands for letter k of the item."""
    masks = masks if masks is not None else letter_masks(item)
    ones, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    up, down, score = ones, 0, len(item)
    best, end = score, 0
    for k, letter in enumerate(text):
        eq = masks.get(letter, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph = down | (~(xh | up) & ones)
        mh = up & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score < best:
                best, end = score, k + 1
        ph = (ph << 1) & ones
        mh = (mh << 1) & ones
        up = mh | (~(xv | ph) & ones)
        down = ph & xv
    return best, end


def letter_masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for k, letter in enumerate(item):
        masks[letter] = masks.get(letter, 0) | 1 << k
    return masks


def word_edge(text: str, at: int) -> bool:
    """Whether no word goes on from the letter before ``at`` to the one there."""
    return not (0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum())


class Finder:
    """All items that stand in a text within their budgets; those of fewer than
    ``min_chars`` letters unchanged and between word edges."""

    def __init__(self, items: list[tuple[int, str]], edits: float, min_chars: int = 0):
        import ahocorasick

        self.items, self.masks = items, {}
        self.short = [len(text) < min_chars for _, text in items]
        self.budget = [0 if short else budget(len(text), edits) for (_, text), short in zip(items, self.short, strict=True)]
        self.machine = ahocorasick.Automaton()
        for k, (_, text) in enumerate(items):
            for offset, piece in pieces(text, self.budget[k] + 1):
                self.machine.add_word(piece, [*self.machine.get(piece, []), (k, offset + len(piece))])
        if items:
            self.machine.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int]]:
        """(item id, distance, end) of each item found, at its best match."""
        if not self.items or not text:
            return []
        best: dict[int, tuple[int, int]] = {}
        checked: dict[int, list[tuple[int, int]]] = {}
        for last, hits in self.machine.iter(text):
            for k, reach in hits:
                most, item = self.budget[k], self.items[k][1]
                if best.get(k, (1,))[0] == 0:
                    continue
                start = last + 1 - reach
                if self.short[k]:
                    if word_edge(text, start) and word_edge(text, last + 1):
                        best[k] = (0, last + 1)
                    continue
                # Pieces of one occurrence are displaced by at most ``most``.
                if any(a <= start <= b for a, b in checked.get(k, ())):
                    continue
                a, b = max(0, start - 4 * most), start + len(item) + 4 * most
                if k not in self.masks:
                    self.masks[k] = letter_masks(item)
                distance, end = best_match(item, text[a:b], self.masks[k])
                checked.setdefault(k, []).append((start - 2 * most, start + 2 * most))
                if distance <= most and distance < best.get(k, (most + 1,))[0]:
                    best[k] = (distance, a + end)
        return sorted((self.items[k][0], d, end) for k, (d, end) in best.items())


HITS = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("distance", T.IntegerType()), T.StructField("end", T.LongType())]))


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    edits: float = 0.08,
    min_chars: int = 40,
    items_at_once: int = 50_000,
) -> DataFrame:
    """Adds benchmark_hits: array of (item_id, distance, end), sorted by item.

    Both sides are compared in lower case with white space runs as one space;
    ``end`` counts letters of that form. An item of n letters may differ by
    ``edits`` * n insertions, deletions and replacements; one of fewer than
    ``min_chars`` letters by none, and no letter or digit of its first or last
    word's may go on beyond it. Items without an id or without text match
    nothing, as do null texts. Items with equal text are all reported. The items are sent with the tasks,
    ``items_at_once`` of them in one pass over the documents; more items take
    more passes. Repeated rows get equal answers; a column of the added name is
    replaced.
    """
    wanted = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    usable = wanted.where(F.col("item").isNotNull() & (F.length("text") > 0)).distinct()
    passes = max(1, -(-usable.count() // items_at_once))
    base = without(docs, "benchmark_hits").withColumn(text_col, F.col(text_col).cast("string"))
    out = base.withColumn("benchmark_hits", F.array().cast(HITS))
    for k in range(passes):
        part = usable.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == k) if passes > 1 else usable
        items = [(i, t) for i, t in ((r[0], plain(r[1])) for r in part.collect()) if t]
        out = map_batches(out, _Search(sorted(items), edits, min_chars, text_col), out.schema, text_col)
    return out


class _Search:
    """The work of one pass; its automaton is built once in each Python worker."""

    built: dict[str, Finder] = {}

    def __init__(self, items: list, edits: float, min_chars: int, text_col: str):
        import hashlib

        self.items, self.edits, self.min_chars, self.text_col = items, edits, min_chars, text_col
        self.name = hashlib.sha256(repr((items, edits, min_chars)).encode()).hexdigest()

    def __call__(self, rows: pa.Table):
        if self.name not in _Search.built:
            _Search.built.clear()
            _Search.built[self.name] = Finder(self.items, self.edits, self.min_chars)
        finder = _Search.built[self.name]
        hits = []
        for text, before in zip(rows[self.text_col].to_pylist(), rows["benchmark_hits"].to_pylist(), strict=True):
            found = [{"item_id": i, "distance": d, "end": e} for i, d, e in finder.find(plain(text))]
            hits.append(sorted(before + found, key=lambda h: h["item_id"]))
        column = rows.schema.field("benchmark_hits")
        yield rows.set_column(rows.column_names.index("benchmark_hits"), column, pa.array(hits, column.type))

