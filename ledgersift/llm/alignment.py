"""Tokens of two tokenizers over the same texts, aligned by byte.

Both encode a text; running sums of their tokens' lengths give where each
token ends. Both sets of ends are intersected; the sorted common ends slice
both lists of ids into groups, and within each slice the
tokens that share a byte are linked. Counts of linked ids over the corpus are
then brought back to every document.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersift.llm.common import few, kept, map_batches, plus, split_rows, without
from ledgersift.llm.pieces import MARK, MODEL
from ledgersift.llm.wordpiece import VOCABULARY, byte_letters

SPACE = re.compile(r"(?<=\w) (?=\w)")
LONG = 1 << 16  # letters of text encoded in one piece, where it can be cut
AT_ONCE = 1 << 17  # bytes of text aligned at once: their sets of ends are small
# How byte-level vocabularies part a text, and letters whose kind
# (letter, number, space or other) all versions of Unicode agree on.
PARTS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SETTLED = re.compile("[\t\n\r\x20-\x7e\xa1-\u017f]*")


def parts(text: str, size: int = LONG) -> list[str]:
    """A text, after a space, in pieces of some ``size`` letters. Each starts
    with a single space between two word letters, where neither encoder lets a
    token go on; a text without such spaces is one piece."""
    full = " " + text
    if len(full) <= size:
        return [full]
    cuts = [0]
    while found := SPACE.search(full, cuts[-1] + size):
        cuts.append(found.start())
    return [full[a:b] for a, b in pairwise([*cuts, len(full)])]


class Encoders:
    """Both tokenizers, and the bytes that each id stands for."""

    def __init__(self, path_a: str, path_b: str):
        # Spark runs a worker a core; threads of their own would only compete.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        value = byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.spelled_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.spelled_a[i] = bytes(value[x] for x in token) if all(x in value for x in token) else token.encode()
        # Where merges are ranked by the ids they make, the ids say all.
        special = {i for i, t in self.a.get_added_tokens_decoder().items() if t.special}
        ranks = {raw: i for i, raw in enumerate(self.spelled_a) if raw and i not in special}
        merged = [vocabulary.get(a + b) for a, b in _merges(path_a)]
        ranked = None not in merged and merged == sorted(merged) and all(bytes([v]) in ranks for v in range(256))
        self.fast = tiktoken.Encoding("ranks", pat_str=PARTS, mergeable_ranks=ranks, special_tokens={}) if ranked else None
        self.b = p = sentencepiece.SentencePieceProcessor(model_file=path_b)
        names = [p.id_to_piece(i) for i in range(p.get_piece_size())]
        self.spelled_b = [bytes([int(w[3:5], 16)]) if p.is_byte(i) else w.replace(MARK, " ").encode() for i, w in enumerate(names)]
        self.cuttable = not any(MARK in w.lstrip(MARK) for w in names)
        self.length_a, self.length_b = (np.array(list(map(len, s)), np.int64) for s in (self.spelled_a, self.spelled_b))
        # Numbers in digits, followed by what may come after them.
        self.digits = {after: np.array([f"{i}{after}" for i in range(max(len(names), len(self.spelled_a)))], object) for after in ",|;"}

    def _encode_a(self, piece: str) -> list[int]:
        if self.fast is not None and SETTLED.fullmatch(piece):
            return self.fast.encode_ordinary(piece)
        return self.a.encode(piece, add_special_tokens=False).ids

    def __call__(self, texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of every text; none where they do not spell space and text."""
        out_a, out_b = [], []
        for text in texts:
            pieces = [] if not text else parts(text) if self.cuttable else [" " + text]
            a = [i for p in pieces for i in self._encode_a(p)]
            b = [i for p in pieces for i in self.b.encode(p[1:])]
            if pieces:
                said = (" " + text).encode()
                if b"".join(map(self.spelled_b.__getitem__, b)) != said or b"".join(map(self.spelled_a.__getitem__, a)) != said:
                    a, b = [], []
            out_a.append(a)
            out_b.append(b)
        return out_a, out_b


def _merges(path: str) -> list[tuple[str, str]]:
    with open(path, encoding="utf-8") as file:
        return [tuple(m.split(" ") if isinstance(m, str) else m) for m in json.load(file)["model"]["merges"]]


def slices(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends that both lists have, and how many tokens of each list end there
    or before."""
    common = set(ends_a.tolist()) & set(ends_b.tolist())
    common = np.sort(np.fromiter(common, np.int64, len(common)))
    return common, np.searchsorted(ends_a, common, "right"), np.searchsorted(ends_b, common, "right")


def links(ends_a, ends_b, cut_a, cut_b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of tokens that share a byte, slice by slice, and their number in
    each. m tokens over n tokens without an inner common end have m + n - 1."""
    start_a, start_b = (np.concatenate(([0], c[:-1])) if len(c) else c for c in (cut_a, cut_b))
    m, n = cut_a - start_a, cut_b - start_b
    size = m + n - 1
    first = np.cumsum(size) - size
    step = np.arange(size.sum()) - np.repeat(first, size)
    a = np.repeat(start_a, size) + np.where(np.repeat(m > 1, size), step, 0)
    b = np.repeat(start_b, size) + np.where(np.repeat(n > 1, size), step, 0)
    for g in np.flatnonzero((m > 1) & (n > 1)).tolist():
        i, j = int(start_a[g]), int(start_b[g])
        for k in range(int(first[g]), int(first[g] + size[g])):
            a[k], b[k] = i, j
            if ends_a[i] < ends_b[j]:
                i += 1
            else:
                j += 1
    return a, b, size


_ENCODERS: dict[tuple[str, str], Encoders] = {}


def encoders(path_a: str, path_b: str) -> Encoders:
    if (path_a, path_b) not in _ENCODERS:
        _ENCODERS[path_a, path_b] = Encoders(path_a, path_b)
    return _ENCODERS[path_a, path_b]


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(values.astype(np.int32)))


def _aligned(e: Encoders, texts: list[str | None], ids: bool) -> dict[str, pa.Array]:
    """Columns of ``align`` for some texts, worked on as one sequence."""
    lists_a, lists_b = e(texts)
    n_a, n_b = (np.array(list(map(len, x)), np.int64) for x in (lists_a, lists_b))
    a, b = (np.fromiter(chain.from_iterable(x), np.int64, n.sum()) for x, n in ((lists_a, n_a), (lists_b, n_b)))
    ends_a, ends_b = np.cumsum(e.length_a[a]), np.cumsum(e.length_b[b])
    common, cut_a, cut_b = slices(ends_a, ends_b)
    to_a, to_b, size = links(ends_a, ends_b, cut_a, cut_b)

    # Every text's last token ends a slice, so slices belong to one text.
    last_a = np.cumsum(n_a)
    groups_to = np.searchsorted(cut_a, last_a, "right")
    n_groups = np.diff(groups_to, prepend=0)
    n_links = np.diff(np.concatenate(([0], np.cumsum(size)))[groups_to], prepend=0)

    # Ids in written form, in the order in which the slices give them.
    of_a, of_b = (np.repeat(np.arange(len(common)), np.diff(c, prepend=0)) for c in (cut_a, cut_b))
    end_a, end_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    end_a[cut_a - 1], end_b[cut_b - 1] = True, True
    words = np.empty(len(a) + len(b), object)
    words[np.arange(len(a)) + np.concatenate(([0], cut_b[:-1]))[of_a] if len(a) else of_a] = np.where(end_a, e.digits["|"][a], e.digits[","][a])
    words[np.arange(len(b)) + cut_a[of_b]] = np.where(end_b, e.digits[";"][b], e.digits[","][b])
    at = np.concatenate(([0], np.cumsum(n_a + n_b))).tolist()
    written = ["".join(words[x:y].tolist())[:-1] for x, y in pairwise(at)]

    # Distinct pairs of every text, and how often it has them.
    # In one number, which needs no order of places to be sorted.
    kinds_a, kinds_b = len(e.length_a), len(e.length_b)
    pair = np.sort((np.repeat(np.arange(len(texts)), n_links) * kinds_a + a[to_a]) * kinds_b + b[to_b])
    new = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, bool))
    who, link_a = np.divmod(pair[new] // kinds_b, kinds_a)
    distinct = np.bincount(who, minlength=len(texts))
    out = {
        "n_a": pa.array(n_a),
        "n_b": pa.array(n_b),
        "n_groups": pa.array(n_groups),
        "n_links": pa.array(n_links),
        "token_groups": pa.array(written, pa.string()),
        "link_a": _lists(link_a, distinct),
        "link_b": _lists(pair[new] % kinds_b, distinct),
        "link_n": _lists(np.diff(np.append(new, len(pair))), distinct),
    }
    return out | ({"a_ids": _lists(a, n_a), "b_ids": _lists(b, n_b)} if ids else {})


_INTS = T.ArrayType(T.IntegerType())
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
ADDED = [*(T.StructField(n, T.LongType()) for n in COUNTS), T.StructField("token_groups", T.StringType()), *(T.StructField(n, _INTS) for n in ("link_a", "link_b", "link_n"))]
IDS = [T.StructField("a_ids", _INTS), T.StructField("b_ids", _INTS)]
BLOCK = T.StructField("align_block", T.LongType())


def align(docs: DataFrame, text_col: str = "text", path_a: str = VOCABULARY, path_b: str = MODEL, ids: bool = True, keep_text: bool = True) -> DataFrame:
    """Adds how a byte-level BPE (A) and a SentencePiece model (B) cut each text.

    n_a, n_b, n_groups, n_links: numbers of tokens, of slices and of pairs of
    tokens that share a byte. token_groups: the slices as ``a1,a2|b1;a3|b2``.
    link_a, link_b, link_n: distinct linked ids, sorted, and how often each
    pair occurs in the text. a_ids, b_ids: the ids, if ``ids``. align_block:
    documents of one number were worked on together.

    Strings of special tokens are plain text. Texts that are null or empty, or
    that either list of tokens does not spell with a space before (say, since
    U+2581 stands in them), have no tokens: zeros, '' and empty lists. Every
    row is worked on by itself; repeated rows get equal answers. Columns of the
    added names, in any case, are replaced, all others kept, the text only if
    ``keep_text``.
    """
    fields = ADDED + (IDS if ids else []) + [BLOCK]

    def work(rows: pa.Table):
        from pyspark import TaskContext

        work.block += 1
        block = (TaskContext.get().partitionId() << 32) + work.block
        for some in split_rows(rows, text_col, AT_ONCE):
            made = _aligned(encoders(path_a, path_b), some[text_col].to_pylist(), ids)
            out = some if keep_text else some.drop_columns([text_col])
            for field in fields[:-1]:
                out = out.append_column(field.name, made[field.name])
            yield out.append_column("align_block", pa.array(np.full(some.num_rows, block)))

    work.block = 0
    base = without(docs, *(f.name for f in fields)).withColumn(text_col, F.col(text_col).cast("string"))
    schema = plus(base.schema if keep_text else base.drop(text_col).schema, *fields)
    return map_batches(base, work, schema, text_col)


def link_counts(aligned: DataFrame) -> DataFrame:
    """(align_block, a, b, n): in how many documents of a block two ids are
    linked. Documents of a block lie together, so nearly all is summed before
    anything moves; a block that is read in parts has several rows."""

    def work(batches):
        for batch in batches:
            block = batch["align_block"].to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            a, b = batch["link_a"], batch["link_b"]
            for x, y in pairwise(edges):
                pair = (a.slice(x, y - x).flatten().to_numpy().astype(np.int64) << 32) | b.slice(x, y - x).flatten().to_numpy()
                pair, n = np.unique(pair, return_counts=True)
                yield pa.record_batch({"align_block": np.full(len(pair), block[x]), "a": (pair >> 32).astype(np.int32), "b": (pair & 0xFFFFFFFF).astype(np.int32), "n": n.astype(np.int64)})

    return aligned.select("align_block", "link_a", "link_b").mapInArrow(work, "align_block long, a int, b int, n long")


def score_links(aligned: DataFrame) -> DataFrame:
    """Adds, from what ``align`` gives: count_sum, the sum over a document's
    links of the number of documents that have the same two ids linked; n_best,
    how many of its links reach the highest such number of their A id, ties
    included. Both are 0 without links. Every row counts as a document.

    A block asks for each distinct pair of ids once, so that a pair that every
    document has is one row a block. Pairs are at most as many as the product
    of the vocabularies, whatever the corpus.
    """
    base = kept(without(aligned, "n_best", "count_sum"), "aligned")
    asked = kept(link_counts(base), "links-asked")
    totals = kept(asked.groupBy("a", "b").agg(F.sum("n").alias("n")), "links-counted")
    highest = totals.groupBy("a").agg(F.max("n").alias("most"))
    marked = kept(totals.join(highest, "a").select("a", "b", "n", (F.col("n") == F.col("most")).cast("int").alias("best")), "links-marked")
    answers = asked.select("align_block", "a", "b").join(few(marked), ["a", "b"])
    schema = plus(base.schema, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()))

    def give(docs: pa.Table, told: pa.Table) -> pa.Table:
        known = (told["a"].to_numpy().astype(np.int64) << 32) | told["b"].to_numpy()
        order = np.argsort(known)
        known, n, best = known[order], told["n"].to_numpy()[order], told["best"].to_numpy()[order]
        a, b, times = (docs[c].combine_chunks() for c in ("link_a", "link_b", "link_n"))
        pair = (a.flatten().to_numpy().astype(np.int64) << 32) | b.flatten().to_numpy()
        times = times.flatten().to_numpy().astype(np.int64)
        at = np.searchsorted(known, pair)
        sizes = np.diff(a.offsets.to_numpy())
        edge = np.concatenate(([0], np.cumsum(sizes)))
        for name, values in (("n_best", times * best[at]), ("count_sum", times * n[at])):
            docs = docs.append_column(name, pa.array(np.diff(np.concatenate(([0], np.cumsum(values)))[edge])))
        return docs.select(schema.names)

    return base.groupBy("align_block").cogroup(answers.groupBy("align_block")).applyInArrow(give, schema)
