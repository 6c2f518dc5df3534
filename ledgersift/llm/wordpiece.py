"""Number of word pieces of a text, by greedy longest match in linear time.

The vocabulary is a trie. Each node knows its failure link, where matching
goes on after the pieces that are then certain have been taken off, and how
many pieces those are. A word is read once, left to right; only the numbers
are added up, no piece is built.
"""

from __future__ import annotations

import json
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersift.llm.common import map_batches, plus, without

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
SPACE_MARK = "Ġ"


class Automaton:
    """Counts greedy longest-match pieces over a set of byte strings.

    A word starts at ``start``, continues at ``inner``: the roots of the
    pieces that begin a word and of those that go on. A word that cannot be
    covered counts as one piece.
    """

    def __init__(self, initial: list[bytes], inner: list[bytes]):
        self.next: list[dict[int, int]] = [{}, {}]
        self.full = [False, False]
        self.start, self.inner = 0, 1
        for root, pieces in ((0, initial), (1, inner)):
            for piece in pieces:
                if piece:
                    self._add(root, piece)
        self.fail = [-1] * len(self.next)
        self.pops = [0] * len(self.next)
        self._link()

    def _add(self, root: int, piece: bytes) -> None:
        at = root
        for byte in piece:
            if byte not in self.next[at]:
                self.next[at][byte] = len(self.next)
                self.next.append({})
                self.full.append(False)
            at = self.next[at][byte]
        self.full[at] = True

    def _link(self) -> None:
        todo = deque([0, 1])
        while todo:
            at = todo.popleft()
            for byte, child in self.next[at].items():
                todo.append(child)
                if self.full[child]:
                    self.fail[child], self.pops[child] = self.inner, 1
                    continue
                # As the parent would go on after its own failure.
                link, popped = self.fail[at], self.pops[at]
                while link != -1 and byte not in self.next[link]:
                    popped += self.pops[link]
                    link = self.fail[link]
                if link != -1:
                    self.fail[child], self.pops[child] = self.next[link][byte], popped

    def count(self, word: bytes) -> int:
        """Pieces of one word; 1 if it cannot be covered, 0 if it is empty."""
        if not word:
            return 0
        step, fail, pops = self.next, self.fail, self.pops
        at, n = self.start, 0
        for byte in word:
            while (to := step[at].get(byte)) is None:
                n += pops[at]
                at = fail[at]
                if at == -1:
                    return 1
            at = to
        while at != self.inner:
            n += pops[at]
            at = fail[at]
            if at == -1:
                return 1
        return n


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def load(path: str = VOCABULARY) -> Automaton:
    """Pieces of a byte-level vocabulary: those with a space mark begin a word,
    all others go on. A byte that begins no piece of the first kind begins
    words by itself, so that every word is covered."""
    letters = byte_letters()
    with open(path, encoding="utf-8") as file:
        pieces = [p for p in json.load(file)["model"]["vocab"] if all(c in letters for c in p)]
    raw = lambda p: bytes(letters[c] for c in p)
    initial = [raw(p[1:]) for p in pieces if p[0] == SPACE_MARK]
    return Automaton([*initial, *(bytes([b]) for b in range(256))], [raw(p) for p in pieces if p[0] != SPACE_MARK])


_LOADED: dict[str, Automaton] = {}


class Memo(dict):
    """Counts of words seen before. Words are few and repeat; long ones and,
    once the memo is full, new ones are counted again each time."""

    def __init__(self, automaton: Automaton, size: int = 1 << 18):
        self.count, self.size = automaton.count, size

    def __missing__(self, word: bytes) -> int:
        n = self.count(word)
        if len(word) <= 64 and len(self) < self.size:
            self[word] = n
        return n


def token_counts(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Adds n_words and n_tokens.

    Words are split at ASCII white space. A null or empty text has none.
    Columns of the added names are replaced, all others kept; repeated rows get
    equal numbers.
    """

    def work(rows: pa.Table):
        if vocabulary not in _LOADED:
            _LOADED[vocabulary] = load(vocabulary)
        memo = _MEMOS.setdefault(vocabulary, Memo(_LOADED[vocabulary]))
        n_words, n_tokens = [], []
        for text in rows[text_col].to_pylist():
            words = (text or "").encode().split()
            n_words.append(len(words))
            n_tokens.append(sum(map(memo.__getitem__, words)))
        out = rows.append_column("n_words", pa.array(n_words, pa.int64()))
        yield out.append_column("n_tokens", pa.array(n_tokens, pa.int64()))

    base = without(docs, "n_words", "n_tokens").withColumn(text_col, F.col(text_col).cast("string"))
    schema = plus(base.schema, T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType()))
    return map_batches(base, work, schema, text_col)


_MEMOS: dict[str, Memo] = {}
