"""SentencePiece ids of a text by a streaming Viterbi search, and back.

The search keeps scores for as many positions as the longest piece has
letters. From time to time it follows the back pointers of all positions that
a later piece can start from; where they meet, everything before is settled,
its ids are given out and forgotten.

In most vocabularies no piece goes on over the start of a word. All paths then
meet there, each word can be searched by itself, and words seen before need no
search. New short words of a batch are searched side by side in arrays; longer
ones, and texts of other vocabularies, letter by letter.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersift.llm.common import map_batches, plus, without

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"  # stands for a space
SEGMENT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
UNUSED = -1e8  # scores below are of pieces the model never prefers


class Vocabulary:
    """Pieces with scores, and the ids of single bytes."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int]):
        self.pieces, self.byte_ids = pieces, byte_ids
        self.longest = max(map(len, pieces), default=1)
        self.unknown = min((s for _, s in pieces.values() if s > UNUSED), default=0.0) - 10.0
        # No piece has the mark after another letter: paths meet before marks.
        self.parted = not any(MARK in p.lstrip(MARK) for p in pieces)
        lengths: dict[str, set[int]] = {}
        for piece in pieces:
            lengths.setdefault(piece[-1], set()).add(len(piece))
        self.ends = {letter: sorted(own, reverse=True) for letter, own in lengths.items()}
        size = max([i for i, _ in pieces.values()] + byte_ids, default=-1) + 1
        self.spelled = [b""] * size
        for piece, (i, _) in pieces.items():
            self.spelled[i] = piece.replace(MARK, " ").encode()
        for value, i in enumerate(byte_ids):
            self.spelled[i] = bytes([value])

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(p.get_piece_size())
        byte_ids = [p.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        plain = {p.id_to_piece(i): (i, p.get_score(i)) for i in ids if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i))}
        return cls(plain, byte_ids)


class StreamingViterbi:
    """Best segmentation of letters that arrive in parts.

    The sum of scores decides; of equal sums the path whose last piece starts
    first. A letter that is no piece stands for its bytes.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.tail = ""  # the last letters, as many as a piece can have
        self.at = 0  # letters read
        self.scores = {0: 0.0}  # of positions that a piece can still start from
        self.back: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.done = 0  # everything before is given out
        self.next = vocabulary.longest  # when to look again where paths meet

    def feed(self, letters: str) -> Iterator[int]:
        longest, pieces, scores, back = self.v.longest, self.v.pieces, self.scores, self.back
        ends = self.v.ends
        for letter in letters:
            self.tail = tail = (self.tail + letter)[-longest:]
            self.at = at = self.at + 1
            best, way = None, None
            # Only lengths of pieces that end with this letter, longest first.
            for size in ends.get(letter, ()):
                if size <= len(tail):
                    found = pieces.get(tail[-size:])
                    if found is not None:
                        score = scores[at - size] + found[1]
                        if best is None or score > best:
                            best, way = score, (at - size, (found[0],))
            if letter not in pieces:
                score = scores[at - 1] + self.v.unknown
                if best is None or score > best:
                    best, way = score, (at - 1, tuple(self.v.byte_ids[b] for b in letter.encode()))
            scores[at], back[at] = best, way
            scores.pop(at - longest, None)
            if at >= self.next:
                yield from self.settle()
                # Where paths stay apart, look again when twice as much waits.
                self.next = at + max(longest, at - self.done)

    def settle(self) -> Iterator[int]:
        """Give out all ids before the boundary where the surviving paths meet."""
        alive = {p for p in self.scores if p >= self.done}
        while len(alive) > 1:
            last = max(alive)
            alive.remove(last)
            alive.add(self.back[last][0])
        yield from self.commit(alive.pop())

    def commit(self, boundary: int) -> Iterator[int]:
        if boundary <= self.done:
            return
        path, p = [], boundary
        while p > self.done:
            p, ids = self.back[p]
            path.append(ids)
        for p in range(self.done + 1, boundary + 1):
            del self.back[p]
        self.done = boundary
        for ids in reversed(path):
            yield from ids

    def finish(self) -> Iterator[int]:
        yield from self.commit(self.at)


class SideBySide:
    """The same search over many short segments at once, a letter of all of
    them at a time. Pieces are met letter by letter in a trie, whose edges are
    sorted numbers. The paths of a segment meet at its end, where its ids are
    given out."""

    ROWS = 4096
    LETTERS = 1 << 21  # letters are numbered from 1; 0 pads

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        nodes, ends = {"": 0}, [(-1, 0.0)]
        edges: list[tuple[int, int]] = []
        for piece, end in vocabulary.pieces.items():
            for size in range(1, len(piece) + 1):
                if piece[:size] not in nodes:
                    edges.append((nodes[piece[: size - 1]] * self.LETTERS + ord(piece[size - 1]) + 1, len(ends)))
                    nodes[piece[:size]] = len(ends)
                    ends.append((-1, 0.0))
            ends[nodes[piece]] = end
        edges.sort()
        # The last edge leads nowhere, so that every search finds a place.
        self.edges = np.array([e for e, _ in edges] + [np.iinfo(np.int64).max], np.int64)
        self.to = np.array([n for _, n in edges] + [0], np.int64)
        self.ids = np.array([i for i, _ in ends], np.int32)
        self.values = np.array([s for _, s in ends], np.float64)

    def search(self, segments: list[str]) -> list[bytes]:
        """Ids of segments, none empty, as 32-bit numbers."""
        out: list[bytes] = [b""] * len(segments)
        order = sorted(range(len(segments)), key=lambda k: len(segments[k]))
        for a in range(0, len(order), self.ROWS):
            own = order[a : a + self.ROWS]
            for k, ids in zip(own, self._some([segments[k] for k in own]), strict=True):
                out[k] = ids
        return out

    def _some(self, segments: list[str]) -> Iterator[bytes]:
        n, width = len(segments), max(map(len, segments))
        size = np.fromiter(map(len, segments), np.int64, n)
        letters = np.array(segments, f"U{width}").view(np.uint32).reshape(n, width).T.astype(np.int64) + 1
        letters[np.arange(width)[:, None] >= size] = 0
        score = np.full((width + 1, n), -np.inf)
        score[0] = 0.0
        start = np.zeros((width + 1, n), np.int64)
        code = np.zeros((width + 1, n), np.int64)  # an id, or below 0 a letter that is no piece
        for s in range(width):
            rows = np.flatnonzero(size > s)
            before, node = score[s, rows], np.zeros(len(rows), np.int64)
            for end in range(s + 1, min(width, s + max(self.v.longest, 1)) + 1):
                key = node * self.LETTERS + letters[end - 1, rows]
                place = np.searchsorted(self.edges, key)
                met = self.edges[place] == key
                node = self.to[place]
                is_piece = met & (self.ids[node] >= 0)
                take = is_piece
                if end == s + 1:
                    # A letter that is no piece stands for its bytes.
                    take = np.ones(len(rows), bool)
                    ids = np.where(is_piece, self.ids[node], -letters[s, rows])
                    value = np.where(is_piece, self.values[node], self.v.unknown)
                else:
                    ids, value = self.ids[node], self.values[node]
                # Starts come in order: of equal sums the first stays.
                some = np.flatnonzero(take)
                total, r = before[some] + value[some], rows[some]
                better = total > score[end, r]
                some, r = some[better], r[better]
                score[end, r], start[end, r], code[end, r] = total[better], s, ids[some]
                if not met.any():
                    break
                rows, before, node = rows[met], before[met], node[met]
        return self._ids(size, start, code)

    def _ids(self, size: np.ndarray, start: np.ndarray, code: np.ndarray) -> Iterator[bytes]:
        """Back pointers followed from the ends of all segments at once."""
        row, at = np.arange(len(size)), size
        rows, codes = [], []
        while len(row):
            rows.append(row)
            codes.append(code[at, row])
            at = start[at, row]
            row, at = row[at > 0], at[at > 0]
        # Last pieces were met first.
        whose, codes = np.concatenate(rows[::-1]), np.concatenate(codes[::-1])
        order = np.argsort(whose, kind="stable")
        whose, codes = whose[order], codes[order]
        letter = -codes - 1
        width = np.where(codes < 0, 1 + (letter >= 0x80) + (letter >= 0x800) + (letter >= 0x10000), 1)
        first = np.concatenate(([0], np.cumsum(width)))
        ids = np.zeros(first[-1], np.int32)
        ids[first[:-1][codes >= 0]] = codes[codes >= 0]
        strange = np.flatnonzero(codes < 0)
        for one in np.unique(letter[strange]).tolist():
            here = first[strange[letter[strange] == one]]
            for k, byte in enumerate(chr(one).encode()):
                ids[here + k] = self.v.byte_ids[byte]
        cuts = (4 * first[np.searchsorted(whose, np.arange(len(size) + 1))]).tolist()
        data = ids.tobytes()
        return (data[a:b] for a, b in zip(cuts, cuts[1:], strict=False))


class Memo(dict):
    """Ids of segments seen before, as bytes. Long segments are searched each
    time; a memo that is full starts anew with the next batch."""

    SHORT = 64

    def __init__(self, vocabulary: Vocabulary, size: int = 1 << 19):
        self.v, self.size, self.many = vocabulary, size, None

    def learn(self, segments: set[str]) -> None:
        """Search those of a batch that are short and not known."""
        new = segments.difference(self)
        if len(self) + len(new) > self.size:
            self.clear()
            new = segments
        new = [s for s in new if len(s) <= self.SHORT]
        if self.many is None:
            self.many = SideBySide(self.v)
        self.update(zip(new, self.many.search(new), strict=True))

    def __missing__(self, segment: str) -> bytes:
        search = StreamingViterbi(self.v)
        return array("i", [*search.feed(segment), *search.finish()]).tobytes()


class Codec:
    def __init__(self, vocabulary: Vocabulary):
        self.v, self.memo = vocabulary, Memo(vocabulary)

    def encode(self, texts: list[str | None]) -> list[bytes | None]:
        """Ids of a batch of texts as 32-bit numbers; None for None. A mark
        that stands in a text itself is written in bytes, so that it does not
        come back as a space."""
        cut = [self._segments(t) if t else [] for t in texts]
        self.memo.learn(set().union(*(own for parts in cut for own in parts)))
        literal = np.array([self.v.byte_ids[b] for b in MARK.encode()], np.int32).tobytes()
        known = self.memo.__getitem__
        return [None if t is None else literal.join([b"".join(map(known, own)) for own in parts]) for t, parts in zip(texts, cut, strict=True)]

    def _segments(self, text: str) -> list[list[str]]:
        """Segments that can be searched by themselves, in a list for each part
        of the text between marks of its own."""
        if self.v.parted and text[0] != " " and text[-1] != " " and "  " not in text and MARK not in text:
            return [(MARK + text.replace(" ", " " + MARK)).split(" ")]
        parts = [MARK * (k == 0) + part.replace(" ", MARK) for k, part in enumerate(text.split(MARK))]
        return [SEGMENT.findall(p) if self.v.parted else [p] * bool(p) for p in parts]

    def decode(self, ids) -> str:
        return b"".join(map(self.v.spelled.__getitem__, ids)).decode("utf-8", "replace")[1:]


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(Vocabulary.load(path))
    return _CODECS[path]


def encode_pieces(docs: DataFrame, text_col: str = "text", model: str = MODEL) -> DataFrame:
    """Adds piece_ids: array of ids.

    A null text has null, an empty one no ids. A column of the added name is
    replaced, all others kept; equal texts get equal ids.
    """

    def work(rows: pa.Table):
        coder = codec(model)
        parts = coder.encode(rows[text_col].to_pylist())
        sizes = np.array([len(p or b"") // 4 for p in parts], np.int64)
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        values = pa.array(np.frombuffer(b"".join(p or b"" for p in parts), np.int32))
        lists = pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array([p is None for p in parts]))
        yield rows.append_column("piece_ids", lists)

    base = without(docs, "piece_ids").withColumn(text_col, F.col(text_col).cast("string"))
    return map_batches(base, work, plus(base.schema, T.StructField("piece_ids", T.ArrayType(T.IntegerType()))), text_col)


def decode_pieces(rows: DataFrame, ids_col: str = "piece_ids", out_col: str = "decoded", model: str = MODEL) -> DataFrame:
    """Adds the text that the ids stand for; null for null."""

    def work(batch: pa.Table):
        coder = codec(model)
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            lists = part[ids_col].combine_chunks()
            none = np.asarray(lists.is_null())
            ids = lists.flatten().to_numpy(zero_copy_only=False).tolist()
            end = np.cumsum(np.where(none, 0, np.asarray(lists.value_lengths().fill_null(0)))).tolist()
            texts = [None if null else coder.decode(ids[a:b]) for null, a, b in zip(none, [0, *end], end, strict=False)]
            yield part.append_column(out_col, pa.array(texts, pa.string()))

    base = without(rows, out_col)
    return map_batches(base, work, plus(base.schema, T.StructField(out_col, T.StringType())))
