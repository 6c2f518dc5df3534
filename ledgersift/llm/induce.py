"""Suffix order of a shard by induced sorting, with common-prefix lengths.

Suffixes that end a descent (LMS) are ordered first, by recursion on their
names. From them all others follow: a suffix is its first letter and the
suffix behind it, so taking suffixes in order and putting what stands before
each into the queue of its letter fills the queues in order. With every entry
goes the length of the prefix it shares with the entry before it: one more
than the least such length between the two suffixes it was induced from.

The queues hold (position, shared length) tuples in blocks and move to disk
when they outgrow their share of memory.
"""

from __future__ import annotations

import tempfile

import numpy as np

BLOCK = 1 << 15


class LetterQueues:
    """A priority queue whose priorities are letters: one queue for each, in
    order of arrival. Beyond ``budget`` bytes, full blocks go to a file."""

    def __init__(self, letters: int, budget: int = 64 << 20):
        self.blocks: list[list] = [[] for _ in range(letters)]
        self.held, self.budget, self.file = 0, budget, None

    def push(self, letter: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        entry = np.empty(len(pos), [("pos", np.int32), ("lcp", np.uint16)])
        entry["pos"], entry["lcp"] = pos, lcp
        if self.held + entry.nbytes > self.budget:
            self.file = self.file or tempfile.TemporaryFile()  # noqa: SIM115
            self.file.seek(0, 2)
            at = self.file.tell()
            self.file.write(entry.tobytes())
            self.blocks[letter].append((at, entry.nbytes, entry.dtype))
            return
        self.held += entry.nbytes
        self.blocks[letter].append(entry)

    def pull(self, letter: int):
        """Entries in order, some ``BLOCK`` at a time; those pushed meanwhile
        come too."""
        waiting = self.blocks[letter]
        k = 0
        while k < len(waiting):
            some, size = [], 0
            while k < len(waiting) and size < BLOCK:
                block, waiting[k] = waiting[k], None
                k += 1
                if isinstance(block, tuple):
                    self.file.seek(block[0])
                    block = np.frombuffer(self.file.read(block[1]), block[2])
                else:
                    self.held -= block.nbytes
                some.append(block)
                size += len(block)
            block = np.concatenate(some)
            for a in range(0, len(block), BLOCK):
                yield block["pos"][a : a + BLOCK].astype(np.int64), block["lcp"][a : a + BLOCK].astype(np.int64)
        self.blocks[letter] = []


def letter_runs(text: np.ndarray) -> np.ndarray:
    """For each position, how many equal letters stand there in a row."""
    last = np.flatnonzero(np.concatenate((text[1:] != text[:-1], [True])))
    return np.repeat(last, np.diff(last, prepend=-1)) - np.arange(len(text)) + 1


def rises(text: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Whether the suffix at each position is less than the next one. The end
    of the text is less than every letter."""
    after = np.arange(len(text)) + runs
    following = np.where(after < len(text), text[np.minimum(after, len(text) - 1)], -1)
    return following > text


def doubled(names: np.ndarray, reach: int) -> np.ndarray:
    """Order of suffixes by their first ``reach`` names, by prefix doubling."""
    rank = np.unique(names, return_inverse=True)[1].astype(np.int64)
    span = 1
    while True:
        behind = np.full(len(rank), -1, np.int64)
        behind[: len(rank) - span if span < len(rank) else 0] = rank[span:]
        key = rank * (len(rank) + 1) + behind + 1
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        new = np.concatenate(([0], np.cumsum(ranked[1:] != ranked[:-1])))
        rank[order] = new
        span *= 2
        if span >= reach or new[-1] == len(rank) - 1:
            return order


def named(text: np.ndarray, up: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Order-preserving names of the substrings from each LMS position to the
    next one, both ends included. Of equal letters the one followed by less is
    less."""
    end = np.concatenate((lms[1:] + 1, [len(text)]))
    size, code = end - lms, text.astype(np.int64) * 2 + up + 1
    rank = np.zeros(len(lms), np.int64)
    # A few letters at a time, packed into one number; only those that are
    # still going and still equal to another are looked at again.
    at, live = 0, np.arange(len(lms))
    while len(live):
        word = np.zeros(len(live), np.int64)
        for k in range(at, at + 4):
            inside = k < size[live]
            letter = np.where(inside, code[np.minimum(lms[live] + k, len(text) - 1)], 0)
            word = word * 1200 + letter
        order = np.lexsort((word, rank[live]))
        r, w = rank[live][order], word[order]
        change = (r[1:] != r[:-1]) | (w[1:] != w[:-1])
        # Names stay free for those that are split off later: a group starts
        # at its old name plus the number of members before it.
        group = np.concatenate(([True], r[1:] != r[:-1]))
        index = np.arange(len(live))
        start = np.maximum.accumulate(np.where(group, index, 0))
        first = np.maximum.accumulate(np.where(np.concatenate(([True], change)), index, 0))
        rank[live[order]] = r + first - start
        if at == 0:
            rank[live[order]] = first
        alone = np.concatenate(([True], change)) & np.concatenate((change, [True]))
        going = ~alone & (size[live[order]] > at + 4)
        live = live[order][going]
        live.sort()
        at += 4
    return rank


def shared(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, up to ``cap``.

    Six letters are packed into a number, and numbers compared until they differ.
    """
    n, wide = len(text), 6
    letters = np.zeros(n + cap + 2 * wide, np.int64)
    letters[:n] = text + 1  # 0 stands behind the end
    words = letters[: n + cap + wide].copy()
    for k in range(1, wide):
        words = (words << 10) | letters[k : k + len(words)]
    out = np.full(len(a), cap, np.int64)
    live = np.arange(len(a))
    for k in range(0, cap, wide):
        x = words[a[live] + k] ^ words[b[live] + k]
        differ = x != 0
        if differ.any():
            # Letters before the highest bit in which the numbers differ.
            bits = np.frexp(x[differ].astype(np.float64))[1]
            out[live[differ]] = k + (10 * wide - bits) // 10
            live = live[~differ]
            if not len(live):
                break
    return np.minimum(np.minimum(out, cap), n - np.maximum(a, b))


def suffix_order(text: np.ndarray, cap: int, budget: int = 64 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Positions in order of their suffixes' first ``cap`` letters, and the
    length each shares with the one before, up to ``cap``. Letters are 0 … 509."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = text.astype(np.int32)
    run = letter_runs(text)
    up = rises(text, run)
    lms = np.flatnonzero(up[1:] & ~up[:-1]) + 1
    if len(lms):
        names = named(text, up, lms)
        order = lms[_order(names, cap, budget)]
        lcp = np.concatenate(([0], shared(text, order[:-1], order[1:], cap)))
    else:
        order, lcp = lms, np.zeros(0, np.int64)
    return _induce(text, up, run, order, lcp, cap, budget)


def _order(names: np.ndarray, cap: int, budget: int) -> np.ndarray:
    """Suffix order of the names. With few names for their number the names are
    a text to be sorted by induction; else, nearly all are told apart soon and
    doubling is shorter."""
    dense = np.unique(names, return_inverse=True)[1]
    if dense.max(initial=0) < 500 and len(dense) > 5000:
        return suffix_order(dense, cap, budget)[0]
    return doubled(dense, cap // 2 + 1)


class _Least:
    """Least of any range of a block."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        step = 1
        while 2 * step <= len(values):
            below = self.levels[-1]
            self.levels.append(np.minimum(below[:-step], below[step:]))
            step *= 2

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of [start, end), none empty."""
        depth = np.frexp((end - start).astype(np.float64))[1] - 1
        out = np.empty(len(start), np.int64)
        for k in np.unique(depth):
            at = depth == k
            out[at] = np.minimum(self.levels[k][start[at]], self.levels[k][end[at] - (1 << int(k))])
        return out


class _Induction:
    """Puts the suffixes that stand before the given ones into their queues."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, cap: int, budget: int):
        self.text, self.wanted, self.cap = text, wanted, cap
        letters = int(text.max()) + 1
        self.queues = LetterQueues(letters, budget)
        self.least = np.full(letters, -1, np.int64)  # since a letter's last entry; -1: none yet

    def take(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        """``pos`` in order; lcp: shared with the one taken before."""
        before = pos - 1
        use = np.flatnonzero((before >= 0) & self.wanted[np.maximum(before, 0)])
        if not len(use):
            self._pass(lcp)
            return
        letter = self.text[before[use]]
        order = np.argsort(letter, kind="stable")
        at, letter = use[order], letter[order]
        head = np.concatenate(([True], letter[1:] != letter[:-1]))
        least = _Least(lcp)
        start = np.where(head, 0, np.concatenate(([0], at[:-1] + 1)))
        got = least.of(start, at + 1)
        last = self.least[letter]
        got = np.where(head, np.where(last < 0, -1, np.minimum(got, np.maximum(last, 0))), got)
        shared = np.minimum(got + 1, self.cap)
        edges = np.flatnonzero(head).tolist() + [len(letter)]
        self._pass(lcp)
        for a, b in zip(edges, edges[1:], strict=False):
            self.queues.push(int(letter[a]), before[at[a:b]], shared[a:b])
        ends = at[np.array(edges[1:]) - 1]
        rest = np.full(len(ends), self.cap, np.int64)
        more = ends + 1 < len(lcp)
        if more.any():
            rest[more] = least.of(ends[more] + 1, np.full(int(more.sum()), len(lcp)))
        self.least[letter[np.array(edges[:-1])]] = rest

    def _pass(self, lcp: np.ndarray) -> None:
        self.least = np.where(self.least < 0, self.least, np.minimum(self.least, lcp.min()))


def _induce(text, up, run, order, lcp, cap, budget):
    n, letters = len(text), int(text.max()) + 1
    starts = np.searchsorted(text[order], np.arange(letters + 1)) if len(order) else np.zeros(letters + 1, np.int64)
    falling = _Induction(text, ~up, cap, budget)
    falling.take(np.array([n]), np.array([0]))
    low: list[tuple[np.ndarray, np.ndarray]] = []
    for c in range(letters):
        got, last = [], None
        for pos, shared_ in falling.queues.pull(c):
            falling.take(pos, shared_)
            got.append((pos, shared_))
            last = pos[-1]
        low.append(_joined(got))
        a, b = int(starts[c]), int(starts[c + 1])
        for k in range(a, b, BLOCK):
            pos, shared_ = order[k : min(k + BLOCK, b)], lcp[k : min(k + BLOCK, b)].copy()
            if k == a:
                shared_[0] = 0 if last is None else min(run[last], run[pos[0]], cap)
            falling.take(pos, shared_)
    rising = _Induction(text, up, cap, budget)
    high: list = [None] * letters
    for c in range(letters - 1, -1, -1):
        got, last = [], None
        for pos, shared_ in rising.queues.pull(c):
            rising.take(pos, shared_)
            got.append((pos, shared_))
            last = pos[-1]
        high[c] = _joined(got)
        pos, shared_ = low[c]
        if len(pos):
            # Downwards each shares with the one above it.
            down = pos[::-1]
            seam = 0 if last is None else min(run[last], run[pos[-1]], cap)
            with_above = np.concatenate(([seam], shared_[1:][::-1]))
            for k in range(0, len(down), BLOCK):
                rising.take(down[k : k + BLOCK], with_above[k : k + BLOCK])
    out_pos, out_lcp = [], []
    for c in range(letters):
        (lp, ll), (hp, hl) = low[c], high[c]
        if len(lp):
            ll = ll.copy()
            ll[0] = 0
        if len(hp):
            seam = 0 if not len(lp) else min(run[lp[-1]], run[hp[-1]], cap)
            hl = np.concatenate(([seam], hl[1:][::-1]))
            hp = hp[::-1]
        out_pos += [lp, hp]
        out_lcp += [ll, hl]
    return np.concatenate(out_pos), np.concatenate(out_lcp)


def _joined(parts: list) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([p for p, _ in parts]), np.concatenate([x for _, x in parts])
