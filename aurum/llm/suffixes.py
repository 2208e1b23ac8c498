"""External induced suffix sorting with common prefixes.

Sorts the suffixes of a text. Queues, text, types and output are in scratch
files; arrays over the whole text (numbers, names, ranks, the section at hand)
are not, so the text is limited by memory (README, known limits). The smallest
local suffixes (those of type S whose predecessor is of type L) are sorted
first: their pieces by one round of induction, then, where pieces repeat, the
string of their names by recursion. All other suffixes are induced from them:
first the L ones in ascending order, then the S ones in descending order.

The suffixes waiting to be placed are in a priority queue ordered by first
symbol and then by arrival. It is kept as one first-in-first-out file section
per symbol: tuples (position, common prefix with the tuple before it) stay in
memory up to a limit and are written to a task-private scratch file beyond it.
A common prefix is induced like the suffix itself: one more than the smallest
common prefix passed in the scan since the queue's last tuple. The text, the
types and the sorted output are memory-mapped scratch files too.

Scratch files live in the task's own temporary folder while it runs, as
Spark's spill files do; nothing reads them afterwards, and a repeated task
makes its own.

Common prefixes are counted up to ``depth``, which is all a caller asks for.
"""

from __future__ import annotations

import heapq
import tempfile
from collections.abc import Iterator

import numpy as np

#: Tuples scanned at a time, tuples a queue set keeps in memory, and the size
#: up to which a recursion's string is sorted in memory.
BATCH, IN_MEMORY, BASE = 1 << 20, 1 << 22, 1 << 22
#: Bytes of an array that isn't worth a file.
SMALL = 1 << 24


def scratch(shape: int, dtype) -> np.ndarray:
    """A zeroed array in an unnamed scratch file (gone with the array), in
    memory where it is small."""
    if shape * np.dtype(dtype).itemsize < SMALL:
        return np.zeros(shape, dtype)
    return np.memmap(tempfile.TemporaryFile(), dtype=dtype, mode="w+", shape=shape)


class Queues:
    """First-in-first-out queues by symbol, spilled to one scratch file."""

    def __init__(self, limit: int = IN_MEMORY):
        self._limit, self._held = limit, 0
        self._parts: dict[int, list] = {}
        self._file, self._end = None, 0

    def push(self, symbol: int, at: np.ndarray, lcp: np.ndarray) -> None:
        self._parts.setdefault(symbol, []).append((at, lcp))
        self._held += len(at)
        if self._held > self._limit:
            self._spill()

    def _spill(self) -> None:
        if self._file is None:
            self._file = tempfile.TemporaryFile()
        self._file.seek(self._end)
        for parts in self._parts.values():
            for i, p in enumerate(parts):
                if isinstance(p[0], np.ndarray):
                    n = len(p[0])
                    parts[i] = (self._end, n)
                    self._file.write(p[0].astype(np.int64).tobytes())
                    self._file.write(p[1].astype(np.int16).tobytes())
                    self._end += 10 * n
        self._held = 0

    def symbols(self) -> list[int]:
        return sorted(self._parts)

    def pop(self, symbol: int, most: int = BATCH) -> tuple[np.ndarray, np.ndarray] | None:
        """The head of a queue, up to about ``most`` tuples."""
        parts = self._parts.get(symbol)
        if not parts:
            self._parts.pop(symbol, None)
            return None
        at, lcp, n = [], [], 0
        taken = 0
        while taken < len(parts) and (not n or n < most):
            a, b = parts[taken]
            if isinstance(a, np.ndarray):
                self._held -= len(a)
            else:
                self._file.seek(a)
                a, b = np.frombuffer(self._file.read(8 * b), np.int64), np.frombuffer(self._file.read(2 * b), np.int16)
            at.append(a)
            lcp.append(b)
            n += len(a)
            taken += 1
        del parts[:taken]
        return np.concatenate(at), np.concatenate(lcp)


class Section:
    """Tuples of one symbol in sorted order, appended and read back whole."""

    def __init__(self):
        self.at, self.lcp = [], []

    def add(self, at, lcp) -> None:
        self.at.append(at)
        self.lcp.append(lcp)


def _types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is of type S, from the end, a batch at a time."""
    n = len(text)
    out = scratch(n, bool)
    following, s = -1, False  # the end is smaller than any symbol: the last suffix is L
    for hi in range(n, 0, -BATCH):
        lo = max(0, hi - BATCH)
        part = np.asarray(text[lo:hi]).astype(np.int64)
        after = np.append(part[1:], following)
        up, equal = part < after, part == after
        # Equal neighbours take the type of the next different one.
        place = np.where(equal, len(part), np.arange(len(part)))
        place = np.minimum.accumulate(place[::-1])[::-1]
        known = np.append(up, s)
        out[lo:hi] = known[place]
        following, s = int(part[0]), bool(out[lo])
    return out


class _Minimum:
    """Range minima over a batch (sparse table)."""

    def __init__(self, x: np.ndarray):
        self.rows = [x]
        step = 1
        while 2 * step <= len(x):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minima over lo..hi, both included."""
        level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        out = np.empty(len(lo), np.int16)
        for k in np.unique(level):
            m = level == k
            row = self.rows[k]
            out[m] = np.minimum(row[lo[m]], row[hi[m] - (1 << int(k)) + 1])
        return out


class _Pass:
    """One direction of induction over one text."""

    def __init__(self, text, s_type, want_s: bool, depth: int, alphabet: int):
        self.text, self.s_type, self.want_s, self.depth = text, s_type, want_s, depth
        self.queues = Queues()
        # Smallest common prefix scanned since the last push to each queue; -1: none yet.
        self.since = np.full(alphabet, -1, np.int16) if depth else None

    def scan(self, at: np.ndarray, lcp: np.ndarray) -> None:
        before = at - 1
        ok = before >= 0
        before = np.where(ok, before, 0)
        ok &= self.s_type[before] == self.want_s
        index = np.flatnonzero(ok)
        symbols = self.text[before[index]].astype(np.int64)
        order = np.argsort(symbols.astype(np.uint8) if self.since is not None else symbols, kind="stable")
        index, symbols = index[order], symbols[order]
        begin = np.flatnonzero(np.diff(symbols, prepend=-1))
        pushed = before[index]
        if self.depth:
            lows = _Minimum(lcp)
            previous = np.empty(len(index), np.int64)
            previous[1:] = index[:-1]
            previous[begin] = -1
            value = lows(previous + 1, index) if len(index) else np.empty(0, np.int16)
            heads = symbols[begin]
            value[begin] = np.minimum(value[begin], self.since[heads])
            value = np.minimum(value + 1, self.depth).astype(np.int16)
            last = index[np.append(begin[1:], len(index)) - 1] if len(index) else index
            np.minimum(self.since, lcp.min() if len(lcp) else self.depth, out=self.since)
            rest = np.full(len(heads), self.depth, np.int16)
            inside = last < len(lcp) - 1
            if inside.any():
                rest[inside] = lows(last[inside] + 1, np.full(int(inside.sum()), len(lcp) - 1))
            self.since[heads] = rest
        else:
            value = np.zeros(len(index), np.int16)
        for lo, hi in zip(begin.tolist(), np.append(begin[1:], len(index)).tolist()):
            self.queues.push(int(symbols[lo]), pushed[lo:hi], value[lo:hi])


def _equal_run(text: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many of the eight symbols from ``x`` and from ``y`` on are equal, up
    to the first that differ or the end of the text."""
    n = len(text)
    run = np.empty(len(x), np.int16)
    slow = np.arange(len(x))
    if text.dtype == np.uint8 and n >= 8:
        # Bytes: eight as one integer, whose lowest different bit is in the first different byte.
        words = np.ndarray((n - 7,), "<u8", text, strides=(1,))
        differ = words[np.minimum(x, n - 8)] ^ words[np.minimum(y, n - 8)]
        run[:] = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) >> 3
        slow = np.flatnonzero(np.maximum(x, y) > n - 8)
    if len(slow):
        i, j = x[slow, None] + np.arange(8), y[slow, None] + np.arange(8)
        same = (i < n) & (j < n) & (text[np.minimum(i, n - 1)] == text[np.minimum(j, n - 1)])
        run[slow] = np.where(same.all(axis=1), 8, same.argmin(axis=1))
    return run


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Common prefixes of suffix pairs, up to ``depth``, eight symbols at a time."""
    out = np.zeros(len(a), np.int16)
    live = np.arange(len(a))
    for k in range(0, depth, 8):
        run = np.minimum(_equal_run(text, a[live] + k, b[live] + k), min(8, depth - k))
        out[live] += run
        live = live[run == 8]
        if not len(live):
            break
    return out


def _induce(text, s_type, seeds: dict[int, list], depth: int, alphabet: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes in ascending order, a section per first symbol and type,
    with common prefixes to the one before. ``seeds``: sorted smallest local
    suffixes by first symbol."""
    n = len(text)
    up = _Pass(text, s_type, False, depth, alphabet)
    end = int(text[n - 1])
    up.queues.push(end, np.array([n - 1]), np.zeros(1, np.int16))
    if depth:
        up.since[end] = 0
    larger: dict[int, tuple] = {}
    todo = sorted(set(seeds) | {end}, reverse=True)

    def seam(a: int, b: int) -> int:
        return int(common_prefix(text, np.array([a]), np.array([b]), depth)[0]) if depth else 0

    pending = set(todo)
    heap = sorted(pending)
    while heap:
        c = heapq.heappop(heap)
        own = Section()
        while (head := up.queues.pop(c)) is not None:
            own.add(*head)
            up.scan(*head)
        if c in seeds:
            at, lcp = seeds[c]
            if own.at:
                lcp = lcp.copy()
                lcp[0] = seam(int(own.at[-1][-1]), int(at[0]))
            up.scan(at, lcp)
        if own.at:
            at, lcp = np.concatenate(own.at), np.concatenate(own.lcp)
            a, b = scratch(len(at), np.int64), scratch(len(at), np.int16)
            a[:], b[:] = at, lcp
            larger[c] = (a, b)
        for s in up.queues.symbols():
            if s not in pending:
                pending.add(s)
                heapq.heappush(heap, s)

    down = _Pass(text, s_type, True, depth, alphabet)
    smaller: dict[int, tuple] = {}
    pending = set(larger)
    heap = [-c for c in pending]
    heapq.heapify(heap)
    while heap:
        c = -heapq.heappop(heap)
        own = Section()
        while (head := down.queues.pop(c)) is not None:
            own.add(*head)
            down.scan(*head)
        if c in larger:
            at, lcp = larger[c]
            back = np.empty(len(at), np.int16)
            back[1:] = lcp[:0:-1]
            back[0] = seam(int(own.at[-1][-1]), int(at[-1])) if own.at else 0
            for lo in range(0, len(at), BATCH):
                down.scan(np.asarray(at[::-1][lo:lo + BATCH]), back[lo:lo + BATCH])
        if own.at:
            at, lcp = np.concatenate(own.at), np.concatenate(own.lcp)
            a, b = scratch(len(at), np.int64), scratch(len(at), np.int16)
            a[:] = at[::-1]
            b[1:] = lcp[:0:-1]
            smaller[c] = (a, b)
        for s in down.queues.symbols():
            if s not in pending:
                pending.add(s)
                heapq.heappush(heap, -s)
    for c in sorted(set(larger) | set(smaller)):
        if c in larger:
            at, lcp = larger[c]
            yield np.asarray(at), np.asarray(lcp)
        if c in smaller:
            at, lcp = smaller[c]
            lcp = np.array(lcp)
            lcp[0] = seam(int(larger[c][0][-1]), int(at[0])) if c in larger else 0
            yield np.asarray(at), lcp


def _sort_in_memory(names: np.ndarray) -> np.ndarray:
    """Suffix order by doubling, for a string that fits in memory. A suffix's
    rank is the place of the first of its equals so far; only those that still
    have equals are sorted again."""
    n = len(names)
    bits = int(names.max() + 2).bit_length()
    k = max(1, min(62 // bits, n))
    key = np.zeros(n, np.int64)
    for j in range(k):  # the first k names at once
        key <<= bits
        key[:n - j] += names[j:] + 1
    out = np.argsort(key)
    live, begin = out, np.ones(n, bool)
    begin[1:] = key[out][1:] != key[out][:-1]
    base = np.zeros(n, np.int64)
    rank = np.empty(n, np.int64)
    while True:
        # Of the sorted live suffixes: rank is the group's base plus the place of its equals.
        first = np.flatnonzero(begin)
        rank[live] = np.repeat(base[first] + first, np.diff(np.append(first, len(live))))
        sizes = np.diff(np.append(first, len(live)))
        out[rank[live[first[sizes == 1]]]] = live[first[sizes == 1]]
        live = live[np.repeat(sizes > 1, sizes)]
        if not len(live):
            return out
        second = np.where(live + k < n, rank[np.minimum(live + k, n - 1)] + 1, 0)
        order = np.lexsort((second, rank[live]))
        live, second = live[order], second[order]
        own = rank[live]
        group = np.ones(len(live), bool)
        group[1:] = own[1:] != own[:-1]
        begin = group.copy()
        begin[1:] |= second[1:] != second[:-1]
        base = own - np.maximum.accumulate(np.where(group, np.arange(len(live)), 0))
        k *= 2


def _by_symbol(text, at: np.ndarray, lcp: np.ndarray) -> dict[int, tuple]:
    """Sorted suffixes cut by first symbol; each section starts anew."""
    if not len(at):
        return {}
    first = text[at].astype(np.int64)
    begin = np.flatnonzero(np.diff(first, prepend=-1))
    out = {}
    for lo, hi in zip(begin.tolist(), np.append(begin[1:], len(at)).tolist()):
        part = lcp[lo:hi].copy()
        part[0] = 0
        out[int(first[lo])] = (at[lo:hi], part)
    return out


def suffix_order(text: np.ndarray, depth: int, *, base: int = BASE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sections (positions, common prefixes with the position before, up to
    ``depth``) of all suffixes of ``text`` in ascending order. The common
    prefix of a section's first suffix is 0 where the section starts a new
    first symbol. Symbols are small non-negative integers."""
    n = len(text)
    if not n:
        return
    alphabet = int(text.max()) + 1
    s_type = _types(text)
    local = np.flatnonzero(s_type & np.append(True, ~np.asarray(s_type[:-1])))
    local = local[local > 0]  # position 0 has nothing to its left to induce
    if len(local):
        # One round of induction from unsorted seeds sorts the pieces between them.
        order = np.argsort(text[local], kind="stable")
        seeds = _by_symbol(text, local[order], np.zeros(len(local), np.int16))
        is_local = np.zeros(n, bool)
        is_local[local] = True
        pieces = np.concatenate([at[is_local[at]] for at, _ in _induce(text, s_type, seeds, 0, alphabet)])
        number = np.empty(n, np.int64)
        number[local] = np.arange(len(local))
        which = number[pieces]
        lengths = np.diff(np.append(local, n - 1)) + 1
        size = lengths[which]
        equal = np.zeros(len(pieces), bool)
        live = np.flatnonzero(size[1:] == size[:-1]) + 1
        # A piece that runs into the end of the text equals no other.
        live = live[(which[live] != len(local) - 1) & (which[live - 1] != len(local) - 1)]
        for k in range(0, int(size[live].max()) if len(live) else 0, 8):
            left = size[live] - k
            same = _equal_run(text, pieces[live] + k, pieces[live - 1] + k) >= np.minimum(left, 8)
            equal[live[same & (left <= 8)]] = True
            live = live[same & (left > 8)]
            if not len(live):
                break
        name = np.empty(len(local), np.int64)
        name[which] = np.cumsum(~equal) - 1
        if equal.any():
            if len(name) <= base:
                rank = _sort_in_memory(name)
            else:
                rank = np.concatenate([at for at, _ in suffix_order(name, 0, base=base)])
        else:
            rank = which
        ordered = local[rank]
        lcp = np.zeros(len(ordered), np.int16)
        for lo in range(1, len(ordered), BATCH // 4) if depth else ():
            hi = min(len(ordered), lo + BATCH // 4)
            lcp[lo:hi] = common_prefix(text, ordered[lo - 1:hi - 1], ordered[lo:hi], depth)
        seeds = _by_symbol(text, ordered, lcp)
    else:
        seeds = {}
    yield from _induce(text, s_type, seeds, depth, alphabet)
