"""Suffix-array dedup over bytes by external induced sorting (operator 6).

Every string of ``length`` bytes that also starts in a document with a smaller
id is removed. Suffix arrays find the equal strings; what they sort is cut down
and dealt out first, without losing a string:

0. Of documents with the same text only the one with the smallest id takes
   part; the others consist of its strings.
1. Each window of ``length`` bytes has one anchor, its byte 24-gram of smallest
   hash (the leftmost of equals). Equal windows have equal anchors at equal
   offsets, so a window whose anchor no other document holds is unique.
2. The windows of an anchor that several documents hold form a chunk, the
   bytes from the first to the end of the last, some 70 bytes. Distinct chunks
   of a task's flush, with the smallest document that holds each, go to the
   shard of their anchor. A chunk held by a third of all documents is one entry
   per flush.
3. A shard takes each distinct chunk once. Its windows, in parts by how far
   before the anchor they begin, can only equal windows of another chunk that
   has the same bytes common to the part; parts whose bytes no other chunk has
   are unique. The rest, separated by a byte that no UTF-8 text holds, goes
   to scratch files and all its suffixes are sorted with common prefixes
   (``suffixes``: induced sorting with disk-backed queues; names, ranks and
   sections are held in memory, so a shard must be small, see the README's known
   limits). Runs of suffixes that share ``length``
   bytes are equal windows; the smallest document of a run answers each.
4. The answers go back to the flushes, run-length coded, and become spans of
   removed bytes by document.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import materialize, mix64, release, row_slices
from aurum.llm.exchange import NO_ID, keyed, on_key, shared_places
from aurum.llm.suffixes import scratch, suffix_order

LENGTH, GRAM = 50, 24
SEPARATOR = 0xFF
#: Shards per shuffle partition: smaller ones sort faster and hold less at a time.
SHARDS = 4
#: Bytes of the input's texts per shard at most, however few the partitions.
SHARD_TEXT = 4 << 20
#: Bytes of chunks in a flush.
FLUSH_BYTES = 32 << 20


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one integer, not copied."""
    return np.ndarray((max(0, len(data) - 7),), "<u8", np.ascontiguousarray(data), strides=(1,))


def _spread(words: np.ndarray) -> np.ndarray:
    words = words * np.uint64(0x9E3779B97F4A7C15)
    words ^= words >> np.uint64(32)
    return words


def _odd(n: int, seed: int) -> np.ndarray:
    """Odd factors for the words of a string."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)


def _blend(words: list[np.ndarray], seed: int = 0) -> np.ndarray:
    """One hash of several spread words each."""
    h = None
    for w, factor in zip(words, _odd(len(words), seed)):
        w = w * factor
        h = w if h is None else np.add(h, w, out=h)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def _offsets(gram: int) -> list[int]:
    """Where the words begin that cover ``gram`` bytes (eight at least)."""
    return sorted({*range(0, gram - 7, 8), gram - 8})


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each ``gram``-byte string: of the words of eight bytes that
    cover it; of shorter strings those of powers of two from two neighbours of
    half the size, put together as the bits of ``gram`` say."""
    if gram >= 8:
        n, words = max(0, len(data) - gram + 1), _spread(_words(data))
        return _blend([words[o:o + n] for o in _offsets(gram)])
    part, size, base = data.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    whole, done = None, 0
    with np.errstate(over="ignore"):
        while True:
            if gram & size:
                if whole is None:
                    whole = part
                else:
                    n = len(part) - done
                    whole = whole[:n] * np.uint64(base) + part[done:]
                done += size
            if 2 * size > gram:
                return mix64(whole)
            part = part[:-size] * np.uint64(base) + part[size:]
            base, size = base * base & (1 << 64) - 1, 2 * size


def _window_anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor's place of each window of a piece of text, and the hashes of
    all ``gram``-byte strings. Hashes are compared by their upper bits (the
    lower ones hold the place), the leftmost of equals is the anchor."""
    h = _gram_hashes(data, gram)
    low = np.uint64((1 << (2 * max(_PIECE, length)).bit_length()) - 1)  # the same for every piece
    best = h & ~low | np.arange(len(h), dtype=np.uint64)
    width, size = length - gram + 1, 1
    while size < width:
        step = min(size, width - size)
        best = np.minimum(best[:-step], best[step:])
        size += step
    return (best & low).astype(np.int64), h


#: Bytes of text whose windows are looked at together.
_PIECE = 1 << 16


def _grouped_runs(texts: list[bytes], length: int, gram: int) -> Iterator[tuple]:
    """Runs of windows of ``length`` bytes that share an anchor, of short texts
    together and of long ones a piece at a time: the first text and the end of
    each group, its bytes, where its texts start in them, and for each run the
    first window, the end, the anchor's place and its hash."""
    lo = 0
    while lo < len(texts):
        hi, size = lo + 1, len(texts[lo])
        while hi < len(texts) and size + len(texts[hi]) <= _PIECE:
            size += len(texts[hi])
            hi += 1
        sizes = np.array([len(t) for t in texts[lo:hi]], np.int64)
        starts = np.cumsum(sizes) - sizes
        windows = np.maximum(sizes - length + 1, 0)
        if size > _PIECE:
            data = np.frombuffer(texts[lo], np.uint8)
            begin, at, h = _long_runs(data, length, gram)
            end = np.append(begin[1:], windows[0]) if len(begin) else begin
        elif windows.any():
            data = np.frombuffer(b"".join(texts[lo:hi]), np.uint8)
            best, h = _window_anchors(data, length, gram)
            # Without the windows that run from one text into the next.
            ends = np.cumsum(windows)
            own = np.repeat(starts - (ends - windows), windows) + np.arange(ends[-1])
            at = best[own]
            first = np.flatnonzero(np.diff(at, prepend=-1))
            begin, at, end = own[first], at[first], own[np.append(first[1:], len(own)) - 1] + 1
            h = h[at]
        else:
            data, begin, end, at, h = np.empty(0, np.uint8), *[np.empty(0, np.int64)] * 3, np.empty(0, np.uint64)
        yield lo, hi, data, starts, begin, end, at, h
        lo = hi


def _long_runs(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    step, last, out = max(_PIECE, length), -1, []
    for lo in range(0, len(data) - length + 1, step):
        best, h = _window_anchors(data[lo:lo + step + length - 1], length, gram)
        first = np.flatnonzero(np.diff(best, prepend=last - lo))  # a run may go on from the piece before
        last = int(best[-1]) + lo
        out.append((first + lo, best[first] + lo, h[best[first]]))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def _anchors(length: int, gram: int):
    def prepare(texts):
        data = [(t or "").encode() for t in texts]
        for lo, hi, _, starts, _, _, at, h in _grouped_runs(data, length, gram):
            cuts = np.searchsorted(at, starts).tolist() + [len(at)]
            for t, start, a, b in zip(data[lo:hi], starts.tolist(), cuts, cuts[1:]):
                yield len(t), h[a:b], None, at[a:b] - start

    return prepare, lambda: lambda made: made


_CHUNKS = ("uid long, bucket int, text binary, sizes binary, digests binary, docs binary, "
           "ids binary, prints binary, owners binary, starts binary, entries binary, anchors binary")
_ANSWERS = "uid long, bucket int, least binary, runs binary"
_SPANS = "doc_id long, print long, spans binary"


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of ranges, one after the other."""
    ends = np.cumsum(size)
    return np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def _digests(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """128 bits of each chunk: two hashes of its size and the words that cover it."""
    words, last, short = _words(np.append(data, np.zeros(8, np.uint8))), np.maximum(size - 8, 0), size < 8
    taken = [_spread(size.astype(np.uint64))]
    for k in range(-(-int(size.max()) // 8) if len(size) else 0):
        w = words[begin + np.minimum(8 * k, last)]
        if short.any():  # without the bytes behind them
            w[short] &= (np.uint64(1) << (8 * size[short]).astype(np.uint64)) - np.uint64(1)
        w = _spread(w)
        w[size <= 8 * k] = 0  # a chunk's hash doesn't depend on the longest one's words
        taken.append(w)
    return np.stack([_blend(taken, seed) for seed in (1, 2)], 1)


class _Flush:
    """The chunks of a task's documents, until there are many."""

    def __init__(self, buckets: int, limit: int):
        self.buckets, self.limit, self.number = buckets, limit, 0
        self._clear()

    def _clear(self) -> None:
        self.bytes = self.count = 0
        # Of chunks: bytes, sizes, digests, buckets, smallest documents, anchors.
        self.chunks: list[list[np.ndarray]] = [[] for _ in range(6)]
        self.ids, self.prints, self.owners, self.starts, self.entries = [], [], [], [], []

    def add(self, ids: list[int], prints: list[int], data: np.ndarray, first: np.ndarray, owner: np.ndarray,
            begin: np.ndarray, size: np.ndarray, at: np.ndarray, h: np.ndarray) -> bool:
        """Add documents that start at ``first`` in ``data`` and their chunks;
        returns whether the flush is full."""
        # Anchors have small hashes: mixed again, they fill all shards alike.
        bucket = ((mix64(h) >> np.uint64(32)) * np.uint64(self.buckets) >> np.uint64(32)).astype(np.int64)
        own = (data[_ranges(begin, size)], size, _digests(data, begin, size), bucket, np.array(ids, np.int64)[owner], at - begin)
        for c, v in zip(self.chunks, own):
            c.append(v)
        self.owners.append((owner + len(self.ids)).astype(np.uint32))
        self.starts.append(begin - first[owner])
        self.entries.append(np.arange(self.count, self.count + len(begin)))
        self.ids += ids
        self.prints += prints
        self.bytes += len(own[0])
        self.count += len(begin)
        if self.bytes < self.limit and self.count < 1 << 20:
            return False
        self._distinct()
        return 2 * self.bytes >= self.limit or self.count >= 1 << 19

    def _distinct(self) -> None:
        """Each chunk once, with the smallest document that holds it, by bucket."""
        data, size, digests, bucket, docs, places = (np.concatenate(c) for c in self.chunks)
        order = np.argsort(digests[:, 0])
        fresh = np.ones(len(order), bool)
        fresh[1:] = (digests[order[1:]] != digests[order[:-1]]).any(axis=1)
        begin = np.flatnonzero(fresh)
        chosen = order[begin]
        docs = np.minimum.reduceat(docs[order], begin)
        by = np.argsort(bucket[chosen].astype(np.uint16) if self.buckets <= 1 << 16 else bucket[chosen], kind="stable")
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        number = np.empty(len(order), np.int64)
        number[order] = rank[np.cumsum(fresh) - 1]
        chosen, offsets = chosen[by], np.cumsum(size) - size
        data = np.concatenate([data[_ranges(offsets[c], size[c])] for c in np.array_split(chosen, 1 + len(chosen) // _PIECE)])
        self.chunks = [[data], [size[chosen]], [digests[chosen]], [bucket[chosen]], [docs[by]], [places[chosen]]]
        self.entries = [number[np.concatenate(self.entries)]]
        self.bytes, self.count = len(data), len(chosen)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.count:
            return
        self._distinct()
        uid = (TaskContext.get().partitionId() << 24) | self.number
        self.number += 1
        data, size, digests, bucket, docs, places = (c[0] for c in self.chunks)
        to = np.append(0, np.cumsum(size))
        size, places = size.astype(np.uint32), places.astype(np.uint32)
        columns = [[] for _ in range(12)]
        begin = np.flatnonzero(np.diff(bucket, prepend=-1))
        for lo, hi in zip(begin.tolist(), np.append(begin[1:], len(bucket)).tolist()):
            row = (uid, int(bucket[lo]), zstandard.compress(data[to[lo]:to[hi]].tobytes(), 1), size[lo:hi].tobytes(),
                   digests[lo:hi].tobytes(), docs[lo:hi].tobytes(), None, None, None, None, None, places[lo:hi].tobytes())
            for c, v in zip(columns, row):
                c.append(v)
        row = (uid, -1, None, size.tobytes(), None, None, np.array(self.ids, np.int64).tobytes(), np.array(self.prints, np.int64).tobytes(),
               np.concatenate(self.owners).tobytes(), np.concatenate(self.starts).astype(np.int64).tobytes(),
               self.entries[0].astype(np.uint32).tobytes(), None)
        for c, v in zip(columns, row):
            c.append(v)
        self._clear()
        types = [pa.int64(), pa.int32()] + [pa.binary()] * 10
        names = [f.split()[0] for f in _CHUNKS.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _pack(length: int, gram: int, buckets: int, flush_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = _Flush(buckets, flush_bytes)
        for b in row_slices(batches):
            ids, prints, texts, places = (b.column(i).to_pylist() for i in range(4))
            for lo, hi, data, first, begin, end, at, h in _grouped_runs([t.encode() for t in texts], length, gram):
                wanted = [np.frombuffer(p, np.int64) for p in places[lo:hi]]
                owner = np.repeat(np.arange(hi - lo), [len(p) for p in wanted])
                wanted = np.concatenate(wanted) + first[owner]
                i = np.searchsorted(at, wanted)
                own = [NO_ID if d is None else d for d in ids[lo:hi]]
                if f.add(own, prints[lo:hi], data, first, owner, begin[i], (end - begin)[i] + (length - 1), at[i], h[i]):
                    yield from f.rows()
        yield from f.rows()
    return run


class Shard:
    """The chunks of one shard, their bytes in a scratch file."""

    #: Parts of a chunk's windows that are compared by the bytes they share.
    PARTS = 5

    def __init__(self, length: int, gram: int):
        self.length, self.gram = length, gram
        self._file = tempfile.TemporaryFile()
        self.uids, self.sizes, self.digests, self.docs, self.anchors = [], [], [], [], []

    def add(self, uid: int, text: bytes, sizes: bytes, digests: bytes, docs: bytes, anchors: bytes) -> None:
        self._file.write(zstandard.decompress(text))
        self.uids.append(uid)
        self.sizes.append(np.frombuffer(sizes, np.uint32).astype(np.int64))
        self.digests.append(np.frombuffer(digests, np.uint64).reshape(-1, 2))
        self.docs.append(np.frombuffer(docs, np.int64))
        self.anchors.append(np.frombuffer(anchors, np.uint32).astype(np.int64))

    def _distinct(self):
        """The distinct chunks: places in the file, sizes, places of their
        anchors, smallest documents, and each entry's number."""
        sizes, digests, docs = np.concatenate(self.sizes), np.concatenate(self.digests), np.concatenate(self.docs)
        order = np.lexsort((digests[:, 1], digests[:, 0]))
        first = np.ones(len(order), bool)
        first[1:] = (digests[order][1:] != digests[order][:-1]).any(axis=1)
        begin = np.flatnonzero(first)
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(first) - 1
        least, chosen = np.minimum.reduceat(docs[order], begin), order[begin]
        # In order of their documents, so that the smaller chunk has the smaller document.
        by_doc = np.argsort(least, kind="stable")
        rank = np.empty(len(by_doc), np.int64)
        rank[by_doc] = np.arange(len(by_doc))
        least, chosen, number = least[by_doc], chosen[by_doc], rank[number]
        return (np.cumsum(sizes) - sizes)[chosen], sizes[chosen], np.concatenate(self.anchors)[chosen], least, number

    def _pieces(self, source: np.ndarray, offsets: np.ndarray, size: np.ndarray, anchors: np.ndarray):
        """What must be sorted: chunk, first window and end of each run of
        windows that may equal those of another chunk.

        A chunk's windows are taken in parts by how far before the anchor they
        begin. The windows of a part share the bytes from where the last of them
        begins to where the first ends; equal windows lie in the same part of
        their chunks, so a part whose bytes (by hash) no other chunk has holds
        only windows of its own chunk."""
        windows = size - self.length + 1
        width = -(-(self.length - self.gram + 1) // self.PARTS)
        common = self.length - width + 1
        if common < 8:
            return np.arange(len(size)), np.zeros(len(size), np.int64), windows
        words = _words(source)
        low, high, shared = [], [], []
        for k in range(self.PARTS - 1, -1, -1):
            # Windows that begin k * width .. k * width + width - 1 bytes before the anchor.
            last = anchors - k * width
            lo, hi = np.clip(last - width + 1, 0, windows), np.clip(last + 1, 0, windows)
            own = np.flatnonzero(lo < hi)
            h = np.empty(len(own), np.uint64)
            for a in range(0, len(own), _PIECE):
                at = (offsets + last)[own[a:a + _PIECE]]
                h[a:a + _PIECE] = _blend([_spread(words[at + o]) for o in _offsets(common)])
            order = np.argsort(h)
            same = h[order][1:] == h[order][:-1]
            several = np.zeros(len(own), bool)
            several[order[1:]] |= same
            several[order[:-1]] |= same
            mine = np.zeros(len(size), bool)
            mine[own[several]] = True
            low.append(lo)
            high.append(hi)
            shared.append(mine)
        low, high, shared = (np.stack(x, 1).reshape(-1) for x in (low, high, shared))
        at = np.flatnonzero(shared)
        chunk, low, high = at // self.PARTS, low[at], high[at]
        # Neighbouring parts are one run.
        begin = np.ones(len(at), bool)
        begin[1:] = (chunk[1:] != chunk[:-1]) | (low[1:] != high[:-1])
        end = np.ones(len(at), bool)
        end[:-1] = begin[1:]
        return chunk[begin], low[begin], high[end]

    def _text(self, source: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The bytes of pieces, each followed by a separator."""
        out = scratch(int(size.sum()) + len(size), np.uint8)
        to = 0
        for lo in range(0, len(size), 1 << 16):
            n, at = size[lo:lo + (1 << 16)] + 1, begin[lo:lo + (1 << 16)]
            part = source[np.minimum(_ranges(at, n), len(source) - 1)]
            part[np.cumsum(n) - 1] = SEPARATOR
            out[to:to + len(part)] = part
            to += len(part)
        return out

    def answer(self) -> Iterator[tuple[int, bytes, bytes]]:
        """For each flush: the smallest document of each window of each of its
        entries, as values and run lengths (runs end with an entry)."""
        offsets, size, anchors, least, number = self._distinct()
        self._file.flush()
        source = np.memmap(self._file, np.uint8, "r")
        chunk, lo, hi = self._pieces(source, offsets, size, anchors)
        windows = size - self.length + 1
        starts = np.cumsum(windows) - windows
        # The smallest chunk of each window's equals; of a window that was not sorted its own.
        low = scratch(int(windows.sum()), np.int32)
        for a in range(0, len(size), 1 << 16):
            n = windows[a:a + (1 << 16)]
            low[int(starts[a]):int(starts[a]) + int(n.sum())] = np.repeat(np.arange(a, a + len(n)), n)
        if len(chunk):
            self._sort(self._text(source, offsets[chunk] + lo, hi - lo + self.length - 1), chunk, starts[chunk] + lo, hi - lo, low)
        done = 0
        for uid, sizes in zip(self.uids, self.sizes):
            own = number[done:done + len(sizes)]
            done += len(sizes)
            n = sizes - self.length + 1
            ends = np.cumsum(n)
            values = least[low[_ranges(starts[own], n)]]
            change = np.empty(len(values), bool)
            change[1:] = values[1:] != values[:-1]
            change[np.concatenate([[0], ends[:-1]])] = True
            begin = np.flatnonzero(change)
            yield uid, values[begin].tobytes(), np.diff(np.append(begin, len(values))).astype(np.uint32).tobytes()

    def _sort(self, text: np.ndarray, chunk: np.ndarray, to: np.ndarray, windows: np.ndarray, low: np.ndarray) -> None:
        """Sort the suffixes of the pieces and note the smallest chunk of each
        run of equal windows in ``low``, where each piece's windows have places
        from ``to`` on."""
        sizes = windows + self.length
        owner = scratch(len(text), np.int32)
        place = scratch(len(text), np.int64)
        starts = np.cumsum(sizes) - sizes
        for a in range(0, len(sizes), 1 << 16):
            n, b = sizes[a:a + (1 << 16)], int(starts[a])
            end = b + int(n.sum())
            owner[b:end] = np.repeat(chunk[a:a + (1 << 16)], n)
            # Suffixes shorter than a window have no place.
            within = np.arange(b, end) - np.repeat(starts[a:a + (1 << 16)], n)
            place[b:end] = np.where(within < np.repeat(windows[a:a + (1 << 16)], n), np.repeat(to[a:a + (1 << 16)], n) + within, -1)
        tail = np.empty(0, np.int64)
        for at, lcp in suffix_order(text, self.length):
            if len(tail) and lcp[0] >= self.length:  # the run goes on from the section before
                at = np.concatenate([tail, at])
                joined = np.full(len(tail), self.length, np.int16)
                joined[0] = 0
                lcp = np.concatenate([joined, lcp])
            begin = np.flatnonzero(lcp < self.length)
            if not len(begin) or begin[0]:
                begin = np.concatenate([[0], begin])
            run = np.repeat(np.minimum.reduceat(owner[at], begin), np.diff(np.append(begin, len(at))))
            to_ = place[at]
            low[to_[to_ >= 0]] = run[to_ >= 0]
            tail = np.array(at[begin[-1]:])


def _sort_shards(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(bucket: int, shard: Shard) -> Iterator[pa.RecordBatch]:
            for uid, least, runs in shard.answer():
                yield pa.RecordBatch.from_pydict({
                    "uid": pa.array([uid], pa.int64()), "bucket": pa.array([bucket], pa.int32()),
                    "least": pa.array([least], pa.binary()), "runs": pa.array([runs], pa.binary())})

        now, shard = None, None
        for b in batches:
            for i in range(b.num_rows):
                uid, bucket, *rest = (b.column(k)[i].as_py() for k in range(7))
                if bucket != now:
                    if shard:
                        yield from told(now, shard)
                    now, shard = bucket, Shard(length, gram)
                shard.add(uid, *rest)
        if shard:
            yield from told(now, shard)
    return run


def _spans(length: int):
    """A flush's chunks with the answers for their windows: removed spans."""
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        out: dict[str, list] = {"doc_id": [], "print": [], "spans": []}
        told = answers.sort_by("bucket").to_pydict()
        for t in table.to_pylist():
            values = np.concatenate([np.frombuffer(x, np.int64) for x in told["least"]])
            runs = np.concatenate([np.frombuffer(x, np.uint32) for x in told["runs"]]).astype(np.int64)
            windows = np.frombuffer(t["sizes"], np.uint32).astype(np.int64) - length + 1
            # The runs of each entry, and where each begins in it.
            ends = np.cumsum(runs)
            stop = np.cumsum(windows)
            first = np.searchsorted(ends - runs, stop - windows)
            count = np.diff(np.append(first, len(runs)))
            inner = (ends - runs) - np.repeat(stop - windows, count)
            entry = np.frombuffer(t["entries"], np.uint32).astype(np.int64)
            ids, prints = np.frombuffer(t["ids"], np.int64), np.frombuffer(t["prints"], np.int64)
            owner, start = np.frombuffer(t["owners"], np.uint32).astype(np.int64), np.frombuffer(t["starts"], np.int64)
            n = count[entry]
            total = np.cumsum(n)
            index = np.repeat(first[entry] - (total - n), n) + np.arange(total[-1] if len(total) else 0)
            who = np.repeat(owner, n)
            hit = values[index] < ids[who]
            index, who = index[hit], who[hit]
            lo = np.repeat(start, n)[hit] + inner[index]
            hi = lo + runs[index] + length - 1
            # Runs are in order within a document: join those that touch.
            begin = np.ones(len(lo), bool)
            begin[1:] = (who[1:] != who[:-1]) | (lo[1:] > hi[:-1])
            at = np.flatnonzero(begin)
            if not len(at):
                continue
            spans = np.stack([lo[at], np.maximum.reduceat(hi, at)], 1)
            whose = who[at]
            cuts = np.flatnonzero(np.diff(whose, prepend=-1))
            for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(at)).tolist()):
                d = int(whose[a])
                out["doc_id"].append(None if ids[d] == NO_ID else int(ids[d]))
                out["print"].append(int(prints[d]))
                out["spans"].append(spans[a:b].tobytes())
        return pa.table({"doc_id": pa.array(out["doc_id"], pa.int64()), "print": pa.array(out["print"], pa.int64()),
                         "spans": pa.array(out["spans"], pa.binary())})
    return run


def repeated_spans(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, flush_bytes: int = FLUSH_BYTES) -> DataFrame:
    """``doc_id, print, spans`` (pairs of 64-bit integers: first byte, end) of
    the bytes to remove, for the documents that have any."""
    if not 0 < gram <= length:
        raise ValueError("gram must be at most length")
    every = keyed(docs)
    least = F.coalesce("doc_id", F.lit(NO_ID))
    # Copies of a text, but for its smallest document: all their bytes go.
    same = every.where(F.octet_length("text") >= length).select(
        least.alias("least"), "doc_id", "print", F.xxhash64(F.lit(1), F.col("text")).alias("print2"), F.octet_length("text").alias("n"))
    same = materialize(same, "texts")
    first = same.groupBy("print", "print2", "n").agg(F.min("least").alias("first"))
    copies = materialize(same.join(first, ["print", "print2", "n"]).where("least > first").select("doc_id", "print", "n"), "copies")
    own = every.alias("e").join(copies.alias("c"), on_key("e", "c"), "left_anti")
    partitions = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    prepare, entries = _anchors(length, gram)
    anchors = shared_places(own, entries, least=False, prepare=prepare).dropDuplicates(["doc_id", "print"])
    some = own.alias("d").join(anchors.alias("a"), on_key("d", "a")).select("d.doc_id", "d.print", "d.text", "a.at")
    size = same.agg(F.sum("n")).first()[0] or 0
    buckets = max(SHARDS * partitions, -(-size // SHARD_TEXT))
    chunks = materialize(some.mapInArrow(_pack(length, gram, buckets, flush_bytes), _CHUNKS), "chunks")
    release(anchors)
    shards = (chunks.where("bucket >= 0").select("uid", "bucket", "text", "sizes", "digests", "docs", "anchors")
              .repartition(max(partitions, buckets // SHARDS), "bucket").sortWithinPartitions("bucket", "uid"))
    answers = materialize(shards.mapInArrow(_sort_shards(length, gram), _ANSWERS), "answers")
    tables = chunks.where("bucket = -1").select("uid", "sizes", "ids", "prints", "owners", "starts", "entries")
    out = materialize(tables.groupBy("uid").cogroup(answers.groupBy("uid")).applyInArrow(_spans(length), _SPANS), "spans")
    release(chunks, answers, same)
    whole = copies.select("doc_id", "print", F.concat(_eight_bytes(F.lit(0)), _eight_bytes("n")).alias("spans"))
    return out.unionByName(whole).dropDuplicates(["doc_id", "print"])


def _eight_bytes(number):
    """A small integer as little-endian 64 bits."""
    number = F.col(number) if isinstance(number, str) else number
    return F.unhex(F.concat_ws("", *[F.lpad(F.hex(F.shiftright(number.cast("long"), 8 * k).bitwiseAND(F.lit(255).cast("long"))), 2, "0")
                                     for k in range(8)]))


def remove_substrings(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept binary``, one row per row of
    ``docs``: the whole text as UTF-8 without each byte that a ``length``-byte
    string covers which also starts in a document with a smaller doc_id.

    Strings never cross documents and are judged on the input. Rows that share
    a doc_id don't remove each other's bytes; a null doc_id counts as larger
    than all others. Null and empty texts have no bytes.
    """
    spans = repeated_spans(docs, length=length, gram=gram)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, removed, runs, kept = [], [], [], []
            for text, s in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                data = (text or "").encode()
                total.append(len(data))
                pairs = np.frombuffer(s, np.int64).reshape(-1, 2).tolist() if s else []
                parts, at = [], 0
                for lo, hi in pairs:
                    parts.append(data[at:lo])
                    at = hi
                parts.append(data[at:])
                kept.append(b"".join(parts))
                removed.append(len(data) - len(kept[-1]))
                runs.append(len(pairs))
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column(0), "n_bytes": pa.array(total, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(runs, pa.int64()), "kept": pa.array(kept, pa.binary())})

    joined = keyed(docs).alias("d").join(spans.alias("s"), on_key("d", "s"), "left").select("d.doc_id", "d.text", "s.spans")
    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
