"""Which hashes occur in more than one document, asked in packed form.

A task turns its documents into entries (hash, place) and packs them a flush
at a time, some million entries: the distinct hashes of a flush, sorted and cut
into buckets by range, and a table of where each occurs in its documents. Only
the distinct hashes travel, one row of bytes per flush and bucket. A bucket's
task merges them and answers each flush, one bit a hash; the answers go back to
the flush's table and become places in documents.

A hash held by a third of all documents is one entry per flush, so no bucket
grows with a hot hash, and a bucket's size is the input's over the number of
shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import document_columns, give_back, materialize, mix64, release, row_slices

FLUSH = 1_500_000
#: Entries worked on at a time where an array's temporaries would be as long as it.
_BLOCK = 1 << 17
#: A null doc_id counts as the largest.
NO_ID = np.iinfo(np.int64).max

_PACKED = "uid long, bucket int, h1 binary, h2 binary, docs binary, flags binary, prints binary, starts binary, at binary"
_ANSWER = "uid long, bucket int, n int, answer binary"
PLACES = "doc_id long, print long, at binary"


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, print, text``: the print tells apart rows that share a doc_id."""
    own = document_columns(docs)
    return own.select("doc_id", F.xxhash64("text").alias("print"), "text")


def on_key(left: str, right: str):
    return F.expr(f"{left}.doc_id <=> {right}.doc_id and {left}.print = {right}.print")


def _cuts(h: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's range of the sorted hashes begins and the last ends."""
    bounds = [(b << 64) // buckets for b in range(1, buckets)]
    return np.concatenate([[0], np.searchsorted(h, np.array(bounds, dtype=np.uint64)), [len(h)]])


def _runs(h1: np.ndarray, h2: np.ndarray | None) -> np.ndarray:
    """First of each run of equal hashes, in sorted order."""
    first = np.ones(len(h1), bool)
    first[1:] = h1[1:] != h1[:-1]
    if h2 is not None:
        first[1:] |= h2[1:] != h2[:-1]
    return first


def _order(h1: np.ndarray, h2: np.ndarray | None) -> np.ndarray:
    return np.argsort(h1, kind="stable") if h2 is None else np.lexsort((h2, h1))


class _Flush:
    """Entries of consecutive documents of a task."""

    def __init__(self, buckets: int, least: bool):
        self.buckets, self.least, self.number = buckets, least, 0
        self._clear()

    def _clear(self) -> None:
        self.h1, self.h2, self.at, self.ids, self.prints, self.starts, self.size, self.words = [], [], [], [], [], [], 0, 0

    def add(self, doc_id, print_, length: int, h1: np.ndarray, h2: np.ndarray | None, at: np.ndarray) -> None:
        if not len(h1):
            return
        self.h1.append(h1)
        if h2 is not None:
            self.h2.append(h2)
        self.at.append((at.astype(np.int64) + self.words).astype(np.uint32 if self.words + length <= 1 << 32 else np.int64))
        self.ids.append(NO_ID if doc_id is None else doc_id)
        self.prints.append(print_)
        self.starts.append(self.words)
        self.size += len(h1)
        self.words += length

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        batch = self._packed()
        give_back()
        yield batch

    def _packed(self) -> pa.RecordBatch:
        # Of the arrays as long as the flush few are held at a time.
        parts, seconds, places = self.h1, self.h2, self.at
        ids, prints, starts = np.array(self.ids, np.int64), np.array(self.prints, np.int64), np.array(self.starts, np.int64)
        self._clear()
        h1 = _joined(parts)
        for lo in range(0, len(h1), _BLOCK):  # Mixed again (one-to-one): hashes chosen for being small still fill all buckets alike.
            h1[lo:lo + _BLOCK] = mix64(h1[lo:lo + _BLOCK])
        h2, at = _joined(seconds) if seconds else None, _joined(places)
        order = _order(h1, h2)
        h1 = h1[order]
        h2 = h2[order] if h2 is not None else None
        at = at[order]
        del order
        # Rows that share a doc_id are documents of their own, unless only the smallest id counts.
        who = ids if self.least else np.unique(np.stack([ids, prints], 1), axis=0, return_inverse=True)[1].reshape(-1)
        owner = np.empty(len(at), who.dtype)
        for lo in range(0, len(at), _BLOCK):
            owner[lo:lo + _BLOCK] = who[np.searchsorted(starts, at[lo:lo + _BLOCK], side="right") - 1]
        first = _runs(h1, h2)
        begin = np.flatnonzero(first)
        low = np.minimum.reduceat(owner, begin)
        if not self.least:  # only whether more than one document holds it
            low = (low != np.maximum.reduceat(owner, begin)).astype(np.uint8)
        del owner
        h1 = h1[begin]
        h2 = h2[begin] if h2 is not None else None
        del begin
        uid = (TaskContext.get().partitionId() << 24) | self.number
        self.number += 1
        columns: dict[str, list] = {k: [] for k in ("uid", "bucket", "h1", "h2", "docs", "flags", "prints", "starts", "at")}

        def put(**row) -> None:
            for k, v in columns.items():
                v.append(row.get(k))

        cuts = _cuts(h1, self.buckets)
        for b, (lo, hi) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            if hi > lo:
                put(uid=uid, bucket=b, h1=h1[lo:hi].tobytes(), h2=h2[lo:hi].tobytes() if h2 is not None else None, docs=low[lo:hi].tobytes())
        put(uid=uid, bucket=-1, docs=ids.tobytes(), flags=np.packbits(first).tobytes(), prints=prints.tobytes(), starts=starts.tobytes(),
            at=at.tobytes(), h1=b"4" if at.dtype == np.uint32 else b"8")
        types = {"uid": pa.int64(), "bucket": pa.int32()}
        return pa.RecordBatch.from_pydict({k: pa.array(v, types.get(k, pa.binary())) for k, v in columns.items()})


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    """The parts in one array; the list is emptied."""
    whole = np.concatenate(parts)
    parts.clear()
    return whole


def _pack(entries: Callable, prepare: Callable, buckets: int, least: bool, flush: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = _Flush(buckets, least)
        make = entries()
        for b in row_slices(batches):
            extra = [b.column(i).to_pylist() for i in range(3, b.num_columns)]
            ids, prints, texts = (b.column(i).to_pylist() for i in range(3))
            for i, made in enumerate(prepare(texts)):
                f.add(ids[i], prints[i], *make(made, *(x[i] for x in extra)))
                if f.size >= flush:
                    yield from f.rows()
        yield from f.rows()
        give_back()
    return run


def _answer(least: bool):
    """Per hash of each flush: whether another flush has a smaller document, or
    whether there are several."""
    def run(table: pa.Table) -> pa.Table:
        out = told(table)
        give_back()
        return out

    def told(table: pa.Table) -> pa.Table:
        rows = table.select(["uid", "bucket", "h1", "h2", "docs"]).to_pydict()
        parts = [np.frombuffer(x, np.uint64) for x in rows["h1"]]
        cuts = np.cumsum([0] + [len(p) for p in parts])
        h1 = np.concatenate(parts)
        h2 = np.concatenate([np.frombuffer(x, np.uint64) for x in rows["h2"]]) if rows["h2"][0] is not None else None
        docs = np.concatenate([np.frombuffer(x, np.int64 if least else np.uint8) for x in rows["docs"]])
        del parts, rows["h1"], rows["h2"], rows["docs"]
        order = _order(h1, h2)
        begin = np.flatnonzero(_runs(h1[order], h2[order] if h2 is not None else None))
        del h1, h2
        sizes = np.diff(np.append(begin, len(order)))
        answer = np.empty(len(order), bool)
        if least:
            answer[order] = np.repeat(np.minimum.reduceat(docs[order], begin), sizes) < docs[order]
        else:
            answer[order] = np.repeat((sizes > 1) | (np.maximum.reduceat(docs[order], begin) > 0), sizes)
        data = [np.packbits(answer[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
        return pa.table({"uid": pa.array(rows["uid"], pa.int64()), "bucket": pa.array(rows["bucket"], pa.int32()),
                         "n": pa.array(np.diff(cuts), pa.int32()), "answer": pa.array(data, pa.binary())})
    return run


def _places(least: bool):
    """A flush's table with the answers for its hashes: places by document."""
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        out = found(table, answers)
        give_back()
        return out

    def found(table: pa.Table, answers: pa.Table) -> pa.Table:
        out: dict[str, list] = {"doc_id": [], "print": [], "at": []}
        told = answers.sort_by("bucket").to_pydict()
        for t in table.to_pylist():
            ids, starts = np.frombuffer(t["docs"], np.int64), np.frombuffer(t["starts"], np.int64)
            at = np.frombuffer(t["at"], np.int64 if t["h1"] == b"8" else np.uint32)
            first = np.unpackbits(np.frombuffer(t["flags"], np.uint8), count=len(at))
            bits = [np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(told["answer"], told["n"])]
            begin = np.flatnonzero(first)
            counts = np.diff(np.append(begin, len(at)))
            hit = np.repeat(np.concatenate(bits) > 0, counts)
            if least:  # or a smaller one of the flush's own
                own = np.empty(len(at), np.int64)
                for lo in range(0, len(at), _BLOCK):
                    own[lo:lo + _BLOCK] = ids[np.searchsorted(starts, at[lo:lo + _BLOCK], side="right") - 1]
                hit |= np.repeat(np.minimum.reduceat(own, begin), counts) < own
                del own
            del begin, counts
            at = np.sort(at[hit])
            owner = np.searchsorted(starts, at, side="right") - 1
            cuts = np.flatnonzero(np.diff(owner, prepend=-1))
            prints = np.frombuffer(t["prints"], np.int64)
            for lo, hi in zip(cuts.tolist(), np.append(cuts[1:], len(at)).tolist()):
                d = int(owner[lo])
                out["doc_id"].append(None if ids[d] == NO_ID else int(ids[d]))
                out["print"].append(int(prints[d]))
                out["at"].append((at[lo:hi] - starts[d]).astype(np.int64).tobytes())
        return pa.table({"doc_id": pa.array(out["doc_id"], pa.int64()), "print": pa.array(out["print"], pa.int64()), "at": pa.array(out["at"], pa.binary())})
    return run


def shared_places(rows: DataFrame, entries: Callable, *, least: bool, prepare: Callable = iter, flush: int = FLUSH) -> DataFrame:
    """``doc_id, print, at binary`` (ascending 64-bit places) for each row that
    holds an entry of which

    * ``least=False``: several documents, told apart by ``doc_id, print``, hold the hash;
    * ``least=True``: a document with a smaller id holds the hash.

    ``rows`` starts with ``doc_id, print, text``; further columns are passed on.
    ``prepare`` turns a batch's texts into what the next function takes.
    ``entries()`` gives a function of a prepared text (and the further columns)
    that returns its length in places, the hashes, second hashes or None, and
    the places. Written to the shared folder before it is returned.
    """
    spark = rows.sparkSession
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    packed = materialize(rows.mapInArrow(_pack(entries, prepare, buckets, least, flush), _PACKED), "packed")
    answers = (packed.where("bucket >= 0").select("uid", "bucket", "h1", "h2", "docs")
               .groupBy("bucket").applyInArrow(_answer(least), _ANSWER))
    # Written, so that the shuffle of the hashes is gone before the next one.
    answers = materialize(answers, "answers")
    tables = packed.where("bucket = -1").drop("bucket", "h2")
    out = materialize(tables.groupBy("uid").cogroup(answers.groupBy("uid")).applyInArrow(_places(least), PLACES), "places")
    release(packed, answers)
    return out
