"""Substring dedup over words by difference-cover anchors (operator 2).

A passage of ``length`` words that two documents share starts anywhere in
each. Anchors are runs of ``length - period + 1`` words at the places whose
remainder modulo ``period`` is in a difference cover: for any two starts some
shift below the period brings both to such a place, so any shared passage has
an anchor at the same offset in both documents. Only anchors are compared over
the whole corpus, at three of seven places.

An anchor that several documents hold is then extended: the passages of full
length around it, at each offset, are compared by 128 bits over the whole
corpus, and those that start in a document with a smaller id are removed, word
by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from aurum.llm.common import give_back, row_slices, word_windows, words_of
from aurum.llm.exchange import keyed, on_key, shared_places

LENGTH = 13
#: Period and cover: every remainder is a difference of two members.
PERIOD, COVER = 7, (0, 1, 3)


def _anchors(length: int, period: int, cover: tuple[int, ...]):
    def make():
        phase = np.zeros(period, bool)
        phase[list(cover)] = True

        def entries(hashed):
            w, runs = hashed
            if len(w) < length:
                return 0, (), None, ()
            at = np.flatnonzero(np.resize(phase, len(runs)))
            return len(w), runs[at], None, at
        return entries
    return make


def _extended(length: int, period: int):
    def make():
        def entries(hashed, anchors):
            w, h1, h2 = hashed
            n = len(h1)
            a = np.frombuffer(anchors, np.int64)
            touched = np.zeros(n + 1, np.int64)
            np.add.at(touched, np.maximum(a - period + 1, 0), 1)
            np.add.at(touched, np.minimum(a, n - 1) + 1, -1)
            at = np.flatnonzero(np.cumsum(touched[:n]) > 0)
            return len(w), h1[at], h2[at], at
        return entries
    return make


def covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of ``n`` places a window of ``length`` from one of ``starts`` covers."""
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, np.minimum(starts + length, n), -1)
    return np.cumsum(marks[:n]) > 0


def repeated_passages(docs: DataFrame, *, length: int = LENGTH, period: int = PERIOD, cover: tuple[int, ...] = COVER) -> DataFrame:
    """``doc_id, print, at``: the starts of passages of ``length`` words that
    also start in a document with a smaller id (64-bit integers, ascending)."""
    if not 0 < period <= length or {(a - b) % period for a in cover for b in cover} != set(range(period)):
        raise ValueError("cover is not a difference cover of period, or period is over length")
    own = keyed(docs)
    anchors = shared_places(own, _anchors(length, period, cover), least=False,
                            prepare=partial(word_windows, n=length - period + 1))
    anchors = anchors.dropDuplicates(["doc_id", "print"])  # once for the repeats of a row
    with_anchors = own.alias("d").join(anchors.alias("a"), on_key("d", "a")).select("d.doc_id", "d.print", "d.text", "a.at")
    return shared_places(with_anchors, _extended(length, period), least=True,
                         prepare=partial(word_windows, n=length, seeds=(1, 2))).dropDuplicates(["doc_id", "print"])


def remove_passages(docs: DataFrame, *, length: int = LENGTH, period: int = PERIOD, cover: tuple[int, ...] = COVER) -> DataFrame:
    """``doc_id, n_words, n_removed, kept binary`` (the kept words joined by one
    space), one row per row of ``docs``.

    Each word that a window of ``length`` words covers is removed if the
    window's words also start in a document with a smaller doc_id. Windows are
    judged on the input. Rows that share a doc_id don't remove each other's
    words; a null doc_id counts as larger than all others. Null and empty texts
    have no words.
    """
    own = keyed(docs)
    starts = repeated_passages(docs, length=length, period=period, cover=cover)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in row_slices(batches):
            total, removed, kept = [], [], []
            for text, at in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                w = words_of(text)
                total.append(len(w))
                if at is None:
                    removed.append(0)
                else:
                    gone = covered(len(w), np.frombuffer(at, np.int64), length)
                    removed.append(int(gone.sum()))
                    w = [w[i] for i in np.flatnonzero(~gone).tolist()]
                kept.append(b" ".join(w))
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "n_words": pa.array(total, pa.int64()),
                                              "n_removed": pa.array(removed, pa.int64()), "kept": pa.array(kept, pa.binary())})
        give_back()

    joined = own.alias("d").join(starts.alias("s"), on_key("d", "s"), "left").select("d.doc_id", "d.text", "s.at")
    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept binary")
