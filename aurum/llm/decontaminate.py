"""Benchmark decontamination by rare n-gram seeds and local alignment (operator 8).

Every word n-gram of the test items is looked for in every document; the
document frequency of each over all documents says how rare it is. Where a
document holds any of an item's n-grams, the passage around it is aligned with
the whole item by Smith-Waterman, so copies with words changed, added or left
out are scored too. Passages around the rarest n-grams come first; a later one
is left out only where the words it shares with the item are too few for a
better score. A pair is reported when the best local alignment reaches
``min_score`` of the item's alignment with itself.

The items are a stated query set: they are taken in blocks of a fixed number
of words, each block's n-grams go to the tasks, and every document is compared
with every block. A block's size is bounded by ``block_words``, not by the
corpus. What leaves the first pass is only the passages around n-gram hits, as
word numbers; nothing of a document travels with a hot n-gram.

Words are runs of characters other than ASCII white space, lower-cased, with
ASCII punctuation deleted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import columns_of, document_columns, materialize, text_slices

NGRAM = 3
MIN_SCORE = 0.5
BLOCK_WORDS = 2_000_000
MATCH, MISMATCH, GAP = 2, -1, -1
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def words(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(None, _PUNCTUATION).split() if text else []


def local_alignment(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman over word numbers: best score and where in the passage
    its last word is; among equal scores the first end. A row of the matrix at
    a time; gaps along the row come from a running maximum."""
    n = len(passage)
    place = np.arange(n + 1, dtype=np.int32) * -GAP
    row = np.zeros(n + 1, np.int32)
    best = end = at = 0
    for i, w in enumerate(item.tolist()):
        new = np.maximum(row + GAP, 0)
        np.maximum(new[1:], row[:-1] + np.where(passage == w, MATCH, MISMATCH), out=new[1:])
        row = np.maximum.accumulate(new + place) - place
        k = int(row.argmax())
        if row[k] > best:
            best, end, at = int(row[k]), k, i + 1
    return best, end, at


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best score, first and past-the-last word of the passage aligned."""
    best, end, at = local_alignment(item, passage)
    if not best:
        return 0, 0, 0
    _, back, _ = local_alignment(item[:at][::-1], passage[:end][::-1])
    return best, end - back, end


class Block:
    """The items of a block as word numbers, and their n-grams."""

    def __init__(self, items: list[tuple[int, str]], n: int):
        self.n = n
        self.numbers: dict[bytes, int] = {}
        self.items = [(i, np.array([self.numbers.setdefault(w, len(self.numbers)) for w in words(t)], dtype=np.int32)) for i, t in items]
        grams: dict[bytes, list[tuple[int, int]]] = {}
        for k, (_, w) in enumerate(self.items):
            size = min(n, len(w))  # a shorter item is its own only seed
            for j in range(len(w) - size + 1 if size else 0):
                grams.setdefault(w[j:j + size].tobytes(), []).append((k, j))
        self.gram_keys = sorted(grams)
        self.places = [grams[g] for g in self.gram_keys]
        by_size: dict[int, list[int]] = {}
        for g, key in enumerate(self.gram_keys):
            by_size.setdefault(len(key) // 4, []).append(g)
        #: Per number of words: hashes of the grams in ascending order, and which those are.
        self.tables = []
        for size, own in sorted(by_size.items()):
            hashes = np.array([self._hash(np.frombuffer(self.gram_keys[g], np.int32)[None, :])[0] for g in own], dtype=np.uint64)
            order = np.argsort(hashes, kind="stable")
            self.tables.append((size, hashes[order], np.array(own)[order]))

    def _hash(self, w: np.ndarray) -> np.ndarray:
        """A polynomial of the word numbers; equal hashes are compared in full."""
        h = np.zeros(len(w), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(w.shape[1]):
                h = h * np.uint64(0x9E3779B97F4A7C15) + w[:, k].astype(np.uint64) + np.uint64(1)
        return h

    def hits(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in a document where one of the n-grams starts, and which."""
        known = w >= 0
        places, seen = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for size, hashes, own in self.tables:
            m = len(w) - size + 1
            if m <= 0:
                continue
            ok = known[:m].copy()
            for k in range(1, size):
                ok &= known[k:k + m]
            at = np.flatnonzero(ok)
            grams = w[at[:, None] + np.arange(size)]
            h = self._hash(grams)
            s = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            found = hashes[s] == h
            at, s, grams = at[found], s[found], grams[found]
            which = own[s]
            same = np.fromiter((self.gram_keys[g] == x.tobytes() for g, x in zip(which, grams)), bool, len(which))
            places.append(at[same])
            seen.append(which[same])
        return np.concatenate(places), np.concatenate(seen)

    def reach(self, gram: int) -> tuple[int, int]:
        """Words before and after a hit that an alignment over it may cover."""
        before = after = 0
        for k, j in self.places[gram]:
            size = len(self.items[k][1])
            slack = size // 2 + 8
            before, after = max(before, j + slack), max(after, size - j + slack)
        return before, after


_HITS = "doc_id long, grams array<int>, starts array<int>, gaps array<int>, words binary"
_PAIRS = "doc_id long, item_id long, score double, first_word long, end_word long"


def _find(block, at: int):
    """Documents with hits: their n-grams with places, and the passages around."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b: Block = block.value
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for lo, hi in text_slices(texts):
                rows = []
                for i in range(lo, hi):
                    get = b.numbers.get
                    ws = words(texts[i])
                    w = np.fromiter((get(x, -1) for x in ws), np.int32, len(ws))
                    places, grams = b.hits(w)
                    if not len(places):
                        continue
                    keep = np.zeros(len(w) + 1, np.int32)
                    for p, g in zip(places.tolist(), grams.tolist()):
                        before, after = b.reach(g)
                        keep[max(0, p - before)] += 1
                        keep[min(len(w), p + after)] -= 1
                    kept = np.flatnonzero(np.cumsum(keep[:-1]) > 0)
                    # Words of the document that are kept, as runs: place less number of kept words before.
                    cut = np.flatnonzero(np.diff(kept, prepend=-2) > 1)
                    rows.append((ids[i].as_py(), grams.tolist(), places.tolist(),
                                 np.stack([cut, kept[cut]], 1).ravel().tolist(), w[kept].tobytes()))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()),
                                                                     pa.list_(pa.int32()), pa.binary()))],
                        names=["doc_id", "grams", "starts", "gaps", "words"])
    return run


def _score(block, frequency, min_score: float):
    """Align the passages around the n-grams of each item, the rarest first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b: Block = block.value
        found_in: list[int] = frequency.value
        for batch in batches:
            rows = []
            for doc_id, grams, starts, gaps, data in zip(*(batch.column(i).to_pylist() for i in range(5))):
                w = np.frombuffer(data, np.int32)
                cuts, firsts = np.array(gaps[::2]), np.array(gaps[1::2])
                spans: dict[int, list[list[int]]] = {}
                for p, g in sorted(zip(starts, grams)):
                    r = int(np.searchsorted(firsts, p, side="right")) - 1
                    local = int(cuts[r]) + p - int(firsts[r])
                    run_lo, run_hi = int(cuts[r]), int(cuts[r + 1]) if r + 1 < len(cuts) else len(w)
                    for k, j in b.places[g]:
                        size = len(b.items[k][1])
                        slack = size // 2 + 8
                        lo, hi = max(run_lo, local - j - slack), min(run_hi, local - j + size + slack)
                        own = spans.setdefault(k, [])
                        if own and lo <= own[-1][1] and own[-1][2] == r:
                            own[-1][1] = max(own[-1][1], hi)
                            own[-1][0] = min(own[-1][0], lo)
                            own[-1][3] = min(own[-1][3], found_in[g])
                        else:
                            own.append([lo, hi, r, found_in[g]])
                for k, own in spans.items():
                    item_id, item = b.items[k]
                    most = MATCH * len(item)
                    best = (0, 0, 0)
                    for lo, hi, r, _ in sorted(own, key=lambda span: span[3]):
                        passage = w[lo:hi]
                        # No more words can match than the passage has of the item's.
                        if MATCH * min(len(item), int(np.isin(passage, item).sum())) < max(min_score * most, best[0]):
                            continue
                        s, first, end = align(item, passage)
                        shift = int(firsts[r]) - int(cuts[r]) + lo
                        if s > best[0] or s == best[0] and first + shift < best[1]:
                            best = (s, first + shift, end + shift)
                    if best[0] >= min_score * most:
                        rows.append((doc_id, item_id, best[0] / most, best[1], best[2]))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()))],
                    names=["doc_id", "item_id", "score", "first_word", "end_word"])
    return run


def find_leaks(docs: DataFrame, items: DataFrame, *, ngram: int = NGRAM, min_score: float = MIN_SCORE,
               block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, item_id, score, first_word, end_word``: for each document and
    test item its best alignment, where that reaches ``min_score`` (1.0: the
    whole item word for word). Words count from 0 in the document.

    Null and empty texts on either side match nothing; an item shorter than an
    n-gram is looked for as a whole. Rows that repeat a doc_id or item_id count as one, with the
    best of their alignments (ties: the first in the document). An empty table
    on either side gives an empty result.
    """
    spark = docs.sparkSession
    own = document_columns(docs)
    asked = (columns_of(items, "item_id", "text").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
             .where(F.trim("text") != ""))
    total = asked.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    out = None
    for n in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == n).distinct().collect()
        if not rows and out is not None:
            continue
        b = Block(sorted((r["item_id"], r["text"]) for r in rows), ngram)
        block = spark.sparkContext.broadcast(b)
        hits = materialize(own.mapInArrow(_find(block, 0), _HITS), "hits")
        counts = {r["g"]: r["n"] for r in hits.select(F.explode(F.array_distinct("grams")).alias("g")).groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect()}
        frequency = [counts.get(g, 0) for g in range(len(b.places))]
        pairs = hits.mapInArrow(_score(block, spark.sparkContext.broadcast(frequency), min_score), _PAIRS)
        out = pairs if out is None else out.unionByName(pairs)
    best = F.max(F.struct("score", (-F.col("first_word")).alias("f"), "end_word")).alias("b")
    return (out.groupBy("doc_id", "item_id").agg(best)
            .select("doc_id", "item_id", "b.score", (-F.col("b.f")).alias("first_word"), "b.end_word"))
