"""N-gram Jaccard join by a blocked sparse matrix product (operator 4).

Documents are rows and word n-grams columns of a 0/1 incidence matrix A; the
overlaps of all pairs are the product of A with its transpose. Only the part of
it that can reach the threshold is formed:

1. Rows with the same word sequence are one row (their class).
2. Columns are put in one order, common ones last, and a row of size n enters
   the product with its first n - ceil(t n) + 1 columns only: two rows of
   Jaccard t or more share one of these. How common a column is comes from a
   fixed-size sketch of all documents' n-grams; it only decides the order, so
   any error of it costs time and never a pair.
3. Columns that one class holds alone are dropped (``exchange``).
4. First product, against one row per column and size class (its smallest):
   linear in the entries. Each row is verified against the few it shares most
   with, and the pairs that link are merged into components; then again, for
   columns that several components hold, against the most central row of each
   column, the one whose columns are held by the most rows for its size.
5. Second product, of what is left: for each column that still joins different
   components, the rows outside the column's largest component against all
   rows of the other components, the smaller row with the short prefix that
   it needs beside a larger one. Overlap counts are accumulated per pair over
   the columns, and pairs below the bound that their sizes and prefixes set
   are discarded. Two rows of one component are never paired again, so a group
   of near copies costs one star, not all its pairs.

   A pair is formed only at columns where it can link if it shares none of
   those before: all that comes from there on, on the shorter side, must reach
   the overlap that the two sizes need. Every pair that links is formed at the
   first column it shares, and not again at a column that follows a shared one
   in both rows, so near copies meet a few times instead of at all columns; rows that have a common passage behind rarer text of
   their own are not paired for it.
6. Every surviving pair is verified on whole sets, in blocks of an Arrow batch.

A pair of different texts at or above the threshold is therefore either
verified itself or already joined through verified pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import folded, give_back, materialize, release, window_hashes, word_windows
from aurum.llm.components import components
from aurum.llm.exchange import keyed, on_key, shared_places

NGRAM = 5
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Counters of the sketch of common columns (4 bytes each).
SKETCH_BITS = 21
_CHUNKS = 64
#: Rows of a turn of the first product that each row is verified against, and
#: further turns of it with other first rows: an order of work, not a limit of
#: what is found, since the second product takes up what they leave.
TRIES = 8
TURNS = 1


def shingle_sets(texts: list, n: int) -> Iterator[np.ndarray]:
    """Per text the distinct n-gram hashes of its words, A-Z lower-cased,
    ascending; fewer words than n are one n-gram."""
    for w, runs in word_windows(texts, n, fold=True):
        if 0 < len(w) < n:
            runs = window_hashes(w, len(w), len(w) + 100)
        yield np.unique(runs)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def prefix(s: np.ndarray, rank: np.ndarray, percent: int) -> np.ndarray:
    """The first columns of a set: rarer classes first, by hash within one."""
    order = np.argsort(rank[s & np.uint64(len(rank) - 1)], kind="stable")
    return s[order[:prefix_length(len(s), percent)]]


_PROFILE = "doc_id long, print long, s1 long, s2 long, n long, chunk int, counts binary"


def _profile(n: int, bits: int):
    """Each row's sequence digest and set size, and the task's sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << bits, np.int64)
        mask = np.uint64((1 << bits) - 1)
        for b in batches:
            digests, sizes = [], []
            pending, held = [], 0
            texts = b.column(2).to_pylist()
            for text, s in zip(texts, shingle_sets(texts, n)):
                digests.append(xxhash.xxh3_128_digest(folded(text)))
                sizes.append(len(s))
                pending.append(s)
                held += len(s)
                if held > 500_000:
                    sketch += np.bincount((np.concatenate(pending) & mask).astype(np.int64), minlength=len(sketch))
                    pending, held = [], 0
            if held:
                sketch += np.bincount((np.concatenate(pending) & mask).astype(np.int64), minlength=len(sketch))
            d = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            rows = len(sizes)
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column(0), "print": b.column(1), "s1": pa.array(d[:, 0]), "s2": pa.array(d[:, 1]),
                "n": pa.array(sizes, pa.int64()), "chunk": pa.nulls(rows, pa.int32()), "counts": pa.nulls(rows, pa.binary())})
        parts = [p.astype(np.uint32).tobytes() for p in np.split(sketch, _CHUNKS)]
        none = pa.nulls(_CHUNKS, pa.int64())
        yield pa.RecordBatch.from_pydict({"doc_id": none, "print": none, "s1": none, "s2": none, "n": none,
                                          "chunk": pa.array(range(_CHUNKS), pa.int32()), "counts": pa.array(parts, pa.binary())})
    return run


def _sum(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.uint32).astype(np.int64) for x in table["counts"].to_pylist())
    return pa.table({"chunk": table["chunk"][:1].cast(pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def _ranks(profile: DataFrame, bits: int) -> np.ndarray:
    """How common each column's counter is: the logarithm of its excess over the
    mean, in units of the mean's own scatter (the counters of columns that are
    rare differ by about the mean's root). ``2**bits`` bytes, whatever the
    corpus."""
    rows = profile.where("chunk is not null").select("chunk", "counts").groupBy("chunk").applyInArrow(_sum, "chunk int, counts binary").collect()
    if not rows:
        return np.zeros(1 << bits, np.uint8)
    total = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in sorted(rows, key=lambda r: r["chunk"])])
    mean = max(float(total.mean()), 1.0)
    return np.log2(1 + np.maximum(total - mean, 0) / np.sqrt(mean)).astype(np.uint8)


def _prefixes(percent: int, rank):
    def make():
        table = rank.value

        def entries(s):
            p = prefix(s, table, percent) if len(s) else s
            return len(p), p, None, np.arange(len(p))
        return entries
    return make


_ROWS = "node long, n long, columns array<long>, at array<int>, text string"


def _matrix_rows(n: int, percent: int, rank):
    """A class's columns in the product (those that others hold, too) and their
    places in the order of its columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rank.value
        for b in batches:
            sizes, columns, places = [], [], []
            for s, at in zip(shingle_sets(b.column(1).to_pylist(), n), b.column(2).to_pylist()):
                at = np.frombuffer(at, np.int64)
                sizes.append(len(s))
                columns.append(prefix(s, table, percent)[at].view(np.int64))
                places.append(at.astype(np.int32))
            yield pa.RecordBatch.from_pydict({"node": b.column(0), "n": pa.array(sizes, pa.int64()), "columns": pa.array(columns, pa.list_(pa.int64())),
                                              "at": pa.array(places, pa.list_(pa.int32())), "text": b.column(1)})
        give_back()
    return run


def _need(n, m, percent: int):
    """The overlap at which sets of these sizes link."""
    return F.ceil((n + m) * percent / (100 + percent))


def _from_here(n, i, m, j, percent: int):
    """Whether rows whose first shared column is the i-th of n in one and the
    j-th of m in the other can link."""
    return F.least(n - i, m - j) >= _need(n, m, percent)


def _reachable(c, n, m, percent: int):
    """Whether rows of sizes n, m whose prefixes share c columns can link: what
    the prefixes leave out adds no more than the larger row's rest."""
    need = _need(n, m, percent)
    rest = F.ceil(F.greatest(n, m) * percent / 100) - 1
    fits = (n * 100 >= m * percent) & (m * 100 >= n * percent)
    return fits & (c + rest >= need)


def _overlap(ngram: int, percent: int):
    """Rows of two whole texts: the pairs that link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, known = [], {}

            def of(node, text):
                # The star of a node comes in a row: its set is made once.
                if node not in known:
                    if len(known) > 64:
                        known.clear()
                    known[node] = next(shingle_sets([text.as_py()], ngram))
                return known[node]

            for a, c, x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3)):
                x, y = of(a, x), of(c, y)
                at = np.searchsorted(x, y)
                both = int((x[np.minimum(at, len(x) - 1)] == y).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _verify(pairs: DataFrame, rows: DataFrame, ngram: int, percent: int, name: str) -> DataFrame:
    """The pairs ``a, b`` whose whole sets reach the threshold."""
    texts = rows.select("node", "text")
    both = (pairs.join(texts.withColumnsRenamed({"node": "a", "text": "x"}), "a")
            .join(texts.withColumnsRenamed({"node": "b", "text": "y"}), "b").select("a", "b", "x", "y"))
    return materialize(both.mapInArrow(_overlap(ngram, percent), "a long, b long"), name)


def _likely(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Of the pairs ``a, b`` those whose prefixes overlap enough to link, and of
    these the likeliest few of each ``a``: the second product takes up every
    pair that this leaves in two components."""
    sides = rows.select("node", "n", "columns")
    counted = (pairs.join(sides.withColumnsRenamed({"node": "a", "n": "n", "columns": "x"}), "a")
               .join(sides.withColumnsRenamed({"node": "b", "n": "m", "columns": "y"}), "b"))
    counted = counted.withColumn("c", F.size(F.array_intersect("x", "y")))
    counted = counted.where(_reachable(F.col("c"), F.col("n"), F.col("m"), percent))
    likely = F.slice(F.sort_array(F.collect_list(F.struct("c", "b")), asc=False), 1, TRIES)
    return counted.groupBy("a").agg(likely.alias("t")).select("a", F.explode("t").alias("t")).select("a", "t.b")


def _components_of(entries: DataFrame, merged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The entries with their rows' components, and the columns that several
    components hold, with the largest (``h, main``)."""
    several = entries.alias("e").join(merged.alias("m"), F.col("e.node") == F.col("m.node"), "left").select(
        "e.h", "e.node", "e.n", "e.i", "e.before", F.coalesce("m.comp", "e.node").alias("comp"))
    counts = several.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("k"))
    mixed = counts.groupBy("h").agg(F.max(F.struct("k", "comp")).alias("m"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    return several, mixed.select("h", F.col("m.comp").alias("main"))


def _centres(entries: DataFrame, rows_in: DataFrame) -> DataFrame:
    """Of each column of ``rows_in`` the row whose columns are held by the most
    rows for its size (``h, b``), and that row's component (``its``).

    The original of many near copies holds what they share and nothing of its
    own, so that copies too far from each other still link with it."""
    held = entries.groupBy("h").agg(F.count(F.lit(1)).alias("held"))
    weights = entries.join(held, "h").groupBy("node").agg((F.sum("held") / F.first("n")).alias("weight"))
    best = F.max_by(F.struct("node", "comp"), F.struct("weight", "node"))
    return rows_in.join(weights, "node").groupBy("h").agg(best.alias("c")).select("h", F.col("c.node").alias("b"), F.col("c.comp").alias("its"))


def _pairs(small: DataFrame, large: DataFrame, percent: int) -> DataFrame:
    """Rows of different components that can link from a column on: the smaller
    one as ``a, n``, the larger as ``b, m``, per run of columns that both have.

    Rows that share the column before this one, too, were paired at that one:
    they could link from there on, if they can from here."""
    x, y = small.alias("x"), large.alias("y")
    n, m = F.col("x.n"), F.col("y.n")
    ordered = ((n < m) | (n == m) & (F.col("x.node") < F.col("y.node"))) & (n * 100 >= m * percent)
    starts = F.coalesce(F.col("x.before") != F.col("y.before"), F.lit(True))
    fits = ordered & starts & (F.col("x.comp") != F.col("y.comp")) & _from_here(n, F.col("x.i"), m, F.col("y.i"), percent)
    return x.join(y, (F.col("x.h") == F.col("y.h")) & fits).select(
        F.col("x.node").alias("a"), F.col("y.node").alias("b"), n.alias("n"), m.alias("m"))


def near_duplicates(docs: DataFrame, *, ngram: int = NGRAM, percent: int = PERCENT, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per row of ``docs``.

    Two documents link when ``100 * intersection >= percent * union`` of their
    sets of word n-grams; a component is named after its smallest doc_id. Null
    and empty texts and texts without words have size 0 and are alone, so their
    component is their own id. Rows that repeat a doc_id are documents of their
    own, that may link. A null doc_id names no component but its own.
    """
    own = keyed(docs)
    profile = materialize(own.mapInArrow(_profile(ngram, sketch_bits), _PROFILE), "profile")
    # The sketch: 2**sketch_bits bytes, a fixed size.
    rank = docs.sparkSession.sparkContext.broadcast(_ranks(profile, sketch_bits))
    sized = profile.where("chunk is null").select("doc_id", "print", "s1", "s2", "n")
    classes = materialize(
        sized.where("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("low"), F.min(F.struct("doc_id", "print")).alias("r"))
        .select("s1", "s2", "low", "r.doc_id", "r.print", F.monotonically_increasing_id().alias("node")), "classes")

    places = shared_places(own, _prefixes(percent, rank), least=False, prepare=partial(shingle_sets, n=ngram)).dropDuplicates(["doc_id", "print"])
    chosen = (own.alias("d").join(classes.alias("c"), on_key("d", "c"))
              .select("c.node", "d.doc_id", "d.print", "d.text").alias("k")
              .join(places.alias("p"), on_key("k", "p")).select("k.node", "k.text", "p.at"))
    rows = materialize(chosen.mapInArrow(_matrix_rows(ngram, percent, rank), _ROWS), "rows")
    release(places)

    # Entries of the matrix, without columns that one class holds alone.
    step = math.log(100 / percent)
    entries = rows.select("node", "n", "columns", F.posexplode(F.arrays_zip("columns", "at")).alias("k", "e")).select(
        "node", "n", F.col("e.columns").alias("h"), F.col("e.at").alias("i"), F.get("columns", F.col("k") - 1).alias("before")).withColumn(
        "size_class", F.floor(F.log("n") / step))
    first = entries.groupBy("h", "size_class").agg(F.min("node").alias("b"), F.max("node").alias("top")).where("b <> top")
    pairs = (entries.join(first.select("h", "size_class", "b"), ["h", "size_class"]).where("node <> b")
             .select(F.col("node").alias("a"), "b").distinct())
    tried, links = None, None
    for turn in range(TURNS + 1):
        if tried is not None:
            # Again, with the most central row of each column that several components hold.
            now, mixed = _components_of(entries, merged)
            rows_in = now.join(mixed, "h")
            centre = _centres(entries, rows_in)
            pairs = (rows_in.join(centre, "h").where(F.col("comp") != F.col("its")).select(F.col("node").alias("a"), "b").distinct()
                     .join(tried, ["a", "b"], "left_anti"))
        pairs = materialize(_likely(pairs, rows, percent), "pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = _verify(pairs, rows, ngram, percent, "links")
        links = found if links is None else links.unionByName(found)
        merged = components(links)
    release(tried)

    several, mixed = _components_of(entries, merged)
    several = materialize(several.join(mixed, "h"), "entries")
    # The smaller row of a pair (of equal ones the lower node) shares its first
    # column before the place that a pair of its own size would allow.
    small, outside = several.where(F.col("n") - F.col("i") >= _need(F.col("n"), F.col("n"), percent)), F.col("comp") != F.col("main")
    product = _pairs(small.where(outside), several, percent).unionByName(_pairs(small.where(~outside), several.where(outside), percent))
    product = product.distinct()
    product = product.join(rows.select(F.col("node").alias("a"), F.col("columns").alias("x")), "a").join(
        rows.select(F.col("node").alias("b"), F.col("columns").alias("y")), "b").withColumn("c", F.size(F.array_intersect("x", "y")))
    pairs = materialize(product.where(_reachable(F.col("c"), F.col("n"), F.col("m"), percent)).select("a", "b"), "pairs")
    more = _verify(pairs, rows, ngram, percent, "more-links")
    release(pairs)
    final = components(links.unionByName(more))

    named = classes.alias("c").join(final.alias("f"), F.col("c.node") == F.col("f.node"), "left").select(
        "c.s1", "c.s2", "c.low", F.coalesce("f.comp", "c.node").alias("comp"))
    low = named.groupBy("comp").agg(F.min("low").alias("component_id"))
    named = materialize(named.join(low, "comp").select("s1", "s2", "component_id"), "components")
    out = sized.join(named, ["s1", "s2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    release(rows, several)
    return out
