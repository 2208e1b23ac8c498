"""Source divergence audit by iceberg prefix refinement (operator 12).

A language keeps the terms that at least ``MIN_DOCS`` of its documents hold.
Rare terms, the bulk of all distinct strings, never have to be moved or counted
as strings: terms are cut to byte prefixes that double from level to level, and
a prefix held by too few documents rules out every term that begins with it.

Each level is one pass over the documents. A task takes the terms still open
(longer than the last level's prefixes, and beginning with one that survived),
cuts them to the level's length and counts the documents of each complete term
and of each prefix that goes on, by a 64-bit hash of language and bytes; Spark
adds these up. What has enough documents survives: prefixes go on to the next
level, complete terms are candidates. The levels end when no prefix is left.

What survives reaches the tasks as a bit map of fixed size. A bit set by another
prefix or term, or two with one hash, let something through that is discarded
later; they never lose a term. The last pass counts the candidates themselves,
by language, source and bytes, and keeps those of enough documents: results
are exact.

The divergence itself is integer arithmetic in Spark on the kept terms' counts.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aurum.llm.common import columns_of, give_back, materialize, mix64, release

MIN_DOCS = 3
#: Bytes of the first level's prefixes; each level doubles them.
FIRST_LEVEL = 8
#: Size of the map of what survives (2**25 bits: 4 MB, whatever the corpus).
MAP_BITS = 25
#: Text bytes that a task counts at a time.
BLOCK = 8 << 20
TOP_TERMS = 200
UNIT = 1_000_000_000

#: Byte values within terms: letters and all bytes of non-ASCII characters; A-Z are lower-cased.
_FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_IN_TERM = bytes(97 <= b < 123 or b >= 128 for b in _FOLD)
#: The first k bytes of an integer of eight.
_FIRST = np.array([(1 << 64) - (1 << 8 * (8 - k)) for k in range(9)], np.uint64)

_LEVEL = "hash long, docs long, goes_on boolean"
_COUNTS = "lang string, source string, term binary, occurrences long, docs long"


def _terms(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the terms begin and how many bytes they have; the first and last
    byte are of none."""
    inside = np.frombuffer(data.translate(_IN_TERM), np.uint8)
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    return edges[::2], edges[1::2] - edges[::2]


def _cells(words: np.ndarray, begin: np.ndarray, length: np.ndarray, level: int) -> list[np.ndarray]:
    """The first ``level`` bytes of each term, eight to an integer, filled with
    zero bytes (which terms don't hold). ``words`` are the eight bytes from each
    place on."""
    length, last = np.minimum(length, level), len(words) - 1
    return [words[np.minimum(begin + at, last)].astype(np.uint64) & _FIRST[np.clip(length - at, 0, 8)] for at in range(0, level, 8)]


def _hashes(langs: np.ndarray, cells: list[np.ndarray], goes_on) -> np.ndarray:
    """Of language, bytes and whether they are a term or a prefix; the same
    whatever number of empty cells follows."""
    h = langs ^ np.where(goes_on, np.uint64(0xA24BAED4963EE407), np.uint64(0))
    with np.errstate(over="ignore"):
        for c in cells:
            h = np.where(c > 0, mix64(h ^ c * np.uint64(0x9E3779B97F4A7C15)), h)
    return h


def _slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    """A place in the map for each hash."""
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _alive(known: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    slot = _slots(hashes, bits)
    return known[slot >> 3] >> (slot & 7).astype(np.uint8) & 1 > 0


def _changes(group: np.ndarray, cells: list[np.ndarray]) -> np.ndarray:
    """Where a row differs from the one before it."""
    new = np.ones(len(group), bool)
    new[1:] = group[1:] != group[:-1]
    for c in cells:
        new[1:] |= c[1:] != c[:-1]
    return new


def _order(hashes: np.ndarray, group: np.ndarray, cells: list[np.ndarray]) -> np.ndarray:
    """An order that puts equal rows side by side, earlier ones first: by the
    upper bits of a hash with the row's number below them, as one sort of
    integers, unless unequal rows share those bits."""
    n = len(group)
    number = np.uint64((1 << max(1, int(n - 1).bit_length())) - 1)
    with np.errstate(over="ignore"):
        key = mix64(hashes ^ group.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) & ~number
    key |= np.arange(n, dtype=np.uint64)
    key.sort()
    order = (key & number).astype(np.int64)
    upper = key & ~number
    same = upper[1:] == upper[:-1]
    if (same & _changes(group[order], [c[order] for c in cells])[1:]).any():
        order = np.lexsort((*cells[::-1], group))
    return order


def _lang_hash(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))


class _Block:
    """The terms of some documents, in order."""

    def __init__(self, langs: list, texts: list):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        # A zero byte before each text, so that a term ends with its text, and eight behind the last.
        data = b"".join([x for r in raw for x in (b"\0", r)] + [bytes(8)]).translate(_FOLD)
        starts = np.cumsum([0] + [len(r) + 1 for r in raw])
        self.data = np.frombuffer(data, np.uint8)
        self.words = np.ndarray(len(data) - 7, ">u8", data, strides=(1,))
        self.begin, self.length = _terms(data)
        self.doc = np.repeat(np.arange(len(raw)), np.diff(np.searchsorted(self.begin, starts)))
        hashes = {x: _lang_hash(x) for x in set(langs)}
        self.langs = np.array([hashes[x] for x in langs], np.uint64)

    def of(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.begin[some], self.length[some], self.doc[some]


def _level_counts(block: _Block, level: int, before: int, known, bits: int) -> dict | None:
    """Documents per hash of the block's terms and prefixes of one level."""
    begin, length, doc = block.of(block.length > before)
    if before and len(begin):
        cells = _cells(block.words, begin, np.minimum(length, before), before)
        some = _alive(known, _hashes(block.langs[doc], cells, True), bits)
        begin, length, doc = begin[some], length[some], doc[some]
    if not len(begin):
        return None
    goes_on = length > level
    hashes = _hashes(block.langs[doc], _cells(block.words, begin, np.minimum(length, level), level), goes_on)
    order = _order(hashes, goes_on, [hashes])
    hashes, doc, goes_on = hashes[order], doc[order], goes_on[order]
    new = _changes(goes_on, [hashes])
    new_doc = new.copy()
    new_doc[1:] |= doc[1:] != doc[:-1]
    at = np.flatnonzero(new)
    return {"hash": pa.array(hashes[at].view(np.int64)), "docs": pa.array(np.add.reduceat(new_doc, at, dtype=np.int64)), "goes_on": pa.array(goes_on[at])}


def _term_counts(block: _Block, names: list, levels: list[int], known, bits: int) -> Iterator[dict]:
    """Occurrences and documents of the block's candidates, per group."""
    numbers: dict = {}
    group_of = np.array([numbers.setdefault(x, len(numbers)) for x in names], np.int64)
    keys = list(numbers)
    for low, level in zip([0, *levels], levels):
        begin, length, doc = block.of((block.length > low) & (block.length <= level))
        if not len(begin):
            continue
        cells = _cells(block.words, begin, length, level)
        hashes = _hashes(block.langs[doc], cells, False)
        some = _alive(known, hashes, bits)
        if not some.any():
            continue
        begin, length, doc, hashes, cells = begin[some], length[some], doc[some], hashes[some], [c[some] for c in cells]
        group = group_of[doc]
        order = _order(hashes, group, cells)
        begin, length, doc, group = begin[order], length[order], doc[order], group[order]
        new = _changes(group, [c[order] for c in cells])
        new_doc = new.copy()
        new_doc[1:] |= doc[1:] != doc[:-1]
        at = np.flatnonzero(new)
        begin, length, group = begin[at], length[at], group[at]
        # The terms' bytes, gathered at once.
        ends = np.cumsum(length)
        index = np.repeat(begin - (ends - length), length) + np.arange(ends[-1])
        bounds = np.concatenate([[0], ends]).astype(np.int32)
        by_name = pa.array(group.astype(np.int32))
        yield {
            "lang": pa.DictionaryArray.from_arrays(by_name, pa.array([k[0] for k in keys], pa.string())).cast(pa.string()),
            "source": pa.DictionaryArray.from_arrays(by_name, pa.array([k[1] for k in keys], pa.string())).cast(pa.string()),
            "term": pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(block.data[index].tobytes())]),
            "occurrences": pa.array(np.diff(np.append(at, len(order)))),
            "docs": pa.array(np.add.reduceat(new_doc, at, dtype=np.int64))}


def _by_block(count):
    """``count(block, groups)`` over blocks of documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, sources, texts = (b.column(i).to_pylist() for i in range(3))
            lo = size = 0
            for hi in range(len(texts) + 1):
                if hi == len(texts) or (size and size + len(texts[hi]) > BLOCK):
                    if hi > lo:
                        for made in count(_Block(langs[lo:hi], texts[lo:hi]), list(zip(langs[lo:hi], sources[lo:hi]))):
                            yield pa.RecordBatch.from_pydict(made)
                    lo, size = hi, 0
                if hi < len(texts):
                    size += len(texts[hi])
        give_back()
    return run


def _levels(level: int, before: int, sent, bits: int):
    def count(block, names):
        made = _level_counts(block, level, before, sent.value if sent is not None else None, bits)
        return [made] if made else []
    return _by_block(count)


def _candidates(levels: list[int], sent, bits: int):
    return _by_block(lambda block, names: _term_counts(block, names, levels, sent.value, bits))


def _map(alive: DataFrame, bits: int) -> np.ndarray:
    """The map of the hashes; ``2**bits / 64`` integers at most reach the driver."""
    slot = F.shiftrightunsigned("hash", 64 - bits)
    word = alive.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - bits}) & 63 as int))")).alias("set"))
    rows = word.toArrow()
    out = np.zeros(max(1, 1 << (bits - 6)), np.uint64)
    out[rows["word"].to_numpy()] = rows["set"].to_numpy().view(np.uint64)
    return out.view(np.uint8)


def kept_terms(docs: DataFrame, *, min_docs: int = MIN_DOCS, first_level: int = FIRST_LEVEL, map_bits: int = MAP_BITS) -> DataFrame:
    """``lang, source, term, count, term_id, all, first`` of the terms that at
    least ``min_docs`` documents of the language hold, for the sources where
    they occur: ``all`` is the term's count in the language, ``term_id`` a number
    of the term of that language, ``first`` marks one of its rows.

    Every row is a document of its own. Written to the shared folder."""
    spark = docs.sparkSession
    texts = columns_of(docs, "lang", "source", "text").select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    candidates, levels, level, sent = None, [], first_level, None
    while True:
        before = levels[-1] if levels else 0
        levels.append(level)
        found = texts.mapInArrow(_levels(level, before, sent, map_bits), _LEVEL)
        found = materialize(found.groupBy("hash", "goes_on").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).select("hash", "goes_on"),
                            f"prefixes-{level}")
        if sent is not None:
            sent.unpersist()
        known = _map(found, map_bits)
        candidates = known if candidates is None else candidates | known
        more = not found.where("goes_on").isEmpty()
        release(found)
        if not more:
            break
        sent = spark.sparkContext.broadcast(known)  # a fixed size
        level *= 2
    sent = spark.sparkContext.broadcast(candidates)  # a fixed size
    # One shuffle: a term's rows of all sources come together, are added up,
    # and go no further if its documents are too few.
    counted = texts.mapInArrow(_candidates(levels, sent, map_bits), _COUNTS)
    counted = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("occurrences").alias("count"), F.sum("docs").alias("docs")).withColumn("id", F.monotonically_increasing_id())
    one = Window.partitionBy("lang", "term")
    counted = counted.select("lang", "source", F.col("term").cast("string").alias("term"), "count", F.sum("docs").over(one).alias("in_docs"),
                             F.min("id").over(one).alias("term_id"), F.sum("count").over(one).alias("all"),
                             (F.col("id") == F.min("id").over(one)).alias("first")).where(F.col("in_docs") >= min_docs)
    return materialize(counted.drop("in_docs"), "kept-terms")


def _exact(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(38,0)")


def _share(count: Column, total: str, terms: str) -> Column:
    """``1 + floor(UNIT * (count + 1) / (total + terms))``, a long of UNIT + 1 at most."""
    over = (_exact(count) + 1) * F.lit(UNIT).cast("decimal(10,0)")
    return (1 + F.call_function("div", over.cast("decimal(38,0)"), _exact(F.col(total) + F.col(terms)))).cast("long")


def _gap(p: Column, q: Column) -> Column:
    """``floor((p - q) * (p - q) / q)``: the square of a long up to UNIT fits a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def audit(docs: DataFrame, *, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, first_level: int = FIRST_LEVEL,
          map_bits: int = MAP_BITS) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far each source's use of
    the kept terms is from the other sources of its language (``pair``) and
    which terms it uses most beyond the language as a whole (``term``, at most
    ``top``).

    Null text, lang and source count as empty strings, every row as a document,
    repeated doc_ids too; doc_id and further columns are not read. Texts of any
    length are read whole. A group without terms, or of a language that keeps
    none, has pairs like any other (of value 0 if none is kept) and no terms.
    Ties are ranked by the item's bytes. An empty table gives an empty one.
    """
    own = columns_of(docs, "lang", "source").select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")])
    kept = kept_terms(docs, min_docs=min_docs, first_level=first_level, map_bits=map_bits)
    used = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"), F.count_if("first").alias("firsts"))
    size = used.groupBy("lang").agg(F.sum("firsts").alias("v"), F.sum("n").alias("n_lang"))
    zero = F.lit(0).cast("long")
    groups = (own.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("rows")).join(used, ["lang", "source"], "left").join(size, "lang", "left")
              .select("lang", "source", F.coalesce("n", zero).alias("n"), F.coalesce("v", zero).alias("v"), F.coalesce("n_lang", zero).alias("n_lang")))
    # A group's number, and the share of a kept term that it doesn't have.
    groups = groups.withColumns({"group": F.monotonically_increasing_id(), "p0": F.when(F.col("v") > 0, _share(zero, "n", "v"))})
    groups = materialize(groups, "groups")
    # One row per term of a group, with its share there and in the language.
    shares = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "group", "term", "term_id", "p0", _share(F.col("count"), "n", "v").alias("p"), _share(F.col("all"), "n_lang", "v").alias("q"))
    shares = materialize(shares, "shares")
    release(kept)

    better = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), _gap(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    terms = better.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    pairs = _pairs(shares, groups).withColumn("rank", F.row_number().over(order))
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank").unionByName(
        terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each two groups' values differ by from those of groups without
    terms, over the terms that both hold; rows come sorted by term."""
    rest = None
    for batch in itertools.chain(batches, [None]):
        rows = [c.to_numpy() for c in batch.columns] if batch is not None else [np.empty(0, np.int64)] * 4
        if rest is not None:
            rows = [np.concatenate(x) for x in zip(rest, rows)]
        term = rows[0]
        # The last term may go on in the next batch.
        whole = len(term) if batch is None else int(np.searchsorted(term, term[-1])) if len(term) else 0
        rest = [x[whole:] for x in rows]
        term, group, p, p0 = (x[:whole] for x in rows)
        here = np.arange(len(term))
        step = 1
        while True:  # each row with the one that many rows on
            here = here[:np.searchsorted(here, len(term) - step)]
            here = here[term[here] == term[here + step]]
            if not len(here):
                break
            there = here + step
            p_, q_, p0_, q0_ = p[here], p[there], p0[here], p0[there]
            none = _gaps(p0_, q0_), _gaps(q0_, p0_)
            forth = _gaps(p_, q_) - _gaps(p_, q0_) - _gaps(p0_, q_) + none[0]
            back = _gaps(q_, p_) - _gaps(q_, p0_) - _gaps(q0_, p_) + none[1]
            a, b, value = np.concatenate([group[here], group[there]]), np.concatenate([group[there], group[here]]), np.concatenate([forth, back])
            order = np.lexsort((b, a))
            a, b, value = a[order], b[order], value[order]
            at = np.flatnonzero(_changes(a, [b]))
            yield pa.RecordBatch.from_pydict({"a": a[at], "b": b[at], "value": np.add.reduceat(value, at)})
            step += 1


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for each two sources of a language.

    The sum over all kept terms starts as if neither source had any, one
    share each, and is put right for the terms that they have: those of one
    of the two by how often each count occurs in a group (few numbers), those of
    both term by term.
    """
    a = groups.select("lang", "source", F.col("group").alias("a"), F.col("p0").alias("pa"), "v")
    b = groups.select("lang", F.col("source").alias("item"), F.col("group").alias("b"), F.col("p0").alias("pb"))
    two = a.join(b, "lang").where("a <> b")
    pa_, pb_ = F.col("pa"), F.col("pb")
    start = two.select("a", "b", F.when(F.col("v") > 0, _gap(pa_, pb_) * F.col("v")).otherwise(0).alias("value"))

    # How many terms of a group have each share.
    alike = shares.groupBy("group", "p").agg(F.count(F.lit(1)).alias("k"))
    p, k = F.col("p"), F.col("k")
    from_a = two.join(alike.withColumnRenamed("group", "a"), "a").groupBy("a", "b").agg(F.sum(k * (_gap(p, pb_) - _gap(pa_, pb_))).alias("value"))
    from_b = two.join(alike.withColumnRenamed("group", "b"), "b").groupBy("a", "b").agg(F.sum(k * (_gap(pa_, p) - _gap(pa_, pb_))).alias("value"))

    # Terms that both hold: the groups of a term side by side.
    held = shares.select("term_id", "group", "p", "p0").repartition("term_id").sortWithinPartitions("term_id", "group")
    both = held.mapInArrow(_meetings, "a long, b long, value long").groupBy("a", "b").agg(F.sum("value").alias("value"))
    total = start.unionByName(from_a).unionByName(from_b).unionByName(both).groupBy("a", "b").agg(F.sum("value").alias("value"))
    names = groups.select("lang", "source", F.col("group").alias("a"))
    return total.join(names, "a").join(groups.select(F.col("source").alias("item"), F.col("group").alias("b")), "b").select(
        "lang", "source", "item", "value")
