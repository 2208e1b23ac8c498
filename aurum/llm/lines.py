"""Line dedup by distinct-site spread (operator 1).

A line that many distinct sites carry is boilerplate. How many sites hold a
line is first estimated for all lines at once: a HyperLogLog sketch per line
hash, kept as bit fields that merge by ``bit_or``, so the sketches of a line
are merged on the map side, merged again after one shuffle, and a line found in
a third of all rows costs one sketch per task. Lines whose estimate is near the
threshold get an exact count of distinct sites; the others are decided by the
estimate. Boilerplate lines are then removed from every document but the first
that holds them, at their first place there.

Sketch: 64 registers of 16 ranks; each register is a bit field of the ranks
seen, four registers to a long. The standard error is 1.04 / sqrt(64) = 13 %;
"near" is four standard errors on either side of the threshold.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import columns_of, materialize, neutral

MIN_SITES = 8
REGISTERS, RANKS = 64, 16
_WORDS = REGISTERS * RANKS // 64
NEAR = 4 * 1.04 / math.sqrt(REGISTERS)
#: Candidate lines that may be broadcast: 16 bytes of key each, 3.2 MB in all.
BROADCAST_LINES = 200_000


def _sketch_columns(site: str):
    """The words of a one-site sketch."""
    h = F.xxhash64(site)
    register = F.pmod(h, F.lit(REGISTERS))
    rest = F.shiftrightunsigned(h, 6)
    low = rest.bitwiseAND(-rest)  # lowest set bit: its place is the rank
    rank = F.when(low == 0, RANKS - 1).otherwise(F.least(F.log2(low.cast("double")).cast("int"), F.lit(RANKS - 1)))
    bit = F.expr("shiftleft(1L, cast(16 * (_register % 4) + _rank as int))")
    return register.cast("int"), rank, bit


def _estimate():
    """The HyperLogLog estimate from the merged words (linear counting while
    registers are empty)."""
    field = f"shiftrightunsigned(element_at(_words, cast(r div 4 as int) + 1), cast(16 * (r % 4) as int)) & {(1 << RANKS) - 1}L"
    fields = F.expr(f"transform(sequence(0, {REGISTERS - 1}), r -> {field})")
    # The highest rank seen in a register is the place of its highest bit.
    inverse = F.aggregate(fields, F.lit(0.0), lambda a, f: a + F.when(f == 0, 1.0).otherwise(
        F.pow(F.lit(2.0), -(F.floor(F.log2(f.cast("double"))) + 1).cast("double"))))
    empty = F.size(F.filter(fields, lambda f: f == 0))
    alpha = 0.709 * REGISTERS * REGISTERS
    raw = alpha / inverse
    return F.when((raw <= 2.5 * REGISTERS) & (empty > 0), REGISTERS * F.log(REGISTERS / empty.cast("double"))).otherwise(raw)


def line_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, print, site, pos, h1, h2`` for each line that isn't blank.
    ``print`` tells apart rows that share a doc_id."""
    own = columns_of(docs, "doc_id", "text", "source").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                                                              F.col("source").cast("string").alias("site"))
    lines = own.select("doc_id", F.xxhash64("text").alias("print"), "site", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return (lines.where(F.trim("line") != "")
            .select("doc_id", "print", "site", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), F.col("line")).alias("h2")))


def sketch_lines(rows: DataFrame) -> DataFrame:
    """``h1, h2, rows_n, sites`` (estimated) per line."""
    register, rank, bit = _sketch_columns("site")
    marked = rows.withColumn("_register", register).withColumn("_rank", rank).withColumn("_bit", bit)
    # A null site sets no bit.
    words = [F.bit_or(F.when((F.expr("_register div 4") == k) & F.col("site").isNotNull(), F.col("_bit")).otherwise(F.lit(0).cast("long")))
             .alias(f"w{k}") for k in range(_WORDS)]
    merged = marked.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("rows_n"), *words)
    return (merged.withColumn("_words", F.array(*[f"w{k}" for k in range(_WORDS)]))
            .select("h1", "h2", "rows_n", _estimate().alias("sites")))


def boilerplate(docs: DataFrame, *, min_sites: int = MIN_SITES) -> DataFrame:
    """Every occurrence of every boilerplate line: ``doc_id, print, pos, h1, h2``.

    A line is boilerplate if at least ``min_sites`` distinct non-null sites
    hold it.
    """
    rows = line_rows(docs)
    low, high = min_sites * (1 - NEAR), min_sites * (1 + NEAR)
    # Fewer rows than sites needed decides exactly, too.
    spread = sketch_lines(rows).where((F.col("rows_n") >= min_sites) & (F.col("sites") >= low))
    spread = materialize(spread.select("h1", "h2", (F.col("sites") < high).alias("near")), "spread")
    few = spread.count() <= BROADCAST_LINES
    found = materialize(rows.join(F.broadcast(spread) if few else spread, ["h1", "h2"]), "occurrences")
    exact = (found.where("near and site is not null").select("h1", "h2", "site").distinct()
             .groupBy("h1", "h2").count().where(F.col("count") >= min_sites).select("h1", "h2"))
    # A table of known size: broadcast if small, else a join whose hot lines are split.
    exact = materialize(exact, "exact")
    sure = found.where("not near").select("doc_id", "print", "pos", "h1", "h2")
    return sure.unionByName(found.where("near").select("doc_id", "print", "pos", "h1", "h2").join(exact, ["h1", "h2"], "left_semi"))


def dedup_lines(docs: DataFrame, *, min_sites: int = MIN_SITES, keep_first: bool = True) -> DataFrame:
    """``docs`` (all its columns) with the boilerplate lines taken out of
    ``text``, and ``lines_n``, ``lines_removed`` appended; one row per row.

    With ``keep_first`` the first occurrence of each such line (smallest
    doc_id, then place) stays. Lines are compared as they are; blank lines are
    never boilerplate. A null text stays null with 0 lines; an empty text is
    one line. Rows repeating doc_id and text are changed alike. A null doc_id
    comes before all others. A column of ``docs`` named ``lines_n`` or
    ``lines_removed`` is replaced; any other, whatever its name, is unchanged.
    """
    hits = boilerplate(docs, min_sites=min_sites)
    if keep_first:
        hits = materialize(hits, "boilerplate")
        # By id and place, the same for the repeats of a row.
        first = materialize(hits.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "print", "pos")).alias("f")), "first-places")
        hits = hits.join(first, ["h1", "h2"]).where(
            ~(F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("print") == F.col("f.print")) & (F.col("pos") == F.col("f.pos"))))
    out = hits.groupBy("doc_id", "print").agg(F.collect_set("pos").alias("places"))  # the lines of one document
    own, restore = neutral(docs, "doc_id", "text", "source")
    d, r = own.withColumn("print", F.xxhash64(F.col("text").cast("string"))).alias("d"), out.alias("r")
    joined = d.join(r, F.col("d.doc_id").cast("long").eqNullSafe(F.col("r.doc_id")) & (F.col("d.print") == F.col("r.print")), "left")
    joined = joined.withColumn("lines", F.split(F.col("d.text"), "\n"))
    lines, places = F.col("lines"), F.col("r.places")
    # The lines between one removed place and the next, in linear time.
    cuts = F.concat(F.array(F.lit(-1)), F.array_sort(places), F.array(F.size(lines)))
    runs = F.transform(F.slice(cuts, 1, F.size(cuts) - 1), lambda x, i: F.slice(lines, x + 2, F.get(cuts, i + 1) - x - 1))
    kept = F.array_join(F.flatten(runs), "\n")
    text = F.when(places.isNull(), F.col("d.text")).otherwise(kept)
    cols = [(text.alias("text") if c == "text" else F.col(f"d.`{c}`")) for c in own.columns]
    counted = joined.select(*cols, F.when(F.col("d.text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("lines_n"),
                            F.coalesce(F.size(places), F.lit(0)).cast("long").alias("lines_removed"))
    return restore(counted, "lines_n", "lines_removed")
