"""Exact dedup by deterministic block naming (operator 5), DataFrame functions only.

A text without its white space is cut into blocks of fixed size. Distinct
blocks are sorted and numbered: equal blocks get one integer name, different
blocks different ones. Then neighbouring names of a document are paired and
the distinct pairs are sorted and numbered the same way, level by level,
until each document holds a single name. Two documents are equal exactly if
they hold the same number of blocks and the same last name: names stand for
whole byte strings, so there is nothing to collide.

The bytes of a block travel once: they are pre-aggregated on the map side and
shuffled to be sorted. What joins names back to documents is a 128-bit
fingerprint of the block, used only after the sorted blocks have shown that it
is one-to-one on this corpus (otherwise another seed is taken). A block that a
third of all rows share is reduced to one row per task before the shuffle, and
the joins back have plain shuffles on both sides, which adaptive execution
splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import document_columns, materialize

BLOCK_CHARS = 4096
_WHITE = r"[\x20\x09-\x0D]+"


def normalised(text="text"):
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), _WHITE, "")


def _numbered(distinct: DataFrame, *keys: str) -> DataFrame:
    """Distinct rows sorted within their partitions and numbered; written
    (without the bytes of blocks), so that the numbers are fixed."""
    ordered = distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())
    return materialize(ordered.drop("block"), "names")


def _fingerprints(seed: int):
    return (F.xxhash64(F.lit(2 * seed), F.col("block")).alias("h1"), F.xxhash64(F.col("block"), F.lit(2 * seed + 1)).alias("h2"))


def _block_names(texts: DataFrame, block_chars: int, seed: int) -> tuple[DataFrame, bool]:
    """Names of the distinct blocks by fingerprint, and whether the
    fingerprints are one-to-one."""
    blocks = texts.select(F.explode(_blocks(block_chars)).alias("block")).select(*_fingerprints(seed), "block")
    names = _numbered(blocks.distinct(), "h1", "h2", "block")
    clash = names.groupBy("h1", "h2").count().where("count > 1").limit(1).count()
    return names, clash == 0


def _blocks(block_chars: int):
    """Blocks of a normalised text in order; an empty text is one empty block."""
    cut = F.regexp_extract_all("norm", F.lit(f"(?s).{{1,{block_chars}}}"), 0)
    return F.when(F.col("norm") == "", F.array(F.lit(""))).otherwise(cut)


def name_documents(docs: DataFrame, *, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, n_chars, text_sha256, n_blocks, name``, one row per row of
    ``docs``; rows are equal where ``n_blocks`` and ``name`` are."""
    own = document_columns(docs)
    texts = own.select("doc_id", F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"), normalised().alias("norm"))
    seed = 0
    names, one_to_one = _block_names(texts, block_chars, seed)
    while not one_to_one:
        seed += 1
        names, one_to_one = _block_names(texts, block_chars, seed)

    h1, h2 = (f"xxhash64({a}, {b})" for a, b in ((f"{2 * seed}", "x"), ("x", f"{2 * seed + 1}")))
    rows = materialize(
        texts.withColumn("blocks", _blocks(block_chars))
        .select(F.monotonically_increasing_id().alias("key"), "doc_id", "n_chars", F.sha2("norm", 256).alias("text_sha256"),
                F.size("blocks").cast("long").alias("n_blocks"),
                F.expr(f"transform(blocks, x -> struct({h1} as h1, {h2} as h2))").alias("prints")),
        "documents")
    level = (rows.select("key", "n_blocks", F.posexplode("prints").alias("i", "p"))
             .select("key", "n_blocks", "i", "p.h1", "p.h2").join(names, ["h1", "h2"]).select("key", "n_blocks", "i", "name"))
    done = level.where("n_blocks = 1").select("key", "name")
    level = materialize(level.where("n_blocks > 1").select("key", "i", "name"), "level")
    most = rows.agg(F.max("n_blocks")).first()[0] or 0
    while most > 1:
        pairs = materialize(
            level.groupBy("key", F.expr("i div 2").cast("int").alias("i"))
            .agg(F.max(F.when(F.col("i") % 2 == 0, F.col("name"))).alias("a"),
                 F.coalesce(F.max(F.when(F.col("i") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b")), "pairs")
        names = _numbered(pairs.select("a", "b").distinct(), "a", "b")
        level = pairs.join(names, ["a", "b"]).select("key", "i", "name")
        most = -(-most // 2)
    done = done.unionByName(level.select("key", "name"))
    return rows.select("key", "doc_id", "n_chars", "text_sha256", "n_blocks").join(done, "key").drop("key")


def dedup(docs: DataFrame, *, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``, one row per row of
    ``docs``, dropped ones too.

    Of equal texts the row with the most code points in its original text
    stays, then the one with the smallest doc_id (a null id after all others).
    A null text counts as empty. Rows that repeat a doc_id as well as a text
    are one document: each is returned and counted, and they are kept or
    dropped together. An empty table gives an empty result.
    """
    named = materialize(name_documents(docs, block_chars=block_chars), "identities")
    best = F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id")))
    # Written, so that the join is over two plain shuffles and a large group is split.
    groups = materialize(named.groupBy("n_blocks", "name").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best")), "groups")
    out = named.join(groups, ["n_blocks", "name"])
    kept = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("n_chars") == -F.col("best.n"))
    return out.select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256")
