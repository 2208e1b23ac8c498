"""The training-corpus pipeline over ``documents``.

Five stages, each one operator of ``aurum.llm`` applied to all that its
predecessor kept. Every stage's result is written as Parquet and read again as
the next one's documents; all but the last return the columns of documents.

1. language ID: documents without a recognisable language go, a null ``lang``
   becomes the language found.
2. line dedup: cross-site boilerplate lines go, but for their first place.
3. n-gram Jaccard join: of each group of near duplicates one document stays.
4. benchmark decontamination: documents that hold a test item go.
5. BPE: whole texts become token ids.

Rows without a doc_id or with a null or empty text: the first stage rejects a
text that is null or holds no letter; a null doc_id is kept as a document of
its own. Every stage accepts an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aurum.llm import bpe, decontaminate, jaccard, langid, lines
from aurum.llm.common import materialize, neutral, read


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is null or has no letter are rejected; a null
    ``lang`` is filled with the language found. The profiles are learned from
    the rows that are not held out; without a single language to learn from,
    nothing is rejected but texts without letters, and nothing is filled."""
    own, restore = neutral(docs, "doc_id", "text", "lang")
    prototypes = langid.learn(own.where(F.col("doc_id").isNotNull() & ~langid.held_out()).select("text", "lang"))
    if not prototypes:
        return restore(own.where(F.col("text").rlike("\\p{L}")))
    found = langid.predict(own, prototypes).where(F.col("lang_pred") != langid.UNKNOWN)
    return restore(found.withColumn("lang", F.coalesce(F.col("lang"), F.col("lang_pred").cast(own.schema["lang"].dataType))))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines are cut out of the texts; a document left without any
    text, all of whose lines stand elsewhere, goes. ``n_chars`` follows the text."""
    own, restore = neutral(docs, "doc_id", "text", "source", "n_chars")
    cleaned = lines.dedup_lines(own)
    left = cleaned.where((F.col("lines_removed") == 0) | (F.trim("text") != ""))
    n_chars = F.when(F.col("lines_removed") == 0, F.col("n_chars")).otherwise(F.char_length("text"))
    return restore(left.withColumn("n_chars", n_chars.cast(own.schema["n_chars"].dataType)))


def _keep(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """The documents whose id is (``left_semi``) or isn't (``left_anti``) among ``ids``."""
    own, restore = neutral(docs, "doc_id")
    return restore(own.join(ids.withColumnRenamed("doc_id", "id"), F.col("doc_id").eqNullSafe(F.col("id")), how))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document that a component is named after stays, with every document
    whose text has no words."""
    found = jaccard.near_duplicates(docs)
    return _keep(docs, found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct(), "left_semi")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item, also an edited one, go."""
    leaks = decontaminate.find_leaks(docs, read(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return _keep(docs, leaks, "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of them and of the decoded text."""
    return bpe.digest_documents(bpe.encode_documents(docs))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("bpe", encode),
]

#: Language profiles, alignment and BPE have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
