"""The registered queries of this subpackage: thin wrappers that read the
benchmark tables, apply an operator with production parameters to the whole
table and derive the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from aurum.llm import (bpe, decontaminate, divergence, fim, html, jaccard, langid, lines, naming, passages, quality, rules,
                       substrings)
from aurum.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_line_dedup(spark, sf_dir):
    cleaned = lines.dedup_lines(read(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", F.col("lines_n").alias("n_lines"), F.col("lines_removed").alias("n_removed"),
                          F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query
def op2_substring_dedup(spark, sf_dir):
    kept = passages.remove_passages(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_quality(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = quality.train(docs, quality.ratings(read(spark, sf_dir, "labels")), 3)
    scored = quality.score(docs, model, 3)
    return scored.select("doc_id", "expected_grade", F.col("p_at_least")[0].alias("p_not_toxic"),
                         F.col("p_at_least")[1].alias("p_good"), "kept")


@query
def op4_jaccard_join(spark, sf_dir):
    return jaccard.near_duplicates(read(spark, sf_dir, "documents"))


@query
def op5_exact_dedup(spark, sf_dir):
    return naming.dedup(read(spark, sf_dir, "documents"))


@query
def op6_suffix_dedup(spark, sf_dir):
    kept = substrings.remove_substrings(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_html_text(spark, sf_dir):
    return html.extract(read(spark, sf_dir, "pages"))


@query
def op8_decontamination(spark, sf_dir):
    return decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op9_language_id(spark, sf_dir):
    return langid.identify(read(spark, sf_dir, "documents")).drop("text")


@query
def op10_bpe(spark, sf_dir):
    return bpe.digest_documents(bpe.encode_documents(read(spark, sf_dir, "documents")))


@query
def op11_fill_in_middle(spark, sf_dir):
    return fim.transform(read(spark, sf_dir, "documents"))


@query
def op12_source_divergence(spark, sf_dir):
    return divergence.audit(read(spark, sf_dir, "documents"))


@query
def op13_quality_rules(spark, sf_dir):
    return rules.apply_rules(read(spark, sf_dir, "documents")).drop("broken_rules")


@query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
