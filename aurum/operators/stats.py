"""Aggregations: cleaning stats, cohort summaries, distributions and audits.

All are single ``agg``/``groupBy().agg()`` passes, which Spark executes as
partial (map-side) plus final aggregation, so a hot site or label is
pre-aggregated in every task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from aurum import config

# Decimals published for the sample standard deviation: engines accumulate the
# variance differently in the last bits. Means are exact (integer sums) and
# are published unrounded.
STAT_DECIMALS = 6


def clean_stats(silver_metadata: DataFrame) -> DataFrame:
    """One-row label tallies of the cleaned metadata."""
    lab = F.col("lesion_label")
    return silver_metadata.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(lab == config.LABEL_POSITIVE).alias("lesion"),
        F.count_if(lab == config.LABEL_NEGATIVE).alias("no_lesion"),
        F.count_if(lab == config.LABEL_PENDING).alias("pending"),
        F.count_if(F.col("lesion_code_requires_review")).alias("review"),
        F.count_if(F.col("has_data_quality_flag")).alias("quality_flagged"),
    )


def cohort_summary(gold: DataFrame, by: Sequence[str] = ("site_location", "lesion_label"),
                   key: str = "subject_surrogate_id") -> DataFrame:
    """Per site and label: subjects, mean/min/max age and review-flag count."""
    return (
        gold.groupBy(*by)
        .agg(
            F.count(key).alias("subject_count"),
            F.avg("age").alias("mean_age"),
            F.min("age").alias("min_age"),
            F.max("age").alias("max_age"),
            F.sum(F.col("lesion_code_requires_review").cast("int")).cast("bigint").alias("flagged_for_review"),
        )
        .orderBy(*by)
    )


def label_distribution(gold: DataFrame, label: str = "lesion_label") -> DataFrame:
    """Count and percentage per label.

    The total is a scalar subquery over the per-label counts (its shuffle is
    reused): evaluated once, used as a value, so the per-label rows stay
    distributed however many distinct labels there are, with no join.
    """
    counts = gold.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.round(F.col("n").cast("double") / total * 100, 2))


def age_distribution(gold: DataFrame, by: str = "site_location", value: str = "age",
                     accuracy: int = 10000) -> DataFrame:
    """Per group: count, mean, sample stddev and approximate quartiles."""
    return (
        gold.groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(value).alias("mean_age"),
            F.round(F.stddev(value), STAT_DECIMALS).alias("stddev_age"),
            F.percentile_approx(value, 0.25, accuracy).alias("p25_age"),
            F.percentile_approx(value, 0.50, accuracy).alias("median_age"),
            F.percentile_approx(value, 0.75, accuracy).alias("p75_age"),
        )
        .orderBy(by)
    )


def distinct_values(df: DataFrame, col: str = "site_location", drop_null: bool = True) -> DataFrame:
    out = df.select(col).distinct()
    return out.where(F.col(col).isNotNull()) if drop_null else out


def invalid_uri_count(silver_manifest: DataFrame, flag: str = "uri_format_valid") -> DataFrame:
    return silver_manifest.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col(flag)).alias("invalid_uri"),
    )


def source_profile(raw_metadata: DataFrame, positives: Iterable[str] = ("1", "Positive"),
                   site: str = "site_location", code: str = "lesion_status_code") -> DataFrame:
    """Profile of a raw extract: rows, per-site split, positive/negative/missing
    counts and percentages (codes compared exactly, as written)."""
    c = F.col(code)
    prof = raw_metadata.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(site) == "CHOC").alias("choc_rows"),
        F.count_if(F.col(site) == "Rady").alias("rady_rows"),
        F.count_if(c.isin(list(positives))).alias("positive"),
        F.count_if(c.isNull()).alias("missing"),
    ).withColumn("negative", F.col("rows") - F.col("positive") - F.col("missing"))
    pct = {f"{k}_pct": F.round(F.col(k).cast("double") / F.col("rows") * 100, 2)
           for k in ("positive", "negative", "missing")}
    return prof.withColumns(pct)


def dq_audit(silver_metadata: DataFrame, site: str = "site_location",
             code: str = "lesion_status_code") -> DataFrame:
    """Data-quality audit table: one row per (site, raw code) that needs
    review or has a quality flag, with counts.

    All rows are grouped and the flags counted; groups without any go
    afterwards. A filter on the derived flags would repeat the cleaning
    expressions below and above itself. (A missing age or date sets the
    quality flag, so counting them over all rows is the same.)
    """
    return silver_metadata.groupBy(site, code).agg(
        F.count_if(F.col("lesion_code_requires_review") | F.col("has_data_quality_flag")).alias("rows"),
        F.count_if(F.col("lesion_code_requires_review")).alias("review_rows"),
        F.count_if(F.col("has_data_quality_flag")).alias("quality_rows"),
        F.count_if(F.col("age").isNull()).alias("missing_age"),
        F.count_if(F.col("scan_date").isNull()).alias("missing_date"),
    ).where("rows > 0")


def phi_audit(published: DataFrame, forbidden: Iterable[str] = ("ssn", "scan_date"),
              pattern: str = config.IDENTIFIER_PATTERN) -> DataFrame:
    """Audit a published dataset for identifiers.

    One row per column: whether the column name is forbidden and how many
    values of a string column match the identifier pattern. A single
    aggregation pass covers every column.
    """
    forbidden = set(forbidden)
    string_cols = [f.name for f in published.schema.fields if isinstance(f.dataType, StringType)]
    aggs = [F.count_if(F.col(c).rlike(pattern)).alias(c) for c in string_cols]
    if not aggs:
        aggs = [F.count(F.lit(1)).alias("_rows")]
    counts = published.agg(*aggs)
    # Unpivot the one-row result: one output row per audited column.
    rows = [F.struct(F.lit(c).alias("column_name"),
                     F.lit(c in forbidden).alias("forbidden_name"),
                     F.col(c).cast("bigint").alias("identifier_values"))
            for c in string_cols]
    for c in published.columns:
        if c not in string_cols:
            rows.append(F.struct(F.lit(c).alias("column_name"),
                                 F.lit(c in forbidden).alias("forbidden_name"),
                                 F.lit(0).cast("bigint").alias("identifier_values")))
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def key_leak_count(silver: DataFrame, key: str = "ssn", cols: Iterable[str] = ("imaging_s3_uri",)) -> DataFrame:
    """Rows whose published columns contain the raw key text (checked before
    masking, since the Gold key is no longer comparable)."""
    return silver.agg(*[F.count_if(F.col(c).contains(F.col(key))).alias(f"{c}_contains_key")
                        for c in cols])


def raw_key_leaks(published: DataFrame, raw: DataFrame, key: str = "ssn", pattern: str = config.IDENTIFIER_PATTERN) -> DataFrame:
    """Raw keys of any patient found in the text columns of a published
    dataset: ``column_name, leaked_keys, leaked_values`` for the columns that
    hold some, with the distinct keys and how often they occur.

    ``key_leak_count`` compares a row with its own key only. Here the
    identifier-shaped tokens of all text columns make an index (column, token,
    occurrences), built with partial aggregation, so that a token on a third of
    all rows is one row per task; the index is joined to the set of raw keys
    (trimmed, without NULLs). A token that is no patient's key doesn't count.
    """
    texts = [f.name for f in published.schema.fields if isinstance(f.dataType, StringType)]
    pairs = [F.struct(F.lit(c).alias("column_name"), F.regexp_extract_all(F.col(f"`{c}`"), F.lit(pattern), 0).alias("tokens")) for c in texts]
    if not pairs:
        return published.sparkSession.createDataFrame([], "column_name string, leaked_keys bigint, leaked_values bigint")
    tokens = (published.select(F.explode(F.array(*pairs)).alias("p"))
              .select("p.column_name", F.explode("p.tokens").alias("token")))
    index = tokens.groupBy("column_name", "token").agg(F.count(F.lit(1)).alias("n"))
    keys = raw.select(F.trim(F.col(key)).alias("token")).where(F.col("token").isNotNull()).distinct()
    return index.join(keys, "token", "left_semi").groupBy("column_name").agg(
        F.count(F.lit(1)).alias("leaked_keys"), F.sum("n").alias("leaked_values"))
