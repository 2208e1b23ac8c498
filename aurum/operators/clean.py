"""Silver cleaning operators: filters, trims, safe typing, harmonisation, flags.

Each function is a lazy ``DataFrame -> DataFrame`` transform (no actions), so
a chain of them collapses into one projection/filter inside a single
whole-stage-codegen stage, and the key filters push down to the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum import config
from aurum.functions import expressions as X
from aurum.session import written


def add_lineage(df: DataFrame, run_ts: str, run_date: str,
                source_file: str | None = None) -> DataFrame:
    """Append the Bronze audit columns (all strings).

    ``source_file`` defaults to the per-row input file from the scan's hidden
    ``_metadata`` column, which is exact when one read covers many files.
    """
    src = F.lit(source_file) if source_file is not None else F.col("_metadata.file_path")
    return df.withColumns({
        "ingested_at": F.lit(run_ts).cast("string"),
        "source_file": src.cast("string"),
        "pipeline_run_date": F.lit(run_date).cast("string"),
    })


def require_keys(df: DataFrame, *keys: str, reject_blank: bool = False) -> DataFrame:
    """Keep rows whose key columns are all non-NULL (optionally non-blank)."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
        if reject_blank:
            cond = cond & (F.trim(F.col(k)) != "")
    return df.filter(cond)


def trim_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Trim leading/trailing spaces of the listed columns (one projection)."""
    return df.withColumns({c: F.trim(F.col(c)) for c in cols if c in df.columns})


def canonicalize_site(df: DataFrame, col: str = "site_location") -> DataFrame:
    return df.withColumn(col, X.upper_trim(col))


def harmonize_codes(df: DataFrame, col_name: str = "lesion_status_code",
                    negatives=config.NEGATIVE_CODES, positives=config.POSITIVE_CODES,
                    blank_label: str = config.LABEL_NEGATIVE, mode: str = "full") -> DataFrame:
    """Add ``lesion_label`` and ``lesion_code_requires_review``.

    ``mode="full"``: blank/negative -> No, positive -> Yes, anything else ->
    Pending with the review flag set. ``mode="binary"``: the upload-preview
    variant (positive -> Yes, everything else -> No; review flag from the raw
    lower-cased code).
    """
    if mode == "full":
        label = X.finding_label(col_name, negatives, positives, blank_label)
        review = X.finding_needs_review(col_name, negatives, positives)
    elif mode == "binary":
        label = X.finding_label_binary(col_name, positives)
        review = X.finding_needs_review_binary(col_name)
    else:
        raise ValueError(f"unknown harmonisation mode {mode!r}")
    return df.withColumns({"lesion_label": label, "lesion_code_requires_review": review})


def harmonize_codes_by_table(df: DataFrame, mapping: DataFrame, col_name: str = "lesion_status_code",
                             blank_label: str = config.LABEL_NEGATIVE) -> DataFrame:
    """Harmonise against a vocabulary table ``(code, label)`` instead of literals.

    For many vendors the vocabulary is data: codes are matched after
    lower(trim(.)). A vocabulary is small, so the optimizer broadcasts it by
    its measured bytes; a larger one is joined by shuffle, where adaptive
    execution splits a code that covers much of the data. A code with two
    labels is an error.
    """
    norm = F.lower(F.trim("code"))
    labels = mapping.groupBy(norm.alias("_code_norm")).agg(F.min("label").alias("_label"), F.max("label").alias("_other"))
    clash = F.concat(F.lit("code with two labels: "), F.col("_code_norm"))
    vocab = written(labels.select("_code_norm", F.when(F.col("_label") == F.col("_other"), F.col("_label"))
                                  .when(F.col("_label").isNotNull(), F.raise_error(clash)).alias("_label")), "vocabulary")
    joined = df.withColumn("_code_norm", F.lower(F.trim(F.col(col_name)))) \
        .join(vocab, "_code_norm", "left")
    blank = X.code_is_blank(col_name)
    return joined.withColumns({
        "lesion_label": F.when(blank, F.lit(blank_label))
        .otherwise(F.coalesce(F.col("_label"), F.lit(config.LABEL_PENDING))),
        "lesion_code_requires_review": ~blank & F.col("_label").isNull(),
    }).drop("_code_norm", "_label")


def flag_quality(df: DataFrame, cols: Iterable[str] = ("age", "scan_date"),
                 name: str = "has_data_quality_flag") -> DataFrame:
    """Flag (never filter) rows where any listed typed column is NULL."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return df.withColumn(name, cond)


def clean_metadata(df: DataFrame, code_col: str = "lesion_status_code",
                   reject_blank_key: bool = False, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Metadata Silver: key filter, trims, safe typing, site upper-case,
    finding harmonisation and the data-quality flag, in one projection."""
    df = require_keys(df, "ssn", reject_blank=reject_blank_key)
    typed = {
        "ssn": F.trim("ssn"),
        "age": X.safe_int("age"),
        "site_location": X.upper_trim("site_location"),
        "ehr_system": F.trim("ehr_system"),
        code_col: F.trim(code_col),
        "scan_date": X.safe_date(F.trim("scan_date"), date_format),
    }
    df = df.withColumns(typed)
    df = harmonize_codes(df, code_col)
    return flag_quality(df)


def clean_manifest(df: DataFrame, trim_key: bool = True, uri_prefix: str = "s3://") -> DataFrame:
    """Manifest Silver: key and URI required, modality upper-case, region
    title-case, URI scheme flag."""
    df = require_keys(df, "ssn", "dicom_s3_uri")
    cols = {
        "modality": X.upper_trim("modality"),
        "body_region": X.title_case("body_region"),
        "uri_format_valid": X.uri_is_valid("dicom_s3_uri", uri_prefix),
    }
    if trim_key:
        cols["ssn"] = F.trim("ssn")
    return df.withColumns(cols)


def fill_missing_columns(df: DataFrame, defaults: Mapping[str, object],
                         types: Mapping[str, str] | None = None) -> DataFrame:
    """Add each absent column with the caller's default (typed NULL if None)."""
    types = types or {}
    add = {}
    for name, value in defaults.items():
        if name in df.columns:
            continue
        add[name] = F.lit(value).cast(types.get(name, "string"))
    return df.withColumns(add) if add else df
