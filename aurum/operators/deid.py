"""De-identification and Gold shaping: surrogate keys, date generalisation,
column purge/ordering and the published projections."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum import config
from aurum.functions import expressions as X


def mask_key(df: DataFrame, id_col: str = "ssn", out_col: str = "subject_surrogate_id",
             salt: str | None = None, keep_source: bool = False) -> DataFrame:
    """Replace ``id_col`` by a 16-hex SHA-256 surrogate (NULL stays NULL)."""
    out = df.withColumn(out_col, X.surrogate_key(id_col, salt))
    return out if keep_source else out.drop(id_col)


def generalize_date(df: DataFrame, date_col: str = "scan_date",
                    out_col: str = "enrollment_year") -> DataFrame:
    """Replace a date by its year."""
    return df.withColumn(out_col, F.year(F.col(date_col))).drop(date_col)


def purge_columns(df: DataFrame, cols: Iterable[str] = config.GOLD_COLUMNS_TO_DROP) -> DataFrame:
    """Drop the listed columns that exist (absent ones are ignored)."""
    present = [c for c in cols if c in df.columns]
    return df.drop(*present)


def order_columns(df: DataFrame, first: Sequence[str] = config.GOLD_COLUMN_ORDER) -> DataFrame:
    """Listed columns first (those that exist), all others after in their order."""
    lead = [c for c in first if c in df.columns]
    rest = [c for c in df.columns if c not in lead]
    return df.select(*lead, *rest)


def require_columns(df: DataFrame, required: Iterable[str], what: str = "input") -> None:
    """Raise naming every missing column (a schema check, no Spark job)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")


def gold_research(silver_joined: DataFrame, id_col: str = "ssn", date_col: str = "scan_date",
                  salt: str | None = None, extra_drop: Iterable[str] = (),
                  pointer_base: str | None = None) -> DataFrame:
    """Gold research dataset: masked key, year only, audit/raw columns purged,
    canonical column order.

    ``pointer_base`` replaces ``imaging_s3_uri`` by an opaque hash pointer of
    the key (for sources whose URIs embed the identifier).
    """
    if pointer_base is not None:
        silver_joined = rewrite_pointer(silver_joined, id_col, pointer_base)
    g = mask_key(silver_joined, id_col, salt=salt)
    g = generalize_date(g, date_col)
    g = purge_columns(g, [*config.GOLD_COLUMNS_TO_DROP, *extra_drop])
    return order_columns(g)


def project_rename(df: DataFrame, mapping: Mapping[str, str], what: str = "input") -> DataFrame:
    """Select the mapping's keys in order, renamed to its values."""
    require_columns(df, mapping.keys(), what)
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])


def gold_ml_projection(gold: DataFrame, mapping: Mapping[str, str] = config.GOLD_ML_COLUMNS) -> DataFrame:
    """The 6-column ML export (two columns renamed)."""
    return project_rename(gold, mapping, "Gold dataset")


def rewrite_pointer(df: DataFrame, key_col: str, base: str, out_col: str = "imaging_s3_uri") -> DataFrame:
    """Replace an imaging URI by an opaque hash-derived pointer of the key."""
    return df.withColumn(out_col, X.hash_pointer(key_col, base))


def gold_preview(silver: DataFrame, pointer_base: str, id_col: str = "ssn",
                 date_col: str = "scan_date", salt: str | None = None) -> DataFrame:
    """Seven-column preview of the Gold record for a Silver slice: masked key,
    generalised year and a hash pointer instead of the raw imaging path."""
    s = rewrite_pointer(silver, id_col, pointer_base, "_pointer")
    s = s.withColumns({
        "surrogate_id": X.surrogate_key(id_col, salt),
        "enrollment_year": F.year(F.col(date_col)),
    })
    return s.select("surrogate_id", "age", "ehr_system", "site_location",
                    "enrollment_year", "lesion_label", F.col("_pointer").alias("s3_dicom_path"))
