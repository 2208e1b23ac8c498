"""Schemas, vocabularies and column lists shared by every layer.

Everything below the "fixed values" marker must keep exactly these values so
that results agree with the reference behaviour; the rest are defaults that
callers may override.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------

# Finding codes read as a clear (negative) result, compared after lower(trim(.)).
NEGATIVE_CODES = ("-1", "na", "n/a", "none")
# Finding codes read as a positive result, compared after lower(trim(.)).
POSITIVE_CODES = ("1", "positive")

LABEL_NEGATIVE = "No Lesion Detected"
LABEL_POSITIVE = "Lesion Detected"
LABEL_PENDING = "Pending Radiologist Review"

# Codes the two-way portal preview treats as recognised (lower-cased, untrimmed).
BINARY_RECOGNISED_CODES = ("1", "-1", "positive", "none", "na")

# Columns removed before the Gold research dataset is published.
GOLD_COLUMNS_TO_DROP = (
    "ingested_at",
    "source_file",
    "pipeline_run_date",
    "uri_format_valid",
    "has_data_quality_flag",
    "lesion_status_code",
)

# Column order of the Gold research dataset; other columns follow.
GOLD_COLUMN_ORDER = (
    "subject_surrogate_id",
    "age",
    "site_location",
    "ehr_system",
    "enrollment_year",
    "lesion_label",
    "lesion_code_requires_review",
    "imaging_s3_uri",
    "modality",
    "body_region",
)

# Gold ML export: internal column -> exported column.
GOLD_ML_COLUMNS = {
    "subject_surrogate_id": "surrogate_id",
    "age": "age",
    "ehr_system": "ehr_system",
    "site_location": "site_location",
    "lesion_label": "lesion_label",
    "imaging_s3_uri": "s3_dicom_path",
}

# Site-native header names -> canonical names.
HEADER_RENAMES = {
    "cerner_id": "ssn",
    "epic_id": "ssn",
    "age_in_years": "age",
    "scan_date": "scan_date",
    "mri_date": "scan_date",
    "lesion_status_code": "raw_lesion_status",
    "lesion_status": "raw_lesion_status",
}

# Canonical columns of a harmonised upload.
CANONICAL_UPLOAD_COLUMNS = ("ssn", "site_location", "age", "scan_date", "raw_lesion_status")

# Canonical -> site-native headers (and the ordinal-id column and its prefix).
SITE_NATIVE_HEADERS = {
    "CHOC": {"id_column": "cerner_id", "id_prefix": "C",
             "renames": {"raw_lesion_status": "lesion_status_code"}},
    "RADY": {"id_column": "epic_id", "id_prefix": "E",
             "renames": {"age": "age_in_years", "scan_date": "mri_date",
                         "raw_lesion_status": "lesion_status"}},
}

# Dataset type chosen at upload -> landing sub-prefix.
DATASET_PREFIXES = {
    "Clinical Metadata Extract": "metadata",
    "DICOM Imaging Manifest": "dicom",
}

# Site -> EHR vendor (anything that is not CHOC is Epic).
SITE_EHR = {"CHOC": "Cerner", "Rady": "Epic"}

# File-name tokens that mark a landed file as a metadata extract / manifest.
METADATA_NAME_TOKENS = ("metadata", "extract", "choc", "rady")
MANIFEST_NAME_TOKENS = ("dicom",)

# Upload-name timestamp suffix: <name>_<YYYYMMDDTHHMMSSZ><ext>.
UPLOAD_TS_PATTERN = r"_(\d{8}T\d{6}Z)(\.[^./]+)?$"
UPLOAD_TS_FORMAT = "yyyyMMdd'T'HHmmss'Z'"

# Bronze audit-column formats.
RUN_TS_FORMAT = "%Y-%m-%dT%H:%M:%SZ"
RUN_DATE_FORMAT = "%Y-%m-%d"

# Synthetic generator targets.
SYNTH_SITE_WEIGHT_CHOC = 0.55
SYNTH_POSITIVE_RATE = 0.20
SYNTH_MISSING_RATE = 0.05
SYNTH_CODES = {"CHOC": ("1", "-1"), "Rady": ("Positive", "NA")}
SYNTH_AGE_RANGE = (5, 18)
SYNTH_YEAR = 2026
SYNTH_MODALITY = "MRI"
SYNTH_BODY_REGION = "Brain"

# ---------------------------------------------------------------------------
# Raw schemas (all strings; typing happens in Silver)
# ---------------------------------------------------------------------------

METADATA_RAW_SCHEMA = StructType([
    StructField("ssn", StringType(), True),
    StructField("age", StringType(), True),
    StructField("site_location", StringType(), True),
    StructField("ehr_system", StringType(), True),
    StructField("lesion_status_code", StringType(), True),
    StructField("scan_date", StringType(), True),
])

MANIFEST_RAW_SCHEMA = StructType([
    StructField("ssn", StringType(), True),
    StructField("dicom_s3_uri", StringType(), True),
    StructField("modality", StringType(), True),
    StructField("body_region", StringType(), True),
])

LINEAGE_COLUMNS = ("ingested_at", "source_file", "pipeline_run_date")
CORRUPT_COLUMN = "_corrupt_record"

# Identifier shapes searched for by the PHI audit of published data.
IDENTIFIER_PATTERN = r"\d{3}-\d{2}-\d{4,}"
