"""Column-level building blocks (pure ``pyspark.sql.functions`` expressions)."""

from aurum.functions.expressions import (  # noqa: F401
    code_is_blank,
    code_is_negative,
    code_is_positive,
    confirmation_id,
    ehr_from_site,
    file_name_of,
    finding_label,
    finding_label_binary,
    finding_needs_review,
    finding_needs_review_binary,
    hash_pointer,
    safe_date,
    safe_int,
    site_partition_key,
    surrogate_key,
    title_case,
    uniform01,
    upload_base_name,
    upload_stamp,
    upload_time,
    upper_trim,
    uri_is_valid,
)
