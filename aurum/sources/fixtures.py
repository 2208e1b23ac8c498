"""Clinical fixture views derived from the benchmark tables.

``fx_metadata`` turns every order into one clinical encounter and
``fx_manifest`` turns every customer into zero, one or two imaging records.
The derivation injects the dirt the pipeline must handle (NULL keys, padded
and mixed-case values, bad ages and dates, unknown codes, NULL sites,
unmatched keys, bad/NULL URIs, manifest fan-out) by fixed rules on the source
keys, so the views grow with the tables and are identical in every engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def zero_pad(key: Column, width: int) -> Column:
    """A non-negative integer key as text, zero-padded to at least ``width``
    digits and never truncated (same text as ``%0<width>d``, without the
    cost of a format call per row)."""
    text = key.cast("string")
    return F.when(key < 10 ** width, F.lpad(text, width, "0")).otherwise(text)


def patient_id(custkey: Column) -> Column:
    """``999-<10..99>-<custkey, at least 6 digits>``."""
    return F.concat(F.lit("999-"), (custkey % 90 + 10).cast("string"), F.lit("-"), zero_pad(custkey, 6))


def fx_metadata(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    c = F.col("o_custkey")
    code = (
        F.when(k % 10 == 0, "1").when(k % 10 == 1, "-1").when(k % 10 == 2, "NA")
        .when(k % 10 == 3, "Positive ").when(k % 10 == 4, F.lit(None).cast("string"))
        .when(k % 10 == 5, "  ").when(k % 10 == 6, "n/a").when(k % 10 == 7, "POSITIVE")
        .when(k % 10 == 8, "None").otherwise("EQUIVOCAL")
    )
    return orders.select(
        F.when(k % 97 == 0, F.lit(None).cast("string")).otherwise(patient_id(c)).alias("ssn"),
        F.when(k % 53 == 0, "unk").when(k % 59 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" "), (c % 14 + 5).cast("string"))).alias("age"),
        F.when(k % 20 < 11, "CHOC").when(k % 41 == 0, F.lit(None).cast("string"))
        .otherwise(" Rady ").alias("site_location"),
        F.when(k % 20 < 11, "Cerner").otherwise("Epic").alias("ehr_system"),
        code.alias("lesion_status_code"),
        F.when(k % 61 == 0, "2026-13-40").when(k % 67 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("scan_date"),
        k.alias("encounter_id"),
    )


def fx_manifest(customer: DataFrame) -> DataFrame:
    c = F.col("c_custkey")
    # Not a sample: customers divisible by 13 model patients without imaging
    # (the unmatched ids reconciliation must report). Every other customer
    # has scan 1; multiples of 5 also scan 2 (manifest fan-out).
    scans = customer.where(c % 13 != 0).select(
        "c_custkey",
        F.explode(F.when(c % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("k"),
    )
    return scans.select(
        patient_id(c).alias("ssn"),
        F.when(c % 31 == 0, F.lit(None).cast("string"))
        .when(c % 11 == 0, F.concat(F.lit("http://host/"), c.cast("string"), F.lit(".dcm")))
        .otherwise(F.concat(F.lit("s3://bucket/imaging/"), c.cast("string"), F.lit("_scan"),
                            F.col("k").cast("string"), F.lit(".dcm"))).alias("dicom_s3_uri"),
        F.when(c % 3 == 0, " mri ").otherwise("Ct").alias("modality"),
        F.lit("BRAIN ").alias("body_region"),
    )


def load_fixtures(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(fx_metadata, fx_manifest) over the tables in ``sf_dir``."""
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer")
    return fx_metadata(orders), fx_manifest(customer)


def metadata_csv_lines(fx: DataFrame, corrupt_short=None, corrupt_long=None) -> DataFrame:
    """Render fixture metadata rows as CSV text lines (NULL -> empty field).

    ``corrupt_short``/``corrupt_long`` are boolean Columns selecting rows that
    lose their last field / gain an extra one, to exercise corrupt-row capture.
    """
    fields = [F.coalesce(F.col(c), F.lit("")) for c in
              ("ssn", "age", "site_location", "ehr_system", "lesion_status_code", "scan_date")]
    full = F.concat_ws(",", *fields)
    short = F.concat_ws(",", *fields[:-1])
    line = full
    if corrupt_long is not None:
        line = F.when(corrupt_long, F.concat(full, F.lit(",extra"))).otherwise(line)
    if corrupt_short is not None:
        line = F.when(corrupt_short, short).otherwise(line)
    return fx.select(line.alias("value"), "encounter_id")
