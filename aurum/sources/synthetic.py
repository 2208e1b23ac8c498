"""Synthetic clinical extracts generated as a Spark job.

One participant per row of a population table (e.g. ``customer``), so the
output scales with the cluster instead of a driver loop. Every random draw is
``uniform01(seed, stream, id)``: a pure function of the participant id, hence
identical under any partitioning, task retry or engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum import config
from aurum.functions.expressions import uniform01
from aurum.operators.dedup import ordinal_within
from aurum.sources.fixtures import zero_pad

DEFAULT_SEED = 42


def synth_metadata(population: DataFrame, id_col: str = "c_custkey", seed: int = DEFAULT_SEED,
                   missing: str = "exact") -> DataFrame:
    """Metadata extract: id, age, site, EHR, vendor finding code, scan date.

    ``missing="exact"`` blanks exactly ``floor(n * rate)`` codes (the rows with
    the smallest missing-draw, ties by id); ``"bernoulli"`` blanks each code
    independently with the rate (no global ordering, cheapest at scale).
    """
    i = F.col(id_col)
    lo, hi = config.SYNTH_AGE_RANGE
    choc_pos, choc_neg = config.SYNTH_CODES["CHOC"]
    rady_pos, rady_neg = config.SYNTH_CODES["Rady"]
    site = F.when(uniform01(seed, "site", i) < config.SYNTH_SITE_WEIGHT_CHOC, F.lit("CHOC")).otherwise(F.lit("Rady"))
    positive = uniform01(seed, "positive", i) < config.SYNTH_POSITIVE_RATE
    days = F.floor(uniform01(seed, "date", i) * 365).cast("int")
    base = population.select(
        i.alias("participant"),
        F.concat(F.lit("999-"), (F.floor(uniform01(seed, "mid", i) * 90) + 10).cast("int").cast("string"),
                 F.lit("-"), zero_pad(i, 4)).alias("ssn"),
        (F.lit(lo) + F.floor(uniform01(seed, "age", i) * (hi - lo + 1))).cast("int").cast("string").alias("age"),
        site.alias("site_location"),
        F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("missing"), i.cast("string"))), 1, 8),
               16, 10).cast("bigint").alias("_miss"),
        positive.alias("_pos"),
        F.date_add(F.make_date(F.lit(config.SYNTH_YEAR), F.lit(1), F.lit(1)), days).cast("string").alias("scan_date"),
    )
    base = base.withColumns({
        "ehr_system": F.when(F.col("site_location") == "CHOC", F.lit(config.SITE_EHR["CHOC"]))
        .otherwise(F.lit(config.SITE_EHR["Rady"])),
        "lesion_status_code": F.when(F.col("site_location") == "CHOC",
                                     F.when(F.col("_pos"), F.lit(choc_pos)).otherwise(F.lit(choc_neg)))
        .otherwise(F.when(F.col("_pos"), F.lit(rady_pos)).otherwise(F.lit(rady_neg))),
    })
    if missing == "exact":
        n = population.count()
        k = int(n * config.SYNTH_MISSING_RATE)
        ranked = ordinal_within(base, order_cols=["_miss", "participant"], name="_miss_rank")
        is_missing = F.col("_miss_rank") < k
        base = ranked
    elif missing == "bernoulli":
        is_missing = F.col("_miss") / F.lit(4294967296.0) < config.SYNTH_MISSING_RATE
    else:
        raise ValueError(f"unknown missing mode {missing!r}")
    code = F.when(is_missing, F.lit(None).cast("string")).otherwise(F.col("lesion_status_code"))
    return base.select("ssn", "age", "site_location", "ehr_system",
                       code.alias("lesion_status_code"), "scan_date")


def synth_manifest(metadata: DataFrame, uri_base: str = "s3://clinical-bronze/imaging/") -> DataFrame:
    """Imaging manifest: one scan per participant; the URI embeds the id (as
    the source systems do, which the PHI audit then reports)."""
    return metadata.select(
        "ssn",
        F.concat(F.lit(uri_base), F.col("ssn"), F.lit("_scan1.dcm")).alias("dicom_s3_uri"),
        F.lit(config.SYNTH_MODALITY).alias("modality"),
        F.lit(config.SYNTH_BODY_REGION).alias("body_region"),
    )


def write_synthetic_extracts(population: DataFrame, root: str, seed: int = DEFAULT_SEED,
                             missing: str = "exact") -> dict[str, str]:
    """Land a synthetic metadata extract and manifest as header CSV under
    ``root`` (``metadata/`` and ``dicom/``), written by every task in
    parallel. Returns the two folders."""
    meta = synth_metadata(population, seed=seed, missing=missing)
    out = {"metadata": f"{root.rstrip('/')}/metadata", "dicom": f"{root.rstrip('/')}/dicom"}
    meta.write.mode("overwrite").option("header", True).csv(out["metadata"])
    synth_manifest(meta).write.mode("overwrite").option("header", True).csv(out["dicom"])
    return out


def population(spark, participants: int, id_col: str = "c_custkey") -> DataFrame:
    """Participant ids 1..n as a distributed range (for standalone generation)."""
    return spark.range(1, participants + 1).withColumnRenamed("id", id_col)


def main(argv: list[str] | None = None) -> None:
    """``python -m aurum.sources.synthetic --out <dir> (--participants N | --population <parquet>)``"""
    import argparse

    from pyspark.sql import SparkSession

    p = argparse.ArgumentParser(description="Land synthetic metadata and manifest extracts.")
    p.add_argument("--out", required=True)
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--participants", type=int)
    src.add_argument("--population", help="parquet table whose id column defines the participants")
    p.add_argument("--id-col", default="c_custkey")
    p.add_argument("--seed", type=int, default=DEFAULT_SEED)
    p.add_argument("--missing", choices=("exact", "bernoulli"), default="exact")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("aurum-synthetic").config("spark.ui.enabled", "false").getOrCreate()
    pop = population(spark, a.participants, a.id_col) if a.participants else spark.read.parquet(a.population)
    print(write_synthetic_extracts(pop.select(a.id_col).withColumnRenamed(a.id_col, "c_custkey"),
                                   a.out, seed=a.seed, missing=a.missing))


if __name__ == "__main__":
    main()
