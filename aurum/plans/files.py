"""File-based registered queries (CSV ingest, partitioned sinks, landing zone,
streaming, the full run).

Each query lands its inputs (derived from the benchmark tables through the
clinical fixture) in a fresh folder under the shared scratch area
(``spark.checkpoint.dir``), runs the operator and returns the read-back
DataFrame, so the check covers the real file round trip.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from aurum import config
from aurum.functions import expressions as X
from aurum.plans import layers
from aurum.plans.lineage import lineage_trace
from aurum.plans.queries import RUN_DATE, RUN_TS, query
from aurum.plans.run import run_medallion
from aurum.session import scratch_path
from aurum.sinks import writers
from aurum.sources import csv, landing
from aurum.sources.fixtures import load_fixtures, metadata_csv_lines, read_table, zero_pad
from aurum.streaming.incremental import incremental_ingest
from aurum.operators import headers, stats
from aurum.operators.deid import require_columns
from aurum.operators.join import ledger_lookup

# The fixture extract carries its encounter id (the dedup tiebreaker), typed.
FIXTURE_METADATA_SCHEMA = StructType(list(config.METADATA_RAW_SCHEMA.fields)
                                     + [StructField("encounter_id", LongType(), True)])
RAW_META_COLS = [f.name for f in config.METADATA_RAW_SCHEMA.fields]

# Whitespace must survive the CSV round trip (padded values are part of the data).
_KEEP_SPACES = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str, header: bool = True) -> str:
    df.write.mode("overwrite").options(header=header, **_KEEP_SPACES).csv(path)
    return path


# Encounters / customers per landed upload: uploads stay bounded (one file
# each, written by one task) while their number grows with the data.
UPLOAD_KEY_SPAN = 100_000
UPLOAD_STAMP = "20260623T131804Z"
META_COLS = [*RAW_META_COLS, "encounter_id"]
MANIFEST_COLS = [f.name for f in config.MANIFEST_RAW_SCHEMA.fields]


def _line(cols: list[str]) -> F.Column:
    """A row as its CSV line (NULL -> empty field; the fixture has no
    delimiters, quotes or line breaks in values)."""
    return F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def land_uploads(df: DataFrame, upload: F.Column, cols: list[str], path: str) -> None:
    """Land rows as CSV uploads, one file per ``upload`` value, written in
    parallel (``partitionBy``). Each file is the header then its lines in byte
    order, so its bytes (and hash) are reproducible from the tables."""
    (df.select(upload.alias("upload"), *cols, _line(cols).alias("_line"))
       .repartition("upload")
       .sortWithinPartitions("upload", "_line")
       .drop("_line")
       .write.mode("overwrite").partitionBy("upload").options(header=True, **_KEEP_SPACES).csv(path))


def land_fixture(spark: SparkSession, sf_dir: str, name: str) -> dict[str, str]:
    """Land the fixture as a landing zone: metadata extracts per site and
    manifests, each upload covering a bounded key range and carrying an
    immutable upload name. Returns the folders."""
    meta, man = load_fixtures(spark, sf_dir)
    root = scratch_path(spark, name)
    site = F.when(F.col("site_location") == "CHOC", F.lit("choc")).otherwise(F.lit("rady"))
    meta_upload = F.concat(site, F.lit("_extract_"), _bucket(F.col("encounter_id")),
                           F.lit(f"_{UPLOAD_STAMP}.csv"))
    custkey = F.element_at(F.split("ssn", "-"), 3).cast("bigint")
    man_upload = F.concat(F.lit("dicom_manifest_"), _bucket(custkey), F.lit(f"_{UPLOAD_STAMP}.csv"))
    land_uploads(meta, meta_upload, META_COLS, f"{root}/raw/metadata")
    land_uploads(man, man_upload, MANIFEST_COLS, f"{root}/raw/dicom")
    return {"root": root, "metadata": f"{root}/raw/metadata", "dicom": f"{root}/raw/dicom"}


def _bucket(key: F.Column) -> F.Column:
    return zero_pad(F.floor(key / UPLOAD_KEY_SPAN), 4)


def _source_is_csv() -> F.Column:
    return F.col("source_file").endswith(".csv").alias("source_is_csv")


# ---------------------------------------------------------------- Bronze ingest

@query("bronze_csv_scan")
def q_bronze_csv_scan(spark, sf_dir):
    meta, _ = load_fixtures(spark, sf_dir)
    path = write_csv(meta, scratch_path(spark, "csv-scan"))
    raw = csv.read_csv(spark, path, FIXTURE_METADATA_SCHEMA)
    return raw.drop(config.CORRUPT_COLUMN)


def _corrupt_lines(spark, sf_dir) -> str:
    meta, _ = load_fixtures(spark, sf_dir)
    e = F.col("encounter_id")
    lines = metadata_csv_lines(meta, corrupt_short=(e % 101 == 0), corrupt_long=(e % 103 == 0))
    path = scratch_path(spark, "corrupt")
    lines.select("value").write.mode("overwrite").text(path)
    return path


@query("corrupt_audit")
def q_corrupt_audit(spark, sf_dir):
    """Rows with too few/many fields, captured with their raw text."""
    path = _corrupt_lines(spark, sf_dir)
    bronze = csv.ingest_bronze(spark, path, config.METADATA_RAW_SCHEMA, RUN_TS, RUN_DATE, header=False)
    return csv.quarantine_rows(bronze).select(*RAW_META_COLS, config.CORRUPT_COLUMN)


@query("ingest_row_count")
def q_ingest_row_count(spark, sf_dir):
    """Rows and corrupt rows ingested per run date (read back from Bronze)."""
    path = _corrupt_lines(spark, sf_dir)
    bronze = csv.ingest_bronze(spark, path, config.METADATA_RAW_SCHEMA, RUN_TS, RUN_DATE, header=False)
    out = scratch_path(spark, "bronze-count")
    writers.write_bronze(bronze, out)
    return writers.read_bronze(spark, out).groupBy("pipeline_run_date").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(config.CORRUPT_COLUMN).isNotNull()).alias("corrupt_rows"))


def _bronze_written(spark, sf_dir, dataset: str) -> DataFrame:
    meta, man = load_fixtures(spark, sf_dir)
    src, schema = (meta, FIXTURE_METADATA_SCHEMA) if dataset == "metadata" else (man, config.MANIFEST_RAW_SCHEMA)
    path = write_csv(src, scratch_path(spark, f"landing-{dataset}"))
    bronze = csv.ingest_bronze(spark, path, schema, RUN_TS, RUN_DATE)
    out = scratch_path(spark, f"bronze-{dataset}")
    writers.write_bronze(bronze, out)
    return writers.read_bronze(spark, out)


@query("bronze_metadata")
def q_bronze_metadata(spark, sf_dir):
    b = _bronze_written(spark, sf_dir, "metadata")
    return b.select(*RAW_META_COLS, "encounter_id", "ingested_at", "pipeline_run_date",
                    _source_is_csv(), config.CORRUPT_COLUMN)


@query("bronze_manifest")
def q_bronze_manifest(spark, sf_dir):
    b = _bronze_written(spark, sf_dir, "dicom")
    return b.select(*[f.name for f in config.MANIFEST_RAW_SCHEMA.fields], "ingested_at", "pipeline_run_date",
                    _source_is_csv(), config.CORRUPT_COLUMN)


@query("header_harmonize")
def q_header_harmonize(spark, sf_dir):
    """Two sites, two header dialects and column orders, some rows too short
    or too long -> canonical columns, malformed rows with their text."""
    root = scratch_path(spark, "headers")
    meta, _ = load_fixtures(spark, sf_dir)
    choc = meta.where(F.col("site_location") == "CHOC").select(
        F.col("lesion_status_code"), F.col("scan_date"), F.col("ssn").alias("cerner_id"), "age", "site_location")
    rady = meta.where(~F.col("site_location").eqNullSafe(F.lit("CHOC"))).select(
        "site_location", F.col("ssn").alias("epic_id"), F.col("age").alias("age_in_years"),
        F.col("scan_date").alias("mri_date"), F.col("lesion_status_code").alias("lesion_status"))
    for name, df in (("choc", choc), ("rady", rady)):
        write_csv(df, f"{root}/{name}")
        # Per encounter divisible by 101 a row of two fields, by 103 one of six,
        # in files of their own under the same header.
        e, own = F.col("encounter_id"), F.col("site_location").eqNullSafe(F.lit("CHOC"))
        bad = meta.where(own if name == "choc" else ~own).where((e % 101 == 0) | (e % 103 == 0))
        line = F.when(e % 101 == 0, F.concat(F.lit("short,"), e.cast("string"))).otherwise(
            F.concat(F.lit("a,b,c,d,e,"), e.cast("string")))
        lines = bad.select(F.pmod(e, F.lit(16)).alias("part"), F.lit(1).alias("rank"), line.alias("value"))
        heads = spark.range(16).select(F.col("id").alias("part"), F.lit(0).alias("rank"), F.lit(",".join(df.columns)).alias("value"))
        (heads.unionByName(lines).repartition("part").sortWithinPartitions("part", "rank").drop("rank")
         .write.partitionBy("part").text(f"{root}/{name}/malformed"))
    frames = [csv.read_headed(spark, f"{root}/{s}", recursive=True) for s in ("choc", "rady")]
    return headers.harmonize_headers(frames)


# ---------------------------------------------------------------- sinks

@query("bronze_roundtrip")
def q_bronze_roundtrip(spark, sf_dir):
    meta, _ = load_fixtures(spark, sf_dir)
    from aurum.operators.clean import add_lineage
    bronze = add_lineage(meta, RUN_TS, RUN_DATE, source_file="landing/metadata/fx_metadata.csv")
    path = scratch_path(spark, "bronze-table")
    writers.write_table(bronze, path)
    return spark.read.parquet(path)


@query("bronze_partition_overwrite")
def q_bronze_partition_overwrite(spark, sf_dir):
    """Two run dates; the second is written twice (a rerun) and must hold the
    rerun's rows only, while the first date is untouched."""
    meta, _ = load_fixtures(spark, sf_dir)
    path = scratch_path(spark, "bronze-dates")
    writers.write_bronze(meta.withColumn("pipeline_run_date", F.lit("2026-06-22")), path)
    partial = meta.where(F.col("encounter_id") % 2 == 0)
    writers.write_bronze(partial.withColumn("pipeline_run_date", F.lit("2026-06-23")), path)
    writers.write_bronze(meta.withColumn("pipeline_run_date", F.lit("2026-06-23")), path)
    return writers.read_bronze(spark, path)


def _silver_site_export(spark, sf_dir) -> str:
    meta, man = load_fixtures(spark, sf_dir)
    path = scratch_path(spark, "silver-sites")
    writers.export_by_site(layers.silver_joined(meta, man), path)
    return path


@query("silver_partition_export")
def q_silver_partition_export(spark, sf_dir):
    path = _silver_site_export(spark, sf_dir)
    return spark.read.option("basePath", path).parquet(path)


@query("site_pruned_read")
def q_site_pruned_read(spark, sf_dir):
    return writers.read_site(spark, _silver_site_export(spark, sf_dir), "CHOC")


@query("silver_roundtrip")
def q_silver_roundtrip(spark, sf_dir):
    meta, man = load_fixtures(spark, sf_dir)
    path = scratch_path(spark, "silver-table")
    writers.write_table(layers.silver_joined(meta, man), path)
    return spark.read.parquet(path)


@query("gold_ml_export")
def q_gold_ml_export(spark, sf_dir):
    meta, man = load_fixtures(spark, sf_dir)
    path = scratch_path(spark, "gold-ml")
    writers.export_gold_ml(layers.gold_dataset(layers.silver_joined(meta, man)), path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- landing zone

@query("landing_scan")
def q_landing_scan(spark, sf_dir):
    """Every metadata extract under the landing prefix, however nested."""
    dirs = land_fixture(spark, sf_dir, "landing-scan")
    spark.createDataFrame([("not an extract",)], "value string").write.text(f"{dirs['metadata']}/notes")
    raw = csv.read_csv(spark, dirs["metadata"], FIXTURE_METADATA_SCHEMA, recursive=True, glob="*.csv")
    return raw.drop(config.CORRUPT_COLUMN)


@query("newest_snapshot")
def q_newest_snapshot(spark, sf_dir):
    """Three metadata snapshots land in turn, each a stamped folder of part
    files written in parallel, then an unrelated newer upload. The newest
    matching snapshot, neither the first nor the last by name, is read."""
    meta, man = load_fixtures(spark, sf_dir)
    root = scratch_path(spark, "snapshots")
    e = F.col("encounter_id")
    for tag, rows in (("a", meta.where(e % 2 == 0)), ("c", meta), ("b", meta.where(e % 2 == 1))):
        write_csv(rows, f"{root}/metadata_snapshot_{tag}_{UPLOAD_STAMP}.csv")
        time.sleep(1.1)  # modification times may be whole seconds
    write_csv(man, f"{root}/other/imaging_manifest_{UPLOAD_STAMP}.csv")
    newest = landing.newest_snapshot(spark, root, config.METADATA_NAME_TOKENS)
    return csv.read_csv(spark, newest, FIXTURE_METADATA_SCHEMA).drop(config.CORRUPT_COLUMN)


@query("landing_name_parts")
def q_landing_name_parts(spark, sf_dir):
    """Upload stamps parsed from landed names (names derived from orders;
    every seventh carries no stamp)."""
    orders = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    name = F.when(k % 7 == 0, F.concat(F.lit("extract_"), k.cast("string"), F.lit(".csv"))).otherwise(
        F.concat(F.lit("extract_"), k.cast("string"), F.lit("_"),
                 F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss'Z'"), F.lit(".csv")))
    names = orders.select(k.alias("o_orderkey"), name.alias("file_name"))
    return names.select("o_orderkey", "file_name", X.upload_base_name("file_name").alias("base_name"),
                        X.upload_time("file_name").alias("uploaded_at"))


def _submissions(spark, dirs, glob: str | None = "*.csv") -> DataFrame:
    """What the uploaders declared, by landed path."""
    listing = landing.list_files(spark, f"{dirs['root']}/raw", glob)
    kind = F.when(F.col("path").contains("/raw/dicom/"), F.lit("DICOM Imaging Manifest")) \
        .otherwise(F.lit("Clinical Metadata Extract"))
    site = F.when(F.col("file_name").startswith("choc_extract"), F.lit("CHOC")).otherwise(F.lit("Rady"))
    return listing.select("path", F.lit("Site coordinator").alias("submitter"),
                          site.alias("affiliation"), kind.alias("dataset_type"))


def _ledger(spark, dirs, glob: str | None = "*.csv") -> DataFrame:
    return landing.landing_ledger(spark, f"{dirs['root']}/raw", _submissions(spark, dirs, glob), glob=glob)


def _stored_ledger(spark, dirs, glob: str | None = "*.csv") -> DataFrame:
    """The ledger as a table: every landed file is hashed once."""
    path = f"{dirs['root']}/ledger"
    landing.append_ledger(spark, _ledger(spark, dirs, glob), path)
    return spark.read.parquet(path)


@query("landing_ledger")
def q_landing_ledger(spark, sf_dir):
    dirs = land_fixture(spark, sf_dir, "ledger")
    return _ledger(spark, dirs, glob=None).drop("source_file")


@query("landing_catalog")
def q_landing_catalog(spark, sf_dir):
    dirs = land_fixture(spark, sf_dir, "catalog")
    ledger = _ledger(spark, dirs, glob=None)
    listing = landing.list_files(spark, dirs["root"])
    cat = landing.landing_catalog(listing, ledger, root=dirs["root"])
    return cat.select(X.landed_object_name("key").alias("object_name"), "submitter", "affiliation", "size_kb")


@query("ledger_lookup")
def q_ledger_lookup(spark, sf_dir):
    """Known ids resolve to their files; an unknown id falls back to the
    default (the first metadata upload)."""
    dirs = land_fixture(spark, sf_dir, "lookup")
    ledger = _stored_ledger(spark, dirs, glob=None)
    default = ledger.where(F.col("object_prefix") == "metadata").agg(F.min("tx_id").alias("d"))
    requests = ledger.select("tx_id").unionByName(
        ledger.select(F.concat(F.lit("TX-UNKNOWN-"), F.col("tx_id")).alias("tx_id")))
    default_id = default.first()["d"]
    return ledger_lookup(requests, ledger, default_id).select(
        "requested_id", "tx_id", "found", "file_name", "affiliation")


# ---------------------------------------------------------------- streaming

@query("incremental_ingest")
def q_incremental_ingest(spark, sf_dir):
    """Landed extracts ingested by an availableNow stream, run twice (the
    second run finds nothing new)."""
    dirs = land_fixture(spark, sf_dir, "stream")
    out = scratch_path(spark, "stream-bronze")
    ckpt = scratch_path(spark, "stream-ckpt")
    for _ in range(2):
        incremental_ingest(spark, dirs["metadata"], FIXTURE_METADATA_SCHEMA, out, ckpt)
    b = writers.read_bronze(spark, out)
    return b.select(*RAW_META_COLS, "encounter_id", _source_is_csv(), config.CORRUPT_COLUMN)


# ---------------------------------------------------------------- full run and lineage

#: Key buckets that a traced run's Silver and Gold are laid out in.
TRACE_BUCKETS = 16


def _run(spark, sf_dir, name, **options):
    dirs = land_fixture(spark, sf_dir, name)
    base = f"{dirs['root']}/lake"
    metrics = run_medallion(spark, dirs["metadata"], dirs["dicom"], base, run_ts=RUN_TS, run_date=RUN_DATE,
                            metadata_schema=FIXTURE_METADATA_SCHEMA, **options)
    return dirs, base, metrics


def _run_with_ledger(spark, sf_dir, name, **options):
    dirs = land_fixture(spark, sf_dir, name)
    base = f"{dirs['root']}/lake"
    run_medallion(spark, dirs["metadata"], dirs["dicom"], base, run_ts=RUN_TS, run_date=RUN_DATE, metadata_schema=FIXTURE_METADATA_SCHEMA,
                  submissions=_submissions(spark, dirs), landing_root=f"{dirs['root']}/raw", **options)
    return dirs, base


@query("run_metrics")
def q_run_metrics(spark, sf_dir):
    _, _, metrics = _run(spark, sf_dir, "run")
    return metrics


@query("gold_two_dialects")
def q_gold_two_dialects(spark, sf_dir):
    """Gold of a run over two sites' own headers equals the single-dialect Gold."""
    meta, man = load_fixtures(spark, sf_dir)
    root = scratch_path(spark, "dialects")
    choc = F.col("site_location").eqNullSafe(F.lit("CHOC"))
    first = meta.where(choc).withColumnsRenamed({"ssn": "cerner_id"}).select(
        "lesion_status_code", "scan_date", "encounter_id", "cerner_id", "age", "ehr_system", "site_location")
    second = meta.where(~choc).withColumnsRenamed({"ssn": "epic_id", "age": "age_in_years", "scan_date": "mri_date",
                                                  "lesion_status_code": "lesion_status"})
    dialects = {write_csv(first, f"{root}/raw/choc"): {"cerner_id": "ssn"},
                write_csv(second, f"{root}/raw/rady"): {"epic_id": "ssn", "age_in_years": "age", "mri_date": "scan_date",
                                                        "lesion_status": "lesion_status_code"}}
    write_csv(man, f"{root}/raw/dicom")
    run_medallion(spark, [], f"{root}/raw/dicom", f"{root}/lake", run_ts=RUN_TS, run_date=RUN_DATE,
                  metadata_schema=FIXTURE_METADATA_SCHEMA, dialects=dialects)
    return spark.read.parquet(f"{root}/lake/gold_research")


@query("registered_gold")
def q_registered_gold(spark, sf_dir):
    """A run that registers its outputs as tables of a namespace: Gold, read by
    its table's name."""
    namespace = f"aurum_{uuid.uuid4().hex[:12]}"
    _run(spark, sf_dir, "registered", namespace=namespace)
    return spark.table(f"{namespace}.gold_research")


@query("run_ledger")
def q_run_ledger(spark, sf_dir):
    """The ledger that a run leaves of the uploads it was given."""
    _, base = _run_with_ledger(spark, sf_dir, "run-ledger")
    return spark.read.parquet(f"{base}/landing_ledger").drop("source_file")


@query("newest_run_metrics")
def q_newest_run_metrics(spark, sf_dir):
    """A run over the newest snapshots of a landing zone that also holds older
    ones (half of the rows, landed first)."""
    meta, man = load_fixtures(spark, sf_dir)
    root = scratch_path(spark, "newest-run")
    for stamp, part in (("20260101T000000Z", True), (UPLOAD_STAMP, False)):
        old = lambda key: F.pmod(F.xxhash64(key), F.lit(2)) == 0 if part else F.lit(True)
        write_csv(meta.where(old("encounter_id")), f"{root}/raw/metadata/metadata_extract_{stamp}.csv")
        write_csv(man.where(old("dicom_s3_uri")), f"{root}/raw/dicom/dicom_manifest_{stamp}.csv")
        time.sleep(1.1)  # landing times are told apart by the second
    return run_medallion(spark, f"{root}/raw/metadata", f"{root}/raw/dicom", f"{root}/lake", run_ts=RUN_TS, run_date=RUN_DATE,
                         metadata_schema=FIXTURE_METADATA_SCHEMA, newest=True)


@query("lineage_trace")
def q_lineage_trace(spark, sf_dir):
    """Trace the first CHOC upload's confirmation id through every layer: the
    run's own ledger, and Silver and Gold laid out by key buckets."""
    _, base = _run_with_ledger(spark, sf_dir, "lineage", trace_buckets=TRACE_BUCKETS)
    ledger = spark.read.parquet(f"{base}/landing_ledger")
    tx_id = ledger.where(F.col("file_name").startswith("choc_extract_0000_")).first()["tx_id"]
    bronze = writers.read_bronze(spark, f"{base}/bronze_metadata")
    silver = spark.read.parquet(f"{base}/silver").drop("site_key")
    gold = spark.read.parquet(f"{base}/gold_research")
    traced = lineage_trace(tx_id, ledger, bronze, silver, gold, trace_buckets=TRACE_BUCKETS)
    # The payload's values, as text, in one digest per stage's own fields.
    fields = {"landed": [config.HEADER_RENAMES.get(c, c) for c in META_COLS], "bronze": META_COLS,
              "silver": ["ssn", "age", "site_location", "scan_date", "lesion_label", "imaging_s3_uri"],
              "gold": ["subject_surrogate_id", "age", "site_location", "enrollment_year", "lesion_label", "imaging_s3_uri"]}
    digest = F.lit(None).cast("string")
    for stage, names in fields.items():
        values = F.concat_ws("|", *[F.get_json_object("payload", f"$.{c}") for c in names])
        digest = F.when(F.col("stage") == stage, F.md5(values)).otherwise(digest)
    return traced.select("stage", "record_key", digest.alias("payload_md5"))


@query("output_locations")
def q_output_locations(spark, sf_dir):
    """Report of written outputs (layer, name, partitions, rows) read back
    from the data itself."""
    meta, man = load_fixtures(spark, sf_dir)
    root = scratch_path(spark, "outputs")
    from aurum.operators.clean import add_lineage
    writers.write_bronze(add_lineage(meta, RUN_TS, RUN_DATE, "x.csv"), f"{root}/bronze_metadata")
    silver = layers.silver_joined(meta, man)
    writers.export_by_site(silver, f"{root}/silver")
    writers.write_table(layers.gold_dataset(silver), f"{root}/gold_research")
    report = writers.output_locations(spark, [("bronze", "metadata", f"{root}/bronze_metadata"),
                                              ("silver", "clinical_imaging_joined", f"{root}/silver"),
                                              ("gold", "research_dataset", f"{root}/gold_research")])
    return report.select("layer", "name", F.substring_index("uri", "/", -1).alias("folder"), "partition", "rows",
                         (F.col("bytes") > 0).alias("has_bytes"))


@query("cohort_summary_export")
def q_cohort_summary_export(spark, sf_dir):
    """The cohort summary written as a table and read back."""
    meta, man = load_fixtures(spark, sf_dir)
    path = scratch_path(spark, "cohort-summary")
    writers.write_table(stats.cohort_summary(layers.gold_dataset(layers.silver_joined(meta, man))), path)
    return spark.read.parquet(path)


@query("required_columns")
def q_required_columns(spark, sf_dir):
    """A complete Silver dataset passes; one without a required column is refused."""
    meta, man = load_fixtures(spark, sf_dir)
    silver = layers.silver_joined(meta, man)
    require_columns(silver, ["ssn", "site_location"], "Silver dataset")
    try:
        require_columns(silver.drop("site_location"), ["ssn", "site_location"], "Silver dataset")
        error = "none"
    except ValueError as e:
        error = "required columns missing from Silver dataset" if "site_location" in str(e) else str(e)
    return silver.agg(F.count(F.lit(1)).alias("rows"), F.lit(error).alias("error"))


@query("synth_run_metrics")
def q_synth_run_metrics(spark, sf_dir):
    """Generate extracts for every customer, land them, run all layers."""
    from aurum.sources.synthetic import write_synthetic_extracts
    root = scratch_path(spark, "synth-run")
    dirs = write_synthetic_extracts(read_table(spark, sf_dir, "customer"), f"{root}/raw")
    return run_medallion(spark, dirs["metadata"], dirs["dicom"], f"{root}/lake", run_ts=RUN_TS,
                         run_date=RUN_DATE, tiebreakers=())


def _increments(spark, sf_dir):
    """Silver metadata in two increments: even orders, then odd ones."""
    meta, _ = load_fixtures(spark, sf_dir)
    silver = layers.silver_metadata(meta)
    even = F.col("encounter_id") % 2 == 0
    return silver.where(even), silver.where(~even)


@query("dedup_incremental")
def q_dedup_incremental(spark, sf_dir):
    """Keep-latest applied in two increments to a log of deltas, one of them
    folded into the base; must equal the one-shot dedup over all rows."""
    from aurum.plans import latest_log
    state = scratch_path(spark, "latest-log")
    for i, part in enumerate(_increments(spark, sf_dir)):
        latest_log.append(spark, part, state, f"part-{i}", tiebreakers=["encounter_id"])
    latest_log.compact(spark, state)
    return latest_log.read(spark, state)


@query("dedup_bucketed")
def q_dedup_bucketed(spark, sf_dir):
    """The same increments applied to a state laid out in key buckets, of which
    the touched ones are rewritten."""
    from aurum.plans import incremental
    state = scratch_path(spark, "latest-state")
    for part in _increments(spark, sf_dir):
        incremental.upsert_latest(spark, part, state, tiebreakers=["encounter_id"], buckets=64)
    return incremental.read_latest(spark, state)


@query("gold_incremental")
def q_gold_incremental(spark, sf_dir):
    """Gold built by two increments (even, then odd encounters, each with the
    imaging records of its customers' halves); must equal the full Gold."""
    from aurum.plans import incremental
    meta, man = load_fixtures(spark, sf_dir)
    base = scratch_path(spark, "incremental")
    cust = F.element_at(F.split("ssn", "-"), 3).cast("bigint")
    for half in (0, 1):
        incremental.apply_increment(spark, meta.where(F.col("encounter_id") % 2 == half),
                                    man.where(cust % 2 == half), base, increment_id=f"inc-{half}", buckets=64)
    return spark.read.parquet(f"{base}/gold_research").drop(incremental.BUCKET_COLUMN)


@query("gold_streaming")
def q_gold_streaming(spark, sf_dir):
    """Gold kept current by Structured Streaming over the landing zone: each
    micro-batch (one landed file per trigger) is applied as an increment."""
    from aurum.plans.incremental import BUCKET_COLUMN
    from aurum.streaming.incremental import stream_increments
    dirs = land_fixture(spark, sf_dir, "streaming")
    base = scratch_path(spark, "streaming-lake")
    stream_increments(spark, dirs["metadata"], dirs["dicom"], base, scratch_path(spark, "streaming-ckpt"),
                      FIXTURE_METADATA_SCHEMA, config.MANIFEST_RAW_SCHEMA, buckets=64, max_files_per_trigger=1)
    return spark.read.parquet(f"{base}/gold_research").drop(BUCKET_COLUMN)
