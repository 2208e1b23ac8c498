"""End-to-end medallion run: CSV landing -> Bronze -> Silver -> Gold.

Each layer is written once and the next layer reads the written table, which
cuts lineage on shared storage (a lost executor costs at most the current
layer) and replaces the repeated re-reads of the CSV. Row counts come from
``Observation``s attached to the writes instead of separate ``count()`` jobs.

Jobs per run: 2 Bronze writes, 1 Silver write, 2 counts of ids (for the
reconciliation), 1 Gold write, 1 ML export, 3 small summary writes, 1 metrics
write. Independent jobs (the two Bronze tables; a write and a count; the Gold
exports and summaries) are submitted together so the scheduler overlaps them.
"""

from __future__ import annotations

import datetime as _dt
import logging
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from aurum import config
from aurum.functions.expressions import site_partition_key
from aurum.operators import join, stats
from aurum.plans import layers
from aurum.plans.lineage import TRACE_BUCKET, trace_bucket
from aurum.session import child_names, delete_path
from aurum.sinks import commits, writers
from aurum.sources import csv, landing

log = logging.getLogger("aurum.run")

#: What a run writes below its base folder, by the tables' names.
OUTPUTS = ("bronze_metadata", "bronze_manifest", "silver", "gold_research", "gold_ml_export", "gold_cohort_summary",
           "gold_label_distribution", "gold_age_distribution", "run_metrics")
#: Outputs that runs add to, by date, file or run; the others hold one run.
ACCUMULATED = ("bronze_metadata", "bronze_manifest", "landing_ledger", "run_metrics")
#: Commits that name the published run.
PUBLISHED = "_published"


@dataclass(frozen=True)
class RunLayout:
    """Where each output of a run lives: all under one base folder, or, for a
    published run, what belongs to one run only under a folder of its own."""

    base: str
    own: str | None = None

    def __getattr__(self, name: str) -> str:  # e.g. layout.bronze_metadata
        if name.startswith("_"):
            raise AttributeError(name)
        base = self.base if self.own is None or name in ACCUMULATED else self.own
        return f"{base.rstrip('/')}/{name}"


def published(spark: SparkSession, base: str) -> RunLayout | None:
    """The outputs of the last run published below ``base``: Silver, Gold and
    exports of one run, whatever a later run has begun. None before the first."""
    state = commits.newest(spark, f"{base.rstrip('/')}/{PUBLISHED}")[1]
    return RunLayout(base, f"{base.rstrip('/')}/{state['run']}") if state else None


def remove_superseded(spark: SparkSession, base: str) -> int:
    """Delete the folders of runs other than the published one; returns how
    many. Only when no run is being written and no reader is left on an old one."""
    root, layout = base.rstrip("/"), published(spark, base)
    gone = [n for n in child_names(spark, f"{root}/runs") if layout is None or layout.own != f"{root}/runs/{n}"]
    for n in gone:
        delete_path(spark, f"{root}/runs/{n}")
    return len(gone)


def run_medallion(spark: SparkSession, metadata_path: str | list[str], manifest_path: str | list[str],
                  base: str, run_ts: str | None = None, run_date: str | None = None,
                  metadata_schema: StructType = config.METADATA_RAW_SCHEMA,
                  manifest_schema: StructType = config.MANIFEST_RAW_SCHEMA,
                  tiebreakers: Sequence[str] = ("encounter_id",), salt: str | None = None,
                  fmt: str = "parquet", site_spread: int | None = None, on_empty: str = "warn",
                  dialects: Mapping[str, Mapping[str, str]] | None = None, defaults: Mapping[str, object] | None = None,
                  namespace: str | None = None, newest: bool = False, submissions: DataFrame | None = None,
                  landing_root: str | None = None, trace_buckets: int | None = None, publish: bool = False) -> DataFrame:
    """Run all layers and return the one-row metrics table (also written; a
    repeated ``run_ts`` replaces its row).

    Bronze keeps every run date; Silver, Gold and the exports hold this run's
    date only, as the reference's overwrite does. Land all extracts again, or
    use ``plans.incremental``, for tables over several dates.

    ``dialects`` reads the metadata of sites whose headers differ, instead of
    ``metadata_path``: per landing folder the map from its headers to the
    schema's column names. Malformed rows are captured in each. ``defaults``
    gives the value of a column that a site's extracts lack.

    ``newest`` reads only the newest landed snapshot below each of the two
    paths instead of all extracts there.

    ``submissions`` (see ``landing.landing_ledger``) records the uploads below
    ``landing_root`` in the run's ledger, ``landing_ledger``; files already in
    it are not hashed again.

    ``namespace`` registers every output as a table there (created if missing).

    ``publish`` writes Silver, Gold and the exports to a folder of this run and
    makes them current by one commit at the end (``published``): no reader sees
    Silver of one run beside Gold of another, and a run that stops leaves the
    published set as it was. Registered tables then point to the new set.

    ``trace_buckets`` lays Silver and Gold out by that many buckets of their
    keys besides, with Bloom filters, so that ``lineage_trace`` reads only the
    buckets of the keys it follows (``read_layer`` hides the bucket column).

    ``site_spread`` bounds Silver files per site (see ``writers.write_table``).
    ``on_empty`` is the zero-row policy for the Bronze ingest: ``"warn"`` or
    ``"fail"`` (raise after the run's counts are known).
    """
    now = _dt.datetime.now(_dt.timezone.utc)
    run_ts = run_ts or now.strftime(config.RUN_TS_FORMAT)
    run_date = run_date or now.strftime(config.RUN_DATE_FORMAT)
    run = f"runs/{re.sub('[^A-Za-z0-9]', '', run_ts)}-{uuid.uuid4().hex[:12]}"
    out = RunLayout(base, f"{base.rstrip('/')}/{run}") if publish else RunLayout(base)
    before = commits.newest(spark, f"{base.rstrip('/')}/{PUBLISHED}")[0] if publish else None
    if submissions is not None and landing_root is None:
        raise ValueError("submissions need the landing_root that holds their files")
    if newest:
        metadata_path = _newest(spark, metadata_path, config.METADATA_NAME_TOKENS)
        manifest_path = _newest(spark, manifest_path, config.MANIFEST_NAME_TOKENS)

    # Bronze: full-width read (corrupt rows captured), lineage, partitioned by run date.
    obs_bm, m = csv.ingest_observation("bronze_metadata")
    # Landing prefixes hold one folder or file per upload: read them recursively.
    if dialects:
        bm = csv.ingest_dialects(spark, dialects, metadata_schema, run_ts, run_date, defaults, recursive=True, glob="*.csv")
    else:
        bm = csv.ingest_bronze(spark, metadata_path, metadata_schema, run_ts, run_date, recursive=True, glob="*.csv")
    bm = bm.observe(obs_bm, *m)
    obs_bd, m = csv.ingest_observation("bronze_manifest")
    bd = csv.ingest_bronze(spark, manifest_path, manifest_schema, run_ts, run_date,
                           recursive=True, glob="*.csv").observe(obs_bd, *m)
    # The two Bronze writes and the ledger are independent jobs: submit them together.
    ledger = [] if submissions is None else [lambda: landing.append_new_uploads(spark, landing_root, submissions, out.landing_ledger, fmt)]
    _concurrently(lambda: writers.write_bronze(bm, out.bronze_metadata, fmt),
                  lambda: writers.write_bronze(bd, out.bronze_manifest, fmt), *ledger)

    # Silver reads this run's Bronze partition only (partition pruning).
    meta_b = csv.good_rows(writers.read_bronze(spark, out.bronze_metadata, fmt, bm.schema)
                           .where(F.col("pipeline_run_date") == run_date))
    man_b = csv.good_rows(writers.read_bronze(spark, out.bronze_manifest, fmt, bd.schema)
                          .where(F.col("pipeline_run_date") == run_date))
    # Cleaning stats ride along the Silver write as Observations (no extra job).
    obs_meta = Observation("silver_metadata")
    lab = F.col("lesion_label")
    meta_stats = [F.count(F.lit(1)).alias("rows"),
                  F.count_if(lab == config.LABEL_POSITIVE).alias("lesion"),
                  F.count_if(lab == config.LABEL_NEGATIVE).alias("no_lesion"),
                  F.count_if(lab == config.LABEL_PENDING).alias("pending"),
                  F.count_if(F.col("lesion_code_requires_review")).alias("review")]
    meta_clean = layers.silver_metadata(meta_b).observe(obs_meta, *meta_stats)
    obs_man = Observation("silver_manifest")
    man_stats = [F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("uri_format_valid")).alias("invalid_uri")]
    man_clean = layers.silver_manifest(man_b).observe(obs_man, *man_stats)
    obs_latest = Observation("silver_latest")
    latest = layers.silver_latest(meta_clean, tiebreakers).observe(obs_latest, F.count("ssn").alias("ids"))
    # Salted: a patient with very many scans is split. The sketch of the keys
    # reads the manifest without the Observation.
    silver = join.salted_join_manifest(latest, man_clean, counted=layers.silver_manifest(man_b))
    obs_s = Observation("silver")
    silver = silver.withColumn("site_key", site_partition_key("site_location")).observe(
        obs_s, F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("site_location").isNull()).alias("rows_without_site"))
    # The Silver table is partitioned by site (NULL sites land in the default
    # partition and are excluded from site reads by partition pruning).
    # The join is reconciled from counts: the ids of the manifest, counted
    # while Silver is written, and those that joined, read back from Silver.
    found: dict = {}
    by_key = [TRACE_BUCKET] if trace_buckets else []
    if trace_buckets:
        silver = silver.withColumn(TRACE_BUCKET, trace_bucket("ssn", trace_buckets))
    _concurrently(lambda: writers.write_table(silver, out.silver, fmt, partition_by=["site_key", *by_key], dynamic=False,
                                              spread=site_spread, bloom=["ssn"] if by_key else ()),
                  lambda: found.update(manifest_ids=layers.silver_manifest(man_b).agg(F.count_distinct("ssn")).first()[0]))

    # Gold from the written Silver table.
    silver_r = spark.read.format(fmt).schema(silver.schema).load(out.silver).drop("site_key", *by_key)
    gold = layers.gold_dataset(silver_r, salt=salt, extra_drop=tiebreakers)
    obs_g = Observation("gold")
    gold = gold.observe(obs_g, F.count(F.lit(1)).alias("rows"),
                        F.count_if(F.col("lesion_code_requires_review")).alias("flagged"))
    kept = gold.withColumn(TRACE_BUCKET, trace_bucket("subject_surrogate_id", trace_buckets)) if trace_buckets else gold
    _concurrently(lambda: writers.write_table(kept, out.gold_research, fmt, partition_by=by_key, dynamic=False,
                                              bloom=["subject_surrogate_id"] if by_key else ()),
                  lambda: found.update(matched=silver_r.agg(F.count_distinct("ssn")).first()[0]))
    gold_r = spark.read.format(fmt).schema(kept.schema).load(out.gold_research).drop(*by_key)
    # Exports, summaries and the PHI audit read the written Gold table
    # independently.
    audit: dict = {}
    _concurrently(
        lambda: audit.update(row=stats.phi_audit(gold_r).agg(
            F.coalesce(F.sum("identifier_values"), F.lit(0)).alias("n")).first()),
        lambda: writers.export_gold_ml(gold_r, out.gold_ml_export, fmt=fmt),
        lambda: writers.write_table(stats.cohort_summary(gold_r), out.gold_cohort_summary, fmt),
        lambda: writers.write_table(stats.label_distribution(gold_r), out.gold_label_distribution, fmt),
        lambda: writers.write_table(stats.age_distribution(gold_r), out.gold_age_distribution, fmt),
    )

    bmv, bdv, sv, gv = obs_bm.get, obs_bd.get, obs_s.get, obs_g.get
    mv = _observed(obs_meta, lambda: layers.silver_metadata(meta_b).agg(*meta_stats))
    dv = _observed(obs_man, lambda: layers.silver_manifest(man_b).agg(*man_stats))
    lv = _observed(obs_latest, lambda: layers.silver_metadata(meta_b).agg(F.count_distinct("ssn").alias("ids")))
    recon = join.reconciliation(int(lv["ids"]), int(found["manifest_ids"]), int(sv["rows"]), int(found["matched"]))
    row = {
        "run_timestamp": run_ts,
        "pipeline_run_date": run_date,
        "bronze_metadata_rows": int(bmv["rows"]),
        "bronze_metadata_corrupt_rows": int(bmv["corrupt_rows"]),
        "bronze_manifest_rows": int(bdv["rows"]),
        "bronze_manifest_corrupt_rows": int(bdv["corrupt_rows"]),
        "silver_metadata_rows": int(mv["rows"]),
        "lesion_detected": int(mv["lesion"]),
        "no_lesion_detected": int(mv["no_lesion"]),
        "pending_review": int(mv["pending"]),
        "review_flagged": int(mv["review"]),
        "dedup_dropped": int(mv["rows"]) - int(recon["metadata_ids"]),
        "silver_manifest_rows": int(dv["rows"]),
        "manifest_invalid_uri_rows": int(dv["invalid_uri"]),
        "silver_joined_rows": int(sv["rows"]),
        "silver_rows_without_site": int(sv["rows_without_site"]),
        "metadata_ids": int(recon["metadata_ids"]),
        "manifest_ids": int(recon["manifest_ids"]),
        "silver_unmatched_count": int(recon["unmatched_min_formula"]),
        "metadata_only_ids": int(recon["metadata_only_ids"]),
        "manifest_only_ids": int(recon["manifest_only_ids"]),
        "gold_rows": int(gv["rows"]),
        "gold_flagged_for_review": int(gv["flagged"]),
        "gold_identifier_values": int(audit["row"]["n"]),
    }
    _report(row, on_empty)
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) else 'bigint'}" for k, v in row.items())
    metrics = spark.createDataFrame([tuple(row.values())], schema)
    # One partition per run: a repeated run replaces its row.
    writers.write_table(metrics.coalesce(1), out.run_metrics, fmt, partition_by=["run_timestamp"])
    if publish:
        commits.commit(spark, f"{base.rstrip('/')}/{PUBLISHED}", before + 1, {"run": run, "run_timestamp": run_ts, "pipeline_run_date": run_date})
    if namespace:
        writers.create_namespace(spark, namespace)
        for name in OUTPUTS + (("landing_ledger",) if submissions is not None else ()):
            writers.register_table(spark, namespace, name, getattr(out, name), fmt)
    back = spark.read.format(fmt).schema(metrics.schema).load(out.run_metrics)
    return back.where(F.col("run_timestamp") == run_ts).select(*metrics.columns)


def read_layer(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A layer that a run wrote, without the columns of its layout."""
    return spark.read.format(fmt).load(path).drop("site_key", TRACE_BUCKET)


def _newest(spark: SparkSession, root: str | list[str], tokens: Sequence[str]) -> str | list[str]:
    """The newest landed snapshot below ``root``; ``root`` itself if it holds none."""
    if not isinstance(root, str):
        raise ValueError("the newest snapshot is looked for below one folder")
    return landing.newest_snapshot(spark, root, tokens) or root


def _concurrently(*jobs) -> None:
    """Run independent Spark actions from threads so the scheduler can
    overlap them (small jobs rarely fill a cluster); re-raise the first error."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target

    # Threads that inherit the caller's job group and local properties.
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        for f in [pool.submit(inheritable_thread_target(j)) for j in jobs]:
            f.result()


def _observed(obs: Observation, fallback) -> dict:
    """An Observation's metrics, or the same aggregate computed directly when
    its node never ran (AQE can skip an operand of a join whose other side
    turned out empty; only then is the extra job paid)."""
    try:
        return obs.get
    except Exception:  # noqa: BLE001  (empty metrics row: the node did not execute)
        return fallback().first().asDict()


def _report(m: dict, on_empty: str) -> None:
    """Log the run's counts; warn on corrupt rows, unmatched ids and bad URIs;
    apply the zero-row policy."""
    log.info("run %s: bronze metadata=%d manifest=%d, silver joined=%d, gold=%d (flagged %d)",
             m["run_timestamp"], m["bronze_metadata_rows"], m["bronze_manifest_rows"],
             m["silver_joined_rows"], m["gold_rows"], m["gold_flagged_for_review"])
    for name in ("bronze_metadata_corrupt_rows", "bronze_manifest_corrupt_rows"):
        if m[name]:
            log.warning("%s: %d malformed rows kept in Bronze with their raw text", name, m[name])
    if m["metadata_only_ids"] or m["manifest_only_ids"]:
        log.warning("join: %d metadata ids without imaging, %d imaging ids without metadata",
                    m["metadata_only_ids"], m["manifest_only_ids"])
    if m["gold_identifier_values"]:
        log.warning("gold: %d values match the identifier pattern (e.g. keys inside imaging URIs); "
                    "consider gold_research(pointer_base=...)", m["gold_identifier_values"])
    if m["manifest_invalid_uri_rows"]:
        log.warning("manifest: %d rows with a non-standard URI scheme", m["manifest_invalid_uri_rows"])
    empty = [k for k in ("bronze_metadata_rows", "bronze_manifest_rows") if m[k] == 0]
    if empty:
        if on_empty == "fail":
            raise RuntimeError(f"zero rows ingested: {empty}")
        log.warning("zero rows ingested: %s", empty)


def main(argv: list[str] | None = None) -> None:
    """``python -m aurum.plans.run --metadata <dir> --manifest <dir> --out <dir>``

    Runs every layer on the cluster the session is configured for (e.g. via
    ``spark-submit``) and prints the run's metrics row as JSON.
    """
    import argparse
    import json

    p = argparse.ArgumentParser(description="Run Bronze -> Silver -> Gold on landed extracts.")
    p.add_argument("--metadata", required=True, help="landing folder of metadata extracts (CSV)")
    p.add_argument("--manifest", required=True, help="landing folder of imaging manifests (CSV)")
    p.add_argument("--out", required=True, help="base folder for all layer tables")
    p.add_argument("--run-date", default=None)
    p.add_argument("--salt", default=None, help="secret salt for surrogate keys")
    p.add_argument("--format", default="parquet")
    p.add_argument("--site-spread", type=int, default=None)
    p.add_argument("--tiebreaker", action="append", default=None,
                   help="dedup tiebreaker column (repeatable); must be in the extract schema")
    a = p.parse_args(argv)

    spark = SparkSession.builder.appName("aurum-medallion").config("spark.ui.enabled", "false").getOrCreate()
    schema = config.METADATA_RAW_SCHEMA
    if a.tiebreaker:
        from pyspark.sql.types import StringType, StructField
        schema = StructType(list(schema.fields) + [StructField(t, StringType(), True)
                                                   for t in a.tiebreaker if t not in schema.fieldNames()])
    metrics = run_medallion(spark, a.metadata, a.manifest, a.out, run_date=a.run_date, salt=a.salt,
                            fmt=a.format, site_spread=a.site_spread, metadata_schema=schema,
                            tiebreakers=tuple(a.tiebreaker or ()))
    print(json.dumps(metrics.first().asDict()))


if __name__ == "__main__":
    main()
