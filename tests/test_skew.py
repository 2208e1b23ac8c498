"""Hot keys: one patient holds a third of all metadata and manifest rows, one
site holds most rows. Results must stay whole and exact (brute force)."""

from __future__ import annotations

import datetime as dt
import re
from collections import Counter

from pyspark.sql import functions as F

from aurum.operators import dedup, join, stats
from aurum.plans import layers
from aurum.sinks import writers
from aurum.session import scratch_path


def _skewed(spark, n=3000):
    meta, man = [], []
    for i in range(n):
        ssn = "999-10-000001" if i % 3 == 0 else f"999-11-{i:06d}"
        meta.append((ssn, str(5 + i % 14), "CHOC" if i % 5 else "Rady", "Cerner", ["1", "NA", "x"][i % 3],
                     (dt.date(2026, 1, 1) + dt.timedelta(days=i % 300)).isoformat(), i))
    for i in range(n // 2):
        ssn = "999-10-000001" if i % 3 == 0 else f"999-11-{2 * i:06d}"
        man.append((ssn, f"s3://b/{i}.dcm", "MRI", "Brain"))
    m = spark.createDataFrame(meta, "ssn string, age string, site_location string, ehr_system string, "
                                    "lesion_status_code string, scan_date string, encounter_id long")
    d = spark.createDataFrame(man, "ssn string, dicom_s3_uri string, modality string, body_region string")
    return meta, man, m.repartition(7), d.repartition(5)


def test_hot_patient_dedup_and_join_exact(spark):
    meta, man, m, d = _skewed(spark)
    out = layers.silver_joined(m, d)
    # Brute force: latest (date, encounter) per patient, then fan-out over scans.
    latest = {}
    for ssn, _, _, _, _, date, enc in meta:
        if ssn not in latest or (date, enc) > latest[ssn]:
            latest[ssn] = (date, enc)
    scans = Counter(s for s, *_ in man)
    expected = Counter()
    for ssn, (date, enc) in latest.items():
        if scans[ssn]:
            expected[(ssn, enc)] += scans[ssn]
    got = Counter((r["ssn"], r["encounter_id"]) for r in out.collect())
    assert got == expected
    hot = "999-10-000001"
    assert got[(hot, latest[hot][1])] == scans[hot] == len(man) // 3


def test_hot_patient_reconcile(spark):
    meta, man, m, d = _skewed(spark)
    r = join.reconcile_join(layers.silver_metadata(m), layers.silver_manifest(d),
                            metadata_deduplicated=True).first()
    m_ids = {x[0] for x in meta}
    d_ids = {x[0] for x in man}
    assert (r["metadata_ids"], r["manifest_ids"]) == (len(m_ids), len(d_ids))
    assert r["joined_rows"] == sum(1 for s, *_ in man if s in m_ids)
    assert (r["metadata_only_ids"], r["manifest_only_ids"]) == (len(m_ids - d_ids), len(d_ids - m_ids))
    # Same answer as reconciling the deduplicated side directly.
    r2 = join.reconcile_join(layers.silver_latest(layers.silver_metadata(m)), layers.silver_manifest(d)).first()
    assert r.asDict() == r2.asDict()


def test_hot_site_ordinal_and_spread_export(spark):
    meta, _, m, _ = _skewed(spark)
    numbered = dedup.ordinal_within(m, order_cols=["encounter_id"], group_cols=["site_location"],
                                    name="o", num_partitions=12)
    per_site = Counter(x[2] for x in meta)
    got = {}
    for r in numbered.collect():
        got.setdefault(r["site_location"], []).append(r["o"])
    assert {s: sorted(v) for s, v in got.items()} == {s: list(range(c)) for s, c in per_site.items()}

    path = scratch_path(spark, "t-spread")
    writers.export_by_site(m, path, spread=4)
    back = spark.read.parquet(path)
    assert back.count() == len(meta)
    files = back.select(F.input_file_name().alias("f"), "site_key").distinct() \
        .groupBy("site_key").count().collect()
    assert all(r["count"] <= 4 for r in files)


def test_hot_site_aggregates_exact(spark):
    meta, _, m, _ = _skewed(spark)
    s = layers.silver_metadata(m)
    rows = {r["site_location"]: r for r in stats.age_distribution(s).collect()}
    for site in ("CHOC", "RADY"):
        ages = [int(x[1]) for x in meta if x[2].upper() == site]
        assert rows[site]["n"] == len(ages)
        assert abs(rows[site]["mean_age"] - sum(ages) / len(ages)) < 1e-6


def test_hot_patient_is_split_in_the_join(spark):
    """A third of the manifest on one patient, no broadcast: adaptive execution
    splits the hot key, and no task reads far more than the others."""
    n = 60_000
    meta = spark.range(n // 10).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("P"), F.col("id").cast("string"))).alias("ssn"),
        F.lit("7").alias("age"), F.lit("CHOC").alias("site_location"), F.lit("Cerner").alias("ehr_system"),
        F.lit("1").alias("lesion_status_code"), F.lit("2026-01-01").alias("scan_date"), F.col("id").alias("encounter_id"))
    man = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("P"), (F.col("id") % 6000).cast("string"))).alias("ssn"),
        F.concat(F.lit("s3://b/"), F.sha2(F.col("id").cast("string"), 512)).alias("dicom_s3_uri"), F.lit("MRI").alias("modality"),
        F.lit("Brain").alias("body_region"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = layers.silver_joined(meta, man.repartition(9)).withColumn("task", F.spark_partition_id())
        sizes = out.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.max("imaging_s3_uri"))  # whole rows are joined
        per_task = [r["n"] for r in sizes.collect()]
        joined = layers.silver_joined(meta, man.repartition(9))
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan, plan
    assert max(per_task) < n // 3 / 2


def test_salted_join_splits_a_heavy_key_without_adaptive_execution(spark):
    """The sketch alone spreads a patient of a third of all scans, and the
    result is the plain join's."""
    n = 30_000
    latest = spark.range(1000).select(F.when(F.col("id") == 0, F.lit("HOT")).otherwise(F.concat(F.lit("P"), F.col("id").cast("string"))).alias("ssn"),
                                      F.col("id").alias("encounter_id"))
    man = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 997 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("P"), (F.col("id") % 2000).cast("string"))).alias("ssn"),
        F.concat(F.lit("s3://b/"), F.col("id").cast("string")).alias("dicom_s3_uri"), F.lit("MRI").alias("modality"),
        F.lit("Brain").alias("body_region"), F.lit(True).alias("uri_format_valid"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = join.salted_join_manifest(latest, man, rows_per_split=100)
        sizes = out.groupBy(F.spark_partition_id()).count().collect()
        plain = join.join_manifest(latest, man)
        assert out.exceptAll(plain).isEmpty() and plain.exceptAll(out).isEmpty()
        assert out.columns == plain.columns
        copies = spark.range(1).select(join.key_copies(man, rows_per_split=100).alias("c")).first()["c"]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert max(r["count"] for r in sizes) < n // 3 / 2
    assert len(copies) == join.SKETCH_SLOTS and max(copies) in (100, 101) and sum(c > 1 for c in copies) == 1


def test_silver_joined_is_planned_without_a_job_and_prunes_columns(spark):
    _, _, m, d = _skewed(spark)
    m_path, d_path = scratch_path(spark, "t-lazy-meta"), scratch_path(spark, "t-lazy-man")
    m.write.parquet(m_path)
    d.write.parquet(d_path)
    meta, man = spark.read.schema(m.schema).parquet(m_path), spark.read.schema(d.schema).parquet(d_path)
    spark.sparkContext.setJobGroup("t-lazy", "t-lazy")
    try:
        summary = stats.label_distribution(layers.gold_dataset(layers.silver_joined(meta, man)))
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("t-lazy")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = summary._jdf.queryExecution().executedPlan().toString()
    scanned = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan))
    assert scanned and not any("ehr_system" in s or "modality" in s for s in scanned), scanned
