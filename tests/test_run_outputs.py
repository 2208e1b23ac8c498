"""What a run leaves besides its layers: registered tables, its ledger, the
newest snapshot, defaults, and a layout by which a trace reads few files."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from aurum.functions.expressions import surrogate_key
from aurum.plans import files
from aurum.plans.lineage import TRACE_BUCKET, lineage_trace
from aurum.plans.run import OUTPUTS, read_layer, run_medallion
from aurum.session import scratch_path
from aurum.sinks import writers

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def traced(spark):
    """A run laid out for tracing, with its ledger and registered tables."""
    return files._run_with_ledger(spark, SF_SMALL, "t-traced", trace_buckets=32, namespace="aurum_t_traced")


def test_every_output_is_a_table(spark, traced):
    _, base = traced
    names = {t.name for t in spark.catalog.listTables("aurum_t_traced")}
    assert names == {*OUTPUTS, "landing_ledger"}
    for name in names:
        assert spark.table(f"aurum_t_traced.{name}").count() == spark.read.parquet(f"{base}/{name}").count() > 0
    # Registering again replaces the table and touches no data.
    writers.register_table(spark, "aurum_t_traced", "silver", f"{base}/silver")
    assert spark.table("aurum_t_traced.silver").count() == spark.read.parquet(f"{base}/silver").count()


def test_layers_are_the_same_without_the_layout(spark, traced):
    dirs, base = traced
    plain = f"{dirs['root']}/plain"
    run_medallion(spark, dirs["metadata"], dirs["dicom"], plain, run_ts=files.RUN_TS, run_date=files.RUN_DATE,
                  metadata_schema=files.FIXTURE_METADATA_SCHEMA)
    for name in ("silver", "gold_research"):
        a, b = read_layer(spark, f"{base}/{name}"), read_layer(spark, f"{plain}/{name}")
        assert a.columns == b.columns and TRACE_BUCKET not in a.columns
        a, b = (x.drop("ingested_at") for x in (a, b))
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_ledger_of_a_run_records_new_files_only(spark, traced):
    dirs, base = traced
    ledger = spark.read.parquet(f"{base}/landing_ledger")
    assert {r["source_file"] for r in ledger.collect()} == {r["source_file"] for r in files._ledger(spark, dirs).collect()}
    files.landing.append_new_uploads(spark, f"{dirs['root']}/raw", files._submissions(spark, dirs), f"{base}/landing_ledger")
    assert spark.read.parquet(f"{base}/landing_ledger").count() == ledger.count()


def test_submissions_need_their_folder(spark, traced):
    dirs, _ = traced
    with pytest.raises(ValueError, match="landing_root"):
        run_medallion(spark, dirs["metadata"], dirs["dicom"], "unused", submissions=files._submissions(spark, dirs))


def _bare(path: str) -> str:
    return re.sub("^file:/+", "/", path)


def test_a_trace_reads_only_the_buckets_of_its_keys(spark, traced):
    """One patient's upload: the scans of Silver and Gold are pruned to the
    buckets of that key, in the plan and in the files read."""
    _, base = traced
    silver, gold = (spark.read.parquet(f"{base}/{n}") for n in ("silver", "gold_research"))
    key = silver.agg(F.min("ssn")).first()[0]
    bronze = writers.read_bronze(spark, f"{base}/bronze_metadata").where(F.col("ssn") == key).withColumn("source_file", F.lit("one.csv"))
    ledger = spark.createDataFrame([("TX-1", "1", "one.csv")], "tx_id string, content_md5 string, source_file string")
    args = ("TX-1", ledger, bronze, silver.drop("site_key"), gold)
    pruned = lineage_trace(*args, include_landed=False, trace_buckets=32)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(rf"PartitionFilters: \[[^\]]*{TRACE_BUCKET}#\d+ = \d+", plan)) == 2, plan
    whole = lineage_trace(*args, include_landed=False)
    same = ["stage", "record_key", "payload"]
    assert sorted(map(tuple, pruned.select(*same).collect())) == sorted(map(tuple, whole.select(*same).collect()))
    assert pruned.where("stage = 'gold'").count() == silver.where(F.col("ssn") == key).count() > 0

    # The files of the one bucket that each scan is cut down to hold all rows of the key.
    surrogate = spark.range(1).select(F.lit(key).alias("ssn")).select(surrogate_key("ssn").alias("s")).first()["s"]
    for layer, by, value in ((silver, "ssn", key), (gold, "subject_surrogate_id", surrogate)):
        bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit(value)), F.lit(32)).alias("b")).first()["b"]
        every = [_bare(f) for f in layer.inputFiles()]
        read = {f for f in every if f"/{TRACE_BUCKET}={bucket}/" in f}
        holding = layer.where(F.col(by) == value).select("_metadata.file_path").distinct().collect()
        assert {_bare(r[0]) for r in holding} <= read and 0 < len(read) < len(every) / 4


def test_bloom_filters_are_written_and_sized_to_the_data(spark):
    import os
    rows = spark.range(2000).select(F.sha2(F.col("id").cast("string"), 256).alias("ssn")).coalesce(1)
    sizes = {}
    for bloom in ((), ("ssn",)):
        path = scratch_path(spark, "t-bloom")
        writers.write_table(rows, path, bloom=bloom)
        sizes[bloom] = os.path.getsize(spark.read.parquet(path).inputFiles()[0].removeprefix("file://"))
    assert 1_000 < sizes[("ssn",)] - sizes[()] < 200_000  # a megabyte if not sized to the data


def test_newest_snapshots_only(spark):
    import os
    import time
    root = scratch_path(spark, "t-newest-run")
    local = root.removeprefix("file:")
    for side, header, lines in (("metadata", "ssn,age,site_location,ehr_system,lesion_status_code,scan_date", ["{},7,CHOC,Cerner,1,2026-01-01"]),
                                ("dicom", "ssn,dicom_s3_uri,modality,body_region", ["{},s3://b/{}.dcm,MRI,Brain"])):
        os.makedirs(f"{local}/{side}")
        for stamp, keys in (("20260101T000000Z", ("a", "b", "c")), ("20260201T000000Z", ("d", "e"))):
            name = "metadata_extract" if side == "metadata" else "dicom_manifest"
            with open(f"{local}/{side}/{name}_{stamp}.csv", "w") as f:
                f.write(header + "\n" + "".join(lines[0].format(k, k) + "\n" for k in keys))
            time.sleep(1.1)
    args = (f"{root}/metadata", f"{root}/dicom")
    newest = run_medallion(spark, *args, f"{root}/lake", tiebreakers=(), newest=True).first()
    assert (newest["bronze_metadata_rows"], newest["bronze_manifest_rows"], newest["gold_rows"]) == (2, 2, 2)
    every = run_medallion(spark, *args, f"{root}/lake-all", tiebreakers=()).first()
    assert (every["bronze_metadata_rows"], every["gold_rows"]) == (5, 5)
    assert (every["metadata_only_ids"], every["manifest_only_ids"], every["silver_unmatched_count"]) == (0, 0, 0)


def test_defaults_of_a_dialect_fill_absent_columns_only(spark):
    import os
    root = scratch_path(spark, "t-defaults")
    local = root.removeprefix("file:")
    for site, text in (("one", "id,age,lesion_status_code,scan_date\nk1,5,1,2026-01-01\n"),
                       ("two", "ssn,age,site_location,ehr_system,lesion_status_code,scan_date\nk2,6,,Epic,0,2026-01-02\n")):
        os.makedirs(f"{local}/{site}")
        with open(f"{local}/{site}/x.csv", "w") as f:
            f.write(text)
    os.makedirs(f"{local}/dicom")
    with open(f"{local}/dicom/m.csv", "w") as f:
        f.write("ssn,dicom_s3_uri,modality,body_region\nk1,s3://b/1,MRI,Brain\nk2,s3://b/2,CT,Head\n")
    run_medallion(spark, [], f"{root}/dicom", f"{root}/lake", tiebreakers=(), defaults={"site_location": "CHOC"},
                  dialects={f"{root}/one": {"id": "ssn"}, f"{root}/two": {}})
    bronze = {r["ssn"]: r["site_location"] for r in spark.read.parquet(f"{root}/lake/bronze_metadata").collect()}
    assert bronze == {"k1": "CHOC", "k2": None}
    with pytest.raises(ValueError, match="schema lacks"):
        run_medallion(spark, [], f"{root}/dicom", f"{root}/lake2", tiebreakers=(), defaults={"nope": 1}, dialects={f"{root}/one": {"id": "ssn"}})


def test_a_run_that_stops_leaves_the_published_set(spark, monkeypatch):
    """Silver and Gold change together, with the commit at the end of a run."""
    from aurum.plans import run as R
    dirs = files.land_fixture(spark, SF_SMALL, "t-publish")
    base = f"{dirs['root']}/lake"
    options = {"metadata_schema": files.FIXTURE_METADATA_SCHEMA, "run_date": files.RUN_DATE, "publish": True}
    assert R.published(spark, base) is None
    R.run_medallion(spark, dirs["metadata"], dirs["dicom"], base, run_ts="2026-01-01T00:00:00Z", namespace="aurum_t_published", **options)
    first = R.published(spark, base)
    rows = {n: spark.read.parquet(getattr(first, n)).count() for n in ("silver", "gold_research")}
    assert rows["silver"] == rows["gold_research"] == spark.table("aurum_t_published.gold_research").count() > 0

    def stops(*a, **kw):
        raise RuntimeError("stopped before Gold")

    with monkeypatch.context() as m:
        m.setattr(R.layers, "gold_dataset", stops)
        with pytest.raises(RuntimeError, match="stopped"):
            R.run_medallion(spark, dirs["metadata"], dirs["dicom"], base, run_ts="2026-01-02T00:00:00Z", salt="new", **options)
    assert R.published(spark, base) == first
    assert {n: spark.read.parquet(getattr(first, n)).count() for n in rows} == rows

    R.run_medallion(spark, dirs["metadata"], dirs["dicom"], base, run_ts="2026-01-03T00:00:00Z", salt="new", **options)
    last = R.published(spark, base)
    assert last != first and last.bronze_metadata == first.bronze_metadata
    keys = lambda layout: {r[0] for r in spark.read.parquet(layout.gold_research).select("subject_surrogate_id").collect()}
    assert keys(last).isdisjoint(keys(first))
    assert R.remove_superseded(spark, base) == 2
    assert spark.read.parquet(R.published(spark, base).gold_research).count() == rows["gold_research"]


def test_two_runs_cannot_publish_over_each_other(spark, monkeypatch):
    from aurum.plans import run as R
    from aurum.sinks import commits
    dirs = files.land_fixture(spark, SF_SMALL, "t-publish-race")
    base = f"{dirs['root']}/lake"
    whole = R.layers.gold_dataset

    def other_first(*a, **kw):
        commits.commit(spark, f"{base}/{R.PUBLISHED}", 0, {"run": "runs/other"})
        return whole(*a, **kw)

    monkeypatch.setattr(R.layers, "gold_dataset", other_first)
    with pytest.raises(commits.Conflict):
        R.run_medallion(spark, dirs["metadata"], dirs["dicom"], base, metadata_schema=files.FIXTURE_METADATA_SCHEMA, publish=True)
    assert R.published(spark, base).own == f"{base}/runs/other"
