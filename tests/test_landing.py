"""File-state operators checked against brute force (Python over the files)."""

from __future__ import annotations

import hashlib
import os
import time
from urllib.parse import urlparse

import pytest

from pyspark.sql import functions as F

from aurum import config
from aurum.plans import files
from aurum.sinks import writers
from aurum.sources import csv, landing
from aurum.streaming.incremental import incremental_ingest
from aurum.session import scratch_path

from conftest import SF_SMALL


def _local(path: str) -> str:
    return urlparse(path).path if path.startswith("file:") else path


def _csv_files(root):
    out = []
    for d, _, fs in os.walk(_local(root)):
        out += [os.path.join(d, f) for f in fs if f.endswith(".csv")]
    return out


def test_ledger_ids_equal_md5_of_file_bytes(spark):
    dirs = files.land_fixture(spark, SF_SMALL, "t-ledger")
    ledger = files._ledger(spark, dirs).collect()
    on_disk = _csv_files(f"{dirs['root']}/raw")
    assert len(ledger) == len(on_disk) == 3
    expected = {}
    for p in on_disk:
        data = open(p, "rb").read()
        upload = os.path.basename(os.path.dirname(p)).split("=", 1)[-1]  # upload=<landed name>
        expected[upload] = "TX-" + hashlib.md5(data).hexdigest()[:6].upper()
    assert {r["file_name"]: r["tx_id"] for r in ledger} == expected
    assert {r["object_prefix"] for r in ledger} == {"metadata", "dicom"}
    assert all(r["uploaded_at"].isoformat() == "2026-06-23T13:18:04" for r in ledger)


def test_ledger_requires_submitter(spark):
    dirs = files.land_fixture(spark, SF_SMALL, "t-nosub")
    subs = spark.createDataFrame([], "file_name string, submitter string, affiliation string, dataset_type string")
    try:
        landing.landing_ledger(spark, f"{dirs['root']}/raw", subs).collect()
    except Exception as e:  # noqa: BLE001
        assert "without submitter" in str(e)
    else:
        raise AssertionError("a landed file without submitter must fail")


def test_catalog_sizes_match_os(spark):
    dirs = files.land_fixture(spark, SF_SMALL, "t-catalog")
    with open(os.path.join(_local(dirs["root"]), "raw", "readme.txt"), "w") as f:
        f.write("not an upload\n")
    cat = landing.landing_catalog(landing.list_files(spark, dirs["root"]), files._ledger(spark, dirs),
                                  root=dirs["root"]).collect()
    sizes = {}
    for d, _, fs in os.walk(_local(dirs["root"])):
        for f in fs:
            if f.startswith((".", "_")):  # hidden files are not data to Spark
                continue
            p = os.path.join(d, f)
            sizes[os.path.relpath(p, _local(dirs["root"]))] = round(os.path.getsize(p) / 1024, 2)
    got = {r["key"]: r["size_kb"] for r in cat}
    assert got == sizes
    known = [r for r in cat if r["key"].endswith(".csv")]
    assert known and all(r["submitter"] == "Site coordinator" for r in known)
    unknown = [r for r in cat if not r["key"].endswith(".csv")]
    assert unknown and all(r["submitter"] == "Unknown" for r in unknown)


def test_ledger_lookup_fallback(spark):
    rows = files.q_ledger_lookup(spark, SF_SMALL).collect()
    found = [r for r in rows if r["found"]]
    missing = [r for r in rows if not r["found"]]
    assert len(found) == len(missing) == 3
    default = {r["tx_id"] for r in missing}
    assert len(default) == 1 and default <= {r["tx_id"] for r in found}


def test_newest_snapshot_prefers_fixed_path_and_mtime(spark):
    root = scratch_path(spark, "t-snap")
    df = spark.createDataFrame([("a",)], "v string")
    for name in ("metadata_old", "metadata_new"):
        df.coalesce(1).write.csv(f"{root}/{name}")
        time.sleep(1.1)
    newest = landing.newest_snapshot(spark, root)
    assert "metadata_new" in newest
    # Make the old one newer on disk: modification time decides, not the name.
    old = _csv_files(f"{root}/metadata_old")[0]
    os.utime(old, None)
    assert "metadata_old" in landing.newest_snapshot(spark, root)
    assert landing.newest_snapshot(spark, root, fixed_path=f"{root}/metadata_new") == f"{root}/metadata_new"


def test_corrupt_rows_captured_with_pruning(spark):
    path = scratch_path(spark, "t-corrupt")
    os.makedirs(_local(path))
    with open(os.path.join(_local(path), "x.csv"), "w") as f:
        f.write("a,b,c\n1,2,3\n4,5\n6,7,8,9\n")
    from pyspark.sql.types import StringType, StructField, StructType
    schema = StructType([StructField(c, StringType()) for c in "abc"])
    df = csv.read_csv(spark, path, schema)
    # Selecting one column must not hide the malformed rows.
    bad = csv.quarantine_rows(df).select("a", config.CORRUPT_COLUMN).collect()
    assert {r[config.CORRUPT_COLUMN] for r in bad} == {"4,5", "6,7,8,9"}


def test_header_order_follows_names(spark):
    path = scratch_path(spark, "t-hdr")
    os.makedirs(_local(path))
    with open(os.path.join(_local(path), "x.csv"), "w") as f:
        f.write("age,ssn\n7,P1\n")
    from pyspark.sql.types import StringType, StructField, StructType
    schema = StructType([StructField("ssn", StringType()), StructField("age", StringType())])
    # Strict: a reordered header is an error, never a silent positional mapping.
    try:
        csv.read_csv(spark, path, schema).collect()
    except Exception as e:  # noqa: BLE001
        assert "header" in str(e).lower()
    else:
        raise AssertionError("reordered header must be rejected")
    # By-name read: values follow the header names.
    r = csv.read_csv(spark, path).first()
    assert (r["ssn"], r["age"]) == ("P1", "7")


def test_incremental_ingest_is_exactly_once(spark):
    dirs = files.land_fixture(spark, SF_SMALL, "t-stream")
    out, ckpt = scratch_path(spark, "t-sb"), scratch_path(spark, "t-sc")
    incremental_ingest(spark, dirs["metadata"], files.FIXTURE_METADATA_SCHEMA, out, ckpt)
    n1 = spark.read.parquet(out).count()
    incremental_ingest(spark, dirs["metadata"], files.FIXTURE_METADATA_SCHEMA, out, ckpt)
    assert spark.read.parquet(out).count() == n1
    # A new upload is picked up on the next run, once.
    meta = files.load_fixtures(spark, SF_SMALL)[0].where(F.col("encounter_id") % 5 == 0)
    files.land_uploads(meta, F.lit("late_20260624T000000Z.csv"), files.META_COLS, f"{dirs['metadata']}/late")
    incremental_ingest(spark, dirs["metadata"], files.FIXTURE_METADATA_SCHEMA, out, ckpt)
    assert spark.read.parquet(out).count() == n1 + meta.count()


def test_partition_rerun_keeps_counts(spark):
    meta = files.load_fixtures(spark, SF_SMALL)[0]
    path = scratch_path(spark, "t-rerun")
    for _ in range(2):
        writers.write_bronze(meta.withColumn("pipeline_run_date", F.lit("2026-06-23")), path)
    assert writers.read_bronze(spark, path).count() == meta.count()


def test_output_locations(spark):
    meta = files.load_fixtures(spark, SF_SMALL)[0]
    path = scratch_path(spark, "t-loc")
    writers.write_bronze(meta.withColumn("pipeline_run_date", F.lit("2026-06-23")), path)
    r = writers.output_locations(spark, [("bronze", "metadata", path)]).first()
    assert (r["layer"], r["rows"], r["partition"], r["uri"]) == ("bronze", meta.count(), "2026-06-23", path)
    assert r["bytes"] == sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(_local(path)) for f in fs if f.startswith("part-"))


def test_create_namespace(spark):
    writers.create_namespace(spark, "aurum_test_ns")
    assert "aurum_test_ns" in [d.name for d in spark.catalog.listDatabases()]


def test_append_ledger_idempotent(spark):
    dirs = files.land_fixture(spark, SF_SMALL, "t-append")
    path = scratch_path(spark, "t-ledger-table")
    assert landing.append_ledger(spark, files._ledger(spark, dirs), path) == 3
    assert landing.append_ledger(spark, files._ledger(spark, dirs), path) == 0
    meta = files.load_fixtures(spark, SF_SMALL)[0].where(F.col("encounter_id") % 7 == 0)
    files.land_uploads(meta, F.lit("late_extract_20260624T000000Z.csv"), files.META_COLS, f"{dirs['metadata']}/late")
    assert landing.append_ledger(spark, files._ledger(spark, dirs), path) == 1
    assert spark.read.parquet(path).count() == 4


def test_run_rerun_same_date_is_idempotent(spark):
    from aurum.plans.run import run_medallion
    dirs = files.land_fixture(spark, SF_SMALL, "t-rerun-run")
    base = f"{dirs['root']}/lake"
    kw = dict(run_ts="2026-06-23T00:00:00Z", run_date="2026-06-23", metadata_schema=files.FIXTURE_METADATA_SCHEMA)
    m1 = run_medallion(spark, dirs["metadata"], dirs["dicom"], base, **kw).first()
    m2 = run_medallion(spark, dirs["metadata"], dirs["dicom"], base,
                       **{**kw, "run_ts": "2026-06-23T01:00:00Z"}).first()
    assert writers.read_bronze(spark, f"{base}/bronze_metadata").count() == m1["bronze_metadata_rows"]
    assert {k: v for k, v in m1.asDict().items() if k != "run_timestamp"} == \
        {k: v for k, v in m2.asDict().items() if k != "run_timestamp"}
    assert spark.read.parquet(f"{base}/run_metrics").count() == 2
    m3 = run_medallion(spark, dirs["metadata"], dirs["dicom"], base, **kw)
    assert m3.collect() == [m1] and spark.read.parquet(f"{base}/run_metrics").count() == 2
    assert spark.read.parquet(f"{base}/gold_research").count() == m1["gold_rows"]


def test_scale_conf():
    from aurum.session import scale_conf
    c = scale_conf(100 * 2 ** 40, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 819200
    assert scale_conf(1 << 20, 8)["spark.sql.shuffle.partitions"] == "16"


def test_ledger_metadata_ids_read_no_content(spark):
    dirs = files.land_fixture(spark, SF_SMALL, "t-meta-id")
    subs = landing.list_files(spark, f"{dirs['root']}/raw", "*.csv").select(
        "file_name", F.lit("x").alias("submitter"), F.lit("CHOC").alias("affiliation"),
        F.lit("Clinical Metadata Extract").alias("dataset_type"))
    led = landing.landing_ledger(spark, f"{dirs['root']}/raw", subs, id_from="metadata")
    plan = led._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[1].split(">")[0]
    rows = led.collect()
    assert len(rows) == 3 and len({r["tx_id"] for r in rows}) == 3


def test_site_export_sanitizes_counts_and_keeps_collisions(spark):
    df = spark.createDataFrame([("A B", 1), ("A/B", 2), (None, 3), ("A_B", 4)], "site_location string, v int")
    path = scratch_path(spark, "t-sites")
    writers.export_by_site(df, path)
    back = {(r["site_key"], r["v"]) for r in spark.read.parquet(path).collect()}
    assert back == {("A_B", 1), ("A-B", 2), ("A_B", 4)}          # colliding keys share a folder, both kept
    assert writers.unexported_rows(df).first()["rows_without_site"] == 1
    assert {r["site_key"] for r in writers.read_site(spark, path, "A B").collect()} == {"A_B"}


def test_gold_ml_export_file_count(spark):
    from aurum.plans import layers
    meta, man = files.load_fixtures(spark, SF_SMALL)
    gold = layers.gold_dataset(layers.silver_joined(meta, man))
    path = scratch_path(spark, "t-ml")
    writers.export_gold_ml(gold, path, files=2)
    parts = [f for f in os.listdir(_local(path)) if f.startswith("part-")]
    assert len(parts) <= 2
    back = spark.read.parquet(path)
    assert back.columns == ["surrogate_id", "age", "ehr_system", "site_location", "lesion_label", "s3_dicom_path"]
    assert back.count() == gold.count()


def test_run_empty_policy(spark):
    import pytest
    from aurum.plans.run import run_medallion
    root = scratch_path(spark, "t-empty")
    os.makedirs(_local(f"{root}/metadata"))
    os.makedirs(_local(f"{root}/dicom"))
    with open(_local(f"{root}/metadata/x.csv"), "w") as f:
        f.write("ssn,age,site_location,ehr_system,lesion_status_code,scan_date\n")
    with open(_local(f"{root}/dicom/y.csv"), "w") as f:
        f.write("ssn,dicom_s3_uri,modality,body_region\nP1,s3://b/1.dcm,MRI,Brain\n")
    m = run_medallion(spark, f"{root}/metadata", f"{root}/dicom", f"{root}/lake", tiebreakers=()).first()
    assert (m["bronze_metadata_rows"], m["bronze_manifest_rows"], m["gold_rows"]) == (0, 1, 0)
    with pytest.raises(RuntimeError, match="zero rows"):
        run_medallion(spark, f"{root}/metadata", f"{root}/dicom", f"{root}/lake2", tiebreakers=(), on_empty="fail")


def test_catalog_last_modified_is_utc(spark):
    import datetime as dt
    dirs = files.land_fixture(spark, SF_SMALL, "t-utc")
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        rows = landing.landing_catalog(landing.list_files(spark, dirs["root"]), root=dirs["root"]).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    for r in rows:
        p = os.path.join(_local(dirs["root"]), r["key"])
        want = dt.datetime.fromtimestamp(os.path.getmtime(p), dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S UTC")
        assert r["last_modified"] == want


def test_write_table_registers_table(spark):
    meta = files.load_fixtures(spark, SF_SMALL)[0]
    path = scratch_path(spark, "t-saveas")
    for _ in range(2):  # overwrite with schema replacement, twice
        writers.write_table(meta, path, table="aurum_t_bronze")
    assert spark.table("aurum_t_bronze").count() == meta.count()
    assert spark.table("aurum_t_bronze").columns == meta.columns


def test_equal_names_keep_their_own_submitter(spark):
    """Two uploads of one name under two prefixes: by path each has its own
    submitter; by name alone whose is whose is an error."""
    root = scratch_path(spark, "t-same-name")
    for folder, text in (("metadata", "a"), ("dicom", "b")):
        os.makedirs(f"{_local(root)}/raw/{folder}")
        with open(f"{_local(root)}/raw/{folder}/x_20260101T000000Z.csv", "w") as f:
            f.write(f"h\n{text}\n")
    listing = landing.list_files(spark, f"{root}/raw", "*.csv")
    who = F.when(F.col("path").contains("/dicom/"), "D").otherwise("M").alias("submitter")
    rest = [F.lit("CHOC").alias("affiliation"), F.lit("Clinical Metadata Extract").alias("dataset_type")]
    led = landing.landing_ledger(spark, f"{root}/raw", listing.select("path", who, *rest))
    rows = {("dicom" if "/dicom/" in r["source_file"] else "metadata"): r["submitter"] for r in led.collect()}
    assert rows == {"dicom": "D", "metadata": "M"} and led.count() == 2
    cat = landing.landing_catalog(listing, led, root=root).collect()
    assert {(r["key"].split("/")[1], r["submitter"]) for r in cat} == {("dicom", "D"), ("metadata", "M")}
    with pytest.raises(Exception, match="submissions by path"):
        landing.landing_ledger(spark, f"{root}/raw", listing.select("file_name", who, *rest)).collect()


def test_colliding_short_ids(spark):
    """Two contents under one short id: lookup reports it, a trace refuses the
    short id and takes the full hash."""
    from aurum.operators.join import ledger_lookup
    from aurum.plans.lineage import lineage_trace
    led = spark.createDataFrame([("TX-AAAAAA", "aaaaaa1", "f1"), ("TX-AAAAAA", "aaaaaa2", "f2"), ("TX-BBBBBB", "bbbbbb1", "f3")],
                                "tx_id string, content_md5 string, source_file string")
    asked = spark.createDataFrame([("TX-AAAAAA",), ("aaaaaa2",), ("nope",), ("nope2",)], "tx_id string")
    got = sorted((r["requested_id"], r["found"], r["ambiguous"], r["source_file"]) for r in ledger_lookup(asked, led, "TX-BBBBBB").collect())
    assert got == [("TX-AAAAAA", True, True, "f1"), ("TX-AAAAAA", True, True, "f2"), ("aaaaaa2", True, False, "f2"),
                   ("nope", False, False, "f3"), ("nope2", False, False, "f3")]
    with pytest.raises(ValueError, match="more than one"):
        ledger_lookup(asked, led, "TX-AAAAAA")
    bronze = spark.createDataFrame([("k1", "f1"), ("k2", "f2")], "ssn string, source_file string")
    silver = spark.createDataFrame([("k1",), ("k2",)], "ssn string")
    gold = spark.createDataFrame([("g",)], "subject_surrogate_id string")
    with pytest.raises(ValueError, match="different files"):
        lineage_trace("TX-AAAAAA", led, bronze, silver, gold, include_landed=False)
    out = lineage_trace("aaaaaa2", led, bronze, silver, gold, include_landed=False).collect()
    assert [(r["stage"], r["record_key"]) for r in out] == [("bronze", "k2"), ("silver", "k2")]


def test_trace_of_more_files_than_the_filter_takes(spark, monkeypatch):
    """The landed stage is whole on either side of the pushed-down list."""
    from aurum.plans import lineage
    root = scratch_path(spark, "t-many-files")
    os.makedirs(f"{_local(root)}/raw/other")
    for i in range(1001):
        with open(f"{_local(root)}/raw/u{i}_20260101T000000Z.csv", "w") as f:
            f.write("epic_id,age\nk,1\n")
    with open(f"{_local(root)}/raw/other/z_20260101T000000Z.csv", "w") as f:
        f.write("age,epic_id\n1,other\n")
    names = landing.list_files(spark, f"{root}/raw", "*.csv").select(F.col("path").alias("source_file"))
    md5 = F.when(F.col("source_file").contains("/other/"), "b").otherwise("a")
    led = names.select(F.concat(F.lit("TX-"), md5).alias("tx_id"), md5.alias("content_md5"), "source_file")
    bronze = names.select(F.when(F.col("source_file").contains("/other/"), "other").otherwise("k").alias("ssn"), "source_file")
    silver = spark.createDataFrame([("k",)], "ssn string")
    gold = spark.createDataFrame([("g",)], "subject_surrogate_id string")
    for limit in (1_000, 2_000):
        monkeypatch.setattr(lineage, "PUSHDOWN_FILES", limit)
        out = lineage.lineage_trace("TX-a", led, bronze, silver, gold)
        got = {(r["stage"], r["record_key"]): r["n"] for r in out.groupBy("stage", "record_key").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert got == {("landed", "k"): 1001, ("bronze", "k"): 1001, ("silver", "k"): 1}


def test_upload_buckets_are_not_cut(spark):
    got = spark.createDataFrame([(5,), (12345 * files.UPLOAD_KEY_SPAN,), (1234 * files.UPLOAD_KEY_SPAN,)], "k long").select(files._bucket(F.col("k")))
    assert [r[0] for r in got.collect()] == ["0000", "12345", "1234"]


def test_newest_snapshot_is_by_time_not_name(spark):
    rows = files.q_newest_snapshot(spark, SF_SMALL)
    meta = files.load_fixtures(spark, SF_SMALL)[0]
    assert rows.count() == meta.where("encounter_id % 2 = 1").count() > 0
    assert rows.where("encounter_id % 2 = 0").count() == 0


def test_stream_refuses_a_reordered_header(spark):
    from aurum import config
    from aurum.streaming.incremental import incremental_ingest, stream_increments
    root = scratch_path(spark, "t-bad-header")
    meta = files.load_fixtures(spark, SF_SMALL)[0].select(*reversed(files.META_COLS))
    files.write_csv(meta, f"{root}/meta")
    with pytest.raises(Exception, match="STREAM_FAILED"):
        incremental_ingest(spark, f"{root}/meta", files.FIXTURE_METADATA_SCHEMA, f"{root}/bronze", f"{root}/ckpt")
    with pytest.raises(Exception, match="STREAM_FAILED"):
        stream_increments(spark, f"{root}/meta", f"{root}/meta", f"{root}/lake", f"{root}/ckpt2",
                          files.FIXTURE_METADATA_SCHEMA, config.MANIFEST_RAW_SCHEMA, buckets=4)


def test_stream_counts_every_batch(spark):
    from pyspark.sql.types import StringType, StructField, StructType

    from aurum.streaming.incremental import incremental_ingest
    root = scratch_path(spark, "t-batches")
    os.makedirs(f"{_local(root)}/in")
    for i in range(104):
        with open(f"{_local(root)}/in/{i}.csv", "w") as f:
            f.write(f"v\n{i}\n")
    schema = StructType([StructField("v", StringType())])
    assert incremental_ingest(spark, f"{root}/in", schema, f"{root}/out", f"{root}/ckpt", max_files_per_trigger=1) == 104
    assert spark.read.parquet(f"{root}/out").count() == 104
    assert incremental_ingest(spark, f"{root}/in", schema, f"{root}/out", f"{root}/ckpt", max_files_per_trigger=1) == 0


def test_content_tree_is_of_the_bytes_whatever_the_splits(spark):
    """Ids of files read in many splits, by many tasks: the same under any
    split size, and changed by any change of the bytes."""
    root = scratch_path(spark, "t-tree")
    os.makedirs(f"{_local(root)}/raw/sub dir")
    long = "".join(f"line {i},{'x' * (i % 90)}\n" for i in range(20_000))
    contents = {"a.csv": long, "sub dir/same+.csv": long, "unended.csv": long[:-1], "swapped.csv": long[7:] + long[:7], "cr.csv": long.replace("\n", "\r\n", 1),
                "blank.csv": "\n", "blanks.csv": "\n\n"}
    for name, text in contents.items():
        with open(f"{_local(root)}/raw/{name}", "wb") as f:
            f.write(text.encode() + (b"\xff\xfe" if name == "cr.csv" else b""))
    seen = {}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for split in ("64k", "100k", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            tree = landing.content_tree(spark, f"{root}/raw", leaf_lines=1000)
            seen[split] = {r["path"].split("/raw/")[1].replace("%20", " "): r["content_md5"] for r in tree.collect()}
            if split == "64k":
                assert spark.read.text(f"{root}/raw/a.csv").rdd.getNumPartitions() > 8
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert seen["64k"] == seen["100k"] == seen["128m"] and set(seen["64k"]) == set(contents)
    by_id = seen["64k"]
    assert by_id["a.csv"] == by_id["sub dir/same+.csv"] and len(set(by_id.values())) == len(contents) - 1


def test_ledger_by_content_tree(spark):
    dirs = files.land_fixture(spark, SF_SMALL, "t-tree-ledger")
    led = landing.landing_ledger(spark, f"{dirs['root']}/raw", files._submissions(spark, dirs), id_from="tree")
    by_content = files._ledger(spark, dirs)
    rows = {r["source_file"]: r for r in led.collect()}
    assert set(rows) == {r["source_file"] for r in by_content.collect()}
    assert all(r["tx_id"] == f"TX-{r['content_md5'][:6].upper()}" for r in rows.values())
    assert {r["content_md5"] for r in rows.values()}.isdisjoint(r["content_md5"] for r in by_content.collect())
