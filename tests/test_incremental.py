"""Incremental keep-latest equals the one-shot dedup and rewrites only the
buckets an increment touches."""

from __future__ import annotations

import datetime as dt
import os
from urllib.parse import urlparse

from aurum.operators import dedup
from aurum.plans import incremental
from aurum.session import scratch_path


def _local(path):
    return urlparse(path).path if path.startswith("file:") else path


def test_increments_equal_one_shot_with_hot_key(spark):
    rows = [("HOT" if i % 3 == 0 else f"P{i % 400}", dt.date(2026, 1, 1) + dt.timedelta(days=i % 97), i)
            for i in range(2400)]
    df = spark.createDataFrame(rows, "ssn string, scan_date date, enc int")
    state = scratch_path(spark, "t-inc")
    for lo, hi in ((0, 800), (800, 1600), (1600, 2400)):
        incremental.upsert_latest(spark, df.where(f"enc >= {lo} and enc < {hi}"), state,
                                  tiebreakers=["enc"], buckets=16)
    got = {(r["ssn"], r["enc"]) for r in incremental.read_latest(spark, state).collect()}
    want = {(r["ssn"], r["enc"]) for r in dedup.keep_latest(df, "ssn", "scan_date", ["enc"]).collect()}
    assert got == want


def test_untouched_buckets_are_not_rewritten(spark):
    df = spark.createDataFrame([(f"P{i}", dt.date(2026, 1, 1), i) for i in range(200)],
                               "ssn string, scan_date date, enc int")
    state = scratch_path(spark, "t-inc2")
    incremental.upsert_latest(spark, df, state, tiebreakers=["enc"], buckets=32)
    root = _local(state)

    def snapshot():
        out = {}
        for d in os.listdir(root):
            if d.startswith(incremental.BUCKET_COLUMN):
                files = [f for f in os.listdir(os.path.join(root, d)) if f.startswith("part-")]
                out[d] = {f: os.path.getmtime(os.path.join(root, d, f)) for f in files}
        return out

    before = snapshot()
    one = spark.createDataFrame([("P7", dt.date(2026, 2, 1), 999)], "ssn string, scan_date date, enc int")
    assert incremental.upsert_latest(spark, one, state, tiebreakers=["enc"], buckets=32) == 1
    after = snapshot()
    changed = [b for b in before if before[b] != after.get(b)]
    assert len(changed) == 1
    latest = {r["ssn"]: r["enc"] for r in incremental.read_latest(spark, state).collect()}
    assert latest["P7"] == 999 and len(latest) == 200


def test_increments_reproduce_full_gold_with_hot_patient(spark):
    from collections import Counter

    from aurum.plans import layers
    from aurum.plans.incremental import BUCKET_COLUMN, apply_increment
    meta = spark.createDataFrame(
        [("999-10-000001" if i % 3 == 0 else f"999-11-{i % 500:06d}", str(5 + i % 14), "CHOC", "Cerner",
          ["1", "NA", "x"][i % 3], f"2026-{1 + i % 12:02d}-{1 + i % 28:02d}", i) for i in range(1500)],
        "ssn string, age string, site_location string, ehr_system string, lesion_status_code string, "
        "scan_date string, encounter_id long")
    man = spark.createDataFrame(
        [("999-10-000001" if i % 3 == 0 else f"999-11-{i % 500:06d}", f"s3://b/{i}.dcm", "MRI", "Brain")
         for i in range(900)], "ssn string, dicom_s3_uri string, modality string, body_region string")
    base = scratch_path(spark, "t-inc-gold")
    for k in (0, 1, 1, 2):  # increment 1 is delivered twice (a retried batch)
        apply_increment(spark, meta.where(f"encounter_id % 3 = {k}"),
                        man.where(f"cast(regexp_extract(dicom_s3_uri, '([0-9]+)', 1) as int) % 3 = {k}"),
                        base, increment_id=f"day-{k}", buckets=16)
    got = Counter(tuple(r) for r in spark.read.parquet(f"{base}/gold_research").drop(BUCKET_COLUMN)
                  .select(*sorted(layers.gold_dataset(layers.silver_joined(meta, man)).columns)).collect())
    full = layers.gold_dataset(layers.silver_joined(meta, man))
    want = Counter(tuple(r) for r in full.select(*sorted(full.columns)).collect())
    assert got == want


def test_streaming_increments_follow_new_uploads(spark):
    from collections import Counter

    from pyspark.sql import functions as F

    from aurum import config
    from aurum.plans import files, layers
    from aurum.plans.incremental import BUCKET_COLUMN
    from aurum.streaming.incremental import stream_increments
    from conftest import SF_SMALL

    meta, man = files.load_fixtures(spark, SF_SMALL)
    early = meta.where(F.col("encounter_id") < 3000)
    late = meta.where(F.col("encounter_id") >= 3000)
    root = scratch_path(spark, "t-stream-inc")
    files.land_uploads(early, F.lit("early_extract_20260601T000000Z.csv"), files.META_COLS, f"{root}/meta/a")
    files.land_uploads(man, F.lit("dicom_manifest_20260601T000000Z.csv"), files.MANIFEST_COLS, f"{root}/man/a")
    base, ckpt = f"{root}/lake", f"{root}/ckpt"
    args = (spark, f"{root}/meta", f"{root}/man", base, ckpt, files.FIXTURE_METADATA_SCHEMA,
            config.MANIFEST_RAW_SCHEMA)

    def gold_rows():
        g = spark.read.parquet(f"{base}/gold_research").drop(BUCKET_COLUMN)
        return Counter(tuple(r) for r in g.select(*sorted(g.columns)).collect())

    def full(m):
        g = layers.gold_dataset(layers.silver_joined(m, man))
        return Counter(tuple(r) for r in g.select(*sorted(g.columns)).collect())

    stream_increments(*args, buckets=16)
    assert gold_rows() == full(early)
    assert stream_increments(*args, buckets=16) == {"metadata_batches": 0, "manifest_batches": 0}
    files.land_uploads(late, F.lit("late_extract_20260602T000000Z.csv"), files.META_COLS, f"{root}/meta/b")
    stream_increments(*args, buckets=16)
    assert gold_rows() == full(meta)


def test_another_bucket_count_is_refused(spark):
    import pytest
    df = spark.createDataFrame([(f"P{i}", dt.date(2026, 1, 1), i) for i in range(100)], "ssn string, scan_date date, enc int")
    state = scratch_path(spark, "t-buckets")
    incremental.upsert_latest(spark, df, state, tiebreakers=["enc"], buckets=64)
    with pytest.raises(ValueError, match="64 buckets"):
        incremental.upsert_latest(spark, df, state, tiebreakers=["enc"], buckets=100)
    assert incremental.read_latest(spark, state).count() == 100


def test_corrected_increment_replaces_its_first_version(spark):
    """Increment x comes again with other metadata (an earlier date, a patient
    less) and other imaging: the tables equal a full run over what holds now."""
    from collections import Counter

    from aurum.plans import layers
    from aurum.plans.incremental import BUCKET_COLUMN, apply_increment

    def meta(rows):
        return spark.createDataFrame([(s, "7", "CHOC", "Cerner", "1", d, e) for s, d, e in rows],
                                     "ssn string, age string, site_location string, ehr_system string, "
                                     "lesion_status_code string, scan_date string, encounter_id long")

    def man(ids):
        return spark.createDataFrame([(s, f"s3://b/{s}/{k}", "MRI", "Brain") for s, k in ids],
                                     "ssn string, dicom_s3_uri string, modality string, body_region string")

    base = scratch_path(spark, "t-corrected")
    a = ([("P1", "2026-01-05", 1), ("P2", "2026-01-05", 2), ("P9", "2026-01-05", 8)], [("P1", 1), ("P2", 1), ("P9", 1)])
    x1 = ([("P1", "2026-03-01", 3), ("P3", "2026-03-01", 4)], [("P3", 1), ("P1", 2)])
    x2 = ([("P1", "2026-01-01", 3)], [("P2", 5)])
    for name, (m, i) in (("a", a), ("x", x1), ("x", x2)):
        apply_increment(spark, meta(m), man(i), base, name, buckets=16)
    full = layers.gold_dataset(layers.silver_joined(meta(a[0] + x2[0]), man(a[1] + x2[1])))
    want = Counter(tuple(r) for r in full.select(*sorted(full.columns)).collect())
    got = Counter(tuple(r) for r in spark.read.parquet(f"{base}/gold_research").drop(BUCKET_COLUMN).select(*sorted(full.columns)).collect())
    assert got == want
    assert {r["ssn"] for r in spark.read.parquet(f"{base}/silver_latest").collect()} == {"P1", "P2", "P9"}


def test_vocabulary_with_two_labels_is_refused(spark):
    import pytest

    from aurum.operators import clean
    rows = spark.createDataFrame([("x",)], "lesion_status_code string")
    with pytest.raises(Exception, match="two labels"):
        clean.harmonize_codes_by_table(rows, spark.createDataFrame([("X", "Yes"), (" x", "No")], "code string, label string")).collect()


def test_small_increments_write_few_files_and_rewrite_the_state_rarely(spark, monkeypatch):
    """One file per trigger: a batch's rows are not scattered over a file per
    bucket and task, and the state is rewritten for many batches at once; the
    tables are those of a full run, and nothing is left pending."""
    import glob
    from collections import Counter

    from pyspark.sql import functions as F

    from aurum import config
    from aurum.plans import files, layers
    from aurum.streaming.incremental import stream_increments
    from conftest import SF_SMALL

    meta, man = files.load_fixtures(spark, SF_SMALL)
    root = scratch_path(spark, "t-stream-few")
    files.land_uploads(meta, F.concat(F.lit("part_"), F.col("encounter_id") % 6, F.lit("_20260601T000000Z.csv")), files.META_COLS, f"{root}/meta")
    files.land_uploads(man, F.lit("dicom_manifest_20260601T000000Z.csv"), files.MANIFEST_COLS, f"{root}/man")
    merged, upsert = [], incremental.upsert_latest
    monkeypatch.setattr(incremental, "upsert_latest", lambda *a, **k: merged.append(1) or upsert(*a, **k))
    base = f"{root}/lake"
    done = stream_increments(spark, f"{root}/meta", f"{root}/man", base, f"{root}/ckpt", files.FIXTURE_METADATA_SCHEMA,
                             config.MANIFEST_RAW_SCHEMA, buckets=16, max_files_per_trigger=1)
    assert done == {"metadata_batches": 6, "manifest_batches": 1} and len(merged) == 1
    own = _local(base)
    assert len(glob.glob(f"{own}/silver_metadata/**/part-*", recursive=True)) <= 12
    assert len(glob.glob(f"{own}/silver_latest/*/part-*")) <= 16 and not os.listdir(f"{own}/silver_latest.pending")
    assert spark.read.parquet(f"{base}/bronze_metadata").select("_batch").distinct().count() == 6
    latest = layers.silver_latest(layers.silver_metadata(meta))
    got = spark.read.parquet(f"{base}/silver_latest").select(*latest.columns)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, latest.collect()))
    full = layers.gold_dataset(layers.silver_joined(meta, man))
    got = spark.read.parquet(f"{base}/gold_research").select(*full.columns)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, full.collect()))


def test_increments_left_pending_are_merged_by_the_next(spark):
    from aurum.plans.incremental import apply_increment, merge_pending
    base = scratch_path(spark, "t-pending")

    def meta(*rows):
        return spark.createDataFrame([(s, "7", "CHOC", "Cerner", "1", d, e) for s, d, e in rows],
                                     "ssn string, age string, site_location string, ehr_system string, "
                                     "lesion_status_code string, scan_date string, encounter_id long")

    none = spark.createDataFrame([], "ssn string, dicom_s3_uri string, modality string, body_region string")

    def latest():
        return {(r["ssn"], r["encounter_id"]) for r in spark.read.parquet(f"{base}/silver_latest").collect()}

    apply_increment(spark, meta(("P1", "2026-01-01", 1), ("P2", "2026-05-01", 2)), none, base, "1", buckets=8, merge_after=3)
    apply_increment(spark, meta(("P1", "2026-02-01", 3)), none, base, "2", buckets=8, merge_after=3)
    assert not os.path.exists(f"{_local(base)}/silver_latest")
    apply_increment(spark, meta(("P2", "2026-02-01", 4), (None, "2026-02-01", 5)), none, base, "3", buckets=8, merge_after=3)
    assert latest() == {("P1", 3), ("P2", 2)}
    apply_increment(spark, meta(("P3", "2026-02-01", 6)), none, base, "4", buckets=8, merge_after=3)
    apply_increment(spark, meta(("P1", "2026-01-15", 3)), none, base, "2", buckets=8, merge_after=3)
    assert merge_pending(spark, base, buckets=8) == 1 and merge_pending(spark, base, buckets=8) == 0
    assert latest() == {("P1", 3), ("P2", 2), ("P3", 6)}


def _patients(spark, rows):
    return spark.createDataFrame([(s, "7", "CHOC", "Cerner", "1", d, e) for s, d, e in rows],
                                 "ssn string, age string, site_location string, ehr_system string, "
                                 "lesion_status_code string, scan_date string, encounter_id long")


def _imaging(spark, ids):
    return spark.createDataFrame([(s, f"s3://b/{s}/{k}", "MRI", "Brain") for s, k in ids],
                                 "ssn string, dicom_s3_uri string, modality string, body_region string")


def _gold(spark, base, meta, man):
    """Rows of the stored Gold and of a full run's."""
    from collections import Counter

    from aurum.plans import layers
    full = layers.gold_dataset(layers.silver_joined(meta, man))
    got = spark.read.parquet(f"{base}/gold_research").select(*full.columns)
    return Counter(map(tuple, got.collect())), Counter(map(tuple, full.collect()))


def test_small_increments_wait_until_they_are_as_large_as_what_they_rewrite(spark, monkeypatch):
    from aurum.plans.incremental import apply_increment, merge_pending
    base, merges, upsert = scratch_path(spark, "t-due"), [], incremental.upsert_latest
    monkeypatch.setattr(incremental, "upsert_latest", lambda *a, **k: merges.append(1) or upsert(*a, **k))
    rows = [[(f"P{i}", "2026-01-01", i) for i in range(k * 20_000, (k + 1) * 20_000)] for k in (0, 1)]
    rows += [[(f"P{i}", "2026-02-01", 90_000 + i)] for i in range(8)]
    scans = [[(f"P{i}", 1) for i in range(0, 20_000, 100)], [(f"P{i}", 2) for i in range(0, 20_000, 50)]] + [[(f"P{i}", 3)] for i in range(8)]
    for k, (m, i) in enumerate(zip(rows, scans)):
        apply_increment(spark, _patients(spark, m), _imaging(spark, i), base, str(k), buckets=4, merge_after=2)
    assert len(merges) == 1  # the two large ones; the eight small ones are no reason to rewrite them
    assert merge_pending(spark, base, buckets=4) == 8 and len(merges) == 2
    got, want = _gold(spark, base, _patients(spark, sum(rows, [])), _imaging(spark, sum(scans, [])))
    assert got == want


def test_increments_wait_with_imaging_and_take_corrections(spark):
    from aurum.plans.incremental import apply_increment, merge_pending
    base = scratch_path(spark, "t-wait")

    def put(name, m, i):
        return apply_increment(spark, _patients(spark, m), _imaging(spark, i), base, name, buckets=8, merge_after=None)

    put("a", [("P1", "2026-01-05", 1), ("P2", "2026-01-05", 2)], [("P1", 1), ("P2", 1)])
    put("b", [("P1", "2026-03-01", 3)], [("P3", 1)])
    assert not os.path.exists(f"{_local(base)}/silver_latest") and not os.path.exists(f"{_local(base)}/gold_research")
    assert merge_pending(spark, base, buckets=8) == 2
    put("c", [("P3", "2026-02-01", 4)], [])
    put("d", [], [("P1", 2)])
    put("b", [("P2", "2026-04-01", 5)], [("P3", 7)])  # corrected at once, c and d still wait
    put("e", [], [])
    assert merge_pending(spark, base, buckets=8) == 2
    meta = [("P1", "2026-01-05", 1), ("P2", "2026-01-05", 2), ("P3", "2026-02-01", 4), ("P2", "2026-04-01", 5)]
    got, want = _gold(spark, base, _patients(spark, meta), _imaging(spark, [("P1", 1), ("P2", 1), ("P1", 2), ("P3", 7)]))
    assert got == want


def _landed(spark, name, uploads):
    from pyspark.sql import functions as F

    from aurum.plans import files
    from conftest import SF_SMALL
    meta, man = files.load_fixtures(spark, SF_SMALL)
    root = scratch_path(spark, name)
    part = lambda key: F.concat(F.lit("part_"), F.pmod(F.xxhash64(key), F.lit(uploads)), F.lit("_20260601T000000Z.csv"))
    files.land_uploads(meta, part("encounter_id"), files.META_COLS, f"{root}/meta")
    files.land_uploads(man, part("ssn"), files.MANIFEST_COLS, f"{root}/man")
    return meta, man, root


def _stream(spark, root):
    from aurum import config
    from aurum.plans import files
    from aurum.streaming.incremental import stream_increments
    return stream_increments(spark, f"{root}/meta", f"{root}/man", f"{root}/lake", f"{root}/ckpt", files.FIXTURE_METADATA_SCHEMA,
                             config.MANIFEST_RAW_SCHEMA, buckets=16, max_files_per_trigger=1)


def test_imaging_uploads_rewrite_gold_rarely(spark, monkeypatch):
    """One file per trigger on both sides: the joined Silver and the Gold are
    rewritten for many batches at once, not for each upload."""
    meta, man, root = _landed(spark, "t-stream-gold", 5)
    written, put = [], incremental._put_buckets
    monkeypatch.setattr(incremental, "_put_buckets", lambda spark, df, path, *a: written.append(path.rsplit("/", 1)[1]) or put(spark, df, path, *a))
    assert _stream(spark, root) == {"metadata_batches": 5, "manifest_batches": 5}
    assert sorted(written) == ["gold_research", "silver_joined", "silver_latest"]
    got, want = _gold(spark, f"{root}/lake", meta, man)
    assert got == want


def test_a_stopped_stream_is_caught_up_by_the_next(spark, monkeypatch):
    """Batches kept in Bronze and not applied, because the call stopped, are
    applied by the next call though the stream doesn't deliver them again."""
    import pytest

    meta, man, root = _landed(spark, "t-stream-stop", 5)
    apply, failed = incremental.apply_increment, []

    def stops(*args, increment_id, **options):
        if increment_id in ("metadata-1", "metadata-3") and len(failed) < 2:
            failed.append(increment_id)
            raise RuntimeError("stopped")
        return apply(*args, increment_id=increment_id, **options)

    monkeypatch.setattr(incremental, "apply_increment", stops)
    with pytest.raises(Exception, match="stopped"):
        _stream(spark, root)
    for _ in range(3):
        try:
            _stream(spark, root)
            break
        except RuntimeError:  # the second one
            continue
    got, want = _gold(spark, f"{root}/lake", meta, man)
    assert got == want and failed
    assert not os.listdir(f"{_local(root)}/lake/bronze_metadata.pending")
    assert _stream(spark, root) == {"metadata_batches": 0, "manifest_batches": 0}
