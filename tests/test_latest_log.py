"""Keep-latest as a log of deltas, and commits."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from aurum.operators import dedup
from aurum.plans import latest_log
from aurum.session import scratch_path
from aurum.sinks import commits

SCHEMA = "ssn string, scan_date date, enc int"


def frame(spark, lo, hi):
    return spark.createDataFrame([("HOT" if i % 3 == 0 else f"P{i % 400}", dt.date(2026, 1, 1) + dt.timedelta(days=i % 97) if i % 11 else None, i)
                                  for i in range(lo, hi)], SCHEMA)


def rows(df):
    return sorted((r["ssn"], r["scan_date"] or dt.date.min, r["enc"]) for r in df.collect())


def size(path):
    root = path.removeprefix("file://").removeprefix("file:")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet"))


def test_deltas_equal_one_dedup_before_and_after_compaction(spark):
    path = scratch_path(spark, "t-log")
    for i in range(4):
        latest_log.append(spark, frame(spark, 600 * i, 600 * (i + 1)), path, f"day-{i}", tiebreakers=["enc"])
        want = rows(dedup.keep_latest(frame(spark, 0, 600 * (i + 1)), "ssn", "scan_date", ["enc"]))
        assert rows(latest_log.read(spark, path)) == want
    version = latest_log.compact(spark, path)
    assert rows(latest_log.read(spark, path)) == want
    assert latest_log.compact(spark, path) == version  # nothing left to fold
    assert latest_log.vacuum(spark, path) == 3
    assert rows(latest_log.read(spark, path)) == want


def test_an_append_writes_in_proportion_to_its_increment(spark):
    path = scratch_path(spark, "t-log-bytes")
    big = spark.range(60_000).selectExpr("sha2(cast(id as string), 256) as ssn", "date'2026-01-01' as scan_date", "cast(id as int) as enc")
    latest_log.append(spark, big, path, "first", tiebreakers=["enc"])
    before = size(path)
    latest_log.append(spark, big.limit(20).coalesce(1), path, "second", tiebreakers=["enc"])
    assert 0 < size(path) - before < before / 100


def test_a_recent_increment_is_replaced_and_a_folded_one_refused(spark):
    path = scratch_path(spark, "t-log-again")
    day = lambda d, enc: spark.createDataFrame([("a", dt.date(2026, 1, d), enc)], SCHEMA)
    latest_log.append(spark, day(1, 1), path, "one")
    latest_log.append(spark, day(9, 2), path, "two")
    latest_log.append(spark, day(5, 3), path, "two")  # corrected: no longer the ninth
    assert rows(latest_log.read(spark, path)) == [("a", dt.date(2026, 1, 5), 3)]
    latest_log.compact(spark, path)
    latest_log.append(spark, day(3, 4), path, "two")  # still a delta
    assert rows(latest_log.read(spark, path)) == [("a", dt.date(2026, 1, 3), 4)]
    with pytest.raises(ValueError, match="part of the base"):
        latest_log.append(spark, day(2, 5), path, "one")
    with pytest.raises(ValueError, match="keeps the latest by"):
        latest_log.append(spark, day(2, 5), path, "three", tiebreakers=["enc"])
    with pytest.raises(ValueError, match="columns"):
        latest_log.append(spark, day(2, 5).drop("enc"), path, "three")


def test_many_deltas_are_compacted_on_the_way(spark):
    path = scratch_path(spark, "t-log-many")
    for i in range(5):
        latest_log.append(spark, frame(spark, 50 * i, 50 * i + 50), path, f"d{i}", tiebreakers=["enc"], max_deltas=2)
    _, state = latest_log._state(spark, path)
    assert state["base"] and len(state["deltas"]) <= 2
    assert rows(latest_log.read(spark, path)) == rows(dedup.keep_latest(frame(spark, 0, 250), "ssn", "scan_date", ["enc"]))


def test_an_empty_increment_and_a_stopped_writer(spark):
    path = scratch_path(spark, "t-log-empty")
    with pytest.raises(ValueError, match="no committed version"):
        latest_log.read(spark, path)
    latest_log.append(spark, frame(spark, 0, 0), path, "none", tiebreakers=["enc"])
    assert rows(latest_log.read(spark, path)) == []
    latest_log.append(spark, frame(spark, 0, 9), path, "some", tiebreakers=["enc"])
    want = rows(latest_log.read(spark, path))
    # Data written without a commit, and a commit that was cut off: neither counts.
    frame(spark, 0, 99).write.parquet(f"{path}/delta-stopped")
    with open(path.removeprefix("file://").removeprefix("file:") + "/_versions/000000000009.json", "w") as f:
        f.write('{"base": nul')
    assert rows(latest_log.read(spark, path)) == want
    assert latest_log.append(spark, frame(spark, 9, 12), path, "more", tiebreakers=["enc"]) == 10


def test_a_version_is_taken_once(spark):
    folder = scratch_path(spark, "t-commits")
    assert commits.newest(spark, folder) == (-1, None)
    commits.commit(spark, folder, 0, {"a": "ü"})
    with pytest.raises(commits.Conflict):
        commits.commit(spark, folder, 0, {"a": 2})
    assert commits.newest(spark, folder) == (0, {"a": "ü"})
