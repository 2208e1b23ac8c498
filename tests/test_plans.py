"""Physical-plan properties that matter at scale."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as E
from aurum import config
from aurum.plans import files, layers
from aurum.sources import csv
from aurum.session import scratch_path

from conftest import SF_SMALL

PURE_KEYS = [k for k in sorted(E.queries()) if E.queries()[k].__module__.endswith("queries")
             and k not in ("site_native_view", "synth_metadata", "synth_manifest", "source_profile")]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    prev_aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    spark.conf.set("spark.sql.adaptive.enabled", prev_aqe)


@pytest.mark.parametrize("key", PURE_KEYS)
def test_no_python_in_plan(spark, key):
    plan = plan_of(E.queries()[key](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                 "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, f"{key}: {node}"


def test_dedup_limits_before_shuffle(spark, no_broadcast):
    plan = plan_of(E.queries()["dedup_latest"](spark, SF_SMALL))
    partial = plan.find("WindowGroupLimit")
    exchange = plan.find("Exchange hashpartitioning(ssn")
    assert "Partial" in plan and "Final" in plan
    # The tree string lists parents first: the exchange sits above the partial limit.
    assert 0 <= exchange < plan.rfind("WindowGroupLimit") and partial >= 0


def test_join_is_over_two_plain_shuffles(spark, no_broadcast):
    """Both sides of the salted join are shuffles by key and salt, which
    adaptive execution can split; the dedup's window lies below its own."""
    plan = plan_of(E.queries()["silver_joined"](spark, SF_SMALL))
    assert "SortMergeJoin" in plan
    assert len(re.findall(r"Exchange hashpartitioning\(ssn#\d+, _salt#\d+", plan)) == 2
    join = plan.index("SortMergeJoin")
    assert plan.index("Exchange hashpartitioning(ssn", join) < plan.index("Window", join)


def test_fixture_scan_prunes_columns(spark):
    df = E.queries()["cohort_summary"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas, plan
    for s in schemas:
        cols = {c.split(":")[0] for c in s.split(",")}
        assert cols <= {"o_orderkey", "o_custkey", "o_orderdate", "c_custkey"}, s


def test_site_read_prunes_partitions(spark):
    path = scratch_path(spark, "t-prune")
    meta, man = files.load_fixtures(spark, SF_SMALL)
    from aurum.sinks import writers
    writers.export_by_site(layers.silver_joined(meta, man), path)
    plan = plan_of(writers.read_site(spark, path, "CHOC"))
    assert re.search(r"PartitionFilters: \[[^\]]*site_key[^\]]*CHOC", plan), plan


def test_csv_key_filter_pushed_down(spark):
    path = files.write_csv(files.load_fixtures(spark, SF_SMALL)[0], scratch_path(spark, "t-push"))
    bronze = csv.good_rows(csv.ingest_bronze(spark, path, files.FIXTURE_METADATA_SCHEMA, "t", "d"))
    plan = plan_of(layers.silver_metadata(bronze))
    assert re.search(r"PushedFilters: \[[^\]]*IsNotNull\(ssn\)", plan), plan


def test_no_driver_collection_in_core(spark):
    for key in ("silver_joined", "gold_research", "cohort_summary", "join_reconcile"):
        plan = plan_of(E.queries()[key](spark, SF_SMALL))
        assert "CollectLimit" not in plan


def test_gold_has_no_forbidden_columns(spark):
    gold = E.queries()["gold_research"](spark, SF_SMALL)
    assert not set(gold.columns) & {"ssn", "scan_date", *config.GOLD_COLUMNS_TO_DROP, "encounter_id"}
    assert gold.columns == list(config.GOLD_COLUMN_ORDER)


def test_lineage_filter_reaches_bronze_scan(spark):
    from aurum.plans.lineage import lineage_trace
    from aurum.plans.run import run_medallion
    from aurum.sinks import writers
    dirs = files.land_fixture(spark, SF_SMALL, "t-lineage-plan")
    base = f"{dirs['root']}/lake"
    run_medallion(spark, dirs["metadata"], dirs["dicom"], base, run_ts="t", run_date="2026-06-23",
                  metadata_schema=files.FIXTURE_METADATA_SCHEMA)
    ledger = files._ledger(spark, dirs)
    tx = ledger.where(ledger.file_name.startswith("choc_extract")).first()["tx_id"]
    out = lineage_trace(tx, ledger, writers.read_bronze(spark, f"{base}/bronze_metadata"),
                        spark.read.parquet(f"{base}/silver").drop("site_key"),
                        spark.read.parquet(f"{base}/gold_research"))
    plan = plan_of(out)
    assert re.search(r"PushedFilters: \[[^\]]*source_file", plan), plan


def test_vocabulary_join_is_broadcast(spark):
    from aurum.operators import clean
    meta = files.load_fixtures(spark, SF_SMALL)[0]
    vocab = spark.createDataFrame([(c, config.LABEL_NEGATIVE) for c in config.NEGATIVE_CODES]
                                  + [(c, config.LABEL_POSITIVE) for c in config.POSITIVE_CODES],
                                  "code string, label string")
    plan = plan_of(clean.harmonize_codes_by_table(meta, vocab))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_apply_scale_conf_sets_session(spark):
    from aurum.session import apply_scale_conf
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        conf = apply_scale_conf(spark, 10 * 2 ** 30, 16)
        assert spark.conf.get("spark.sql.shuffle.partitions") == conf["spark.sql.shuffle.partitions"] == "80"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
