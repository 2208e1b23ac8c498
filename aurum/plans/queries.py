"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory.

Every query reads the benchmark tables in ``sf_dir`` (through the clinical
fixture views or directly) and runs over the whole tables. Computed columns
carry explicit aliases that match the oracle SQL in ``aurum.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aurum import config
from aurum.functions import expressions as X
from aurum.operators import clean, dedup, deid, headers, join, stats
from aurum.plans import layers
from aurum.sources.fixtures import load_fixtures, read_table
from aurum.sources import synthetic
from aurum.session import written

RUN_TS = "2026-06-23T13:18:04Z"
RUN_DATE = "2026-06-23"
POINTER_BASE = "s3://imaging-pointers/imaging/"

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def register(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return register


# ---------------------------------------------------------------- shared inputs

def _silver_meta(spark, sf_dir) -> DataFrame:
    meta, _ = load_fixtures(spark, sf_dir)
    return layers.silver_metadata(meta)


def _silver_manifest(spark, sf_dir) -> DataFrame:
    _, man = load_fixtures(spark, sf_dir)
    return layers.silver_manifest(man)


def _silver_joined(spark, sf_dir) -> DataFrame:
    meta, man = load_fixtures(spark, sf_dir)
    return layers.silver_joined(meta, man)


def _gold(spark, sf_dir) -> DataFrame:
    return layers.gold_dataset(_silver_joined(spark, sf_dir))


# ---------------------------------------------------------------- projections / filters

@query("lineage_append")
def q_lineage_append(spark, sf_dir):
    meta, _ = load_fixtures(spark, sf_dir)
    return clean.add_lineage(meta, RUN_TS, RUN_DATE, source_file="landing/metadata/fx_metadata.csv")


@query("required_key_filter")
def q_required_key_filter(spark, sf_dir):
    meta, _ = load_fixtures(spark, sf_dir)
    return clean.require_keys(meta, "ssn")


@query("trim_columns")
def q_trim_columns(spark, sf_dir):
    meta, _ = load_fixtures(spark, sf_dir)
    return clean.trim_columns(meta, ["ssn", "site_location", "ehr_system", "lesion_status_code", "scan_date"])


@query("safe_int_cast")
def q_safe_int_cast(spark, sf_dir):
    meta, _ = load_fixtures(spark, sf_dir)
    return meta.select("encounter_id", F.col("age").alias("age_raw"), X.safe_int("age").alias("age"))


@query("safe_date_parse")
def q_safe_date_parse(spark, sf_dir):
    meta, _ = load_fixtures(spark, sf_dir)
    return meta.select("encounter_id", F.col("scan_date").alias("scan_date_raw"),
                       X.safe_date(F.trim("scan_date")).alias("scan_date"))


@query("site_upper")
def q_site_upper(spark, sf_dir):
    meta, _ = load_fixtures(spark, sf_dir)
    return clean.canonicalize_site(meta).select("encounter_id", "site_location")


@query("code_harmonize")
def q_code_harmonize(spark, sf_dir):
    meta, _ = load_fixtures(spark, sf_dir)
    return clean.harmonize_codes(meta).select("encounter_id", "lesion_status_code", "lesion_label")


@query("code_review_flag")
def q_code_review_flag(spark, sf_dir):
    meta, _ = load_fixtures(spark, sf_dir)
    return clean.harmonize_codes(meta).select("encounter_id", "lesion_status_code",
                                              "lesion_code_requires_review")


@query("code_harmonize_binary")
def q_code_harmonize_binary(spark, sf_dir):
    meta, _ = load_fixtures(spark, sf_dir)
    return clean.harmonize_codes(meta, mode="binary").select(
        "encounter_id", "lesion_status_code", "lesion_label", "lesion_code_requires_review")


@query("quality_flag")
def q_quality_flag(spark, sf_dir):
    return _silver_meta(spark, sf_dir).select("encounter_id", "age", "scan_date", "has_data_quality_flag")


@query("silver_metadata")
def q_silver_metadata(spark, sf_dir):
    return _silver_meta(spark, sf_dir)


@query("manifest_clean")
def q_manifest_clean(spark, sf_dir):
    _, man = load_fixtures(spark, sf_dir)
    kept = clean.require_keys(man, "ssn", "dicom_s3_uri")
    return kept.select("ssn", "dicom_s3_uri", X.upper_trim("modality").alias("modality"))


@query("silver_manifest")
def q_silver_manifest(spark, sf_dir):
    return _silver_manifest(spark, sf_dir)


@query("initcap_region")
def q_initcap_region(spark, sf_dir):
    _, man = load_fixtures(spark, sf_dir)
    return man.select("ssn", F.col("body_region").alias("body_region_raw"),
                      X.title_case("body_region").alias("body_region"))


@query("uri_flag")
def q_uri_flag(spark, sf_dir):
    _, man = load_fixtures(spark, sf_dir)
    return man.select("ssn", "dicom_s3_uri", X.uri_is_valid("dicom_s3_uri").alias("uri_format_valid"))


@query("derive_ehr")
def q_derive_ehr(spark, sf_dir):
    meta = _silver_meta(spark, sf_dir)
    return meta.select("encounter_id", "site_location", X.ehr_from_site("site_location").alias("ehr_system"))


@query("hash_pointer")
def q_hash_pointer(spark, sf_dir):
    s = layers.silver_latest(_silver_meta(spark, sf_dir))
    return deid.rewrite_pointer(s, "ssn", POINTER_BASE, "imaging_pointer").select("ssn", "imaging_pointer")


@query("mask_key")
def q_mask_key(spark, sf_dir):
    return deid.mask_key(_silver_meta(spark, sf_dir)).select("encounter_id", "subject_surrogate_id")


@query("reduce_date")
def q_reduce_date(spark, sf_dir):
    return deid.generalize_date(_silver_meta(spark, sf_dir)).select("encounter_id", "enrollment_year")


@query("column_purge")
def q_column_purge(spark, sf_dir):
    meta, man = load_fixtures(spark, sf_dir)
    bronze = clean.add_lineage(meta, RUN_TS, RUN_DATE, source_file="landing/metadata/fx_metadata.csv")
    return deid.purge_columns(layers.silver_joined(bronze, man))


@query("column_order")
def q_column_order(spark, sf_dir):
    s = deid.generalize_date(deid.mask_key(_silver_joined(spark, sf_dir)))
    return deid.order_columns(s)


@query("gold_preview")
def q_gold_preview(spark, sf_dir):
    s = layers.silver_latest(_silver_meta(spark, sf_dir))
    return deid.gold_preview(s, POINTER_BASE)


@query("filter_flagged")
def q_filter_flagged(spark, sf_dir):
    return _gold(spark, sf_dir).where(F.col("lesion_code_requires_review"))


@query("fill_missing_columns")
def q_fill_missing_columns(spark, sf_dir):
    """An upload lacking the site and code columns: the site comes from the
    uploader's affiliation, the code becomes a typed NULL."""
    meta, _ = load_fixtures(spark, sf_dir)
    upload = meta.select("ssn", "age", "scan_date", "encounter_id")
    filled = clean.fill_missing_columns(upload, {"site_location": "CHOC", "raw_lesion_status": None})
    return filled.select("encounter_id", *config.CANONICAL_UPLOAD_COLUMNS)


@query("site_native_view")
def q_site_native_view(spark, sf_dir):
    meta, _ = load_fixtures(spark, sf_dir)
    canonical = meta.select("ssn", "site_location", "age", "scan_date",
                            F.col("lesion_status_code").alias("raw_lesion_status"), "encounter_id")
    return headers.site_native_view(canonical, "CHOC", order_cols=["encounter_id"])


@query("confirmation_id")
def q_confirmation_id(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", X.confirmation_id(F.col("text").cast("binary")).alias("tx_id"))


# ---------------------------------------------------------------- windows / joins

@query("dedup_latest")
def q_dedup_latest(spark, sf_dir):
    return layers.silver_latest(_silver_meta(spark, sf_dir))


@query("dedup_latest_str")
def q_dedup_latest_str(spark, sf_dir):
    """Keep-latest on the raw extract, ordering by the date *text*."""
    meta, _ = load_fixtures(spark, sf_dir)
    return dedup.keep_latest(meta, "ssn", "scan_date", ["encounter_id"])


@query("silver_join")
def q_silver_join(spark, sf_dir):
    """The join alone, of the latest record per patient (read from a table)
    with all its scans."""
    latest = written(layers.silver_latest(_silver_meta(spark, sf_dir)), "latest")
    return join.join_manifest(latest, _silver_manifest(spark, sf_dir))


@query("silver_joined")
def q_silver_joined(spark, sf_dir):
    return _silver_joined(spark, sf_dir)


@query("join_reconcile")
def q_join_reconcile(spark, sf_dir):
    meta = layers.silver_latest(_silver_meta(spark, sf_dir))
    return join.reconcile_join(meta, _silver_manifest(spark, sf_dir))


@query("join_unmatched")
def q_join_unmatched(spark, sf_dir):
    meta = layers.silver_latest(_silver_meta(spark, sf_dir))
    return join.unmatched_ids(meta, _silver_manifest(spark, sf_dir))


@query("preview_head")
def q_preview_head(spark, sf_dir):
    """First rows of an extract in a deterministic order (a top-k report)."""
    meta, _ = load_fixtures(spark, sf_dir)
    return meta.orderBy("encounter_id").limit(5)


# ---------------------------------------------------------------- Gold + aggregates

@query("gold_research")
def q_gold_research(spark, sf_dir):
    return _gold(spark, sf_dir)


@query("clean_stats")
def q_clean_stats(spark, sf_dir):
    return stats.clean_stats(_silver_meta(spark, sf_dir))


@query("cohort_summary")
def q_cohort_summary(spark, sf_dir):
    return stats.cohort_summary(_gold(spark, sf_dir))


@query("label_distribution")
def q_label_distribution(spark, sf_dir):
    return stats.label_distribution(_gold(spark, sf_dir))


@query("age_distribution")
def q_age_distribution(spark, sf_dir):
    return stats.age_distribution(_gold(spark, sf_dir))


@query("distinct_sites")
def q_distinct_sites(spark, sf_dir):
    return stats.distinct_values(_silver_joined(spark, sf_dir), "site_location")


@query("dedup_stats")
def q_dedup_stats(spark, sf_dir):
    return dedup.dropped_by_dedup(_silver_meta(spark, sf_dir), "ssn")


@query("invalid_uri_count")
def q_invalid_uri_count(spark, sf_dir):
    return stats.invalid_uri_count(_silver_manifest(spark, sf_dir))


@query("dq_audit")
def q_dq_audit(spark, sf_dir):
    return stats.dq_audit(_silver_meta(spark, sf_dir))


@query("phi_audit")
def q_phi_audit(spark, sf_dir):
    return stats.phi_audit(_gold(spark, sf_dir))


# ---------------------------------------------------------------- generic operators on raw tables

@query("dedup_latest_orders")
def q_dedup_latest_orders(spark, sf_dir):
    """Keep-latest on a non-clinical table: each customer's newest order."""
    orders = read_table(spark, sf_dir, "orders")
    return dedup.keep_latest(orders, "o_custkey", "o_orderdate", ["o_orderkey"])


@query("mask_key_events")
def q_mask_key_events(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    masked = deid.mask_key(ev.select("event_id", F.col("user_id").cast("string").alias("user_id"), "ts"),
                           "user_id", out_col="user_surrogate_id")
    return deid.generalize_date(masked, "ts", "event_year")


@query("age_distribution_lineitem")
def q_age_distribution_lineitem(spark, sf_dir):
    """The distribution operator on a non-clinical measure (quantity per flag)."""
    li = read_table(spark, sf_dir, "lineitem")
    return stats.age_distribution(li.select("l_returnflag", "l_quantity"), by="l_returnflag",
                                  value="l_quantity")


# ---------------------------------------------------------------- synthetic generator

@query("synth_metadata")
def q_synth_metadata(spark, sf_dir):
    return synthetic.synth_metadata(read_table(spark, sf_dir, "customer"))


@query("synth_manifest")
def q_synth_manifest(spark, sf_dir):
    return synthetic.synth_manifest(synthetic.synth_metadata(read_table(spark, sf_dir, "customer")))


@query("source_profile")
def q_source_profile(spark, sf_dir):
    return stats.source_profile(synthetic.synth_metadata(read_table(spark, sf_dir, "customer")))


def _synth_silver(spark, sf_dir) -> DataFrame:
    meta = synthetic.synth_metadata(read_table(spark, sf_dir, "customer"))
    return layers.silver_joined(meta, synthetic.synth_manifest(meta), tiebreakers=())


@query("phi_audit_synth")
def q_phi_audit_synth(spark, sf_dir):
    """PHI audit of a Gold dataset whose source URIs embed the raw identifier."""
    return stats.phi_audit(layers.gold_dataset(_synth_silver(spark, sf_dir), extra_drop=()))


@query("phi_key_leak")
def q_phi_key_leak(spark, sf_dir):
    """Rows whose published imaging URI contains the raw key (checked before masking)."""
    return stats.key_leak_count(_synth_silver(spark, sf_dir))


@query("phi_raw_keys")
def q_phi_raw_keys(spark, sf_dir):
    """Raw keys of any patient within the text columns of Gold."""
    silver = _synth_silver(spark, sf_dir)
    return stats.raw_key_leaks(layers.gold_dataset(silver, extra_drop=()), silver)


@query("gold_pointer_rewrite")
def q_gold_pointer_rewrite(spark, sf_dir):
    """Gold with identifier-bearing URIs replaced by hash pointers."""
    return layers.gold_dataset(_synth_silver(spark, sf_dir), extra_drop=(), pointer_base=POINTER_BASE)
