"""Edge cases per operator (FIXTURES.md §2), compared as sets, never by position."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from aurum import config
from aurum.functions import expressions as X
from aurum.operators import clean, dedup, deid, headers, join, stats


def _one_col(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_reference_unit_case(spark):
    """The reference's own test: -1, NA, NULL, 1 -> No, No, No, Yes."""
    df = spark.createDataFrame([(1, "-1"), (2, "NA"), (3, None), (4, "1")], "i int, raw_code string")
    out = {r["i"]: r["lesion_label"] for r in clean.harmonize_codes(df, "raw_code").collect()}
    assert out == {1: "No Lesion Detected", 2: "No Lesion Detected", 3: "No Lesion Detected",
                   4: "Lesion Detected"}


@pytest.mark.parametrize("code,label,review", [
    (None, "No Lesion Detected", False), ("", "No Lesion Detected", False),
    ("  ", "No Lesion Detected", False), ("NA", "No Lesion Detected", False),
    (" n/a ", "No Lesion Detected", False), ("None", "No Lesion Detected", False),
    ("-1", "No Lesion Detected", False), ("1", "Lesion Detected", False),
    (" positive ", "Lesion Detected", False), ("POSITIVE", "Lesion Detected", False),
    ("EQUIVOCAL", "Pending Radiologist Review", True), ("negative", "Pending Radiologist Review", True),
    ("1.0", "Pending Radiologist Review", True), ("0", "Pending Radiologist Review", True),
])
def test_harmonize(spark, code, label, review):
    r = clean.harmonize_codes(_one_col(spark, [code]), "v").first()
    assert (r["lesion_label"], r["lesion_code_requires_review"]) == (label, review)


def test_harmonize_by_table_matches_literals(spark):
    codes = [None, "", "  ", "NA", " n/a ", "None", "-1", "1", " positive ", "EQUIVOCAL", "0"]
    vocab = spark.createDataFrame(
        [(c, config.LABEL_NEGATIVE) for c in config.NEGATIVE_CODES]
        + [(c, config.LABEL_POSITIVE) for c in config.POSITIVE_CODES], "code string, label string")
    df = _one_col(spark, codes)
    a = as_pairs(clean.harmonize_codes(df, "v"))
    b = as_pairs(clean.harmonize_codes_by_table(df, vocab, "v"))
    assert a == b


def as_pairs(df):
    return {(r["v"], r["lesion_label"], r["lesion_code_requires_review"]) for r in df.collect()}


def test_binary_mode(spark):
    out = {r["v"]: (r["lesion_label"], r["lesion_code_requires_review"])
           for r in clean.harmonize_codes(_one_col(spark, ["1", " Positive", "-1", "EQUIVOCAL", None]), "v",
                                          mode="binary").collect()}
    assert out["1"] == ("Lesion Detected", False)
    assert out[" Positive"] == ("Lesion Detected", True)  # review uses the untrimmed code
    assert out["-1"] == ("No Lesion Detected", False)
    assert out["EQUIVOCAL"] == ("No Lesion Detected", True)
    assert out[None] == ("No Lesion Detected", True)


@pytest.mark.parametrize("raw,expected", [
    ("7", 7), (" 7 ", 7), ("7.9", 7), ("-3", -3), ("x", None), ("", None), ("99999999999", None),
    ("1e1", None), ("7d", None), (None, None),
])
def test_safe_int(spark, raw, expected):
    assert _one_col(spark, [raw]).select(X.safe_int("v").alias("a")).first()["a"] == expected


@pytest.mark.parametrize("raw,expected", [
    ("2026-01-02", dt.date(2026, 1, 2)), ("2026-2-3", None), ("2026-02-30", None), ("bad", None),
    ("2026-01-02 10:00", None), (None, None), ("2026-13-40", None),
])
def test_safe_date(spark, raw, expected):
    assert _one_col(spark, [raw]).select(X.safe_date("v").alias("d")).first()["d"] == expected


def test_mask_key(spark):
    out = {r["v"]: r["k"] for r in _one_col(spark, ["P001", None]).select(
        "v", X.surrogate_key("v").alias("k")).collect()}
    assert out == {"P001": "df1e40051eff4bcf", None: None}
    salted = _one_col(spark, ["P001"]).select(X.surrogate_key("v", salt="s3cret").alias("k")).first()["k"]
    assert salted == hashlib.sha256(b"s3cretP001").hexdigest()[:16]


@pytest.mark.parametrize("uri,valid", [("s3://x", True), ("s3a://x", False), ("S3://x", False),
                                       ("http://x", False)])
def test_uri_flag(spark, uri, valid):
    assert _one_col(spark, [uri]).select(X.uri_is_valid("v").alias("f")).first()["f"] is valid


def test_site_partition_key(spark):
    out = [r["k"] for r in _one_col(spark, ["A B", "A/B", None]).select(
        X.site_partition_key("v").alias("k")).collect()]
    assert sorted(out, key=str) == sorted(["A_B", "A-B", None], key=str)


def test_confirmation_id(spark):
    df = spark.createDataFrame([(bytearray(b"abc"),)], "content binary")
    assert df.select(X.confirmation_id("content").alias("t")).first()["t"] == "TX-900150"


def test_upload_name_parts(spark):
    df = _one_col(spark, ["clinical_trial_batch_001_20260623T131804Z.csv", "plain.csv",
                          "x_20261340T000000Z.csv"])
    out = {r["v"]: (r["b"], r["t"]) for r in df.select(
        "v", X.upload_base_name("v").alias("b"), X.upload_time("v").alias("t")).collect()}
    assert out["clinical_trial_batch_001_20260623T131804Z.csv"] == (
        "clinical_trial_batch_001", dt.datetime(2026, 6, 23, 13, 18, 4))
    assert out["plain.csv"] == ("plain", None)
    assert out["x_20261340T000000Z.csv"][1] is None


def test_hash_pointer(spark):
    r = _one_col(spark, ["999-55-9876"]).select(X.hash_pointer("v", "s3://b/imaging/").alias("p")).first()
    assert r["p"] == "s3://b/imaging/scan_" + hashlib.md5(b"999-55-9876").hexdigest()[:8].upper() + ".dcm"


def test_ehr_from_site(spark):
    out = {r["v"]: r["e"] for r in _one_col(spark, ["CHOC", "choc", "Rady", None]).select(
        "v", X.ehr_from_site("v").alias("e")).collect()}
    assert out == {"CHOC": "Cerner", "choc": "Cerner", "Rady": "Epic", None: "Epic"}


def test_dedup_tiebreak_and_null_dates(spark):
    df = spark.createDataFrame([
        ("a", dt.date(2026, 1, 1), 1), ("a", dt.date(2026, 1, 1), 2),   # tie -> higher tiebreaker
        ("b", None, 3), ("b", dt.date(2025, 1, 1), 4),                    # real date beats NULL
        ("c", None, 5),
    ], "ssn string, scan_date date, enc int")
    out = {r["ssn"]: r["enc"] for r in dedup.keep_latest(df, "ssn", "scan_date", ["enc"]).collect()}
    assert out == {"a": 2, "b": 4, "c": 5}


def test_portal_demo_dedup(spark):
    """The portal demo frame: one key at both sites; the later date wins."""
    df = spark.createDataFrame([
        ("999-12-3456", "CHOC", 14, "2025-02-14", "1"), ("999-55-9876", "CHOC", 8, "2025-05-19", "-1"),
        ("999-88-1111", "CHOC", 11, "2026-01-10", "-1"), ("999-55-9876", "Rady", 8, "2025-06-01", "Positive"),
        ("999-44-2222", "Rady", 6, "2024-11-20", "None"),
    ], "ssn string, site_location string, age int, scan_date string, raw_lesion_status string")
    kept = dedup.keep_latest(df, "ssn", "scan_date", ["site_location"])
    assert kept.count() == 4
    assert kept.where(F.col("ssn") == "999-55-9876").first()["site_location"] == "Rady"
    st = dedup.dropped_by_dedup(df, "ssn").first()
    assert (st["rows_before"], st["rows_after"], st["dropped"]) == (5, 4, 1)


def test_join_fanout_and_reconcile(spark):
    meta = spark.createDataFrame([("a",), ("b",), ("c",)], "ssn string")
    man = spark.createDataFrame([("a", "s3://1", "MRI", "Brain", True), ("a", "s3://2", "MRI", "Brain", True),
                                 ("d", "s3://3", "MRI", "Brain", True)],
                                "ssn string, dicom_s3_uri string, modality string, body_region string, "
                                "uri_format_valid boolean")
    j = join.join_manifest(meta, man)
    assert j.count() == 2
    r = join.reconcile_join(meta, man).first()
    assert (r["metadata_ids"], r["manifest_ids"], r["joined_rows"]) == (3, 2, 2)
    assert r["unmatched_min_formula"] == 0            # fan-out hides the miss
    assert (r["metadata_only_ids"], r["manifest_only_ids"]) == (2, 1)
    sides = {(x["ssn"], x["side"]) for x in join.unmatched_ids(meta, man).collect()}
    assert sides == {("b", "metadata_only"), ("c", "metadata_only"), ("d", "manifest_only")}


def test_required_columns_error(spark):
    df = spark.createDataFrame([(1,)], "age int")
    with pytest.raises(ValueError, match="subject_surrogate_id"):
        deid.gold_ml_projection(df)


def test_column_purge_and_order(spark):
    df = spark.createDataFrame([(1, "x", "y", "z")], "age int, source_file string, zeta string, site_location string")
    out = deid.order_columns(deid.purge_columns(df, ["source_file", "absent"]))
    assert out.columns == ["age", "site_location", "zeta"]


def test_header_collision_raises(spark):
    df = spark.createDataFrame([("1", "2")], "cerner_id string, epic_id string")
    with pytest.raises(ValueError, match="both map to 'ssn'"):
        headers.rename_headers(df)


def test_fill_missing_columns_typed(spark):
    df = spark.createDataFrame([("a",)], "ssn string")
    out = clean.fill_missing_columns(df, {"age": None, "site_location": "CHOC"}, {"age": "int"})
    assert dict(out.dtypes) == {"ssn": "string", "age": "int", "site_location": "string"}
    assert out.first()["site_location"] == "CHOC"


def test_phi_audit_detects_identifier(spark):
    df = spark.createDataFrame([("s3://b/999-12-0001_scan1.dcm", 5), ("s3://b/x.dcm", 6)],
                               "imaging_s3_uri string, age int")
    rows = {r["column_name"]: r["identifier_values"] for r in stats.phi_audit(df).collect()}
    assert rows == {"imaging_s3_uri": 1, "age": 0}


def test_ordinal_within_matches_bruteforce(spark):
    """Dense per-group ordinals with a hot group holding most rows."""
    rows = [("hot" if i % 3 else f"g{i % 7}", i * 7919 % 1000, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "grp string, v int, id int")
    out = dedup.ordinal_within(df, order_cols=["v", "id"], group_cols=["grp"], name="o", num_partitions=16)
    got = {r["id"]: r["o"] for r in out.collect()}
    expected = {}
    by = {}
    for g, v, i in rows:
        by.setdefault(g, []).append((v, i))
    for g, items in by.items():
        for pos, (_, i) in enumerate(sorted(items)):
            expected[i] = pos
    assert got == expected


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_native_ids_per_site_bruteforce(spark):
    rows = [("CHOC" if i % 4 else " Rady ", f"P{i:04d}", i) for i in range(400)]
    df = spark.createDataFrame(rows, "site_location string, ssn string, enc int")
    out = headers.native_ids(df, order_cols=["ssn", "enc"])
    got = {r["enc"]: (r["native_id_column"], r["native_id"]) for r in out.collect()}
    choc = sorted((s, e) for site, s, e in rows if site == "CHOC")
    rady = sorted((s, e) for site, s, e in rows if site != "CHOC")
    exp = {e: ("cerner_id", f"C{i:05d}") for i, (_, e) in enumerate(choc)}
    exp.update({e: ("epic_id", f"E{i:05d}") for i, (_, e) in enumerate(rady)})
    assert got == exp


def test_site_native_view_rady_headers(spark):
    df = spark.createDataFrame([("P1", "Rady", "7", "2026-01-01", "NA")],
                               "ssn string, site_location string, age string, scan_date string, "
                               "raw_lesion_status string")
    out = headers.site_native_view(df, "Rady", order_cols=["ssn"])
    assert out.columns == ["epic_id", "ssn", "site_location", "age_in_years", "mri_date", "lesion_status"]
    assert out.first()["epic_id"] == "E00000"


def test_harmonize_headers_with_affiliation_default(spark):
    choc = spark.createDataFrame([("P1", "7", "2026-01-01", "1")],
                                 "cerner_id string, age string, scan_date string, lesion_status_code string")
    rady = spark.createDataFrame([("2026-02-02", "P2", "NA", "9", "Rady")],
                                 "mri_date string, epic_id string, lesion_status string, age_in_years string, "
                                 "site_location string")
    out = headers.harmonize_headers([choc, rady], defaults={"site_location": "CHOC"})
    assert out.columns == list(config.CANONICAL_UPLOAD_COLUMNS)
    assert {tuple(r) for r in out.collect()} == {("P1", "CHOC", "7", "2026-01-01", "1"),
                                                 ("P2", "Rady", "9", "2026-02-02", "NA")}


def test_synthetic_population_and_bernoulli_mode(spark):
    from aurum.sources import synthetic
    pop = synthetic.population(spark, 2000)
    assert pop.count() == 2000 and pop.agg(F.min("c_custkey"), F.max("c_custkey")).first()[:] == (1, 2000)
    exact = synthetic.synth_metadata(pop)
    bern = synthetic.synth_metadata(pop, missing="bernoulli")
    assert exact.where(F.col("lesion_status_code").isNull()).count() == 100          # exactly 5 %
    n_missing = bern.where(F.col("lesion_status_code").isNull()).count()
    assert 50 < n_missing < 160                                                        # about 5 %
    # Everything but the missing draw is identical between the modes.
    cols = ["ssn", "age", "site_location", "ehr_system", "scan_date"]
    assert {tuple(r) for r in exact.select(*cols).collect()} == {tuple(r) for r in bern.select(*cols).collect()}
    assert exact.select("ssn").distinct().count() == 2000


def test_raw_keys_of_other_patients_are_found(spark):
    """Another patient's id within a URI is reported; an id of nobody is not."""
    from aurum.operators import stats
    gold = spark.createDataFrame(
        [("a1", "s3://b/999-10-000002/x.dcm", "note 999-10-000001, 999-10-000002"), ("a2", "s3://b/123-45-6789.dcm", None),
         ("a3", "s3://b/999-10-000002.dcm", "999-10-00000")], "subject_surrogate_id string, imaging_s3_uri string, `free.text` string")
    raw = spark.createDataFrame([("999-10-000001",), (" 999-10-000002 ",), (None,)], "ssn string")
    found = {tuple(r) for r in stats.raw_key_leaks(gold, raw).collect()}
    assert found == {("imaging_s3_uri", 1, 2), ("free.text", 2, 2)}
    assert stats.raw_key_leaks(gold.select(F.lit(1).alias("n")), raw).count() == 0
