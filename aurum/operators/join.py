"""Metadata x manifest join, join reconciliation and ledger lookup.

The join is a plain equi-join: the optimizer (with AQE) broadcasts a side only
when its measured size is under the threshold, otherwise it sort-merges, and
AQE splits skewed keys (a patient with many scans) at runtime. It can only do
so while both inputs are plain shuffles, which a side that was deduplicated on
the same key is not: ``salted_join_manifest`` joins on the key and a salt, so
that such a side is dealt out anew, and splits heavy keys by itself besides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MANIFEST_JOIN_COLUMNS = {
    "dicom_s3_uri": "imaging_s3_uri",
    "modality": "modality",
    "body_region": "body_region",
    "uri_format_valid": "uri_format_valid",
}


def join_manifest(metadata: DataFrame, manifest: DataFrame, key: str = "ssn",
                  columns: dict[str, str] | None = None) -> DataFrame:
    """Inner join; one output row per matching manifest row (fan-out kept).

    The manifest (the side that fans out) is the streamed, left side and the
    one-row-per-key metadata the buffered, right side: a sort-merge join
    buffers the right side's rows per key, so a patient with very many scans
    never has to fit in memory. Output columns: metadata first, then imaging.
    """
    columns = columns or MANIFEST_JOIN_COLUMNS
    scans = manifest.select(key, *[F.col(src).alias(dst) for src, dst in columns.items()])
    joined = scans.join(metadata, on=key, how="inner")
    return joined.select(*metadata.columns, *[c for c in columns.values()])


#: Counters of the key sketch: a fixed size, whatever the number of keys.
SKETCH_SLOTS = 1 << 12
#: Scans of one patient that one task joins; more are split.
ROWS_PER_SPLIT = 500_000


def _slot(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(SKETCH_SLOTS)).cast("int")


def key_copies(manifest: DataFrame, key: str = "ssn", rows_per_split: int = ROWS_PER_SPLIT) -> Column:
    """Replication table of a salted join, as a scalar subquery: per hash slot
    of the key, over how many salts its manifest rows are spread.

    A sketch of ``SKETCH_SLOTS`` counters, summed on the map side, finds the
    slots of heavy keys: those with more rows than twice the average and
    ``rows_per_split`` besides. Keys that share a slot with a heavy one are
    spread as well, which costs copies and changes nothing else. Only the key
    column is read, in the same job that runs the join.
    """
    spark = manifest.sparkSession
    rows = manifest.select(_slot(key).alias("slot"), F.lit(1).cast("bigint").alias("n")).unionByName(
        spark.range(SKETCH_SLOTS, numPartitions=1).select(F.col("id").cast("int").alias("slot"), F.lit(0).cast("bigint").alias("n")))
    counts = rows.groupBy("slot").agg(F.sum("n").alias("n"))
    sketch = counts.agg(F.array_sort(F.collect_list(F.struct("slot", "n"))).alias("s"), F.sum("n").alias("rows"))
    spare = lambda x: x["n"] - 2 * F.col("rows") / SKETCH_SLOTS
    copies = F.transform("s", lambda x: F.greatest(F.lit(1), F.ceil(spare(x) / rows_per_split).cast("int")))
    return sketch.select(copies.alias("copies")).scalar()


def salted_join_manifest(metadata: DataFrame, manifest: DataFrame, key: str = "ssn", columns: dict[str, str] | None = None,
                         spread_by: Sequence[str] = ("dicom_s3_uri",), rows_per_split: int = ROWS_PER_SPLIT,
                         counted: DataFrame | None = None) -> DataFrame:
    """``join_manifest`` with heavy keys split over several tasks, planned
    lazily: nothing runs or is written until the result is used, and columns
    that the caller drops are pruned through it.

    A patient's scans get a salt below the patient's entry in the replication
    table (``key_copies``), and the patient's one metadata row a copy per salt.
    The salt is a hash of ``spread_by``, so a task that runs again deals the
    same rows to the same salts. ``metadata`` must hold a key once. ``counted``
    is the manifest that the sketch reads, if not ``manifest`` itself (one that
    carries no Observation).
    """
    columns = columns or MANIFEST_JOIN_COLUMNS
    copies = key_copies(manifest if counted is None else counted, key, rows_per_split)
    salt, own = "_salt", metadata.columns
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in spread_by]), F.get(copies, _slot(key))).cast("int")
    scans = manifest.select(key, spread.alias(salt), *[F.col(src).alias(dst) for src, dst in columns.items()])
    dealt = metadata.withColumn(salt, F.explode(F.sequence(F.lit(0), F.get(copies, _slot(key)) - 1)))
    joined = scans.join(dealt, on=[key, salt], how="inner")
    return joined.select(*own, *columns.values())


def reconcile_join(metadata: DataFrame, manifest: DataFrame, key: str = "ssn",
                   metadata_deduplicated: bool = False) -> DataFrame:
    """One-row reconciliation of an inner join on ``key``.

    Reports distinct ids on each side, joined rows, the legacy
    ``max(0, min(ids) - joined_rows)`` estimate and the exact number of ids
    present on only one side (anti-joins), which the estimate hides whenever
    the manifest fans out.

    ``metadata_deduplicated=True`` reconciles the join the metadata will
    have *after* keep-latest dedup (one row per id) without running the
    dedup: only the set of ids matters, so a cheap distinct suffices.
    """
    # Per-id multiplicities: joined rows = sum over shared ids of m_count * d_count.
    m_cnt = metadata.groupBy(key).agg(F.count(F.lit(1)).alias("_m"))
    if metadata_deduplicated:
        m_cnt = m_cnt.withColumn("_m", F.lit(1).cast("bigint"))
    d_cnt = manifest.groupBy(key).agg(F.count(F.lit(1)).alias("_d"))
    both = m_cnt.join(d_cnt, key, "full_outer").where(F.col(key).isNotNull())
    stats = both.agg(
        F.count_if(F.col("_m").isNotNull()).alias("metadata_ids"),
        F.count_if(F.col("_d").isNotNull()).alias("manifest_ids"),
        F.coalesce(F.sum(F.col("_m") * F.col("_d")), F.lit(0)).alias("joined_rows"),
        F.count_if(F.col("_m").isNotNull() & F.col("_d").isNull()).alias("metadata_only_ids"),
        F.count_if(F.col("_d").isNotNull() & F.col("_m").isNull()).alias("manifest_only_ids"),
    )
    return stats.select(
        F.col("metadata_ids").cast("bigint").alias("metadata_ids"),
        F.col("manifest_ids").cast("bigint").alias("manifest_ids"),
        F.col("joined_rows").cast("bigint").alias("joined_rows"),
        F.greatest(F.lit(0), F.least("metadata_ids", "manifest_ids") - F.col("joined_rows"))
        .cast("bigint").alias("unmatched_min_formula"),
        F.col("metadata_only_ids").cast("bigint").alias("metadata_only_ids"),
        F.col("manifest_only_ids").cast("bigint").alias("manifest_only_ids"),
    )


def reconciliation(metadata_ids: int, manifest_ids: int, joined_rows: int, matched_ids: int) -> dict[str, int]:
    """``reconcile_join``'s row from counts taken on the way: ids of the
    deduplicated metadata, distinct ids of the manifest, rows of the join and
    distinct ids in it."""
    return {"metadata_ids": metadata_ids, "manifest_ids": manifest_ids, "joined_rows": joined_rows,
            "unmatched_min_formula": max(0, min(metadata_ids, manifest_ids) - joined_rows),
            "metadata_only_ids": metadata_ids - matched_ids, "manifest_only_ids": manifest_ids - matched_ids}


def unmatched_ids(metadata: DataFrame, manifest: DataFrame, key: str = "ssn") -> DataFrame:
    """The ids present on exactly one side, with the side they are on."""
    m = metadata.select(key).where(F.col(key).isNotNull()).distinct()
    d = manifest.select(key).where(F.col(key).isNotNull()).distinct()
    only_m = m.join(d, key, "left_anti").withColumn("side", F.lit("metadata_only"))
    only_d = d.join(m, key, "left_anti").withColumn("side", F.lit("manifest_only"))
    return only_m.unionByName(only_d)


def ledger_lookup(requests: DataFrame, ledger: DataFrame, default_id: str,
                  id_col: str = "tx_id") -> DataFrame:
    """Resolve requested confirmation ids against the ledger.

    A request may be the short id or the full ``content_md5``. Unknown ids
    fall back to ``default_id``; the result carries the requested id, the
    resolved id, whether it was found, whether it is ``ambiguous`` (files of
    different content share the short id; each gives a row), and the ledger
    attributes.

    Unknown requests never meet on the default's key: its one entry is looked
    up beforehand and attached as constants. A default that is unknown or
    ambiguous is an error.
    """
    files = ledger.columns
    default = ledger.where(F.col(id_col) == default_id).limit(2).collect()
    if len(default) != 1:
        raise ValueError(f"default id {default_id!r} names {'no' if not default else 'more than one'} landed file")
    contents = ledger.groupBy(id_col).agg((F.min("content_md5") != F.max("content_md5")).alias("ambiguous"))
    known = ledger.join(contents, id_col)
    by_id = known.select(F.col(id_col).alias("_asked"), "*")
    by_hash = known.select(F.col("content_md5").alias("_asked"), "*").withColumn("ambiguous", F.lit(False))
    asked = requests.select(F.col(id_col).alias("requested_id"))
    found = asked.join(by_id.unionByName(by_hash), F.col("requested_id") == F.col("_asked"), "left")
    attached = [F.when(F.col("_asked").isNull(), F.lit(default[0][c]).cast(ledger.schema[c].dataType)).otherwise(F.col(c)).alias(c)
                for c in files]
    return found.select("requested_id", F.col("_asked").isNotNull().alias("found"),
                        F.coalesce("ambiguous", F.lit(False)).alias("ambiguous"), *attached)
