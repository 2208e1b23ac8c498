"""Record-level lineage: follow one upload through Bronze, Silver and Gold.

The confirmation id (or the full content hash) selects the landed file(s) in
the ledger; Bronze rows are those whose ``source_file`` is one of them; Silver
rows share their keys; Gold rows share the surrogate of those keys (recomputed,
since Gold has no raw key). Each stage is a semi-join, so only matching rows
are returned and no stage is gathered on the driver.
"""

from __future__ import annotations

from os.path import commonprefix

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aurum.functions.expressions import surrogate_key
from aurum.operators.headers import rename_headers

# File names up to this count become a filter that the Bronze scan is pruned
# by; more are a semi-join. The result is the same.
PUSHDOWN_FILES = 1_000
#: Partition column of a layer laid out for tracing.
TRACE_BUCKET = "_trace_bucket"


def trace_bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _of_keys(layer: DataFrame, keys: DataFrame, key: str, buckets: int | None) -> DataFrame:
    """The layer's rows of these keys. A layer laid out by buckets is read in
    the buckets of the keys only: their numbers, ``buckets`` at most, reach
    the driver and become a filter on the partitions."""
    if buckets and TRACE_BUCKET in layer.columns:
        hit = keys.agg(F.array_sort(F.collect_set(trace_bucket(key, buckets)))).first()[0]
        layer = layer.where(F.col(TRACE_BUCKET).isin(hit))
    return layer.drop(TRACE_BUCKET).join(keys, key, "left_semi")


def lineage_trace(tx_id: str, ledger: DataFrame, bronze: DataFrame, silver: DataFrame, gold: DataFrame,
                  key: str = "ssn", salt: str | None = None, include_landed: bool = True,
                  trace_buckets: int | None = None) -> DataFrame:
    """Long table ``(stage, record_key, payload)``; payload is the row as JSON.

    Stages: ``landed`` (the uploaded files as sent, site headers mapped to the
    canonical key), then ``bronze``, ``silver`` and ``gold``. ``tx_id`` is a
    short id or a full ``content_md5``; a short id that files of different
    content share is an error (ask for the hash). ``ledger`` should be a stored
    table (``append_ledger``): deriving ids reads every landed byte.

    ``trace_buckets`` is the bucket count that Silver and Gold were laid out in
    (``run_medallion``), to read only the buckets of the traced keys; layers
    without the bucket column are read whole.
    """
    asked = (F.col("tx_id") == tx_id) | (F.col("content_md5") == tx_id)
    # The files carrying this id: normally one, several for re-uploads of the
    # same bytes. No more of the names than become a filter reach the driver.
    files = ledger.where(asked).select("source_file", "content_md5").distinct()
    names = files.limit(PUSHDOWN_FILES + 1).collect()
    few = len(names) <= PUSHDOWN_FILES
    contents = {r["content_md5"] for r in names}
    if not few:
        contents |= {r[0] for r in files.agg(F.min("content_md5"), F.max("content_md5")).select(F.explode(F.array("*"))).collect()}
    if len(contents) > 1:
        raise ValueError(f"{tx_id} names {len(contents)} different files; trace one by its content_md5")
    files = files.select("source_file").distinct()
    paths = sorted({r["source_file"] for r in names})
    if few:  # row groups whose source_file range or Bloom filter excludes them are skipped
        raw = bronze.where(F.col("source_file").isin(paths))
    else:
        raw = bronze.join(files, "source_file", "left_semi")
    keys = raw.select(F.trim(F.col(key)).alias(key)).where(F.col(key).isNotNull()).distinct()
    silver_rows = _of_keys(silver, keys, key, trace_buckets)
    gold_keys = keys.select(surrogate_key(key, salt).alias("subject_surrogate_id"))
    gold_rows = _of_keys(gold, gold_keys, "subject_surrogate_id", trace_buckets)

    def longform(df: DataFrame, stage: str, key_col: str) -> DataFrame:
        cols = sorted(df.columns)
        return df.select(F.lit(stage).alias("stage"), F.col(key_col).cast("string").alias("record_key"),
                         F.to_json(F.struct(*cols)).alias("payload"))

    out = (longform(raw, "bronze", key)
           .unionByName(longform(silver_rows, "silver", key))
           .unionByName(longform(gold_rows, "gold", "subject_surrogate_id")))
    if include_landed and names:
        out = longform(_landed(bronze.sparkSession, files, paths, few), "landed", key).unionByName(out)
    return out


def _landed(spark, files: DataFrame, names: list[str], few: bool) -> DataFrame:
    """The rows of the landed files as the site sent them: its own headers,
    all text. The files have one content, so the first one's header is theirs."""
    reader = spark.read.option("header", True).option("inferSchema", False)
    if few:
        return rename_headers(reader.csv(names))
    # All below the folder that the names share, cut down to these files.
    first, last = files.agg(F.min("source_file"), F.max("source_file")).first()
    root = commonprefix([first, last]).rpartition("/")[0]
    every = reader.schema(reader.csv(first).schema).option("recursiveFileLookup", True).csv(root)
    own = every.withColumn("_file", F.col("_metadata.file_path")).join(files, F.col("_file") == F.col("source_file"), "left_semi")
    return rename_headers(own.drop("_file"))
