"""Incremental keep-latest: apply a day's records to the Silver state without
recomputing history.

The state (one row per key) is a table partitioned by a hash bucket of the
key. An increment touches only the buckets of its keys: those partitions are
read (partition pruning), unioned with the new rows, reduced with
``keep_latest`` and written back with dynamic partition overwrite, so the work
is proportional to the increment and the buckets it hits, not to history.
The result equals ``keep_latest`` over all rows ever applied.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from aurum.operators.dedup import keep_latest
from aurum.session import child_names, delete_path, ensure_checkpoint_dir, make_folder, path_exists, read_text, stored_bytes
from aurum.sinks import writers

BUCKET_COLUMN = "_key_bucket"


def key_bucket(key: str, buckets: int) -> F.Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _check_buckets(spark: SparkSession, path: str, buckets: int) -> None:
    """The bucket count is part of a state's layout: stored beside it at first
    use, and any other value is refused afterwards."""
    beside = f"{path.rstrip('/')}.buckets"
    if path_exists(spark, beside):
        part = next(n for n in child_names(spark, beside) if n.startswith("part-"))
        stored = json.loads(read_text(spark, f"{beside}/{part}"))["buckets"]
        if stored != buckets:
            raise ValueError(f"{path} is laid out in {stored} buckets, not {buckets}")
    else:
        spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").json(beside)


def _by_bucket(spark: SparkSession, df: DataFrame, buckets: int) -> DataFrame:
    """The rows of a bucket in one task, so that a bucket is one file and not
    one per task of the step before."""
    return df.repartition(min(buckets, int(spark.conf.get("spark.sql.shuffle.partitions"))), BUCKET_COLUMN)


def _put_buckets(spark: SparkSession, df: DataFrame, path: str, buckets: int, fmt: str) -> None:
    """Write ``df`` as the whole content of the buckets that it has rows of. It
    may be read from these: their files are replaced when all tasks are done."""
    writers.write_table(_by_bucket(spark, df, buckets), path, fmt, partition_by=[BUCKET_COLUMN], dynamic=True)


def _replace_buckets(spark: SparkSession, df: DataFrame, path: str, touched: Sequence[int], buckets: int, fmt: str) -> None:
    """Write ``df`` as the whole content of the ``touched`` buckets; buckets
    left without a row lose their partition."""
    ensure_checkpoint_dir(spark)
    # The touched partitions may be both read and replaced: the result is on
    # shared storage (reliable checkpoint) before they are overwritten.
    df = df.checkpoint(eager=True)
    filled = {r[0] for r in df.select(BUCKET_COLUMN).distinct().collect()}
    _put_buckets(spark, df, path, buckets, fmt)
    for b in set(touched) - filled:
        delete_path(spark, f"{path}/{BUCKET_COLUMN}={b}")


def upsert_latest(spark: SparkSession, new_rows: DataFrame, state_path: str, key: str = "ssn",
                  order_col: str = "scan_date", tiebreakers: Sequence[str] = (), buckets: int = 1024,
                  fmt: str = "parquet") -> int:
    """Merge ``new_rows`` into the keep-latest state at ``state_path``.

    Returns the number of buckets rewritten. ``buckets`` bounds the list of
    touched buckets that reaches the driver; size it so that a bucket is some
    hundred MB, for an increment of more keys than buckets touches them all.
    """
    _check_buckets(spark, state_path, buckets)
    new = new_rows.withColumn(BUCKET_COLUMN, key_bucket(key, buckets))
    touched = [r[0] for r in new.select(BUCKET_COLUMN).distinct().collect()]
    if not touched:
        return 0
    combined = new
    if path_exists(spark, state_path):
        old = (spark.read.format(fmt).schema(new.schema).load(state_path)
               .where(F.col(BUCKET_COLUMN).isin(touched)))
        combined = old.unionByName(new)
    # Every touched bucket has a row, one of the new ones if no other.
    _put_buckets(spark, keep_latest(combined, key, order_col, tiebreakers), state_path, buckets, fmt)
    return len(touched)


def read_latest(spark: SparkSession, state_path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(state_path).drop(BUCKET_COLUMN)


INCREMENT_COLUMN = "_increment"


def _known_empty(df: DataFrame) -> bool:
    """Whether planning alone tells that there are no rows."""
    most = df._jdf.queryExecution().optimizedPlan().maxRows()
    return most.isDefined() and most.get() == 0


def _buckets_of(spark: SparkSession, paths: Sequence[str], fmt: str) -> set[int]:
    """The buckets that stored increments have rows of."""
    if not paths:
        return set()
    rows = spark.read.format(fmt).schema(f"{BUCKET_COLUMN} int").load(list(paths))
    return {r[0] for r in rows.distinct().collect()}


def _put_version(spark: SparkSession, rows: DataFrame, path: str, increment_id: str, key: str, buckets: int,
                 fmt: str) -> set[int] | None:
    """Store an increment's rows in a folder of the increment, sorted by bucket,
    in place of an earlier version of it. Returns the buckets of both versions
    if there was an earlier one, None otherwise."""
    rows = rows.withColumns({BUCKET_COLUMN: key_bucket(key, buckets), INCREMENT_COLUMN: F.lit(str(increment_id))})
    mine = f"{path}/{INCREMENT_COLUMN}={increment_id}"
    old = _buckets_of(spark, [mine], fmt) if path_exists(spark, mine) else None
    if not _known_empty(rows):
        # As many files as its tasks, not one per bucket; nothing is written of no rows.
        writers.write_table(rows.sortWithinPartitions(BUCKET_COLUMN), path, fmt, partition_by=[INCREMENT_COLUMN], dynamic=True)
    if old is None:
        return None
    new = {r[0] for r in rows.select(BUCKET_COLUMN).distinct().collect()}
    if not new:
        delete_path(spark, mine)
    return old | new


def _pending(latest_path: str) -> str:
    """The folder that names the stored increments not merged yet."""
    return f"{latest_path}.pending"


def _has(spark: SparkSession, path: str, increment_id: str) -> bool:
    """Whether rows of an increment are stored: one without any has no folder."""
    return path_exists(spark, f"{path}/{INCREMENT_COLUMN}={increment_id}")


def _stored(spark: SparkSession, path: str, ids: Sequence[str] | None = None) -> list[str]:
    """The folders of stored increments, of all or of some."""
    names = [n for n in child_names(spark, path) if n.startswith(f"{INCREMENT_COLUMN}=")]
    wanted = None if ids is None else {f"{INCREMENT_COLUMN}={i}" for i in ids}
    return [f"{path}/{n}" for n in names if wanted is None or n in wanted]


def merge_due(spark: SparkSession, base: str, merge_after: int) -> bool:
    """Whether the waiting increments are ``merge_after`` at least and as large
    as the tables that a merge rewrites, so that all merges together write no
    more than in proportion to what was applied."""
    ids = child_names(spark, _pending(f"{base}/silver_latest"))
    if len(ids) < merge_after:
        return False
    if merge_after <= 1:
        return True
    waiting = [p for side in ("silver_metadata", "silver_manifest") for p in _stored(spark, f"{base}/{side}", ids)]
    rewritten = sum(stored_bytes(spark, f"{base}/{t}") for t in ("silver_latest", "silver_joined", "gold_research"))
    return sum(stored_bytes(spark, p) for p in waiting) >= rewritten


def is_stored(spark: SparkSession, base: str, increment_id: str) -> bool:
    """Whether rows of an increment are stored: applying it again replaces them."""
    return any(_has(spark, f"{base}/{side}", increment_id) for side in ("silver_metadata", "silver_manifest"))


def merge_pending(spark: SparkSession, base: str, tiebreakers: Sequence[str] = ("encounter_id",), key: str = "ssn",
                  buckets: int = 1024, fmt: str = "parquet", salt: str | None = None) -> int:
    """Merge the increments that ``apply_increment`` stored and left pending
    into ``silver_latest``, and recompute ``silver_joined`` and
    ``gold_research`` in their buckets, in one step; returns how many.
    ``salt`` as in ``apply_increment``. A merge that stops half-way is done
    again by the next one, with the same result."""
    return _merge(spark, base, tiebreakers, key, buckets, salt, fmt)[0]


def _merge(spark: SparkSession, base: str, tiebreakers: Sequence[str], key: str, buckets: int, salt: str | None, fmt: str,
           schema: StructType | None = None) -> tuple[int, set[int]]:
    """``merge_pending``; returns the buckets joined again besides."""
    latest_path = f"{base}/silver_latest"
    ids = child_names(spark, _pending(latest_path))
    new_metadata, new_manifests = (_stored(spark, f"{base}/{side}", ids) if ids else [] for side in ("silver_metadata", "silver_manifest"))
    if new_metadata:
        rows = spark.read.format(fmt).load(new_metadata).drop(BUCKET_COLUMN)
        upsert_latest(spark, rows, latest_path, key, "scan_date", [t for t in tiebreakers if t in rows.columns], buckets, fmt)
    done = set()
    if (new_metadata or new_manifests) and _joinable(spark, base):
        done = _buckets_of(spark, [*new_metadata, *new_manifests], fmt)
        _rejoin(spark, base, done, tiebreakers, key, buckets, salt, fmt, schema)
    for i in ids:
        delete_path(spark, f"{_pending(latest_path)}/{i}")
    return len(ids), done


def _joinable(spark: SparkSession, base: str) -> bool:
    return path_exists(spark, f"{base}/silver_latest") and bool(_stored(spark, f"{base}/silver_manifest"))


def _rejoin(spark: SparkSession, base: str, touched: set[int], tiebreakers: Sequence[str], key: str, buckets: int,
            salt: str | None, fmt: str, schema: StructType | None = None, corrected: bool = False) -> None:
    """Recompute the joined Silver and the Gold of the ``touched`` buckets."""
    from aurum.operators import join
    from aurum.plans import layers

    joined_path, gold_path = f"{base}/silver_joined", f"{base}/gold_research"
    hit = F.col(BUCKET_COLUMN).isin(sorted(touched))
    reader = spark.read.format(fmt)
    latest = (reader.schema(schema) if schema else reader).load(f"{base}/silver_latest").where(hit)
    scans = spark.read.format(fmt).load(f"{base}/silver_manifest").where(hit).drop(BUCKET_COLUMN, INCREMENT_COLUMN)
    joined = join.join_manifest(latest, scans, key)
    stored = spark.read.format(fmt).schema(joined.schema)
    # Rows only come with a new increment, and go with a corrected one: then
    # buckets may be left without any.
    put = (lambda df, path: _replace_buckets(spark, df, path, touched, buckets, fmt)) if corrected else (
        lambda df, path: _put_buckets(spark, df, path, buckets, fmt))
    put(joined, joined_path)
    tb = [t for t in tiebreakers if t in latest.columns]
    put(layers.gold_dataset(stored.load(joined_path).where(hit), salt=salt, extra_drop=tb), gold_path)


def apply_increment(spark: SparkSession, new_metadata: DataFrame, new_manifest: DataFrame | None, base: str,
                    increment_id: str, tiebreakers: Sequence[str] = ("encounter_id",), key: str = "ssn",
                    buckets: int = 1024, salt: str | None = None, fmt: str = "parquet",
                    merge_after: int | None = 1) -> dict[str, int]:
    """Apply one increment of Bronze rows to the Silver and Gold tables.

    * ``silver_metadata`` and ``silver_manifest``: cleaned records of each
      increment, partitioned by increment and sorted by key bucket, so that the
      touched buckets are read without most of the other pages;
    * ``silver_latest``: keep-latest state, merged with new increments
      (``upsert_latest``);
    * ``silver_joined`` and ``gold_research``: recomputed for the touched
      buckets only (both inputs pruned to them) and replaced; a bucket left
      without rows loses its partition.

    After any sequence of increments the tables equal a full run over all
    rows applied so far. Applying an ``increment_id`` again, with the same or
    with corrected rows, replaces that increment: the buckets of both versions
    are recomputed, the latest records from the stored increments. Gold
    carries the bucket (a hash of the key modulo ``buckets``, less than the
    surrogate key itself reveals) as its partition. ``increment_id`` names a
    folder: letters, digits, ``-`` and ``_`` only.

    Without a manifest (None) the increment's imaging is as it was.

    ``merge_after`` above 1 lets that many increments wait, stored in
    ``silver_metadata`` and ``silver_manifest``, before the three other tables
    are rewritten with all of them, and more while they are smaller than these
    tables. ``merge_pending`` merges those that are left, or all of them if
    ``merge_after`` is None. Such increments may be applied at the same time as
    others and as one ``merge_pending``, unless they are stored already (``is_stored``).
    """
    from aurum.plans import layers

    if not re.fullmatch(r"[A-Za-z0-9_-]+", str(increment_id)):
        raise ValueError(f"increment id {increment_id!r}: letters, digits, - and _ only")
    meta_path, latest_path, man_path = f"{base}/silver_metadata", f"{base}/silver_latest", f"{base}/silver_manifest"

    _check_buckets(spark, latest_path, buckets)
    meta = layers.silver_metadata(new_metadata)
    meta_again = _put_version(spark, meta, meta_path, increment_id, key, buckets, fmt)
    man_again = None
    if new_manifest is not None:
        man_again = _put_version(spark, layers.silver_manifest(new_manifest), man_path, increment_id, key, buckets, fmt)
    schema = meta.withColumn(BUCKET_COLUMN, key_bucket(key, buckets)).schema
    if meta_again:
        rows = (spark.read.format(fmt).schema(schema).load(meta_path).where(F.col(BUCKET_COLUMN).isin(sorted(meta_again)))
                .select(*schema.fieldNames()))
        tb = [t for t in tiebreakers if t in meta.columns]
        _replace_buckets(spark, keep_latest(rows, key, "scan_date", tb), latest_path, meta_again, buckets, fmt)
    if (meta_again is None and _has(spark, meta_path, increment_id)
            or new_manifest is not None and man_again is None and _has(spark, man_path, increment_id)):
        make_folder(spark, f"{_pending(latest_path)}/{increment_id}")
    done = (meta_again or set()) | (man_again or set())
    if done and _joinable(spark, base):
        _rejoin(spark, base, done, tiebreakers, key, buckets, salt, fmt, schema, corrected=True)
    else:
        done = set()
    if merge_after and merge_due(spark, base, merge_after):
        done = done | _merge(spark, base, tiebreakers, key, buckets, salt, fmt, schema)[1]
    return {"buckets_rewritten": len(done)}
