"""Keep-latest deduplication and skew-safe ordinals.

``keep_latest`` is a ``row_number() = 1`` window; Spark plans it as a partial
``WindowGroupLimit`` before the shuffle, so a key holding a large share of the
rows is cut to one row per map task before anything crosses the network.

``ordinal_within`` numbers rows 0..n-1 inside a group (e.g. per site) without
putting a whole group into one task: rows are range-partitioned on
(group, order), each partition numbers its own slice, and a small per-slice
offset table turns local positions into group-wide ordinals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aurum.session import ensure_checkpoint_dir

# Offset tables at most this many rows are broadcast; larger ones are joined
# with a shuffle. The table has one row per (range slice, group).
BROADCAST_ROW_LIMIT = 200_000


def _order_expr(c, descending: bool) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.desc_nulls_last() if descending else col.asc_nulls_last()


def keep_latest(df: DataFrame, partition_col: str | Sequence[str] = "ssn",
                order_col: str = "scan_date", tiebreakers: Sequence[str] = (),
                descending: bool = True) -> DataFrame:
    """Keep one row per key: the newest ``order_col`` (NULLs last), ties broken
    by ``tiebreakers`` (same direction) so the result is deterministic."""
    keys = [partition_col] if isinstance(partition_col, str) else list(partition_col)
    order = [_order_expr(order_col, descending)] + [_order_expr(t, descending) for t in tiebreakers]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dropped_by_dedup(df: DataFrame, key: str = "ssn") -> DataFrame:
    """One row ``(rows_before, rows_after, dropped)`` computed in one pass.

    ``rows_after`` counts distinct keys with a NULL key counting as one group,
    matching what ``keep_latest`` keeps.
    """
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        (F.count_distinct(key) + F.max(F.col(key).isNull().cast("int"))).alias("rows_after"),
    ).select(
        "rows_before",
        F.coalesce(F.col("rows_after"), F.lit(0)).cast("bigint").alias("rows_after"),
        (F.col("rows_before") - F.coalesce(F.col("rows_after"), F.lit(0))).cast("bigint").alias("dropped"),
    )


def ordinal_within(df: DataFrame, order_cols: Sequence[str | Column], group_cols: Sequence[str] = (),
                   name: str = "ordinal", start: int = 0, num_partitions: int | None = None) -> DataFrame:
    """Dense ordinal ``start..`` per group in ``order_cols`` order.

    ``order_cols`` should determine a total order inside each group (append a
    unique key) for the numbering to be reproducible.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keys = [F.col(g).asc_nulls_first() for g in group_cols] + \
           [F.col(c) if isinstance(c, str) else c for c in order_cols]
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    ranged = ranged.sortWithinPartitions(*keys).withColumns({
        "_slice": F.spark_partition_id(),
        "_mid": F.monotonically_increasing_id(),
    })
    # Reliable checkpoint (shared storage): pins slice ids and row ids so the
    # offset table and the rows agree even if tasks are retried.
    ranged = ranged.checkpoint(eager=True)

    slices = ranged.groupBy("_slice", *group_cols).agg(
        F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = (Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))) \
        .orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_offset", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    # Derived from the checkpointed rows, so recomputing it is deterministic.
    if slices.count() <= BROADCAST_ROW_LIMIT:
        slices = F.broadcast(slices)

    s = slices.alias("_s")
    r = ranged.alias("_r")
    cond = F.col("_r._slice") == F.col("_s._slice")
    for g in group_cols:
        cond = cond & F.col(f"_r.{g}").eqNullSafe(F.col(f"_s.{g}"))
    out = r.join(s, cond, "inner").select(
        "_r.*",
        (F.lit(start) + F.col("_s._offset") + F.col("_r._mid") - F.col("_s._first")).alias(name),
    )
    return out.drop("_slice", "_mid")
