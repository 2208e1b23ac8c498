"""Table writers for every layer.

All writes are distributed (each task writes its own files); nothing is
collected to the driver. Partitioned writes use dynamic partition overwrite so
rerunning a run date replaces only that date. Partitioned exports never
repartition by the partition column alone: with one hot site, that would
funnel a third of the data through one task. By default every task writes the
sites it holds; ``spread=N`` bounds the files per site by shuffling to
(site, hash mod N), which still splits a hot site over N tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aurum import config
from aurum.functions.expressions import site_partition_key
from aurum.operators.deid import project_rename, require_columns


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Iterable[str] = (), table: str | None = None,
                compression: str = "snappy", dynamic: bool = True, spread: int | None = None,
                bloom: Iterable[str] = ()) -> None:
    """Write ``df`` to ``path`` (and register it as ``table`` if given).

    ``bloom`` names columns that get a Parquet Bloom filter, by which a scan
    for some of their values skips row groups.

    ``dynamic`` overwrites only the partitions present in ``df``.

    ``spread`` (partitioned writes only) shuffles rows to
    ``(partition values, hash(row) mod spread)``: every partition value is
    written by at most ``spread`` tasks (bounded file count) and a hot value
    is still split over ``spread`` tasks rather than funnelled into one.
    Without it each task writes the partition values it already holds (no
    shuffle; files = tasks x values).
    """
    parts = list(partition_by)
    if parts and spread:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(spread))
        df = df.repartition(*[F.col(c) for c in parts], salt)
    w = df.write.format(fmt).mode(mode).option("compression", compression)
    if fmt == "parquet":
        for c in bloom:
            w = w.option(f"parquet.bloom.filter.enabled#{c}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    if parts:
        w = w.partitionBy(*parts)
        if dynamic and mode == "overwrite":
            w = w.option("partitionOverwriteMode", "dynamic")
    if table:
        w.option("path", path).saveAsTable(table)
    else:
        w.save(path)


def write_bronze(bronze: DataFrame, path: str, fmt: str = "parquet", table: str | None = None) -> None:
    """Bronze: partitioned by ``pipeline_run_date``; a rerun replaces its date."""
    write_table(bronze, path, fmt, partition_by=["pipeline_run_date"], table=table)


def read_bronze(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """Read a Bronze table with the run date kept as text (no type inference).

    Pass the writer's ``schema`` to read back a table that may hold no files
    (an empty extract writes no partition) and to skip footer inference.
    """
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    df = r.load(path)
    return df.withColumn("pipeline_run_date", F.col("pipeline_run_date").cast("string"))


def export_by_site(silver: DataFrame, path: str, site_col: str = "site_location",
                   key_col: str = "site_key", fmt: str = "parquet", spread: int | None = None) -> None:
    """Silver export, one directory per site (storage-safe key).

    Rows without a site are not exported (count them with
    ``unexported_rows``). Two sites whose keys collide share one directory.
    """
    require_columns(silver, [site_col], "Silver dataset")
    out = silver.where(F.col(site_col).isNotNull()).withColumn(key_col, site_partition_key(site_col))
    write_table(out, path, fmt, partition_by=[key_col], dynamic=False, spread=spread)


def unexported_rows(silver: DataFrame, site_col: str = "site_location") -> DataFrame:
    return silver.agg(F.count_if(F.col(site_col).isNull()).alias("rows_without_site"))


def read_site(spark: SparkSession, path: str, site: str, key_col: str = "site_key",
              fmt: str = "parquet") -> DataFrame:
    """Read one site's partition; the filter on the partition column prunes
    the other directories at planning time."""
    key = site.replace(" ", "_").replace("/", "-")
    return spark.read.format(fmt).option("basePath", path).load(path).where(F.col(key_col) == key)


def export_gold_ml(gold: DataFrame, path: str, mapping: Mapping[str, str] = config.GOLD_ML_COLUMNS,
                   fmt: str = "parquet", files: int | None = None) -> None:
    """Flat ML export of the renamed 6-column projection, optionally as
    ``files`` output files (a final shuffle, so the read stays fully
    parallel; ``coalesce`` would shrink the upstream stage to ``files`` tasks)."""
    out = project_rename(gold, mapping, "Gold dataset")
    if files:
        out = out.repartition(files)
    write_table(out, path, fmt)


def create_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def register_table(spark: SparkSession, namespace: str, name: str, path: str, fmt: str = "parquet") -> str:
    """Make the data at ``path`` the external table ``namespace.name``, with
    the schema and partitions found there; an earlier registration is replaced
    and no data is touched. Returns the table's full name."""
    table = f"`{namespace}`.`{name}`"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.catalog.createTable(table, path=path, source=fmt)
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.catalog.recoverPartitions(table)
    return table


def output_locations(spark: SparkSession, entries: Iterable[tuple[str, str, str]], fmt: str = "parquet") -> DataFrame:
    """Report ``(layer, name, uri, partition, rows, bytes)`` for written
    outputs, one row per partition value (NULL for an unpartitioned table).

    Rows and partition values are read back from the written data itself, sizes
    from its files.
    """
    frames = []
    for layer, name, uri in entries:
        df = spark.read.format(fmt).load(uri)
        part_cols = [c for c in ("pipeline_run_date", "site_key") if c in df.columns]
        value = F.col(part_cols[0]).cast("string") if part_cols else F.lit(None).cast("string")
        rows = df.groupBy(value.alias("partition")).agg(F.count(F.lit(1)).alias("rows"))
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(uri)
        folder = F.nullif(F.regexp_extract("path", f"/{part_cols[0]}=([^/]*)/", 1), F.lit("")) if part_cols else F.lit(None)
        sizes = files.groupBy(F.url_decode(folder.cast("string")).alias("partition")).agg(F.sum("length").alias("bytes"))
        both = rows.alias("r").join(sizes.alias("s"), F.col("r.partition").eqNullSafe(F.col("s.partition")), "left")
        frames.append(both.select(F.lit(layer).alias("layer"), F.lit(name).alias("name"), F.lit(uri).alias("uri"),
                                  "r.partition", "rows", "bytes"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
