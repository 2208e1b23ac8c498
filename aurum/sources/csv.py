"""Bronze CSV ingest with corrupt-row capture and lineage columns.

Reads are header-aware and full-width: the corrupt-record column is part of
the schema and CSV column pruning is switched off for the read, so a row with
too few or too many fields is always captured, whichever columns a later
query selects. Nothing here triggers a Spark job; counts are taken by
``Observation`` when the caller writes the Bronze table.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from aurum import config
from aurum.operators.clean import add_lineage, fill_missing_columns
from aurum.operators.headers import rename_headers


def with_corrupt_column(schema: StructType, name: str = config.CORRUPT_COLUMN) -> StructType:
    if name in schema.fieldNames():
        return schema
    return StructType(list(schema.fields) + [StructField(name, StringType(), True)])


def reader_options(reader, schema: StructType, header: bool = True, check_header: bool = True,
                   corrupt_column: str = config.CORRUPT_COLUMN):
    """The strict read of a known schema, for a batch or a stream reader:
    malformed rows captured in full, and a file whose header is not the
    schema's, in its order, an error instead of a mapping by position."""
    return (reader.schema(with_corrupt_column(schema, corrupt_column))
            .option("header", header)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", corrupt_column)
            .option("columnPruning", False)
            .option("enforceSchema", not (header and check_header)))


def read_headed(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """Read files of one header dialect: the columns are the header's, all
    text, and rows with too few or too many fields are captured like those of
    a known schema."""
    r = spark.read.option("header", True).option("inferSchema", False)
    for name, option in (("recursive", "recursiveFileLookup"), ("glob", "pathGlobFilter")):
        if options.get(name):
            r = r.option(option, options[name])
    return read_csv(spark, path, r.csv(path).schema, **options)


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | None = None,
             header: bool = True, check_header: bool = True, recursive: bool = False,
             glob: str | None = None, corrupt_column: str = config.CORRUPT_COLUMN,
             **options) -> DataFrame:
    """Read CSV files.

    With a ``schema`` the read is typed, PERMISSIVE, and captures malformed
    rows in ``corrupt_column``; ``check_header`` makes Spark compare the file
    header with the schema's names and fail on a reordered or renamed header
    instead of silently mapping by position. Without a schema every column is
    read by header name as a string.
    """
    r = spark.read.option("header", header)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    for k, v in options.items():
        r = r.option(k, v)
    if schema is not None:
        r = reader_options(r, schema, header, check_header, corrupt_column)
    else:
        r = r.option("inferSchema", False)
    return r.csv(path)


def ingest_bronze(spark: SparkSession, path: str | list[str], schema: StructType, run_ts: str,
                  run_date: str, source_file: str | None = None, header: bool = True,
                  check_header: bool = True, **options) -> DataFrame:
    """Full-width Bronze frame: raw string columns, the corrupt-record column
    and the lineage columns (``source_file`` is the per-row input file unless
    given)."""
    raw = read_csv(spark, path, schema, header=header, check_header=check_header, **options)
    return add_lineage(raw, run_ts, run_date, source_file)


def ingest_dialects(spark: SparkSession, dialects: Mapping[str, Mapping[str, str]], schema: StructType,
                    run_ts: str, run_date: str, defaults: Mapping[str, object] | None = None, **options) -> DataFrame:
    """Bronze frame over sites whose headers differ: per folder the map from
    its headers to the schema's names. A column that a site lacks holds the
    caller's default, or NULL without one; two headers that map to one name are
    an error."""
    absent = {**dict.fromkeys(schema.fieldNames()), **(defaults or {})}
    unknown = sorted(set(absent) - set(schema.fieldNames()))
    if unknown:
        raise ValueError(f"defaults for columns that the schema lacks: {unknown}")
    frames = []
    for path, renames in dialects.items():
        df = add_lineage(read_headed(spark, path, **options), run_ts, run_date)
        df = fill_missing_columns(rename_headers(df, renames), absent)
        typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
        frames.append(df.select(*typed, config.CORRUPT_COLUMN, "ingested_at", "source_file", "pipeline_run_date"))
    return reduce(DataFrame.unionByName, frames)


def good_rows(bronze: DataFrame, corrupt_column: str = config.CORRUPT_COLUMN) -> DataFrame:
    return bronze.where(F.col(corrupt_column).isNull()).drop(corrupt_column)


def quarantine_rows(bronze: DataFrame, corrupt_column: str = config.CORRUPT_COLUMN) -> DataFrame:
    """Malformed rows with their raw text and source file (full width)."""
    return bronze.where(F.col(corrupt_column).isNotNull())


def ingest_observation(name: str, corrupt_column: str = config.CORRUPT_COLUMN) -> tuple[Observation, list]:
    """An Observation and its metric expressions for a Bronze write:
    rows ingested and corrupt rows, gathered during the write itself."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows"),
               F.count_if(F.col(corrupt_column).isNotNull()).alias("corrupt_rows")]
    return obs, metrics
