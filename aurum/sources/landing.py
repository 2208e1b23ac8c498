"""Landing-zone scans: object listing, catalog, newest snapshot, upload ledger.

Listing uses the ``binaryFile`` source without its ``content`` column, so
only file metadata is read; the ledger reads content once per landed file to
derive the confirmation id. Landed names are immutable:
``<name>_<YYYYMMDDTHHMMSSZ><ext>``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aurum import config
from aurum.functions import expressions as X
from aurum.session import path_exists


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Every file under ``root`` (recursive): path, landed object name,
    length, modificationTime."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(root).select("path", X.landed_object_name("path").alias("file_name"),
                               "length", "modificationTime")


def landing_catalog(listing: DataFrame, ledger: DataFrame | None = None, root: str | None = None) -> DataFrame:
    """Object catalog: key, submitter, affiliation, size in KB, last modified."""
    key = F.col("path") if root is None else relative_path(F.col("path"), root)
    tz = listing.sparkSession.conf.get("spark.sql.session.timeZone")
    out = listing.select("path", key.alias("key"), "file_name", "length", "modificationTime")
    if ledger is not None:
        # By landed path: two uploads may share a name.
        attrs = ledger.select(F.col("source_file").alias("path"), "submitter", "affiliation")
        out = out.join(attrs, "path", "left")
    else:
        out = out.withColumns({"submitter": F.lit(None).cast("string"), "affiliation": F.lit(None).cast("string")})
    return out.select(
        "key",
        F.coalesce(F.col("submitter"), F.lit("Unknown")).alias("submitter"),
        F.coalesce(F.col("affiliation"), F.lit("Unknown")).alias("affiliation"),
        F.round(F.col("length") / 1024, 2).alias("size_kb"),
        F.date_format(F.to_utc_timestamp("modificationTime", tz), "yyyy-MM-dd HH:mm:ss 'UTC'")
        .alias("last_modified"),
    )


def relative_path(path_col, root: str):
    """``path_col`` with everything up to and including ``root/`` removed."""
    bare = root.rstrip("/").split(":", 1)[-1]
    return F.regexp_replace(path_col, "^.*?" + _regex_escape(bare) + "/", "")


def _regex_escape(s: str) -> str:
    return "".join("\\" + ch if ch in ".^$*+?{}[]\\|()" else ch for ch in s)


def name_matches(file_name_col, tokens: Sequence[str]):
    low = F.lower(file_name_col)
    cond = F.lit(False)
    for t in tokens:
        cond = cond | low.contains(t)
    return cond


def newest_snapshot(spark: SparkSession, root: str, tokens: Sequence[str] = config.METADATA_NAME_TOKENS,
                    glob: str | None = "*.csv", fixed_path: str | None = None) -> str | None:
    """Path of the newest landed object (a file, or a stamped folder of part
    files) whose path below ``root`` contains one of ``tokens``; newest means
    the latest modification time of its files, then the path. A
    ``fixed_path`` that exists wins.

    Only one value (a path) reaches the driver; the search is a distributed
    aggregation over the listing.
    """
    if fixed_path is not None and path_exists(spark, fixed_path):
        return fixed_path
    listing = list_files(spark, root, glob)
    own_file = F.regexp_extract("path", r"([^/]+)$", 1) == F.col("file_name")
    objects = listing.select(
        F.when(own_file, F.col("path")).otherwise(F.regexp_replace("path", r"/[^/]*$", "")).alias("object"),
        "modificationTime",
    ).groupBy("object").agg(F.max("modificationTime").alias("mtime"))
    objects = objects.where(name_matches(relative_path(F.col("object"), root), tokens))
    row = objects.agg(F.max_by("object", F.struct("mtime", "object")).alias("p")).first()
    return row["p"] if row else None


def landing_ledger(spark: SparkSession, root: str, submissions: DataFrame, glob: str | None = "*.csv",
                   dataset_prefixes=config.DATASET_PREFIXES, id_from: str = "content") -> DataFrame:
    """One row per landed file: confirmation id, full MD5, submitter,
    affiliation, dataset type and prefix, upload time (from the name) and
    file name.

    ``submissions`` carries what the uploader declared:
    ``(path, submitter, affiliation, dataset_type)``, keyed by the landed path.
    Keyed by ``file_name`` (the landed object name, see
    ``landed_object_name``) instead, a name that several landed files or
    submissions share is an error: whose upload it is can't be told. A landed
    file with no submitter is an error (provenance is mandatory).

    ``tx_id`` is for display; ``content_md5`` tells files apart.
    ``id_from="content"`` hashes each file's bytes (one task per file); a file
    over 2 GiB, which the ``binaryFile`` source can't read, is an error.
    ``id_from="tree"`` hashes the content of files of any size, each in many
    tasks (``content_tree``). ``id_from="metadata"`` hashes (path, size,
    modification time) instead and reads no content. The three give different
    ids: choose one per landing zone.
    ``append_ledger`` never derives the id of a recorded file again, so a
    stored ledger keeps its ids.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    listing = r.load(root)
    if id_from == "content":
        digest = F.md5("content")
    elif id_from == "metadata":
        digest = F.md5(F.concat_ws("|", "path", F.col("length").cast("string"),
                                   F.col("modificationTime").cast("string")))
    elif id_from == "tree":
        listing = listing.join(content_tree(spark, root, glob).select("path", "content_md5"), "path")
        digest = F.col("content_md5")
    else:
        raise ValueError(f"unknown id_from {id_from!r}")
    files = listing.select("path", X.landed_object_name("path").alias("file_name"),
                           digest.alias("content_md5"))
    prefix = F.lit(None).cast("string")
    for dtype, pfx in dataset_prefixes.items():
        prefix = F.when(F.col("dataset_type") == dtype, F.lit(pfx)).otherwise(prefix)
    if "path" in submissions.columns:
        files = files.join(submissions.drop("file_name"), "path", "left").withColumn("_shared", F.lit(False))
    else:
        twice = (files.select("file_name", F.lit(1).alias("f"), F.lit(0).alias("s"))
                 .unionByName(submissions.select("file_name", F.lit(0).alias("f"), F.lit(1).alias("s")))
                 .groupBy("file_name").agg(((F.sum("f") > 1) | (F.sum("s") > 1)).alias("_shared")))
        files = files.join(submissions, "file_name", "left").join(twice, "file_name", "left")
    ledger = files.select(
        F.concat(F.lit("TX-"), F.upper(F.substring("content_md5", 1, 6))).alias("tx_id"),
        "content_md5", "submitter", "affiliation", "dataset_type",
        prefix.alias("object_prefix"),
        X.upload_time("file_name").alias("uploaded_at"),
        "file_name", F.col("path").alias("source_file"), "_shared",
    )
    return ledger.withColumn(
        "submitter",
        F.when(F.col("_shared"), F.raise_error(F.concat(F.lit("name of several uploads, give submissions by path: "), F.col("file_name"))))
        .when(F.col("submitter").isNull() | (F.trim("submitter") == ""),
               F.raise_error(F.concat(F.lit("landed file without submitter: "), F.col("file_name"))))
        .otherwise(F.col("submitter")),
    ).drop("_shared")


#: Lines of a leaf of the content tree. Part of the id: files hashed with
#: another value get other ids.
LEAF_LINES = 1 << 16


def content_tree(spark: SparkSession, root: str, glob: str | None = "*.csv", leaf_lines: int = LEAF_LINES) -> DataFrame:
    """``path, length, content_md5`` of every file below ``root``: a hash of its
    content as a tree, which files of any size get from many tasks.

    The leaves are runs of ``leaf_lines`` lines, whatever the splits that the
    files are read in: lines are numbered by their place in their split and the
    number of lines in the splits before it. A leaf is the MD5 of its lines'
    MD5s in order, the root that of the leaves' and the length in bytes (which
    tells a last line with a line feed from one without). Equal bytes have equal
    ids, under any split size. What one group collects is a leaf, or one hash
    per leaf of a file. A file without a byte is in no listing of Spark's file
    sources, so it has no id, as in the other kinds.
    """
    r = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n")
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r, listing = r.option("pathGlobFilter", glob), listing.option("pathGlobFilter", glob)
    lines = r.text(root).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                                F.monotonically_increasing_id().alias("at"), F.md5(F.col("value").cast("binary")).alias("h"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = lines.groupBy("path", "block").agg(F.count(F.lit(1)).alias("n")).select(
        "path", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("path", "block").orderBy("at")) - 1
    numbered = lines.withColumn("place", place).join(offsets, ["path", "block"]).select(
        "path", "h", (F.col("before") + F.col("place")).alias("line"))

    def chain(order: str) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "h"))), lambda x: x["h"]), "")

    leaves = numbered.groupBy("path", F.expr(f"line div {leaf_lines}").alias("leaf")).agg(F.md5(chain("line").cast("binary")).alias("h"))
    roots = leaves.groupBy("path").agg(chain("leaf").alias("chain"))
    # The two sources may write a path's scheme and spaces differently.
    name = lambda c: F.regexp_replace(F.url_decode(F.regexp_replace(c, r"\+", "%2B")), "^file:/+", "/")
    files = listing.load(root).select("path", "length")
    both = files.join(roots.select(name("path").alias("_name"), "chain"), name(F.col("path")) == F.col("_name"), "left")
    return both.select("path", "length", F.md5(F.concat(F.coalesce("chain", F.lit("")), F.lit("|"), F.col("length").cast("string")).cast("binary"))
                       .alias("content_md5"))


def append_ledger(spark: SparkSession, ledger: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Append ledger rows for files not yet recorded (by landed path).

    Idempotent: rerunning over the same landing zone adds nothing. Returns
    the number of rows appended (taken from the write's Observation).
    """
    from pyspark.sql import Observation

    new = ledger
    if path_exists(spark, path):
        known = spark.read.format(fmt).load(path).select("source_file")
        new = ledger.join(known, "source_file", "left_anti")
    obs = Observation("ledger_append")
    new.observe(obs, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode("append").save(path)
    return int(obs.get["rows"])


def append_new_uploads(spark: SparkSession, root: str, submissions: DataFrame, path: str, fmt: str = "parquet",
                       glob: str | None = "*.csv") -> int:
    """Record the landed files below ``root`` that the ledger at ``path`` does
    not hold yet; returns how many."""
    return append_ledger(spark, landing_ledger(spark, root, submissions, glob=glob), path, fmt)
