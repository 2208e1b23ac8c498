"""Incremental landing ingest with Structured Streaming.

A file-source stream over the landing prefix with ``trigger(availableNow)``
processes every file that arrived since the last run exactly once (the
checkpoint records processed files; the file sink's log makes the output
transactional), then stops. Rerunning with no new files adds nothing.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from aurum import config
from aurum.session import child_names, delete_path, make_folder
from aurum.sources.csv import reader_options


#: Batches that wait for one rewrite of the keep-latest state, the joined Silver
#: and the Gold, at least; more while they are smaller than these tables.
MERGE_AFTER = 16
#: Increments stored at a time, while the stream goes on to the next batches.
STORED_AT_A_TIME = 4


def incremental_ingest(spark: SparkSession, landing_dir: str, schema: StructType, bronze_path: str,
                       checkpoint_path: str, glob: str = "*.csv", header: bool = True,
                       max_files_per_trigger: int | None = None) -> int:
    """Ingest new landed files into a Bronze table; returns the number of
    micro-batches committed by this call (from the checkpoint's commit log).

    A file whose header is not the schema's fails the stream. Lineage: ``source_file`` is the per-row input file; ``ingested_at`` and
    ``pipeline_run_date`` come from the micro-batch time.
    """
    reader = (reader_options(spark.readStream, schema, header)
              .option("recursiveFileLookup", True)
              .option("pathGlobFilter", glob))
    before = _last_batch(spark, checkpoint_path)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(landing_dir)
    # Micro-batch time as UTC wall clock (the stamp says 'Z' whatever the
    # session time zone is).
    bronze = stream.withColumns(_batch_lineage(spark))
    q = (bronze.writeStream.format("parquet")
         .option("checkpointLocation", checkpoint_path)
         .partitionBy("pipeline_run_date")
         .trigger(availableNow=True)
         .start(bronze_path))
    q.awaitTermination()
    return _last_batch(spark, checkpoint_path) - before


def _batch_lineage(spark: SparkSession) -> dict:
    now = F.to_utc_timestamp(F.current_timestamp(), spark.conf.get("spark.sql.session.timeZone"))
    return {"ingested_at": F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            "source_file": F.col("_metadata.file_path"),
            "pipeline_run_date": F.date_format(now, "yyyy-MM-dd")}


def _last_batch(spark: SparkSession, checkpoint_path: str) -> int:
    """The last committed batch of a stream's checkpoint; -1 if none."""
    return max([int(n) for n in child_names(spark, f"{checkpoint_path}/commits") if n.isdigit()], default=-1)


def stream_increments(spark: SparkSession, metadata_dir: str, manifest_dir: str, base: str,
                      checkpoint_path: str, metadata_schema: StructType, manifest_schema: StructType,
                      tiebreakers=("encounter_id",), buckets: int = 1024, glob: str = "*.csv",
                      max_files_per_trigger: int | None = None) -> dict[str, int]:
    """Keep Silver and Gold current from the landing zone with Structured
    Streaming: every new landed file is read once (``availableNow``), and each
    micro-batch is kept in Bronze and applied as one increment
    (``plans.incremental.apply_increment``). Batches of one call wait for each
    other (``MERGE_AFTER``); all are in every table when it returns.

    Micro-batches are idempotent by epoch (Bronze partition ``_batch`` and
    the increment id are both derived from it), so a retried batch replaces
    its own output. The metadata stream runs before the manifest stream, and
    while one batch's increment is stored, or those that wait are merged, the
    next ones are read; the tables that several increments share are rewritten
    by one thread at a time. A batch that Bronze holds and that was not applied
    when a call stopped is applied by the next. The stream checkpoint belongs with the tables (both on shared storage): epochs
    restart if it is discarded, so reset the tables with it.
    """
    from aurum.plans.incremental import apply_increment, is_stored, merge_due, merge_pending

    counts = {"metadata_batches": 0, "manifest_batches": 0}

    def empty(schema: StructType):
        # A relation known to be empty when it is planned: no job runs for it.
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema]).where(F.lit(False))

    def run(side: str, directory: str, schema: StructType):
        reader = (reader_options(spark.readStream, schema).option("recursiveFileLookup", True)
                  .option("pathGlobFilter", glob))
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        # The same lineage columns as a batch ingest's Bronze.
        stream = reader.csv(directory).withColumns(_batch_lineage(spark))
        bronze, kept = stream.schema, f"{base}/bronze_{side}"
        # Names the batches that Bronze holds and that are not applied yet.
        todo = f"{kept}.pending"

        def increment(epoch: str) -> None:
            # Silver is made from what Bronze keeps, read with the caller's
            # session: a stream's own plans every shuffle without adaptation.
            rows = spark.read.schema(bronze).parquet(f"{kept}/_batch={epoch}")
            good = rows.where(F.col(config.CORRUPT_COLUMN).isNull()).select(*schema.fieldNames())
            if side == "metadata":
                meta, man = good, None
            else:
                meta, man = empty(metadata_schema), good
            apply_increment(spark, meta, man, base, increment_id=f"{side}-{epoch}", tiebreakers=tiebreakers,
                            buckets=buckets, merge_after=None)
            delete_path(spark, f"{todo}/{epoch}")

        with ThreadPoolExecutor(STORED_AT_A_TIME) as pool:
            under_way, merging, alone = [], [], []

            def finish(most: int = 0) -> None:
                while len(under_way) > most:
                    under_way.pop(0).result()
                while merging and (not most or merging[0].done()):
                    merging.pop().result()

            def start(epoch: str) -> None:
                # One that replaces rows of the tables goes alone, and the first, which finds or
                # makes what belongs to the tables.
                if not alone or is_stored(spark, base, f"{side}-{epoch}"):
                    finish()
                    increment(epoch)
                    alone.append(epoch)
                else:
                    under_way.append(pool.submit(increment, epoch))
                    finish(2 * STORED_AT_A_TIME)

            def apply(batch, epoch_id):
                epoch = str(int(epoch_id))
                batch.write.mode("overwrite").parquet(f"{kept}/_batch={epoch}")
                # From here on the batch is applied, by the next call if not by this one.
                make_folder(spark, f"{todo}/{epoch}")
                start(epoch)
                counts[f"{side}_batches"] += 1
                # A merge takes the increments that wait when it begins; others may come meanwhile.
                if counts[f"{side}_batches"] % MERGE_AFTER == 0 and not merging and merge_due(spark, base, MERGE_AFTER):
                    merging.append(pool.submit(merge_pending, spark, base, tiebreakers, buckets=buckets))

            for epoch in child_names(spark, todo):
                start(epoch)
            finish()  # before the stream may write one of them again
            q = (stream.writeStream.foreachBatch(apply)
                 .option("checkpointLocation", f"{checkpoint_path}/{side}")
                 .trigger(availableNow=True).start())
            q.awaitTermination()
            finish()

    run("metadata", metadata_dir, metadata_schema)
    run("manifest", manifest_dir, manifest_schema)
    merge_pending(spark, base, tiebreakers, buckets=buckets)
    return counts
