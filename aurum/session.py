"""Session helpers: a local session for tests/bench and the shared scratch area.

Library functions never create a session; they take the caller's ``spark``.
Scratch output (checkpoints, written intermediate tables, round-trip files)
goes under the folder the cluster names in ``spark.checkpoint.dir`` so that it
is on shared storage and survives executor loss. Only when no such folder is
configured (a bare local run) do we pick one and register it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8,
                  app_name: str = "aurum") -> SparkSession:
    """A local-mode session configured the way the tests and bench expect."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_UNSET = ("spark.checkpoint.dir is not set: point it at a shared folder (HDFS/object store) "
          "for checkpoints and intermediate tables")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session, set up only if missing."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    try:
        sc = spark.sparkContext
    except Exception as e:  # noqa: BLE001  (remote sessions expose no context)
        raise ValueError(_UNSET) from e
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not str(sc.master).startswith("local"):
        # A machine-local folder is not visible to executors on a cluster.
        raise ValueError(_UNSET)
    # Unset in a local-mode run (tests): register our own folder with the
    # context (the conf itself cannot change on a running session).
    root = tempfile.mkdtemp(prefix="aurum-ckpt-")
    sc.setCheckpointDir(root)
    return (sc.getCheckpointDir() or root).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/aurum-scratch/{name}-{uuid.uuid4().hex[:12]}"


def written(df, name: str):
    """Write ``df`` to the shared scratch area and read it back: what follows
    is planned from the table (its size is known, its shuffles are over)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make sure ``DataFrame.checkpoint()`` has a reliable target."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (remote sessions manage checkpoints server-side)
        return
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(checkpoint_root(spark))


def scale_conf(input_bytes: int, executor_cores_total: int, target_partition_bytes: int = 128 << 20,
               max_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Runtime SQL settings sized to the input so partitions fit in executor
    memory (no spills from oversized tasks, no storm of tiny ones).

    * initial shuffle partitions: input / target size, at least 2x the cores
      (AQE coalesces them at runtime, so erring high is cheap);
    * file splits of ``max_partition_bytes`` for the scans;
    * AQE on, with skew-join splitting and a matching advisory size.
    """
    shuffle = max(2 * executor_cores_total, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(max_partition_bytes),
    }


def apply_scale_conf(spark: SparkSession, input_bytes: int, executor_cores_total: int, **kw) -> dict[str, str]:
    conf = scale_conf(input_bytes, executor_cores_total, **kw)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if it doesn't exist."""
    jvm_path, fs = _file_system(spark, path)
    if not fs.exists(jvm_path):
        return []
    # In one call, whatever their number.
    paths = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(jvm_path))
    joined = spark._jvm.scala.collection.mutable.ArraySeq.make(paths).mkString("\0")
    return [p.rsplit("/", 1)[1] for p in joined.split("\0") if p]


def make_folder(spark: SparkSession, path: str) -> None:
    jvm_path, fs = _file_system(spark, path)
    fs.mkdirs(jvm_path)


def delete_path(spark: SparkSession, path: str) -> None:
    jvm_path, fs = _file_system(spark, path)
    fs.delete(jvm_path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, through the cluster's Hadoop file
    system (works for HDFS, object stores and local paths alike)."""
    jvm_path, fs = _file_system(spark, path)
    return bool(fs.exists(jvm_path))


def read_text(spark: SparkSession, path: str) -> str:
    """The whole of a small file, read without a job."""
    jvm_path, fs = _file_system(spark, path)
    stream = fs.open(jvm_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a folder; none if it doesn't exist."""
    jvm_path, fs = _file_system(spark, path)
    return fs.getContentSummary(jvm_path).getLength() if fs.exists(jvm_path) else 0
