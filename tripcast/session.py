"""Spark session helpers.

The library never changes global settings of a session it is handed; it only
reads them.  ``build_session`` is for tests, the bench and local runs.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tripcast") -> SparkSession:
    """Local session with the settings the tests and the bench use."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TRIPCAST_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder every task of the session can read and write.

    It is the one named by ``spark.checkpoint.dir`` (or set on the context).
    With neither, only a session whose tasks all run inside this process
    (master ``local`` or ``local[n]``) gets a folder of its own; on anything
    else each executor would write to its own disk, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tripcast-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (for stream sinks,
    stream checkpoints and materialised intermediate tables)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tripcast-{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Removes a table that ``scratch_path`` named, once nothing reads it any
    more; anything outside the shared checkpoint folder is left alone."""
    if not path.startswith(f"{ensure_checkpoint_dir(spark).rstrip('/')}/tripcast-"):
        raise ValueError(f"{path} is not a scratch table")
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 executor_memory_gb: float, target_partition_mb: int = 256) -> dict[str, str]:
    """Suggested settings for a cluster run over ``input_bytes`` of trip
    parquet (set them when the session is built; the library never changes a
    running session).

    * scan splits of ``target_partition_mb`` (``maxPartitionBytes``), so a
      task's input is a fixed size at any scale;
    * shuffle partitions sized from the input so one shuffle partition stays
      near the same size (the largest shuffles here -- the dense sequence
      sort and per-batch windows -- move about the input width), at least
      2 x the total core count, and AQE to coalesce what turns out smaller
      and to split skewed join partitions;
    * broadcast threshold kept at the default order of magnitude: the
      library broadcasts only tables whose size it checked or bounded.
    """
    cores = executors * cores_per_executor
    part_bytes = target_partition_mb * 1024 * 1024
    shuffle = max(2 * cores, -(-input_bytes // part_bytes))
    mem_per_core_mb = executor_memory_gb * 1024 / max(1, cores_per_executor)
    if mem_per_core_mb < 2 * target_partition_mb:
        shuffle = max(shuffle, -(-input_bytes // int(mem_per_core_mb * 1024 * 1024 / 2)))
    return {
        "spark.sql.files.maxPartitionBytes": str(part_bytes),
        "spark.sql.shuffle.partitions": str(int(shuffle)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(part_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
