"""Spark session helpers.

On a cluster the session is created by the platform; ``get_spark`` only
fills in settings that are unset, so cluster-provided values (shuffle
partitions, checkpoint folder, ...) always win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings applied only when the session does not define them already.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # reliable checkpoints (chunked running totals) are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "ledgerlight") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    wanted = dict(_DEFAULTS)
    if shuffle_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if not _submitted():                        # a submitted driver has its memory already
        wanted["spark.driver.memory"] = os.environ.get("LEDGERLIGHT_DRIVER_MEM", "16g")
    for k, v in wanted.items():
        if not _given(k):
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def _submitted() -> bool:
    """True when spark-submit (or a running session) started the JVM before this code."""
    return "PYSPARK_GATEWAY_PORT" in os.environ or SparkContext._active_spark_context is not None


def _given(key: str) -> bool:
    """True when the submit command, the defaults file or the running session sets ``key``."""
    if f"{key}=" in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        return True
    return _submitted() and SparkConf().contains(key)


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.split("[")[0] == "local"


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names that folder. Only a local master gets a local folder
    when the setting is absent (tests); elsewhere that is an error, because
    executors would not see each other's files.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="ledgerlight-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext on a remote (Connect) session
        return path
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path): works for any store that Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of input files/folders, from the store that holds them."""
    total = 0
    for path in paths:
        fs, p = file_system(spark, path)
        if fs.exists(p):
            total += fs.getContentSummary(p).getLength()
    return total


def size_shuffles(spark: SparkSession, scanned_bytes: int, total_cores: int,
                  target_partition_bytes: int = 512 << 20, expansion: float = 1.0, per_core: int = 2) -> int:
    """Size the shuffle so each partition holds about ``target_partition_bytes``
    of shuffled data (``expansion`` x the scanned parquet bytes: compressed
    shuffle blocks are about as big as compressed parquet, and projections
    and partial aggregation shrink them), with at least ``per_core``
    partitions per core (2 on a shared cluster, 1 for a single local JVM). AQE coalesces the small ones and splits skewed ones;
    the advisory size is set to the same target, and parquet splits are
    capped at it too, so map and reduce tasks both fit executor memory.
    Returns the partition count set."""
    n = max(per_core * total_cores, int(scanned_bytes * expansion // target_partition_bytes) + 1)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_partition_bytes // 2))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(min(target_partition_bytes, 128 << 20)))
    return n
