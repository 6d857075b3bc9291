"""Spark session defaults for the mart jobs.

On a cluster the session is created by the launcher and only the SQL
settings below are applied; locally (tests, bench) a ``local[N]`` session is
built. Nothing here opens a UI or any other listener.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC session zone (dates derived from
# timestamps must not move with the host zone), AQE for runtime re-planning,
# skew-join splitting and partition coalescing.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a task groups or sorts what one split or one coalesced partition holds; packed
    # columns take some ten times their size there
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "innspark") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master or not os.environ.get("SPARK_MASTER_URL"):
        builder = builder.master(master or "local[*]")
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               # the status store keeps job/stage/SQL history in driver memory even
               # without a UI; a long-running job session only needs recent entries
               .config("spark.ui.retainedJobs", "100")
               .config("spark.ui.retainedStages", "200")
               .config("spark.ui.retainedTasks", "20000")
               .config("spark.sql.ui.retainedExecutions", "50")
               .config("spark.driver.memory", os.environ.get("INNSPARK_DRIVER_MEM", "16g"))
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8)))
    for k, v in SQL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL defaults to an existing session (e.g. the driver's)."""
    for k, v in SQL_DEFAULTS.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


SHUFFLED_BYTES = 4 << 20  # input bytes for each shuffle partition


def spread_shuffles(spark: SparkSession, paths: list[str]) -> int:
    """Shuffle partitions that grow with the size of ``paths``, so that a task's part
    of a shuffle doesn't; never fewer than are set. AQE joins them up to as many bytes:
    keys that pack well take up to a hundred times that in a task. Returns their number."""
    conf, size = spark._jsc.hadoopConfiguration(), 0
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(conf)
        if fs.exists(at):
            size += fs.getContentSummary(at).getLength()
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHUFFLED_BYTES))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(SHUFFLED_BYTES))
    return n


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of the queries run within go on all executors as each query ends;
    otherwise they stay until the driver's garbage collector meets their plans."""
    old = spark.conf.get(DROP_SHUFFLES)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, old)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` is read from the session. A ``local`` master (tests)
    gets a fresh scratch folder when it is unset; on a cluster that folder would
    be another one on each machine, so it must be set there.
    """
    sc = spark.sparkContext
    current = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    local = tempfile.mkdtemp(prefix="innspark-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint location for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def size_for(spark: SparkSession, input_bytes: int, partition_bytes: int = 256 << 20) -> int:
    """Spill-aware sizing for a cluster run over ``input_bytes`` of input:
    scan splits of ``partition_bytes`` and enough shuffle partitions that each
    holds about that much before AQE coalesces the small ones. Returns the
    shuffle partition count it set (at least the default parallelism)."""
    n = max(spark.sparkContext.defaultParallelism, -(-input_bytes // partition_bytes))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(partition_bytes))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
