"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job of this package relies on; all of them can be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when that costs one more exchange further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
# What a task scans or reads bounds its sorts and hash tables, whatever the size of the input; a cluster may name its own.
TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": "8m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
}
PARTITIONS_PER_CORE = 64  # half a gigabyte a core and shuffle before its parts outgrow the advisory size


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; memory stays with the cluster.

    On a cluster a shuffle starts with many partitions per core, unless the cluster names a number itself: adaptive
    execution merges partitions that turn out small, but splits large ones in skewed joins only.
    """
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    for key, value in TASK_BYTES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if not spark.sparkContext.master.startswith("local") and spark.conf.get(initial, None) is None:
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set(initial, str(max(int(spark.conf.get("spark.sql.shuffle.partitions")), PARTITIONS_PER_CORE * cores)))
    return spark


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Single-JVM session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("farmledger")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    A cluster must name one. A session on one machine, as in tests, may leave it unset: it gets a folder of its own, which is
    removed when the process ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    return _local_root()


@functools.cache
def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="farmledger-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody else writes to, below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/farmledger/{label}-{uuid.uuid4().hex}"
