"""Session defaults for tests and the bench.

On a cluster the session comes from the platform; ``configure`` only fills in
settings that are still unset, so cluster-provided values always win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the jobs rely on. AQE re-plans joins at runtime from real shuffle
# sizes (broadcast conversion, skew split, partition coalescing); ANSI mode stays
# on, so every lossy cast in the library is an explicit try_cast.
DEFAULTS: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.caseSensitive": "false",
}


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "estrella",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session for tests and benchmarks (UI off, no servers)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("ESTRELLA_DRIVER_MEMORY", "8g"))
    )
    for key, value in {**DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply DEFAULTS to an existing session without overriding explicit settings."""
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    return spark


# Tasks by the plans' rows: those of the warehouse hold many repeated words, so a shuffle packs
# them 20 to 70 times smaller than they lie in memory, and the 64 MB that Spark puts together for
# one task by default are some GB of rows there.
TASK_BYTES = 8 << 20  # shuffled bytes that one task reads, about
INPUT_BYTES = 4 << 20  # bytes of the input tables for each shuffle partition
SCAN_BYTES = 32 << 20  # stored bytes that one task scans, at most


def sized_session(spark: SparkSession, input_bytes: int) -> SparkSession:
    """A session beside ``spark``, with its settings, whose tasks keep their size as the input
    grows: shuffle partitions follow ``input_bytes`` and are put together up to ``TASK_BYTES``, and
    files are scanned in splits of ``SCAN_BYTES``, whose groups a map-side aggregation can hold.
    Smaller sizes and more partitions that ``spark`` has stay; ``spark`` itself is not changed.
    """
    out = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if out.conf.get(key, None) != value and out.conf.isModifiable(key):
            out.conf.set(key, value)
    most = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_BYTES,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 4 * TASK_BYTES,
        "spark.sql.files.maxPartitionBytes": SCAN_BYTES,
    }
    for key, size in most.items():
        given = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
        out.conf.set(key, f"{min(given, size)}b")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out.conf.set("spark.sql.shuffle.partitions", str(max(partitions, -(-input_bytes // INPUT_BYTES))))
    return out


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (distributed) folder there and it is used as is. Where it
    is unset, a fresh scratch folder is created if the master is local (tests, one
    machine); on a cluster that is an error, as executors do not share local folders.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    scratch = tempfile.mkdtemp(prefix="estrella-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir() or scratch
