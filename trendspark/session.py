"""Session helpers: a local session for tests/bench and session defaults.

On a cluster the session comes from the platform; ``prepare`` only pins the
SQL time zone (all dates in the model are UTC calendar dates) and names a
checkpoint folder when the cluster did not configure one.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "trendspark") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    checkpoint_dir(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Idempotent session defaults used by every entry point."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Called only where a reliable checkpoint is taken. A private folder is
    created only for a local master (tests); on a cluster the setting must
    name shared storage, never a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(_CKPT_KEY, None) or sc.getConf().get(_CKPT_KEY, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"{_CKPT_KEY} is not set; name a shared folder for checkpoints")
        configured = tempfile.mkdtemp(prefix="trendspark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


#: Spark removes an execution's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written once to the shared checkpoint folder: frames that read them several times read one
    result, and a lost executor's work is not done again from the sources. The shuffle files that made them go at once,
    not when the driver happens to collect its garbage."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        return df.select("*").checkpoint()  # a frame has the setting that holds when it is made
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


CLUSTER_DEFAULTS = {
    # AQE re-plans at runtime: coalesces small shuffle partitions towards the
    # advisory size and splits skewed join partitions
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024 * 1024),
    # scan splits of ~128 MB keep a task's input within executor memory
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def tune_for_cluster(spark: SparkSession, target_input_bytes: int | None = None) -> dict:
    """Apply ``CLUSTER_DEFAULTS`` where the platform left a setting unset.

    With ``target_input_bytes`` the initial shuffle partition count is sized
    so each partition starts near the advisory size (AQE then coalesces);
    without it, a multiple of the cluster's default parallelism is used.
    """
    applied = {}
    for key, value in CLUSTER_DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
            applied[key] = value
    if "spark.sql.shuffle.partitions" not in spark.sparkContext.getConf().toDebugString():
        advisory = int(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
        if target_input_bytes:
            n = max(1, target_input_bytes // advisory)
        else:
            n = 3 * spark.sparkContext.defaultParallelism
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        applied["spark.sql.shuffle.partitions"] = str(n)
    return applied


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    """A stable per-stream checkpoint folder under ``spark.checkpoint.dir``.

    ``SparkContext.getCheckpointDir()`` adds a per-application id, which would
    lose a stream's progress between runs; this path depends on the setting
    and the stream name only.
    """
    sc = spark.sparkContext
    base = spark.conf.get(_CKPT_KEY, None) or sc.getConf().get(_CKPT_KEY, None)
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"{_CKPT_KEY} is not set; name a shared folder for checkpoints")
        base = os.path.dirname(checkpoint_dir(spark).rstrip("/"))
    return os.path.join(base, "streams", name)

