"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults a cluster job wants: AQE re-plans joins and partition counts at
# runtime from real shuffle sizes, splits skewed join partitions, and only
# broadcasts a side whose measured size is under the threshold.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # Python keeps no call site of every column expression (for error messages); a plan of some
    # hundred expressions is built in half the time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    # With the UI off nobody reads the driver's in-memory job/stage/task/SQL
    # history; keeping it short stops a driver that runs many queries from
    # slowing down as that history (and its GC load) grows.
    "spark.ui.retainedJobs": "100",
    "spark.ui.retainedStages": "100",
    "spark.ui.retainedTasks": "2000",
    "spark.sql.ui.retainedExecutions": "50",
}


def build_session(master: str | None = None, app: str = "hearth",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    On a cluster ``master`` stays None so spark-submit decides; tests pass
    ``local[*]`` and a small ``shuffle_partitions``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    if not shuffle_partitions:
        size_shuffles(spark)
    return spark


# Floor for the initial shuffle partition count on a cluster.
MIN_INITIAL_SHUFFLE_PARTITIONS = 8192


def size_shuffles(spark: SparkSession) -> None:
    """On a cluster, start every shuffle wide and let AQE coalesce it.

    AQE can merge small shuffle partitions but never split a large one (only
    skewed join partitions are split). So a shuffle starts from at least
    ``MIN_INITIAL_SHUFFLE_PARTITIONS`` (or four per core) partitions. AQE then
    coalesces them towards ``advisoryPartitionSizeInBytes`` (128 MB), not
    towards the core count (``parallelismFirst`` off, as recommended for
    shared clusters). Nothing changes on ``local`` masters, and settings the
    job was submitted with are kept.
    """
    sc = spark.sparkContext
    if sc.master.startswith("local"):
        return
    submitted = sc.getConf()
    if not (submitted.contains("spark.sql.shuffle.partitions")
            or submitted.contains("spark.sql.adaptive.coalescePartitions.initialPartitionNum")):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                       str(max(MIN_INITIAL_SHUFFLE_PARTITIONS, 4 * sc.defaultParallelism)))
    if not submitted.contains("spark.sql.adaptive.coalescePartitions.parallelismFirst"):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session. Only when it is unset
    (local runs and tests) is a private folder created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="hearth-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
