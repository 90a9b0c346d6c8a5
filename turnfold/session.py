"""Session helpers: one place that builds a local session for tests and
reads cluster settings (checkpoint folder) from whatever session is live."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "turnfold") -> SparkSession:
    """Local session as used by tests and the bench.  On a cluster the
    caller owns the session; nothing here is needed there."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TURNFOLD_DRIVER_MEM", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared (HDFS/object-store) folder and
    is respected as is.  Only when it is unset -- local tests -- a private
    scratch folder is created and registered."""
    sc = spark.sparkContext
    set_by_caller = sc.getCheckpointDir()
    if set_by_caller:
        # Spark appends a folder of its own name to the one that was set
        return set_by_caller.rsplit("/", 1)[0]
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="turnfold-ckpt-")
    sc.setCheckpointDir(current)
    return current


def ship(spark: SparkSession) -> None:
    """Let local Python workers import this package whatever the working
    folder; a cluster gets it by ``--py-files`` or PYTHONPATH."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH", ""), root) if x)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written
    intermediate tables (lineage cuts, round trips)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def scale_conf(input_bytes: int, total_cores: int,
               target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings for a large cluster, sized from the input volume.

    * shuffle partitions: enough that each reduce task handles about
      ``target_partition_bytes`` before AQE coalesces (and at least two
      waves of the available cores);
    * scan splits of the same size, so a map task's input fits in memory;
    * AQE coalescing toward the same size, skew-join splitting for
      partitions four times larger than that, and a broadcast threshold
      small enough that a broadcast side is never one of the big tables.
    """
    import math
    parts = max(2 * total_cores, math.ceil(input_bytes / target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    """Apply runtime-settable SQL settings to a live session."""
    for k, v in conf.items():
        spark.conf.set(k, v)
