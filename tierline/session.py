"""Session construction and shared-folder handling."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every tierline session wants: adaptive execution (runtime coalescing,
# broadcast conversion from measured sizes, skew-join splitting), a fixed session
# time zone for reproducible timestamp semantics, and no web UI.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings sized to the data: scan splits and shuffle partitions of about
    ``target_partition_bytes`` so each task's working set fits executor memory,
    at least two tasks per core, and AQE targets that coalesce small
    partitions and split skewed ones at the same size.

    For 100 TB on 1000 executors x 8 cores: ~400k shuffle partitions of 256 MB.
    """
    import math
    parts = max(2 * total_cores, math.ceil(input_bytes / target_partition_bytes))
    size = str(target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        # broadcast only sides proven small by statistics / AQE measurements; files of ids and flags are
        # many times larger in memory than on disk, so their sizes count eightfold
        "spark.sql.sources.fileCompressionFactor": "8.0",
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def build_session(master: str | None = None, app_name: str = "tierline",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a SparkSession with tierline's defaults.

    ``shuffle_partitions`` should be sized so one shuffle partition fits in an
    executor task (~128-256 MB); AQE coalesces small ones at runtime.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``; only where that is unset
    (local runs and tests) a folder inside Spark's warehouse is registered instead. On a cluster
    the warehouse may by default be a folder of the driver's machine, so there the setting is required.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a driver-side context: the setting alone
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc is None or not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        configured = f"{warehouse}/tierline-scratch"
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_scratch(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared checkpoint location.

    Used for tables and files that jobs write and read back (CSV round trips,
    audited saves); never a machine-local temporary folder.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tierline-{label}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, label: str = "cut") -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder
    and continue from the written files.

    Survives executor loss (unlike a local checkpoint), truncates the plan, and
    the re-read scan carries file-size statistics, so the planner can still
    broadcast a small result (an RDD checkpoint has none) - and parquet is
    columnar and compressed rather than Java-serialised rows.
    """
    spark = df.sparkSession
    path = shared_scratch(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
