"""SparkSession helpers.

Library code never creates its own session; it takes the caller's.  The only
session-level requirement is a reliable checkpoint directory (used to cut
lineage when dense surrogate keys are numbered).  On a cluster that is the
shared folder named by ``spark.checkpoint.dir``; only a local-mode session
without one (tests, the bench) gets a private scratch folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings of sessions built here.  Queries never change the settings of a
# session they are given: time columns carry no zone, and adaptive execution
# is on by default.  Checkpoints that nothing refers to any more are removed
# by Spark's cleaner (give the same setting to spark-submit on a cluster).
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "stardw",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests / bench / CLI runs (the UI stays off: no server)."""
    b = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20,
               shuffle_fraction: float = 0.25) -> dict[str, str]:
    """Settings for a cluster run sized from the raw input volume.

    Shuffles move a fraction of the raw bytes (projected columns, map-side
    partial aggregation), so the partition count targets
    ``input * shuffle_fraction / target_partition_bytes`` — each partition
    fits executor memory, AQE coalesces small ones and splits skewed ones.
    The count grows with the input; to track fewer map outputs, raise the
    target size.  Scan splits use the same target size."""
    parts = int(input_bytes * shuffle_fraction // target_partition_bytes) + 1
    parts = max(200, parts)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, configuring it from
    ``spark.checkpoint.dir`` when the context has none yet.  A private scratch
    folder is created only for local-mode sessions that name none."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect client: the server owns the context
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            raise RuntimeError("spark.checkpoint.dir is not set on the Spark Connect server")
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at a folder shared by all "
            "executors (HDFS / object store) before building the warehouse")
    scratch = tempfile.mkdtemp(prefix="stardw-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory (never a
    machine-local temp folder on a cluster)."""
    import uuid
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
