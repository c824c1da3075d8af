"""Lineage cuts.

A reliable checkpoint (files in the shared ``spark.checkpoint.dir``) makes a
result stable under re-execution and executor loss, and lets several
consumers read it without recomputing its plan.  Local checkpoints are never
used: they die with the executor that holds them.  ``staged`` writes a narrow
parquet table instead (column pruning and statistics for its readers), which
the caller removes when it is done.
"""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from stardw.session import ensure_checkpoint_dir, scratch_dir


def materialize(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` as a parquet table of the shared scratch folder, and its path."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a staged table through the file system that holds it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a staged table's files."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def release(spark: SparkSession) -> None:
    """Lets the shuffle files of finished steps go: Spark's cleaner deletes
    them when the driver has collected what refers to them, and a driver with
    memory to spare may not do so before the disk is full."""
    gc.collect()
    spark._jvm.System.gc()
