"""Stored keys of a table, dealt to buckets (S3 and S5 against a large table).

Beside a table that is appended to lies ``<table>__keys``: its keys only, in
folders by a hash of the key.  A batch reads the folders of its own keys'
buckets and nothing of the table itself, so what an append reads follows the
batch as long as it has fewer keys than there are buckets, and the narrow index
otherwise.  The index is built from the table when it is first needed.

A marker stands beside the index while an append is under way.  If one is found
later, that append did not end: the index is built anew from the table, which
holds all rows or none of each of its write tasks' commits.  One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stardw.operators.lineage import remove

#: Buckets of an index that is built anew; an existing one keeps its number.
BUCKETS = 256


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def index_path(table_path: str) -> str:
    return f"{table_path}__keys"


def _marker(table_path: str) -> str:
    return f"{table_path}__keys_open"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a key; integers of any width fall alike."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def drop_index(spark: SparkSession, table_path: str) -> None:
    """For a table that is written anew."""
    for path in (index_path(table_path), _marker(table_path)):
        if _exists(spark, path):
            remove(spark, path)


def _write(keys: DataFrame, names: Sequence[str], table_path: str, buckets: int, mode: str) -> None:
    (keys.select(*names).withColumn("buckets", F.lit(buckets)).withColumn("bucket", bucket_of(names, buckets))
     .repartition("bucket").write.mode(mode).partitionBy("buckets", "bucket").parquet(index_path(table_path)))


def open_index(table: DataFrame, names: Sequence[str], table_path: str, buckets: int = BUCKETS) -> DataFrame:
    """The index of a stored table: the one there is, or a new one."""
    spark = table.sparkSession
    path = index_path(table_path)
    if _exists(spark, _marker(table_path)) or not _exists(spark, f"{path}/_SUCCESS"):
        drop_index(spark, table_path)
        _write(table, names, table_path, buckets, "overwrite")
    schema = ", ".join(f"`{k}` {table.schema[k].dataType.simpleString()}" for k in names)
    return spark.read.schema(f"{schema}, buckets int, bucket int").parquet(path)


def keys_met(index: DataFrame, names: Sequence[str], batch: DataFrame) -> DataFrame:
    """The stored keys in the buckets of the batch's keys (the driver gets the
    numbers of the buckets only)."""
    buckets = index.select("buckets").first()
    if buckets is None:
        return index.select(*names)
    here = [r.b for r in batch.select(bucket_of(names, buckets[0]).alias("b")).distinct().collect()]
    return index.where(F.col("bucket").isin(here)).select(*names)


def begin_append(spark: SparkSession, table_path: str) -> None:
    fs, p = _fs(spark, _marker(table_path))
    fs.create(p, True).close()


def end_append(fresh: DataFrame, names: Sequence[str], index: DataFrame, table_path: str, buckets: int = BUCKETS) -> None:
    """Adds the appended rows' keys and takes the marker away."""
    known = index.select("buckets").first()
    _write(fresh, names, table_path, known[0] if known else buckets, "append")
    remove(fresh.sparkSession, _marker(table_path))
