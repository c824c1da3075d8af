"""Warehouse tables on shared storage.

* ``write_table`` — full refresh (``overwrite``) with the fixed column order;
  the facts are range-partitioned and sorted on their unique key led by the
  date key, so date-sliced reads skip files and row groups by min/max stats
  and no single day (however hot) funnels into one writer task.
* ``append_ignore`` — insert-ignore append: rows whose key already exists
  (in the batch or in the table) are dropped, the first by a stated order is
  kept.  What is stored is looked up in an index of the keys by buckets
  (``key_index.py``), not in the table.
* ``extend_dimension`` — members that a dimension does not hold yet, numbered
  on from its greatest key; what is stored keeps its keys and attributes.
* ``read_table`` — read back (natural key -> surrogate key lookups).
Writes go through Spark's file commit protocol: a lost executor's task is
re-run and its partial output discarded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stardw import schemas as S
from stardw.operators.keys import dense_key, in_ranges, keep_first
from stardw.operators.lineage import materialize, release
from stardw.sources import key_index

# Range keys are the table's full unique key (leading with the date), so a
# hot day — or a hot seller on a hot day — still splits over many tasks.
SORT_KEYS = {
    "fact_order_item": ["sk_date_purchase", "sk_seller", "order_id", "order_item_id"],
    "fact_daily_seller_category": ["sk_date", "sk_seller", "sk_product_category"],
}
MAX_RECORDS_PER_FILE = 5_000_000


def table_path(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{table}"


def _layout(df: DataFrame, table: str) -> DataFrame:
    """Declared columns, order and types (S9); natural ids keep the source's type."""
    types = {c: t for c, t, *_ in S.TABLES[table]}
    out = df.select(*[F.col(c) if types[c] is None else F.col(c).cast(types[c]).alias(c) for c in S.column_order(table)])
    keys = SORT_KEYS.get(table)
    if keys:
        out = out.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return out


def write_table(df: DataFrame, base: str, table: str, mode: str = "overwrite") -> str:
    path = table_path(base, table)
    if mode == "overwrite":
        key_index.drop_index(df.sparkSession, path)
    _layout(df, table).write.mode(mode).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(path)
    return path


def write_table_in_ranges(df: DataFrame, base: str, table: str, tops: Sequence) -> str:
    """`write_table` of one range of the table's first sort key after the other
    (``tops``: where they end): the same layout, for the files of a range are
    sorted and lie in it, and the shuffle files of a range go before the next.
    ``df`` is read once for each range: for a stored table."""
    for k, of in enumerate(in_ranges(SORT_KEYS[table][0], tops)):
        path = write_table(df.where(of), base, table, "append" if k else "overwrite")
        release(df.sparkSession)
    return path


def read_table(spark: SparkSession, base: str, table: str) -> DataFrame:
    return spark.read.parquet(table_path(base, table)).select(*S.column_order(table))


def _existing(spark: SparkSession, base: str, table: str) -> DataFrame | None:
    """The stored table; None if there is no such path (a table that is there
    but cannot be read is an error)."""
    try:
        found = spark.read.parquet(table_path(base, table))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return found.select(*S.column_order(table))


def append_ignore(batch: DataFrame, base: str, table: str, keys: Sequence[str],
                  order_cols: Sequence[str]) -> DataFrame:
    """S5 against existing rows; returns the rows actually appended
    (materialized before the write, so reading them later does not re-probe
    the grown table).  A row with a NULL key part is an error."""
    spark = batch.sparkSession
    existing = _existing(spark, base, table)
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    checked = batch.withColumn(keys[0], F.when(complete, F.col(keys[0])).otherwise(
        F.raise_error(F.lit(f"{table}: a key column of {list(keys)} is NULL")).cast(batch.schema[keys[0]].dataType)))
    fresh = keep_first(checked, list(keys), list(order_cols))
    path = table_path(base, table)
    fresh = materialize(fresh)
    if existing is None:
        key_index.drop_index(spark, path)
    else:
        index = key_index.open_index(existing, keys, path)
        fresh = materialize(fresh.join(key_index.keys_met(index, keys, fresh), list(keys), "left_anti"))
    key_index.begin_append(spark, path)
    _layout(fresh, table).write.mode("append").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(path)
    if existing is not None:
        key_index.end_append(fresh, keys, index, path)
    return fresh


def extend_dimension(members: DataFrame, base: str, table: str, natural: str, surrogate: str) -> DataFrame:
    """Appends the ``members`` (a dimension's columns; the surrogate key is not
    read) whose natural key the stored dimension lacks, and returns them.

    Their keys go on from the greatest stored one, dense and in the order of
    the natural key.  Stored members change neither key nor attributes, and a
    repeated load adds nothing (S5)."""
    stored = _existing(members.sparkSession, base, table)
    attrs = members.select(*[c for c in S.column_order(table) if c != surrogate])
    top = 0
    if stored is not None:
        attrs = attrs.join(stored.select(natural), natural, "left_anti")
        top = stored.agg(F.max(surrogate)).first()[0] or 0
    fresh = materialize(dense_key(attrs, [natural], surrogate).withColumn(surrogate, F.col(surrogate) + F.lit(top)))
    write_table(fresh, base, table, mode="append")
    return fresh


def write_jdbc(df: DataFrame, table: str, url: str, target: str, properties: dict[str, str],
               mode: str = "append", batch_size: int = 2000) -> None:
    """Append a warehouse table to a database table through Spark's JDBC
    writer, in the fixed column order, ``batch_size`` rows per insert batch.
    Each task writes its partition in its own transaction; key conflicts are
    left to the target's constraints."""
    (df.select(*S.column_order(table)).write.mode(mode).option("batchsize", batch_size)
     .jdbc(url, target, properties=properties))


TABLES = ["dim_date", "dim_customer", "dim_seller", "dim_product", "fact_order_item",
          "fact_daily_seller_category", "dim_product_category"]


def register_catalog(spark: SparkSession, base: str, database: str = "stardw") -> list[str]:
    """Expose the stored warehouse as external parquet tables of a
    catalog database (``CREATE TABLE ... USING parquet LOCATION``), so the
    star schema can be queried with plain Spark SQL.  A table that is
    registered already then reads ``base`` (its files elsewhere stay); one that
    is no external table is an error."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for t in TABLES:
        name = f"{database}.{t}"
        if spark.catalog.tableExists(name):
            if spark.catalog.getTable(name).tableType != "EXTERNAL":
                raise ValueError(f"{name} is no external table")
            spark.sql(f"DROP TABLE {name}")
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{table_path(base, t)}'")
        names.append(name)
    return names
