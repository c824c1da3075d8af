"""Streaming insert-ignore: replayed and repeated fact rows are stored once."""

from pyspark.sql import functions as F

from stardw.catalog import warehouse
from stardw.session import scratch_dir
from stardw.sources.warehouse_io import read_table
from stardw.streaming.append import fact_appender

from paths import SF_SMALL


def test_stream_append_is_idempotent(spark):
    fact = warehouse(spark, SF_SMALL).fact_order_item
    n = fact.count()
    base = scratch_dir(spark, "stream-test")
    fact.where(F.col("sk_seller") % 2 == 0).write.mode("append").parquet(f"{base}/staging")
    fact.write.mode("append").parquet(f"{base}/staging")
    q = fact_appender(spark, f"{base}/staging", fact.schema, f"{base}/wh", f"{base}/progress", files_per_batch=3)
    q.awaitTermination()
    stored = read_table(spark, f"{base}/wh", "fact_order_item")
    assert stored.count() == n
    assert stored.select("order_id", "order_item_id").distinct().count() == n
    # a new query over the same files (e.g. a lost checkpoint) appends nothing twice
    q2 = fact_appender(spark, f"{base}/staging", fact.schema, f"{base}/wh", f"{base}/progress2")
    q2.awaitTermination()
    assert read_table(spark, f"{base}/wh", "fact_order_item").count() == n
