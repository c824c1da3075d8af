"""Streaming insert-ignore of fact rows (S3 + S5 over micro-batches).

New fact rows land as parquet files in a staging folder; a Structured
Streaming query picks them up and, per micro-batch, appends only rows whose
(order_id, order_item_id) is new — duplicates inside the batch keep the first
row by a stated order, keys already stored are dropped.  Because the sink
skips stored keys, a micro-batch replayed after a failure appends nothing
twice: the sink is idempotent on top of the query's checkpointed progress.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stardw.sources.warehouse_io import append_ignore

FACT_KEYS = ["order_id", "order_item_id"]
FACT_ORDER = ["sk_date_purchase", "sk_customer", "sk_seller", "sk_product", "price", "freight_value"]


def fact_appender(spark: SparkSession, staging_dir: str, schema: T.StructType, warehouse_dir: str,
                  checkpoint_location: str, files_per_batch: int | None = None,
                  available_now: bool = True) -> StreamingQuery:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(staging_dir)

    def sink(batch: DataFrame, _batch_id: int) -> None:
        append_ignore(batch, warehouse_dir, "fact_order_item", FACT_KEYS, FACT_ORDER)

    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
