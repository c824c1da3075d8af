"""The seven raw marketplace tables the warehouse is built from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Columns the pipeline reads, with their Spark types.  Natural ids are
# strings in the CSV source; the parquet-derived fixtures keep BIGINT ids.
RAW_SCHEMAS: dict[str, T.StructType] = {
    "customers": T.StructType([
        T.StructField("customer_id", T.StringType()),
        T.StructField("customer_unique_id", T.StringType()),
        T.StructField("customer_city", T.StringType()),
        T.StructField("customer_state", T.StringType()),
    ]),
    "orders": T.StructType([
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("order_purchase_timestamp", T.TimestampNTZType()),
        T.StructField("order_approved_at", T.TimestampNTZType()),
        T.StructField("order_delivered_customer_date", T.TimestampNTZType()),
        T.StructField("order_estimated_delivery_date", T.TimestampNTZType()),
    ]),
    "items": T.StructType([
        T.StructField("order_id", T.StringType()),
        T.StructField("order_item_id", T.IntegerType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("seller_id", T.StringType()),
        T.StructField("price", T.DecimalType(10, 2)),
        T.StructField("freight_value", T.DecimalType(10, 2)),
    ]),
    "products": T.StructType([
        T.StructField("product_id", T.StringType()),
        T.StructField("product_category_name", T.StringType()),
    ]),
    "sellers": T.StructType([
        T.StructField("seller_id", T.StringType()),
        T.StructField("seller_city", T.StringType()),
        T.StructField("seller_state", T.StringType()),
    ]),
    "reviews": T.StructType([
        T.StructField("order_id", T.StringType()),
        T.StructField("review_score", T.IntegerType()),
    ]),
    "translation": T.StructType([
        T.StructField("product_category_name", T.StringType()),
        T.StructField("product_category_name_english", T.StringType()),
    ]),
}


@dataclass(frozen=True)
class RawTables:
    customers: DataFrame
    orders: DataFrame
    items: DataFrame
    products: DataFrame
    sellers: DataFrame
    reviews: DataFrame
    translation: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {k: getattr(self, k) for k in RAW_SCHEMAS}
