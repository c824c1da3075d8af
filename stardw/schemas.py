"""Warehouse table definitions (S9) and fixed sink column order.

Each table lists (column, Spark type, NOT NULL, max length for VARCHAR(n)).
Natural ids (order_id, customer_unique_id, seller_id, product_id) keep the
type of the source they come from; their declared VARCHAR length is audited.
"""

from __future__ import annotations

from pyspark.sql import types as T

NATURAL = None  # type follows the source

# FIXED VALUES: table names, columns, types, lengths and NOT NULL of the source's
# table definitions (surrogate keys are 64-bit here).
TABLES: dict[str, list[tuple[str, T.DataType | None, bool, int | None]]] = {
    "dim_date": [
        ("sk_date", T.IntegerType(), True, None),
        ("date", T.DateType(), True, None),
        ("day", T.ShortType(), True, None),
        ("month", T.ShortType(), True, None),
        ("month_name", T.StringType(), True, 10),
        ("quarter", T.ShortType(), True, None),
        ("year", T.ShortType(), True, None),
        ("day_of_week", T.StringType(), True, 10),
        ("is_weekend", T.BooleanType(), True, None),
    ],
    "dim_customer": [
        ("sk_customer", T.LongType(), True, None),
        ("customer_unique_id", NATURAL, True, 32),
        ("customer_city", T.StringType(), False, 50),
        ("customer_state", T.StringType(), False, 2),
        ("customer_region", T.StringType(), False, 15),
        ("customer_age", T.ShortType(), False, None),
        ("customer_age_group", T.StringType(), False, 10),
        ("customer_gender", T.StringType(), False, 1),
        ("customer_signup_date", T.DateType(), False, None),
        ("customer_segment", T.StringType(), False, 10),
    ],
    "dim_seller": [
        ("sk_seller", T.LongType(), True, None),
        ("seller_id", NATURAL, True, 32),
        ("seller_city", T.StringType(), False, 50),
        ("seller_state", T.StringType(), False, 2),
        ("seller_region", T.StringType(), False, 15),
        ("seller_main_category", T.StringType(), False, 50),
        ("seller_size_category", T.StringType(), False, 10),
        ("seller_tier", T.StringType(), False, 10),
        ("seller_join_date", T.DateType(), False, None),
    ],
    "dim_product": [
        ("sk_product", T.LongType(), True, None),
        ("product_id", NATURAL, True, 32),
        ("product_category", T.StringType(), False, 50),
        ("product_category_group", T.StringType(), False, 30),
        ("list_price", T.DecimalType(10, 2), False, None),
        ("price_band", T.StringType(), False, 10),
        ("unit_cost", T.DecimalType(10, 2), False, None),
        ("is_premium", T.BooleanType(), False, None),
    ],
    "fact_order_item": [
        ("order_id", NATURAL, True, 32),
        ("order_item_id", T.ShortType(), True, None),
        ("sk_date_purchase", T.IntegerType(), True, None),
        ("sk_date_delivered", T.IntegerType(), False, None),
        ("sk_date_estimated_delivery", T.IntegerType(), False, None),
        ("sk_customer", T.LongType(), True, None),
        ("sk_seller", T.LongType(), True, None),
        ("sk_product", T.LongType(), True, None),
        ("price", T.DecimalType(10, 2), True, None),
        ("freight_value", T.DecimalType(10, 2), True, None),
        ("revenue", T.DecimalType(10, 2), True, None),
        ("gross_profit", T.DecimalType(10, 2), False, None),
        ("unit_cost", T.DecimalType(10, 2), False, None),
        ("delivery_days", T.ShortType(), False, None),
        ("is_on_time", T.ShortType(), False, None),
        ("review_score", T.ShortType(), False, None),
    ],
    "fact_daily_seller_category": [
        ("sk_date", T.IntegerType(), True, None),
        ("sk_seller", T.LongType(), True, None),
        ("sk_product_category", T.IntegerType(), True, None),
        ("orders_count", T.IntegerType(), False, None),
        ("items_count", T.IntegerType(), False, None),
        ("revenue_total", T.DecimalType(12, 2), False, None),
        ("freight_total", T.DecimalType(12, 2), False, None),
        ("gross_profit_total", T.DecimalType(12, 2), False, None),
        ("on_time_deliveries", T.IntegerType(), False, None),
        ("delivered_items", T.IntegerType(), False, None),
        ("review_score_sum", T.IntegerType(), False, None),
        ("reviews_count", T.IntegerType(), False, None),
    ],
    "dim_product_category": [
        ("sk_product_category", T.IntegerType(), True, None),
        ("product_category", T.StringType(), True, 50),
    ],
}

# primary key and unique natural keys per table
KEYS: dict[str, list[tuple[str, list[str]]]] = {
    "dim_date": [("pk", ["sk_date"]), ("uq_date", ["date"])],
    "dim_customer": [("pk", ["sk_customer"]), ("uq_natural", ["customer_unique_id"])],
    "dim_seller": [("pk", ["sk_seller"]), ("uq_natural", ["seller_id"])],
    "dim_product": [("pk", ["sk_product"]), ("uq_natural", ["product_id"])],
    "fact_order_item": [("pk", ["order_id", "order_item_id"])],
    "fact_daily_seller_category": [("pk", ["sk_date", "sk_seller", "sk_product_category"])],
    "dim_product_category": [("pk", ["sk_product_category"]), ("uq_natural", ["product_category"])],
}

# foreign keys: (name, child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("foi_date_purchase", "fact_order_item", "sk_date_purchase", "dim_date", "sk_date"),
    ("foi_date_delivered", "fact_order_item", "sk_date_delivered", "dim_date", "sk_date"),
    ("foi_date_estimated", "fact_order_item", "sk_date_estimated_delivery", "dim_date", "sk_date"),
    ("foi_customer", "fact_order_item", "sk_customer", "dim_customer", "sk_customer"),
    ("foi_seller", "fact_order_item", "sk_seller", "dim_seller", "sk_seller"),
    ("foi_product", "fact_order_item", "sk_product", "dim_product", "sk_product"),
    ("fdsc_date", "fact_daily_seller_category", "sk_date", "dim_date", "sk_date"),
    ("fdsc_seller", "fact_daily_seller_category", "sk_seller", "dim_seller", "sk_seller"),
    ("fdsc_category", "fact_daily_seller_category", "sk_product_category",
     "dim_product_category", "sk_product_category"),
]


def column_order(table: str) -> list[str]:
    return [c for c, *_ in TABLES[table]]

