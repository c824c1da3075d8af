"""Fact plans.

Join layout of the order-line fact, chosen to keep the shuffles of the
largest table (order lines) few:

* lines and orders are first restricted to resolvable keys (non-null and
  matched in the dimensions); only then are repeats dropped, so an invalid
  copy never displaces a valid one;
* orders are keyed with the customer surrogate and the best review
  (pre-aggregated per order) on the orders side, which is smaller than the
  lines; lines ⋈ keyed orders on order_id is the one big join shuffle.
Every fact-to-dimension join is a plain equi-join: Spark broadcasts a side by
its measured bytes and splits a hot key's partition at run time.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stardw.functions import exprs as X
from stardw.operators.keys import dense_key, keep_first
from stardw.operators.lineage import release, remove, staged
from stardw.session import scratch_dir

SUMMARY_COLUMNS = [
    "sk_date", "sk_seller", "sk_product_category", "orders_count", "items_count",
    "revenue_total", "freight_total", "gross_profit_total", "on_time_deliveries",
    "delivered_items", "review_score_sum", "reviews_count",
]

def best_review(reviews: DataFrame) -> DataFrame:
    """Best (= highest) score per order; partial aggregation map-side."""
    return (reviews.where(F.col("order_id").isNotNull())
            .groupBy("order_id").agg(F.max("review_score").alias("review_score")))


def customer_key_lookup(customers: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """customer_id -> customer_unique_id -> sk_customer; the final
    group-by keeps one key per customer_id."""
    return (customers.select("customer_id", "customer_unique_id")
            .join(dim_customer.select("customer_unique_id", "sk_customer"), "customer_unique_id")
            .groupBy("customer_id").agg(F.min("sk_customer").alias("sk_customer")))


ORDER_COLS = ["customer_id", "order_purchase_timestamp",
              "order_delivered_customer_date", "order_estimated_delivery_date"]
LINE_KEYS = ["order_id", "order_item_id"]
LINE_ORDER = ["product_id", "seller_id", "price", "freight_value"]


def keyed_orders(orders: DataFrame, customers: DataFrame, reviews: DataFrame,
                 dim_customer: DataFrame) -> DataFrame:
    """One row per resolvable order (purchase time and known customer), with
    its customer key and best review; of repeats the first by ORDER_COLS."""
    valid = (orders.select("order_id", *ORDER_COLS)
             .where("order_id IS NOT NULL AND order_purchase_timestamp IS NOT NULL")
             .join(customer_key_lookup(customers, dim_customer), "customer_id"))
    first = keep_first(valid, ["order_id"], ORDER_COLS)
    return first.join(best_review(reviews), "order_id", "left")


def build_fact_order_item(orders: DataFrame, items: DataFrame, customers: DataFrame,
                          reviews: DataFrame, dim_customer: DataFrame, dim_seller: DataFrame,
                          dim_product: DataFrame, product_attrs: Sequence[str] = (),
                          days: tuple[_dt.date, _dt.date] | None = None) -> DataFrame:
    """One row per (order_id, order_item_id) with date / customer / seller /
    product keys and measures; then the ``product_attrs``, columns of the
    product dimension that a reader of the lines needs beside them.

    A value wider than its column (an item number of 40,000) is NULL there and
    counted by ``constraint_audit``; it does not end the load.

    P4 before S5: lines with an unknown or missing key go first, then of the
    lines of one key the first by LINE_ORDER stays (insert-ignore).

    With ``days`` (first, last) the rows purchased then: which copy of an order
    stays is settled among all of them, then lines of other orders go before
    anything is attached to them."""
    keyed = keyed_orders(orders, customers, reviews, dim_customer)
    if days is not None:
        keyed, _ = staged(keyed.where(F.to_date("order_purchase_timestamp").between(*days)), "orders-of-days")
        items = items.join(keyed.select("order_id"), "order_id", "left_semi")
    return fact_rows(items, keyed, dim_seller, dim_product, product_attrs)


def stage_fact_order_item(orders: DataFrame, items: DataFrame, customers: DataFrame, reviews: DataFrame,
                          dim_customer: DataFrame, dim_seller: DataFrame, dim_product: DataFrame,
                          parts: int = 1) -> tuple[DataFrame, str]:
    """The fact as a staged table, and its path, built in ``parts`` by a hash
    of the order: nothing in it reaches beyond its order, so a part has whole
    orders, and the shuffle files of one part go before the next is built.
    ``items`` is read once for each part: for a stored table."""
    spark = items.sparkSession
    keyed, keyed_path = staged(keyed_orders(orders, customers, reviews, dim_customer), "keyed-orders")
    release(spark)
    if items.schema["order_id"].dataType != keyed.schema["order_id"].dataType:
        parts = 1  # equal ids of two types have two hashes
    path = scratch_dir(spark, "fact-parts")
    of = F.pmod(F.xxhash64("order_id"), F.lit(parts))
    for part in range(parts):
        rows = fact_rows(items.where(of == part), keyed.where(of == part), dim_seller, dim_product)
        rows.write.mode("append").option("compression", "zstd").parquet(path)
        release(spark)
    remove(spark, keyed_path)
    return spark.read.schema(rows.schema).parquet(path), path


def fact_rows(items: DataFrame, keyed: DataFrame, dim_seller: DataFrame, dim_product: DataFrame,
              product_attrs: Sequence[str] = ()) -> DataFrame:
    """The fact's rows of these lines and keyed orders."""
    attrs = [F.col(c).alias(f"__{c}") for c in product_attrs]
    lines = items.select(*LINE_KEYS, *LINE_ORDER).where("order_id IS NOT NULL AND order_item_id IS NOT NULL")
    lines = (lines.join(dim_product.select("product_id", "sk_product", "unit_cost", *attrs), "product_id")
             .join(dim_seller.select("seller_id", "sk_seller"), "seller_id"))
    # shuffled on (order_id, order_item_id), so even an order holding a third
    # of all lines spreads over many tasks
    lines = keep_first(lines, LINE_KEYS, LINE_ORDER)
    f = lines.join(keyed, "order_id")

    purchase = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    estimated = F.col("order_estimated_delivery_date")
    return f.select(
        F.col("order_id"),
        F.col("order_item_id").try_cast("smallint").alias("order_item_id"),
        X.date_key(purchase).alias("sk_date_purchase"),
        X.date_key(delivered).alias("sk_date_delivered"),
        X.date_key(estimated).alias("sk_date_estimated_delivery"),
        "sk_customer",
        "sk_seller",
        "sk_product",
        F.col("price").try_cast("decimal(10,2)").alias("price"),
        F.col("freight_value").try_cast("decimal(10,2)").alias("freight_value"),
        (F.col("price") + F.col("freight_value")).try_cast("decimal(10,2)").alias("revenue"),
        (F.col("price") - F.coalesce(F.col("unit_cost"), F.lit(0))).try_cast("decimal(10,2)").alias("gross_profit"),
        F.col("unit_cost").try_cast("decimal(10,2)").alias("unit_cost"),
        X.elapsed_days(purchase, delivered).try_cast("smallint").alias("delivery_days"),
        X.on_time_flag(delivered, estimated).alias("is_on_time"),
        F.col("review_score").try_cast("smallint").alias("review_score"),
        *[F.col(f"__{c}").alias(c) for c in product_attrs],
    )


def category_ids(by_name: DataFrame) -> DataFrame:
    """K2: 1-based ids of the distinct category names in code-point order."""
    return dense_key(by_name.select("product_category").distinct(), ["product_category"], "sk_product_category", "int")


def daily_summary_by_name(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """A7 on (purchase date, seller, category name): one partial+final hash
    aggregate; the exact distinct order count is Spark's two-level distinct
    aggregation (no per-group lists).  Lines that carry their category are not
    joined for it; money is added in whole cents, narrow rows to shuffle."""
    f = fact
    if "product_category" not in fact.columns:
        f = fact.join(dim_product.select("sk_product", "product_category"), "sk_product", "left")
    f = f.withColumn("product_category", F.coalesce("product_category", F.lit("Unknown")))

    def money(c: str):
        total = (F.sum(X.cents(c)).cast("decimal(20,0)") / F.lit(100)).cast("decimal(20,2)")
        return F.coalesce(total, F.lit(0)).cast("decimal(12,2)")
    return f.groupBy("sk_date_purchase", "sk_seller", "product_category").agg(
        F.count_distinct("order_id").cast("int").alias("orders_count"),
        F.count("order_item_id").cast("int").alias("items_count"),
        money("revenue").alias("revenue_total"),
        money("freight_value").alias("freight_total"),
        money("gross_profit").alias("gross_profit_total"),
        F.count_if(F.col("is_on_time") == 1).cast("int").alias("on_time_deliveries"),
        F.count("sk_date_delivered").cast("int").alias("delivered_items"),
        F.coalesce(F.sum("review_score"), F.lit(0)).cast("int").alias("review_score_sum"),
        F.count("review_score").cast("int").alias("reviews_count"),
    )


def build_fact_daily_seller_category(fact: DataFrame, dim_product: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The daily seller x category summary and the category map
    (persisted as ``dim_product_category``).  Category ids are attached to the
    already-aggregated rows, not to the order lines.  Both the summary and the
    map are small written tables, so the planner knows the map's bytes: the
    few dozen names are broadcast, whatever the number of products."""
    by_name, _ = staged(daily_summary_by_name(fact, dim_product), "summary-by-name")
    return number_categories(by_name)


def stage_summary_by_name(fact: DataFrame, dim_product: DataFrame, days: Sequence[Column]) -> tuple[DataFrame, str]:
    """`daily_summary_by_name` as a staged table, and its path, built for one
    range of days after the other: the day is in its key, and the shuffle files
    of a range go before the next is built."""
    spark = fact.sparkSession
    path = scratch_dir(spark, "summary-by-name")
    for of in days:
        rows = daily_summary_by_name(fact.where(of), dim_product)
        rows.write.mode("append").option("compression", "zstd").parquet(path)
        release(spark)
    return spark.read.schema(rows.schema).parquet(path), path


def number_categories(by_name: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The summary with category ids, and the category map, of the (written)
    summary by category name."""
    cat_map, _ = staged(category_ids(by_name).select("sk_product_category", "product_category"), "category-map")
    summary = (by_name.join(cat_map, "product_category")
               .withColumnRenamed("sk_date_purchase", "sk_date")
               .select(*SUMMARY_COLUMNS))
    return summary, cat_map
