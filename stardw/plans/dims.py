"""Dimension plans.

Each builder takes raw DataFrames and returns the dimension with its
surrogate key, columns in warehouse order and explicit types.  Aggregations
are written pre-aggregated (per entity before joining) so that the large
order-line table is reduced map-side before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stardw.functions import exprs as X
from stardw.operators.aggregates import date_bounds, first_non_null_by
from stardw.operators.keys import dense_key, keep_known_first
from stardw.params import Params

ORDER_DATE_COLUMNS = ["order_purchase_timestamp", "order_approved_at",
                      "order_delivered_customer_date", "order_estimated_delivery_date"]


# ------------------------------------------------------------------ C1

def build_dim_date(orders: DataFrame) -> DataFrame:
    """One row per calendar day between the earliest and the latest date
    found in any of the four order timestamps (inclusive).

    The bounds are one partial-aggregated pass over orders; the day spine is
    bounded by the calendar span, not by the data volume."""
    bounds = date_bounds(orders, ORDER_DATE_COLUMNS).where(F.col("lo").isNotNull())
    days = bounds.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    d = F.col("date")
    return days.select(
        X.date_key(d).alias("sk_date"),
        d.alias("date"),
        F.dayofmonth(d).cast("smallint").alias("day"),
        F.month(d).cast("smallint").alias("month"),
        X.month_name(d).alias("month_name"),
        F.quarter(d).cast("smallint").alias("quarter"),
        F.year(d).cast("smallint").alias("year"),
        X.weekday_name(d).alias("day_of_week"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    )


def order_dates(orders: DataFrame) -> DataFrame:
    """U1 + A8: the set of calendar dates referenced by any of the four order
    timestamps (one array explode per row, then a partial-aggregating
    distinct)."""
    return (orders.select(F.explode(F.array(*[F.to_date(c) for c in ORDER_DATE_COLUMNS])).alias("date"))
            .where(F.col("date").isNotNull()).distinct())


# ------------------------------------------------------------------ C2

def customer_profile(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """J1 + A1: one row per customer_unique_id with first non-NULL city/state
    (by customer_id), number of timestamped orders and first order time.

    Orders are reduced to one row per customer_id before the join."""
    per_customer_id = (orders.where(F.col("customer_id").isNotNull())
                       .groupBy("customer_id")
                       .agg(F.count("order_purchase_timestamp").alias("n_orders"),
                            F.min("order_purchase_timestamp").alias("first_ts")))
    joined = (customers.select("customer_id", "customer_unique_id", "customer_city", "customer_state")
              .where(F.col("customer_unique_id").isNotNull())
              .join(per_customer_id, "customer_id", "left"))
    return joined.groupBy("customer_unique_id").agg(
        first_non_null_by("customer_city", "customer_id").alias("customer_city"),
        first_non_null_by("customer_state", "customer_id").alias("customer_state"),
        F.coalesce(F.sum("n_orders"), F.lit(0)).cast("long").alias("order_count"),
        F.min("first_ts").alias("first_order"),
    )


def build_dim_customer(customers: DataFrame, orders: DataFrame, p: Params) -> DataFrame:
    """Customer dimension with simulated attributes and dense keys."""
    prof = customer_profile(customers, orders)
    key = F.col("customer_unique_id")
    age = X.sim_age(key, p)
    attrs = prof.select(
        key,
        F.col("customer_city").cast("string"),
        F.col("customer_state").cast("string"),
        X.region_of("customer_state").alias("customer_region"),
        age.alias("customer_age"),
        X.age_group(age).alias("customer_age_group"),
        X.sim_gender(key, p).alias("customer_gender"),
        X.sim_signup_date(key, "first_order", p).alias("customer_signup_date"),
        X.customer_segment("order_count").alias("customer_segment"),
    )
    keyed = dense_key(attrs, ["customer_unique_id"], "sk_customer")
    return keyed.select("sk_customer", *[c for c in attrs.columns])


# ------------------------------------------------------------------ shared: category translation

def translation_lookup(translation: DataFrame) -> DataFrame:
    """Category translation with duplicate source names resolved as "last
    row wins" (row position = scan order: the row order of a single file;
    across several files Spark orders splits by size, so the winner among
    duplicates in different files is unspecified)."""
    pos = translation.withColumn("__pos", F.monotonically_increasing_id())
    return (pos.where(F.col("product_category_name").isNotNull())
            .groupBy("product_category_name")
            .agg(F.max_by("product_category_name_english", "__pos").alias("product_category_name_english")))


def product_categories(products: DataFrame, translation: DataFrame) -> DataFrame:
    """product_id -> English category (untranslated names pass through); of
    rows that share an id the smallest name stays, NULL ids are refused (S5)."""
    return (keep_known_first(products.select("product_id", "product_category_name"), "product_id", ["product_category_name"])
            .join(translation_lookup(translation), "product_category_name", "left")
            .select("product_id",
                    F.coalesce("product_category_name_english", "product_category_name")
                    .alias("product_category")))


# ------------------------------------------------------------------ C3

def seller_stats(items: DataFrame, products: DataFrame, translation: DataFrame) -> DataFrame:
    """A2 + A3 per seller: main category (mode, ties -> smallest, all-NULL ->
    "Unknown"), item count and price sum.

    Narrow lines meet their product's category in one shuffle ((seller,
    product) pairs hardly repeat, so counting them first would move the lines
    twice; a hot product is split by the join); then one (seller, category)
    aggregation, combined map-side, feeds both the mode and the totals in a
    single per-seller aggregation (``min(struct(-count, category))`` over the
    non-NULL categories is the deterministic mode)."""
    lines = (items.where(F.col("seller_id").isNotNull())
             .select("seller_id", "product_id", "price", F.col("order_item_id").isNotNull().alias("numbered")))
    cats = product_categories(products, translation)
    per_cat = (lines.join(cats, "product_id", "left")
               .groupBy("seller_id", "product_category")
               .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("numbered").alias("n_items"),
                    F.sum("price").alias("price_sum")))
    cat = F.col("product_category")
    best = F.min(F.when(cat.isNotNull(), F.struct((-F.col("n_rows")).alias("neg_n"), cat.alias("v"))))
    return per_cat.groupBy("seller_id").agg(
        F.sum("n_items").alias("total_items"),
        F.sum("price_sum").alias("total_revenue"),
        F.coalesce(best.getField("v"), F.lit("Unknown")).alias("seller_main_category"))


def build_dim_seller(sellers: DataFrame, items: DataFrame, products: DataFrame,
                     translation: DataFrame, p: Params) -> DataFrame:
    """Seller dimension.  A seller without items keeps a NULL main category.
    Of rows that share an id the smallest (city, state) stays, a known value
    before NULL; NULL ids are refused (S5)."""
    stats = seller_stats(items, products, translation)
    one = keep_known_first(sellers.select("seller_id", "seller_city", "seller_state"), "seller_id", ["seller_city", "seller_state"])
    s = one.join(stats, "seller_id", "left")
    attrs = s.select(
        "seller_id",
        F.col("seller_city").cast("string"),
        F.col("seller_state").cast("string"),
        X.region_of("seller_state").alias("seller_region"),
        F.col("seller_main_category").cast("string"),
        X.seller_size("total_items", p).alias("seller_size_category"),
        X.seller_tier("total_revenue", p).alias("seller_tier"),
        X.sim_seller_join_date(F.col("seller_id"), p).alias("seller_join_date"),
    )
    keyed = dense_key(attrs, ["seller_id"], "sk_seller")
    return keyed.select("sk_seller", *attrs.columns)


# ------------------------------------------------------------------ C4

def product_list_price(items: DataFrame) -> DataFrame:
    """A4: mean sale price per product, rounded half-up to cents, computed in
    exact integer cents (no float and no double rounding)."""
    agg = (items.where(F.col("product_id").isNotNull())
           .groupBy("product_id")
           .agg(F.sum(X.cents("price")).alias("cents_sum"), F.count("price").alias("n")))
    return agg.select("product_id",
                      X.half_up_ratio("cents_sum", F.col("n") * 100, 2, 10).alias("list_price"))


def build_dim_product(products: DataFrame, items: DataFrame, translation: DataFrame,
                      p: Params) -> DataFrame:
    """C4: product dimension; unsold products keep NULL prices (band Unknown,
    not premium)."""
    cats = product_categories(products, translation)
    priced = cats.join(product_list_price(items), "product_id", "left")
    lp = F.col("list_price")
    attrs = priced.select(
        "product_id",
        F.col("product_category").cast("string"),
        X.category_group("product_category").alias("product_category_group"),
        lp.try_cast("decimal(10,2)").alias("list_price"),
        X.price_band(lp, p).alias("price_band"),
        F.round(lp * X._dec(p.cost_ratio), 2).try_cast("decimal(10,2)").alias("unit_cost"),
        X.is_premium(lp, p).alias("is_premium"),
    )
    keyed = dense_key(attrs, ["product_id"], "sk_product")
    return keyed.select("sk_product", *attrs.columns)
