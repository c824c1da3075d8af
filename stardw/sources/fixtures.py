"""Raw marketplace tables derived from the driver's TPC-H-style parquet.

The shapes (documented in FIXTURES.md) put NULLs, unknown states, orders
without delivery or estimate, deliveries before purchase, several reviews
per order, untranslated / missing categories and repeated order lines into
the data on purpose.  Everything is a lazy DataFrame over the parquet scans,
so every query built on it grows with the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stardw.operators.keys import keep_first
from stardw.sources.raw import RawTables

# FIXED VALUES (fixture definition): brand -> English category name; of repeated
# brands the last counts.
FIXTURE_TRANSLATION = [
    ("Brand#3", "audio_old"), ("Brand#7", "bags_old"),
    ("Brand#1", "electronics"), ("Brand#2", "computers_accessories"), ("Brand#3", "audio"),
    ("Brand#4", "bed_bath_table"), ("Brand#5", "garden_tools"), ("Brand#6", "home_appliances"),
    ("Brand#7", "fashion_bags"), ("Brand#8", "luggage"), ("Brand#9", "health_beauty"),
    ("Brand#10", "perfumery"), ("Brand#11", "sports_leisure"), ("Brand#12", "toys"),
    ("Brand#13", "books_general"), ("Brand#14", "cds_dvds_musicals"), ("Brand#15", "food_drink"),
    ("Brand#16", "auto"), ("Brand#17", "construction_tools"), ("Brand#18", "security_services"),
    ("Brand#19", "arts_and_craft"), ("Brand#20", "party_supplies"), ("Brand#21", "pet_shop"),
    ("Brand#22", "cool_stuff"),
]

# FIXED VALUES (fixture definition): nation key -> state code (nation 24 has none).
FIXTURE_NATION_STATE = [
    (0, "AM"), (1, "PA"), (2, "AC"), (3, "TO"), (4, "MA"), (5, "CE"), (6, "BA"), (7, "PE"),
    (8, "SE"), (9, "MT"), (10, "MS"), (11, "GO"), (12, "DF"), (13, "SP"), (14, "RJ"), (15, "MG"),
    (16, "ES"), (17, "PR"), (18, "SC"), (19, "RS"), (20, "SP"), (21, "RJ"), (22, "SP"), (23, "ZZ"),
]

# Ids added to those of the tables: entities without sales, and ids that no
# table holds.
IDLE, UNKNOWN = 50_000_000, 100_000_000
UNKNOWN_ORDER = 900_000_000

_BASE_COLUMNS = {
    "customer": ["c_custkey", "c_nationkey"],
    "supplier": ["s_suppkey", "s_nationkey"],
    "part": ["p_partkey", "p_brand", "p_size"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"],
    "lineitem": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"],
    "nation": ["n_nationkey", "n_name"],
}


def read_base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan with the projection stated up front (ReadSchema pruning)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*_BASE_COLUMNS[name])


def _state_of(nationkey: str):
    m = F.create_map(*[F.lit(x) for kv in FIXTURE_NATION_STATE for x in kv])
    return m[F.col(nationkey)]


def _nation_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_base(spark, sf_dir, "nation")


def _secs(c):
    return c.cast("int")


def fixture_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_base(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    unique = F.concat(F.lit("U"), F.when(k % 10 == 9, k - 1).otherwise(k).cast("string"))
    return (c.join(_nation_names(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(k.alias("customer_id"), unique.alias("customer_unique_id"),
                    F.lower("n_name").alias("customer_city"),
                    _state_of("c_nationkey").alias("customer_state")))


def fixture_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth supplier has a twin without sales; some suppliers appear
    again under the same id in another nation, one without an id."""
    s = read_base(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    moved = s.where(k % 9 == 4).withColumn("s_nationkey", (F.col("s_nationkey") + 5) % 25)
    lost = s.where(k == 1).withColumn("s_suppkey", F.lit(None).cast("long"))
    s = s.unionByName(s.where(k % 10 == 0).withColumn("s_suppkey", k + IDLE)).unionByName(moved).unionByName(lost)
    return (s.join(_nation_names(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .select(k.alias("seller_id"), F.lower("n_name").alias("seller_city"),
                    _state_of("s_nationkey").alias("seller_state")))


def fixture_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every twentieth part has an unsold twin; some parts appear again under
    the same id with another brand, one without an id."""
    p = read_base(spark, sf_dir, "part")
    k = F.col("p_partkey")
    other = p.where(k % 15 == 4).withColumn("p_brand", F.lit("Brand#13"))
    lost = p.where(k == 1).withColumn("p_partkey", F.lit(None).cast("long"))
    p = p.unionByName(p.where(k % 20 == 0).withColumn("p_partkey", k + IDLE)).unionByName(other).unionByName(lost)
    return p.select(k.alias("product_id"),
                    F.when(F.col("p_size") == 50, F.lit(None)).otherwise(F.col("p_brand"))
                    .alias("product_category_name"))


def fixture_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some orders lack the purchase time or a known customer; some appear
    twice, the other copy without purchase time and customer or a day later."""
    o = read_base(spark, sf_dir, "orders")
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    purchase = F.when(k % 61 == 5, F.lit(None)).otherwise(F.timestamp_add("SECOND", _secs(k * 7919 % 86400), d))
    customer = (F.when(k % 71 == 5, F.lit(None)).when(k % 67 == 5, F.col("o_custkey") + UNKNOWN)
                .otherwise(F.col("o_custkey")))
    approved = F.timestamp_add("DAY", F.lit(1), d)
    delivered = F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(
        F.timestamp_add("SECOND", _secs(k * 104729 % 86400),
                        F.timestamp_add("DAY", _secs(k % 40), d)))
    estimated = F.when(k % 50 == 0, F.lit(None)).otherwise(F.timestamp_add("DAY", F.lit(25), d))
    base = o.select(k.alias("order_id"), customer.cast("long").alias("customer_id"),
                    purchase.cast("timestamp_ntz").alias("order_purchase_timestamp"),
                    approved.alias("order_approved_at"),
                    delivered.cast("timestamp_ntz").alias("order_delivered_customer_date"),
                    estimated.cast("timestamp_ntz").alias("order_estimated_delivery_date"))
    invalid = (base.where(F.col("order_id") % 19 == 3)
               .withColumn("customer_id", F.lit(None).cast("long"))
               .withColumn("order_purchase_timestamp", F.lit(None).cast("timestamp_ntz")))
    later = (base.where(F.col("order_id") % 23 == 3)
             .withColumn("order_purchase_timestamp", F.timestamp_add("DAY", F.lit(1), F.col("order_purchase_timestamp"))))
    return base.unionByName(invalid).unionByName(later)


def fixture_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as a source delivers them: (order_id, order_item_id)
    repeats; products and sellers are missing or unknown on some lines, and
    some valid lines have an invalid copy; some orders are unknown."""
    li = read_base(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    product = (F.when(k % 97 == 5, F.lit(None)).when(k % 89 == 5, F.col("l_partkey") + UNKNOWN)
               .otherwise(F.col("l_partkey")))
    seller = (F.when(k % 103 == 5, F.lit(None)).when(k % 101 == 5, F.col("l_suppkey") + UNKNOWN)
              .otherwise(F.col("l_suppkey")))
    base = li.select(k.alias("order_id"), F.col("l_linenumber").alias("order_item_id"),
                     product.cast("long").alias("product_id"), seller.cast("long").alias("seller_id"),
                     F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
                     F.col("l_quantity").cast("decimal(10,2)").alias("freight_value"))
    o = F.col("order_id")
    no_product = base.where(o % 17 == 3).withColumn("product_id", F.lit(None).cast("long"))
    no_seller = base.where(o % 13 == 3).withColumn("seller_id", F.col("seller_id") + UNKNOWN)
    no_order = base.where((o % 83 == 3) & (F.col("order_item_id") == 1)).withColumn("order_id", o + UNKNOWN_ORDER)
    return base.unionByName(no_product).unionByName(no_seller).unionByName(no_order)


def fixture_first_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert-ignore on (order_id, order_item_id), first row by
    (product_id, seller_id, price, freight_value)."""
    return keep_first(fixture_items(spark, sf_dir), ["order_id", "order_item_id"],
                      ["product_id", "seller_id", "price", "freight_value"])


def fixture_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_base(spark, sf_dir, "orders").select("o_orderkey")
    k = F.col("o_orderkey")
    first = o.where(k % 7 != 0).select(k.alias("order_id"), (1 + k % 5).cast("int").alias("review_score"))
    second = o.where(k % 11 == 0).select(k.alias("order_id"), (1 + (k + 2) % 5).cast("int").alias("review_score"))
    return first.unionByName(second)


def fixture_translation(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FIXTURE_TRANSLATION,
                                 "product_category_name string, product_category_name_english string")


def fixture_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(
        customers=fixture_customers(spark, sf_dir),
        orders=fixture_orders(spark, sf_dir),
        items=fixture_items(spark, sf_dir),
        products=fixture_products(spark, sf_dir),
        sellers=fixture_sellers(spark, sf_dir),
        reviews=fixture_reviews(spark, sf_dir),
        translation=fixture_translation(spark),
    )
