"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus the
matching oracle SQL.  Every query reads the driver's parquet tables (through
the fixture derivation) so its work grows with them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stardw import oracle as O
from stardw.params import FIXTURE_PARAMS, Params
from stardw.plans import audit, dims, facts, reports
from stardw.plans.warehouse import Warehouse
from stardw.sources import fixtures as FX
from stardw.sources.raw import RAW_SCHEMAS

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn
    return deco


def warehouse(spark: SparkSession, sf_dir: str, p: Params = FIXTURE_PARAMS) -> Warehouse:
    return Warehouse(FX.fixture_tables(spark, sf_dir), p)


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


# ============================================================ dimensions / facts

@register("dim_date_spine", O.with_warehouse("SELECT * FROM w_dim_date"))
def q_dim_date(spark, sf_dir):
    return warehouse(spark, sf_dir).dim_date


@register("order_date_set", O.with_fixtures("""
SELECT DISTINCT d AS date FROM (
  SELECT CAST(order_purchase_timestamp AS DATE) AS d FROM fx_orders
  UNION ALL SELECT CAST(order_approved_at AS DATE) FROM fx_orders
  UNION ALL SELECT CAST(order_delivered_customer_date AS DATE) FROM fx_orders
  UNION ALL SELECT CAST(order_estimated_delivery_date AS DATE) FROM fx_orders) x
WHERE d IS NOT NULL"""))
def q_order_date_set(spark, sf_dir):
    return dims.order_dates(FX.fixture_orders(spark, sf_dir))


@register("dim_customer", O.with_warehouse("SELECT * FROM w_dim_customer"))
def q_dim_customer(spark, sf_dir):
    return warehouse(spark, sf_dir).dim_customer


@register("customer_attributes", O.with_warehouse("""
SELECT customer_age_group, customer_gender, customer_segment,
       CAST(count(*) AS BIGINT) AS customers,
       CAST(min(customer_age) AS SMALLINT) AS min_age, CAST(max(customer_age) AS SMALLINT) AS max_age,
       CAST(min(date_diff('day', customer_signup_date, CAST(first_order AS DATE))) AS INTEGER) AS min_signup_lead_days,
       CAST(max(date_diff('day', customer_signup_date, CAST(first_order AS DATE))) AS INTEGER) AS max_signup_lead_days,
       CAST(count(customer_signup_date) AS BIGINT) AS with_signup
FROM w_dim_customer JOIN w_cust_profile USING (customer_unique_id)
GROUP BY customer_age_group, customer_gender, customer_segment"""))
def q_customer_attributes(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    prof = dims.customer_profile(w.raw.customers, w.raw.orders).select("customer_unique_id", "first_order")
    return (w.dim_customer.join(prof, "customer_unique_id")
            .groupBy("customer_age_group", "customer_gender", "customer_segment")
            .agg(F.count(F.lit(1)).alias("customers"),
                 F.min("customer_age").cast("smallint").alias("min_age"),
                 F.max("customer_age").cast("smallint").alias("max_age"),
                 F.min(F.datediff(F.to_date("first_order"), "customer_signup_date")).cast("int")
                 .alias("min_signup_lead_days"),
                 F.max(F.datediff(F.to_date("first_order"), "customer_signup_date")).cast("int")
                 .alias("max_signup_lead_days"),
                 F.count("customer_signup_date").alias("with_signup")))


@register("dim_seller", O.with_warehouse("SELECT * FROM w_dim_seller"))
def q_dim_seller(spark, sf_dir):
    return warehouse(spark, sf_dir).dim_seller


@register("dim_product", O.with_warehouse("SELECT * FROM w_dim_product"))
def q_dim_product(spark, sf_dir):
    return warehouse(spark, sf_dir).dim_product


@register("category_group_map", O.with_warehouse(
    "SELECT DISTINCT product_category, product_category_group FROM w_dim_product"))
def q_category_group_map(spark, sf_dir):
    return warehouse(spark, sf_dir).dim_product.select("product_category", "product_category_group").distinct()


@register("line_dedup", O.with_fixtures("SELECT * FROM fx_first_items"))
def q_line_dedup(spark, sf_dir):
    return FX.fixture_first_items(spark, sf_dir)


@register("best_review", O.with_warehouse("SELECT order_id, CAST(review_score AS INTEGER) AS review_score FROM w_best_review"))
def q_best_review(spark, sf_dir):
    return facts.best_review(FX.fixture_reviews(spark, sf_dir)).select(
        "order_id", F.col("review_score").cast("int"))


@register("customer_key_lookup", O.with_warehouse("SELECT customer_id, sk_customer FROM w_cust_sk"))
def q_customer_key_lookup(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return facts.customer_key_lookup(w.raw.customers, w.dim_customer)


@register("fact_order_item", O.with_warehouse("SELECT * FROM w_fact"))
def q_fact_order_item(spark, sf_dir):
    return warehouse(spark, sf_dir).fact_order_item


@register("category_ids", O.with_warehouse("SELECT * FROM w_cat_ids"))
def q_category_ids(spark, sf_dir):
    return warehouse(spark, sf_dir).dim_product_category


@register("fact_daily_seller_category", O.with_warehouse("SELECT * FROM w_summary"))
def q_fact_daily(spark, sf_dir):
    return warehouse(spark, sf_dir).fact_daily_seller_category


# reports and audits register themselves on import
reports.register_all(register, warehouse)
audit.register_all(register, warehouse)


# ============================================================ sources / sinks round trips

# What the CSV round trip must carry beside the fixture's own values: free text
# with blanks, quotes, separators and line breaks, null tokens with and without
# blanks around them, whole numbers in float form, times out of range.
_ODD_TEXT = ["plain", " blanks ", "two\nlines", 'a "quote", b', " NA ", "  ", "NA", "n/a", "None", "nan", "-1.#IND", ""]


def _csv_roundtrip_sql() -> str:
    tokens = {"NA", "n/a", "None", "nan", "-1.#IND", ""}
    text = " ".join(f"WHEN {k} THEN {'NULL' if t in tokens else O._q(t)}" for k, t in enumerate(_ODD_TEXT))
    return O.with_fixtures(f"""
SELECT 'orders' AS table_name, order_id AS id, CAST(order_purchase_timestamp AS VARCHAR) AS a,
       CAST(order_estimated_delivery_date AS VARCHAR) AS b, CAST(customer_id AS VARCHAR) AS c FROM fx_orders
UNION ALL SELECT 'items', order_id, CAST(price AS VARCHAR), CAST(order_item_id AS VARCHAR), CAST(seller_id AS VARCHAR) FROM fx_items
UNION ALL SELECT 'products', product_id, product_category_name, NULL, NULL FROM fx_products
UNION ALL SELECT 'reviews', order_id, CAST(review_score AS VARCHAR), NULL, NULL FROM fx_reviews
UNION ALL SELECT 'sellers', seller_id, seller_city, seller_state, NULL FROM fx_sellers
UNION ALL SELECT 'customers', customer_id, customer_unique_id, customer_city, CASE customer_id % {len(_ODD_TEXT)} {text} END
          FROM fx_customers""")


@register("csv_source_roundtrip", _csv_roundtrip_sql())
def q_csv_roundtrip(spark, sf_dir):
    """Write the raw tables as header CSV with a null token, read them
    back by name with token clean-up and lenient casts; every value must
    survive.  Item numbers and scores are written as ``5.0``, some estimates
    lie beyond the range of times (and must read as NULL), and the customers'
    state holds odd texts."""
    from pyspark.sql import types as T
    from stardw.session import scratch_dir
    from stardw.sources.csv import read_csv_table, read_raw_csv, write_csv_table
    raw = FX.fixture_tables(spark, sf_dir).as_dict()
    odd = F.element_at(F.array(*[F.lit(t) for t in _ODD_TEXT]), (F.col("customer_id") % len(_ODD_TEXT)).cast("int") + 1)
    raw["customers"] = raw["customers"].withColumn("customer_state", odd)
    raw["items"] = raw["items"].withColumn("order_item_id", F.concat(F.col("order_item_id").cast("string"), F.lit(".0")))
    raw["reviews"] = raw["reviews"].withColumn("review_score", F.concat(F.col("review_score").cast("string"), F.lit(".0")))
    late = "order_estimated_delivery_date"
    raw["orders"] = raw["orders"].withColumn(late, F.coalesce(F.col(late).cast("string"), F.lit("9999-12-31 00:00:00")))
    base = scratch_dir(spark, "csv")
    for name, df in raw.items():
        write_csv_table(df, f"{base}/{name}.csv")
    back = read_raw_csv(spark, base, id_type=T.LongType()).as_dict()
    back["customers"] = read_csv_table(spark, f"{base}/customers.csv", "customers", T.StructType(
        [T.StructField(f.name, T.LongType() if f.name == "customer_id" else f.dataType) for f in RAW_SCHEMAS["customers"].fields]),
        multi_line=True)

    def row(name: str, key: str, *cols: str) -> DataFrame:
        values = [F.col(c).cast("string") for c in cols] + [F.lit(None).cast("string")] * (3 - len(cols))
        return back[name].select(F.lit(name).alias("table_name"), F.col(key).alias("id"),
                                 *[v.alias(x) for v, x in zip(values, "abc", strict=True)])
    return reduce(DataFrame.unionByName, [
        row("orders", "order_id", "order_purchase_timestamp", late, "customer_id"),
        row("items", "order_id", "price", "order_item_id", "seller_id"), row("products", "product_id", "product_category_name"),
        row("reviews", "order_id", "review_score"), row("sellers", "seller_id", "seller_city", "seller_state"),
        row("customers", "customer_id", "customer_unique_id", "customer_city", "customer_state")])


@register("fact_without_reviews", O.with_warehouse(
    "SELECT * REPLACE (CAST(NULL AS SMALLINT) AS review_score) FROM w_fact"))
def q_fact_without_reviews(spark, sf_dir):
    """The reviews source is absent -> typed empty table -> the fact
    still builds, with NULL review scores."""
    import dataclasses
    from stardw.session import scratch_dir
    from stardw.sources.csv import read_optional
    raw = FX.fixture_tables(spark, sf_dir)
    missing = f"{scratch_dir(spark, 'absent')}/reviews.csv"
    raw = dataclasses.replace(raw, reviews=read_optional(spark, missing, "reviews", raw.reviews.schema))
    return Warehouse(raw, FIXTURE_PARAMS).fact_order_item


@register("warehouse_roundtrip", O.with_warehouse("SELECT * FROM w_fact"))
def q_warehouse_roundtrip(spark, sf_dir):
    """C7 + S3/S4/S7/S10: full load to storage, fact read back."""
    from stardw.plans.load import load_warehouse
    from stardw.session import scratch_dir
    stored = load_warehouse(FX.fixture_tables(spark, sf_dir), FIXTURE_PARAMS, scratch_dir(spark, "warehouse"))
    return stored.fact_order_item


@register("dim_seller_two_loads", O.with_warehouse("""
SELECT d.* REPLACE (CAST(CASE WHEN seller_id % 3 <> 0 THEN row_number() OVER (PARTITION BY seller_id % 3 <> 0 ORDER BY seller_id)
                         ELSE (SELECT count(*) FROM w_dim_seller WHERE seller_id % 3 <> 0)
                              + row_number() OVER (PARTITION BY seller_id % 3 <> 0 ORDER BY seller_id) END AS BIGINT) AS sk_seller)
FROM w_dim_seller d"""))
def q_dim_seller_two_loads(spark, sf_dir):
    """S5 for a dimension against stored rows: a first load without every third
    seller, then all of them twice; stored members keep their keys, the others
    are numbered on."""
    from stardw.plans.dims import build_dim_seller
    from stardw.session import scratch_dir
    from stardw.sources.warehouse_io import extend_dimension, read_table
    raw, base = FX.fixture_tables(spark, sf_dir), scratch_dir(spark, "two-loads")
    for sellers in (raw.sellers.where("seller_id % 3 <> 0"), raw.sellers, raw.sellers):
        extend_dimension(build_dim_seller(sellers, raw.items, raw.products, raw.translation, FIXTURE_PARAMS), base, "dim_seller", "seller_id", "sk_seller")
    return read_table(spark, base, "dim_seller")


STREAM_FILES = 8  # of each staged copy


@register("fact_stream_append", O.with_warehouse("SELECT * FROM w_fact"))
def q_fact_stream_append(spark, sf_dir):
    """S5 over a stream: the fact rows are staged twice; the streaming
    insert-ignore sink must store each key exactly once.  The fact is built
    once; each copy lies in the same number of files whatever its size, so the
    batches grow with the rows and not in number (each reads the stored keys)."""
    from stardw.session import scratch_dir
    from stardw.sources.warehouse_io import read_table
    from stardw.streaming.append import fact_appender
    w = warehouse(spark, sf_dir)
    base = scratch_dir(spark, "stream")
    fact = w.hold_fact().fact_order_item
    for copy in ("a", "b"):
        fact.coalesce(STREAM_FILES).write.mode("append").parquet(f"{base}/staging")
    q = fact_appender(spark, f"{base}/staging", fact.schema, f"{base}/warehouse", f"{base}/progress",
                      files_per_batch=4)
    q.awaitTermination()
    return read_table(spark, f"{base}/warehouse", "fact_order_item")
