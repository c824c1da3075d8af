"""Report queries over the warehouse.

Every report first reduces the fact to the keys its groups need (partial
aggregation, then one shuffle of narrow rows), then attaches the dimension
attributes to the reduced rows and groups again; sums and counts add up, so
ratios are taken last.  Joins are plain equi-joins: Spark broadcasts a side by
its bytes and splits hot keys at run time.
Ratios are exact half-up decimals computed from integral sums
(``half_up_ratio``), never averages of doubles.  Thresholds the source leaves
open are ``Params`` fields.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stardw import oracle as O
from stardw.functions import exprs as X
from stardw.params import FIXTURE_PARAMS, Params
from stardw.plans.slicers import date_key_range, item_sliced, sliced
from stardw.plans.warehouse import Warehouse


# ------------------------------------------------------------------ star joins

def _join_seller(df: DataFrame, w: Warehouse, *cols: str) -> DataFrame:
    return df.join(w.dim_seller.select("sk_seller", *cols), "sk_seller")


def _join_customer(df: DataFrame, w: Warehouse, *cols: str) -> DataFrame:
    return df.join(w.dim_customer.select("sk_customer", *cols), "sk_customer")


def _categorised(w: Warehouse, *cols: str) -> DataFrame:
    """The order lines with their product's category (missing: Unknown)."""
    return (w.fact_lines("product_category", *cols)
            .withColumn("product_category", F.coalesce("product_category", F.lit("Unknown"))))


def _dim_date(w: Warehouse, *cols: str, role: str = "sk_date_purchase") -> DataFrame:
    """The date dimension in one role (one row per calendar day)."""
    return w.dim_date.select(F.col("sk_date").alias(role), *cols)


# ------------------------------------------------------------------ measures (A10)

# Additive parts of the measures: summed over lines first, over groups later.
PARTS = ["items", "revenue_sum", "profit_sum", "score_sum", "reviews", "on_time", "flagged", "delivered"]


def line_parts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("items"),
        F.sum("revenue").cast("decimal(28,2)").alias("revenue_sum"),
        F.sum("gross_profit").cast("decimal(28,2)").alias("profit_sum"),
        F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("reviews"),
        F.count_if(F.col("is_on_time") == 1).alias("on_time"),
        F.count("is_on_time").alias("flagged"),
        F.count("sk_date_delivered").alias("delivered"),
    ]


def added_parts() -> list[Column]:
    """PARTS of groups of groups."""
    return [(F.sum(c).cast("decimal(28,2)") if c in ("revenue_sum", "profit_sum") else F.sum(c)).alias(c) for c in PARTS]


def _cents(c: str) -> Column:
    return (F.col(c) * 100).cast("decimal(38,0)")


def margin_pct(profit: Column | None = None, revenue: Column | None = None) -> Column:
    profit = _cents("profit_sum") if profit is None else profit
    revenue = _cents("revenue_sum") if revenue is None else revenue
    return X.half_up_ratio(profit * 100, revenue, 6).alias("margin_pct")


def mean_review() -> Column:
    return X.half_up_ratio("score_sum", "reviews", 6).alias("mean_review")


def on_time_rate() -> Column:
    return X.half_up_ratio("on_time", "flagged", 6).alias("on_time_rate")


def matrix_measures() -> list[Column]:
    return [F.col("revenue_sum").alias("revenue"), F.col("profit_sum").alias("gross_profit"),
            margin_pct(), mean_review(), on_time_rate(), F.col("items")]


MATRIX_MEASURES_SQL = f"""
  CAST(sum(revenue) AS DECIMAL(28,2)) AS revenue,
  CAST(sum(gross_profit) AS DECIMAL(28,2)) AS gross_profit,
  {O.ratio_sql('CAST(sum(CAST(gross_profit * 100 AS BIGINT)) AS HUGEINT) * 100', 'sum(CAST(revenue * 100 AS BIGINT))', 6)} AS margin_pct,
  {O.ratio_sql('sum(review_score)', 'count(review_score)', 6)} AS mean_review,
  {O.ratio_sql('count(*) FILTER (WHERE is_on_time = 1)', 'count(is_on_time)', 6)} AS on_time_rate,
  CAST(count(*) AS BIGINT) AS items"""

LINES_SQL = """
w_lines AS (
  SELECT f.*, coalesce(p.product_category, 'Unknown') AS product_category, p.product_category_group,
         p.list_price, s.seller_id, s.seller_tier, s.seller_region
  FROM w_fact f JOIN w_dim_product p ON f.sk_product = p.sk_product
       JOIN w_dim_seller s ON f.sk_seller = s.sk_seller)"""


# ------------------------------------------------------------------ R1 / R2

def category_tier_cells(w: Warehouse) -> DataFrame:
    """J15 reduced: PARTS per (category, seller tier)."""
    per = _categorised(w).groupBy("product_category", "sk_seller").agg(*line_parts())
    return _join_seller(per, w, "seller_tier").groupBy("product_category", "seller_tier").agg(*added_parts())


def report_category_tier_matrix(w: Warehouse) -> DataFrame:
    """A11 + A10: category -> tier hierarchy with subtotals; the ROLLUP
    expands the few cells, not the lines.  ``level`` is grouping_id (0 detail,
    1 category subtotal, 3 grand total)."""
    return (category_tier_cells(w).rollup("product_category", "seller_tier")
            .agg(F.grouping_id().cast("int").alias("level"), *added_parts())
            .select("product_category", "seller_tier", "level", *matrix_measures()))


def report_filtered_matrix(w: Warehouse) -> DataFrame:
    """R2: R1 under the time-period and category-group slicers (see
    ``slicers``: the period is a key range pushed into the fact scan, the
    groups a semi-join with the product dimension)."""
    return report_category_tier_matrix(sliced(w))


def report_sliced_tier_value(w: Warehouse) -> DataFrame:
    """R2 cascading to R3: tier totals and per-seller means under the slicers."""
    return report_tier_value(sliced(w))


def report_item_category_matrix(w: Warehouse) -> DataFrame:
    """R2 with the period and item-category slicers, on R1."""
    return report_category_tier_matrix(item_sliced(w))


def report_item_category_tier_value(w: Warehouse) -> DataFrame:
    """R2 with the period and item-category slicers, on R3."""
    return report_tier_value(item_sliced(w))


def report_item_category_scatter(w: Warehouse) -> DataFrame:
    """R2 with the period and item-category slicers, on R4."""
    return seller_scatter(item_sliced(w))


def _slicer_sql(p: Params) -> str:
    groups = ",".join(O._q(g) for g in p.slicer_groups)
    return (f"product_category_group IN ({groups}) AND sk_date_purchase IN "
            f"(SELECT sk_date FROM w_dim_date WHERE date BETWEEN DATE '{p.period_from}' AND DATE '{p.period_to}')")


def _item_slicer_sql(p: Params) -> str:
    names = ",".join(O._q(c) for c in p.slicer_categories)
    return (f"product_category IN ({names}) AND sk_date_purchase IN "
            f"(SELECT sk_date FROM w_dim_date WHERE date BETWEEN DATE '{p.period_from}' AND DATE '{p.period_to}')")


def _matrix_sql(where: str = "TRUE") -> str:
    return f"""
SELECT product_category, seller_tier, CAST(GROUPING(product_category, seller_tier) AS INTEGER) AS level,
{MATRIX_MEASURES_SQL}
FROM w_lines WHERE {where}
GROUP BY ROLLUP (product_category, seller_tier)"""


# ------------------------------------------------------------------ R3 / R14

def report_tier_value(w: Warehouse) -> DataFrame:
    """Totals per tier and means per seller (denominator: sellers with sales)."""
    per = w.fact_order_item.groupBy("sk_seller").agg(*line_parts())
    agg = _join_seller(per, w, "seller_tier").groupBy("seller_tier").agg(F.count(F.lit(1)).alias("sellers"), *added_parts())
    return agg.select(
        "seller_tier", "sellers", "items", F.col("revenue_sum").alias("revenue"), F.col("profit_sum").alias("gross_profit"),
        X.half_up_ratio(_cents("revenue_sum"), F.col("sellers") * 100, 2).alias("revenue_per_seller"),
        X.half_up_ratio(_cents("profit_sum"), F.col("sellers") * 100, 2).alias("gross_profit_per_seller"))


def _tier_value_sql(where: str = "TRUE") -> str:
    return f"""
SELECT seller_tier, sellers, items, revenue, gross_profit,
       {O.ratio_sql('rc', 'sellers * 100', 2)} AS revenue_per_seller,
       {O.ratio_sql('gc', 'sellers * 100', 2)} AS gross_profit_per_seller
FROM (SELECT seller_tier, CAST(count(DISTINCT sk_seller) AS BIGINT) AS sellers, CAST(count(*) AS BIGINT) AS items,
             CAST(sum(revenue) AS DECIMAL(28,2)) AS revenue, CAST(sum(gross_profit) AS DECIMAL(28,2)) AS gross_profit,
             sum(CAST(revenue * 100 AS BIGINT)) AS rc, sum(CAST(gross_profit * 100 AS BIGINT)) AS gc
      FROM w_lines WHERE {where} GROUP BY seller_tier) t"""


TIER_VALUE_SQL = _tier_value_sql()


def report_sellers_per_tier(w: Warehouse) -> DataFrame:
    """Sellers per tier (all sellers of the dimension) and how many sold."""
    return w.dim_seller.groupBy("seller_tier").agg(
        F.count(F.lit(1)).alias("sellers"),
        F.count("seller_main_category").alias("sellers_with_items"))


SELLERS_PER_TIER_SQL = """
SELECT seller_tier, CAST(count(*) AS BIGINT) AS sellers, CAST(count(seller_main_category) AS BIGINT) AS sellers_with_items
FROM w_dim_seller GROUP BY seller_tier"""


# ------------------------------------------------------------------ R4 and the seller decisions R10, R11, R13

def seller_scatter(w: Warehouse) -> DataFrame:
    """R4 + F13: one row per seller with sales."""
    per = w.fact_order_item.groupBy("sk_seller").agg(
        F.sum("revenue").cast("decimal(28,2)").alias("revenue"),
        F.sum("review_score").alias("_ss"), F.count("review_score").alias("reviews"))
    return (_join_seller(per, w, "seller_id", "seller_tier")
            .select("sk_seller", "seller_id", "seller_tier", "revenue", "reviews",
                    X.half_up_ratio("_ss", "reviews", 6).alias("mean_review"),
                    F.when(F.col("revenue") > 0, F.round(F.log10(F.col("revenue").cast("double")), 6))
                    .cast("decimal(18,6)").alias("log10_revenue")))


def _scatter_cte(name: str = "w_scatter", where: str = "TRUE") -> str:
    return f"""
{name} AS (
  SELECT sk_seller, seller_id, seller_tier, CAST(sum(revenue) AS DECIMAL(28,2)) AS revenue,
         CAST(count(review_score) AS BIGINT) AS reviews,
         {O.ratio_sql('sum(review_score)', 'count(review_score)', 6)} AS mean_review,
         CAST(CASE WHEN sum(revenue) > 0 THEN round(log10(CAST(sum(revenue) AS DOUBLE)), 6) END AS DECIMAL(18,6)) AS log10_revenue
  FROM w_lines WHERE {where}
  GROUP BY sk_seller, seller_id, seller_tier)"""


SCATTER_CTE = _scatter_cte()

SCATTER_COLS = "sk_seller, seller_id, seller_tier, revenue, reviews, mean_review, log10_revenue"


def report_risk_sellers(w: Warehouse) -> DataFrame:
    """High revenue, low review."""
    p = w.params
    return seller_scatter(w).where((F.col("revenue") >= X._dec(p.risk_min_revenue))
                                   & (F.col("mean_review") <= X._dec(p.risk_max_review)))


def report_growth_sellers(w: Warehouse) -> DataFrame:
    """Bronze sellers with excellent reviews."""
    p = w.params
    return seller_scatter(w).where((F.col("seller_tier") == "Bronze")
                                   & (F.col("mean_review") >= X._dec(p.growth_min_review)))


def report_tier_moves(w: Warehouse) -> DataFrame:
    """Silver sellers at Gold level (revenue >= Gold revenue per seller and
    review >= Gold mean review) -> "promote"; Gold sellers with a review at or
    below the Bronze mean -> "demote".  The three benchmarks come as one row
    from the per-seller rows the report itself starts from."""
    per = w.fact_order_item.groupBy("sk_seller").agg(*line_parts())
    sellers = _join_seller(per, w, "seller_id", "seller_tier")
    tier = F.col("seller_tier")

    def total(name: str, value: str) -> Column:
        return F.sum(F.when(tier == name, F.col(value)))
    bench = sellers.agg(
        X.half_up_ratio((total("Gold", "revenue_sum") * 100).cast("decimal(38,0)"), F.count_if(tier == "Gold") * 100, 2).alias("gold_revenue"),
        X.half_up_ratio(total("Gold", "score_sum"), total("Gold", "reviews"), 6).alias("gold_review"),
        X.half_up_ratio(total("Bronze", "score_sum"), total("Bronze", "reviews"), 6).alias("bronze_review"))
    # one row, added to each seller (a scalar subquery evaluated once)
    sc = sellers.select("sk_seller", "seller_id", "seller_tier", F.col("revenue_sum").alias("revenue"), mean_review(),
                        bench.select(F.struct("*")).scalar().alias("b"))
    move = (F.when((tier == "Silver") & (F.col("revenue") >= F.col("b.gold_revenue"))
                   & (F.col("mean_review") >= F.col("b.gold_review")), "promote")
            .when((tier == "Gold") & (F.col("mean_review") <= F.col("b.bronze_review")), "demote"))
    return sc.select("sk_seller", "seller_id", "seller_tier", "revenue", "mean_review",
                     move.alias("move")).where(F.col("move").isNotNull())


TIER_MOVES_SQL = f"""
, w_tier_bench AS (
  SELECT seller_tier,
         {O.ratio_sql('sum(CAST(revenue * 100 AS BIGINT))', 'count(DISTINCT sk_seller) * 100', 2)} AS rev_per_seller,
         {O.ratio_sql('sum(review_score)', 'count(review_score)', 6)} AS mean_review
  FROM w_lines GROUP BY seller_tier),
w_moves AS (
  SELECT sk_seller, seller_id, seller_tier, revenue, mean_review,
         CASE WHEN seller_tier = 'Silver'
                   AND revenue >= (SELECT rev_per_seller FROM w_tier_bench WHERE seller_tier = 'Gold')
                   AND mean_review >= (SELECT mean_review FROM w_tier_bench WHERE seller_tier = 'Gold') THEN 'promote'
              WHEN seller_tier = 'Gold'
                   AND mean_review <= (SELECT mean_review FROM w_tier_bench WHERE seller_tier = 'Bronze') THEN 'demote'
         END AS move
  FROM w_scatter)"""


# ------------------------------------------------------------------ R5 / R6

def _seller_region_parts(w: Warehouse) -> DataFrame:
    per = w.fact_order_item.groupBy("sk_seller").agg(*line_parts())
    return (_join_seller(per, w, "seller_region").groupBy("seller_region")
            .agg(F.count(F.lit(1)).alias("sellers"), *added_parts()))


def report_region_review(w: Warehouse) -> DataFrame:
    """Mean review by seller region."""
    return _seller_region_parts(w).select("seller_region", "sellers", "items", "reviews", mean_review())


REGION_REVIEW_SQL = f"""
SELECT seller_region, CAST(count(DISTINCT sk_seller) AS BIGINT) AS sellers, CAST(count(*) AS BIGINT) AS items,
       CAST(count(review_score) AS BIGINT) AS reviews,
       {O.ratio_sql('sum(review_score)', 'count(review_score)', 6)} AS mean_review
FROM w_lines GROUP BY seller_region"""


def report_region_on_time(w: Warehouse) -> DataFrame:
    """On-time rate by seller region, on both bases (D12): among flagged
    lines (delivered with an estimate) and among delivered lines, plus the
    delivered and flagged shares that explain the survivorship bias."""
    return _seller_region_parts(w).select(
        "seller_region", "items", F.col("delivered").alias("delivered_items"), F.col("on_time").alias("on_time_items"),
        on_time_rate(),
        X.half_up_ratio("on_time", "delivered", 6).alias("on_time_rate_delivered"),
        X.half_up_ratio("delivered", "items", 6).alias("delivered_share"),
        X.half_up_ratio("flagged", "items", 6).alias("flagged_share"))


REGION_ON_TIME_SQL = f"""
SELECT seller_region, CAST(count(*) AS BIGINT) AS items, CAST(count(sk_date_delivered) AS BIGINT) AS delivered_items,
       CAST(count(*) FILTER (WHERE is_on_time = 1) AS BIGINT) AS on_time_items,
       {O.ratio_sql('count(*) FILTER (WHERE is_on_time = 1)', 'count(is_on_time)', 6)} AS on_time_rate,
       {O.ratio_sql('count(*) FILTER (WHERE is_on_time = 1)', 'count(sk_date_delivered)', 6)} AS on_time_rate_delivered,
       {O.ratio_sql('count(sk_date_delivered)', 'count(*)', 6)} AS delivered_share,
       {O.ratio_sql('count(is_on_time)', 'count(*)', 6)} AS flagged_share
FROM w_lines GROUP BY seller_region"""


# ------------------------------------------------------------------ R7 + R8

def report_monthly_tier_revenue(w: Warehouse) -> DataFrame:
    """Monthly revenue by tier; R8: a month is flagged incomplete when its
    last day lies after the latest purchase date (scalar subquery)."""
    per = w.fact_order_item.groupBy("sk_date_purchase", "sk_seller").agg(*line_parts())
    last_key = w.fact_order_item.agg(F.max("sk_date_purchase")).scalar()
    days = per.join(_dim_date(w, "year", "month"), "sk_date_purchase")
    agg = (_join_seller(days, w, "seller_tier").groupBy("year", "month", "seller_tier").agg(*added_parts())
           .select("year", "month", "seller_tier", F.col("revenue_sum").alias("revenue"),
                   F.col("profit_sum").alias("gross_profit"), "items"))
    month_end = X.date_key(F.last_day(F.make_date("year", "month", F.lit(1))))
    return agg.withColumn("is_incomplete_month", month_end > last_key)


MONTHLY_SQL = """
SELECT d.year, d.month, l.seller_tier, CAST(sum(l.revenue) AS DECIMAL(28,2)) AS revenue,
       CAST(sum(l.gross_profit) AS DECIMAL(28,2)) AS gross_profit, CAST(count(*) AS BIGINT) AS items,
       CAST(strftime(last_day(make_date(d.year, d.month, 1)), '%Y%m%d') AS INTEGER)
         > (SELECT max(sk_date_purchase) FROM w_fact) AS is_incomplete_month
FROM w_lines l JOIN w_dim_date d ON l.sk_date_purchase = d.sk_date
GROUP BY d.year, d.month, l.seller_tier"""


# ------------------------------------------------------------------ R9 (from the summary table)

def report_daily_group_quarter(w: Warehouse) -> DataFrame:
    """Daily revenue and on-time rate of one category group in one
    quarter, answered from the daily summary (not the order lines)."""
    p = w.params
    q_start = _dt.date(p.focus_year, 3 * p.focus_quarter - 2, 1)
    q_end = (_dt.date(p.focus_year + (p.focus_quarter == 4), (3 * p.focus_quarter) % 12 + 1, 1)
             - _dt.timedelta(days=1))
    summary, names = w.daily_summary(q_start, q_end)
    cats = names.where(X.category_group("product_category") == p.focus_group)
    days = _dim_date(w, "date", role="sk_date").where(date_key_range("sk_date", q_start, q_end))
    s = (summary.where(date_key_range("sk_date", q_start, q_end))
         .join(cats, "sk_product_category").join(days, "sk_date"))
    return s.groupBy("date").agg(
        F.sum("revenue_total").cast("decimal(28,2)").alias("revenue"),
        F.sum("orders_count").alias("orders"),
        F.sum("items_count").alias("items"),
        X.half_up_ratio(F.sum("on_time_deliveries"), F.sum("delivered_items"), 6).alias("on_time_rate"))


def _daily_group_sql(p: Params) -> str:
    return f"""
SELECT d.date, CAST(sum(s.revenue_total) AS DECIMAL(28,2)) AS revenue, CAST(sum(s.orders_count) AS BIGINT) AS orders,
       CAST(sum(s.items_count) AS BIGINT) AS items,
       {O.ratio_sql('sum(s.on_time_deliveries)', 'sum(s.delivered_items)', 6)} AS on_time_rate
FROM w_summary s JOIN w_cat_ids c ON s.sk_product_category = c.sk_product_category
     JOIN w_dim_date d ON s.sk_date = d.sk_date
WHERE {O.group_sql('c.product_category')} = {O._q(p.focus_group)} AND d.year = {p.focus_year} AND d.quarter = {p.focus_quarter}
GROUP BY d.date"""


# ------------------------------------------------------------------ R12

def report_category_investment(w: Warehouse) -> DataFrame:
    """Per category margin x satisfaction, against the overall margin and
    review and the mean revenue per category: "expand" (both at or above the
    overall values), "fix" (revenue at or above the mean, review below), else
    "hold"."""
    parts = _categorised(w).groupBy("product_category").agg(*line_parts())
    # the overall values are sums over the per-category rows (one per category)
    rows = Window.partitionBy(F.lit(0))
    total = {c: F.sum(c).over(rows) for c in ("revenue_sum", "profit_sum", "score_sum", "reviews")}
    cents = {c: (total[c] * 100).cast("decimal(38,0)") for c in ("revenue_sum", "profit_sum")}
    per = parts.select(
        "product_category", F.col("revenue_sum").alias("revenue"), margin_pct(), mean_review(), "items",
        margin_pct(cents["profit_sum"], cents["revenue_sum"]).alias("o_margin"),
        X.half_up_ratio(total["score_sum"], total["reviews"], 6).alias("o_review"),
        X.half_up_ratio(cents["revenue_sum"], F.count(F.lit(1)).over(rows) * 100, 2).alias("o_rev"))
    action = (F.when((F.col("margin_pct") >= F.col("o_margin")) & (F.col("mean_review") >= F.col("o_review")), "expand")
              .when((F.col("revenue") >= F.col("o_rev")) & (F.col("mean_review") < F.col("o_review")), "fix")
              .otherwise("hold"))
    return per.withColumn("action", action).drop("o_margin", "o_review", "o_rev")


CATEGORY_INVESTMENT_SQL = f"""
, w_overall AS (
  SELECT {O.ratio_sql('CAST(sum(CAST(gross_profit * 100 AS BIGINT)) AS HUGEINT) * 100', 'sum(CAST(revenue * 100 AS BIGINT))', 6)} AS margin_pct,
         {O.ratio_sql('sum(review_score)', 'count(review_score)', 6)} AS mean_review,
         {O.ratio_sql('sum(CAST(revenue * 100 AS BIGINT))', 'count(DISTINCT product_category) * 100', 2)} AS rev_per_cat
  FROM w_lines),
w_per_cat AS (
  SELECT product_category, CAST(sum(revenue) AS DECIMAL(28,2)) AS revenue,
         {O.ratio_sql('CAST(sum(CAST(gross_profit * 100 AS BIGINT)) AS HUGEINT) * 100', 'sum(CAST(revenue * 100 AS BIGINT))', 6)} AS margin_pct,
         {O.ratio_sql('sum(review_score)', 'count(review_score)', 6)} AS mean_review,
         CAST(count(*) AS BIGINT) AS items
  FROM w_lines GROUP BY product_category)"""


# ------------------------------------------------------------------ R15 / R16

def _region_pairs(w: Warehouse) -> DataFrame:
    """Freight and delivery parts per (customer region, seller region): the
    lines meet the customers once and are reduced to (region, seller) before
    they meet the sellers."""
    freight = F.sum("freight_value").cast("decimal(28,2)").alias("freight")
    per = _join_customer(w.fact_order_item, w, "customer_region").groupBy("customer_region", "sk_seller").agg(
        F.count(F.lit(1)).alias("lines"), freight, F.count("freight_value").alias("with_freight"),
        F.sum("delivery_days").alias("days"), F.count("delivery_days").alias("delivered_lines"))
    return _join_seller(per, w, "seller_region").groupBy("customer_region", "seller_region").agg(
        F.sum("lines").alias("lines"), F.sum("freight").cast("decimal(28,2)").alias("freight"),
        F.sum("with_freight").alias("with_freight"), F.sum("days").alias("days"),
        F.sum("delivered_lines").alias("delivered_lines"))


def _pivot_regions(pairs: DataFrame, value: str, regions: list[str]) -> DataFrame:
    """Rows = customer region, columns = seller region.  The pivot runs on the
    (at most regions x regions) pre-aggregated cells; the columns are
    ``Params.regions``, so a region that the parameter leaves out has no
    column (the long form `report_region_pairs` always has all)."""
    return pairs.groupBy("customer_region").pivot("seller_region", regions).agg(F.first(value))


def report_freight_matrix(w: Warehouse) -> DataFrame:
    """Mean freight per line, customer region x seller region."""
    cells = _region_pairs(w).select("customer_region", "seller_region",
                                    X.half_up_ratio(_cents("freight"), F.col("with_freight") * 100, 2).alias("v"))
    return _pivot_regions(cells, "v", list(w.params.regions))


def report_delivery_matrix(w: Warehouse) -> DataFrame:
    """Mean delivery days per delivered line, same shape as R15."""
    cells = _region_pairs(w).select("customer_region", "seller_region",
                                    X.half_up_ratio("days", "delivered_lines", 6).alias("v"))
    return _pivot_regions(cells, "v", list(w.params.regions))


def report_region_pairs(w: Warehouse) -> DataFrame:
    """R15 / R16 in long form: one row per (customer region, seller region)."""
    return _region_pairs(w).select(
        "customer_region", "seller_region", "lines",
        X.half_up_ratio(_cents("freight"), F.col("with_freight") * 100, 2).alias("mean_freight"), "delivered_lines",
        X.half_up_ratio("days", "delivered_lines", 6).alias("mean_delivery_days"))


REGION_PAIRS_SQL = f"""
SELECT c.customer_region, l.seller_region, CAST(count(*) AS BIGINT) AS lines,
       {O.ratio_sql('sum(CAST(l.freight_value * 100 AS BIGINT))', 'count(l.freight_value) * 100', 2)} AS mean_freight,
       CAST(count(l.delivery_days) AS BIGINT) AS delivered_lines,
       {O.ratio_sql('sum(l.delivery_days)', 'count(l.delivery_days)', 6)} AS mean_delivery_days
FROM w_lines l JOIN w_dim_customer c ON l.sk_customer = c.sk_customer
GROUP BY c.customer_region, l.seller_region"""


def _matrix_pivot_sql(value_sql: str, p: Params) -> str:
    cols = ", ".join(f'max(CASE WHEN seller_region = {O._q(r)} THEN v END) AS "{r}"' for r in p.regions)
    return f"""
, w_cells AS (
  SELECT c.customer_region, l.seller_region, {value_sql} AS v
  FROM w_lines l JOIN w_dim_customer c ON l.sk_customer = c.sk_customer
  GROUP BY c.customer_region, l.seller_region)
SELECT customer_region, {cols} FROM w_cells GROUP BY customer_region"""


# ------------------------------------------------------------------ R17 / R18

def audit_cost_basis(w: Warehouse) -> DataFrame:
    """Lines with negative gross profit / sold below the product's list
    price, per category."""
    lines = _categorised(w, "list_price")
    return lines.groupBy("product_category").agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if(F.col("gross_profit") < 0).alias("negative_profit_lines"),
        F.coalesce(F.sum(F.when(F.col("gross_profit") < 0, F.col("gross_profit"))), F.lit(0))
        .cast("decimal(28,2)").alias("negative_profit_total"),
        F.count_if(F.col("price") < F.col("list_price")).alias("below_list_lines"))


COST_BASIS_SQL = """
SELECT product_category, CAST(count(*) AS BIGINT) AS items,
       CAST(count(*) FILTER (WHERE gross_profit < 0) AS BIGINT) AS negative_profit_lines,
       CAST(coalesce(sum(CASE WHEN gross_profit < 0 THEN gross_profit END), 0) AS DECIMAL(28,2)) AS negative_profit_total,
       CAST(count(*) FILTER (WHERE price < list_price) AS BIGINT) AS below_list_lines
FROM w_lines GROUP BY product_category"""


def audit_tier_basis(w: Warehouse) -> DataFrame:
    """Tier on the price basis (freight excluded, as the dimension does)
    vs. on the revenue basis (freight included), per seller, flagging the
    sellers whose tier would change."""
    p = w.params
    per = w.fact_order_item.groupBy("sk_seller").agg(
        F.sum("price").cast("decimal(28,2)").alias("price_sum"),
        F.sum("revenue").cast("decimal(28,2)").alias("revenue_sum"))
    return (_join_seller(per, w, "seller_id", "seller_tier")
            .select("sk_seller", "seller_id", "seller_tier", "price_sum", "revenue_sum",
                    X.seller_tier("price_sum", p).alias("tier_by_price"),
                    X.seller_tier("revenue_sum", p).alias("tier_by_revenue"))
            .withColumn("tier_changes", F.col("tier_by_price") != F.col("tier_by_revenue")))


def _tier_basis_sql(p: Params) -> str:
    return f"""
SELECT *, tier_by_price <> tier_by_revenue AS tier_changes FROM (
  SELECT sk_seller, seller_id, seller_tier, price_sum, revenue_sum,
         {O.tier_sql('price_sum', p)} AS tier_by_price, {O.tier_sql('revenue_sum', p)} AS tier_by_revenue
  FROM (SELECT sk_seller, seller_id, seller_tier, CAST(sum(price) AS DECIMAL(28,2)) AS price_sum,
               CAST(sum(revenue) AS DECIMAL(28,2)) AS revenue_sum
        FROM w_lines GROUP BY sk_seller, seller_id, seller_tier) t) x"""


# ------------------------------------------------------------------ J14

def role_playing_dates(w: Warehouse) -> DataFrame:
    """The date dimension in three roles (purchase: inner; delivered and
    estimated: left, the keys are nullable)."""
    purchase = _dim_date(w, F.col("year").alias("purchase_year"))
    delivered = _dim_date(w, F.col("date").alias("delivered_date"),
                          F.col("is_weekend").alias("delivered_weekend"), role="sk_date_delivered")
    estimated = _dim_date(w, F.col("date").alias("estimated_date"), role="sk_date_estimated_delivery")
    f = (w.fact_order_item
         .join(purchase, "sk_date_purchase")
         .join(delivered, "sk_date_delivered", "left")
         .join(estimated, "sk_date_estimated_delivery", "left"))
    return f.groupBy("purchase_year").agg(
        F.count(F.lit(1)).alias("items"),
        F.count("delivered_date").alias("delivered_items"),
        F.count_if(F.col("delivered_weekend")).alias("weekend_deliveries"),
        F.count("estimated_date").alias("estimated_items"),
        F.min("delivered_date").alias("first_delivery"),
        F.max("estimated_date").alias("last_estimate"))


ROLE_DATES_SQL = """
SELECT dp.year AS purchase_year, CAST(count(*) AS BIGINT) AS items,
       CAST(count(dd.date) AS BIGINT) AS delivered_items,
       CAST(count(*) FILTER (WHERE dd.is_weekend) AS BIGINT) AS weekend_deliveries,
       CAST(count(de.date) AS BIGINT) AS estimated_items,
       min(dd.date) AS first_delivery, max(de.date) AS last_estimate
FROM w_fact f JOIN w_dim_date dp ON f.sk_date_purchase = dp.sk_date
     LEFT JOIN w_dim_date dd ON f.sk_date_delivered = dd.sk_date
     LEFT JOIN w_dim_date de ON f.sk_date_estimated_delivery = de.sk_date
GROUP BY dp.year"""


# ------------------------------------------------------------------ registration

def register_all(register, warehouse) -> None:
    p = FIXTURE_PARAMS

    def wh(fn):
        return lambda spark, sf_dir: fn(warehouse(spark, sf_dir))

    lines = LINES_SQL
    scat = LINES_SQL + "," + SCATTER_CTE
    register("report_category_tier_matrix", O.with_warehouse(_matrix_sql(), p, lines))(
        wh(report_category_tier_matrix))
    register("report_filtered_matrix", O.with_warehouse(_matrix_sql(_slicer_sql(p)), p, lines))(
        wh(report_filtered_matrix))
    register("report_tier_value", O.with_warehouse(TIER_VALUE_SQL, p, lines))(wh(report_tier_value))
    register("report_sliced_tier_value", O.with_warehouse(_tier_value_sql(_slicer_sql(p)), p, lines))(
        wh(report_sliced_tier_value))
    items = _item_slicer_sql(p)
    register("report_item_category_matrix", O.with_warehouse(_matrix_sql(items), p, lines))(
        wh(report_item_category_matrix))
    register("report_item_category_tier_value", O.with_warehouse(_tier_value_sql(items), p, lines))(
        wh(report_item_category_tier_value))
    register("report_item_category_scatter", O.with_warehouse(
        f"SELECT {SCATTER_COLS} FROM w_item_scatter", p, LINES_SQL + "," + _scatter_cte("w_item_scatter", items)))(
        wh(report_item_category_scatter))
    register("report_sellers_per_tier", O.with_warehouse(SELLERS_PER_TIER_SQL, p))(wh(report_sellers_per_tier))
    register("report_seller_scatter", O.with_warehouse(f"SELECT {SCATTER_COLS} FROM w_scatter", p, scat))(
        wh(seller_scatter))
    register("report_risk_sellers", O.with_warehouse(
        f"SELECT {SCATTER_COLS} FROM w_scatter WHERE revenue >= {O.dec(p.risk_min_revenue)} "
        f"AND mean_review <= {O.dec(p.risk_max_review)}", p, scat))(wh(report_risk_sellers))
    register("report_growth_sellers", O.with_warehouse(
        f"SELECT {SCATTER_COLS} FROM w_scatter WHERE seller_tier = 'Bronze' "
        f"AND mean_review >= {O.dec(p.growth_min_review)}", p, scat))(wh(report_growth_sellers))
    register("report_tier_moves", O.with_warehouse(
        "SELECT * FROM w_moves WHERE move IS NOT NULL", p, scat + TIER_MOVES_SQL))(wh(report_tier_moves))
    register("report_region_review", O.with_warehouse(REGION_REVIEW_SQL, p, lines))(wh(report_region_review))
    register("report_region_on_time", O.with_warehouse(REGION_ON_TIME_SQL, p, lines))(wh(report_region_on_time))
    register("report_monthly_tier_revenue", O.with_warehouse(MONTHLY_SQL, p, lines))(
        wh(report_monthly_tier_revenue))
    register("report_daily_group_quarter", O.with_warehouse(_daily_group_sql(p), p))(
        wh(report_daily_group_quarter))
    register("report_category_investment", O.with_warehouse(
        """SELECT c.*, CASE WHEN c.margin_pct >= o.margin_pct AND c.mean_review >= o.mean_review THEN 'expand'
                            WHEN c.revenue >= o.rev_per_cat AND c.mean_review < o.mean_review THEN 'fix'
                            ELSE 'hold' END AS action
           FROM w_per_cat c, w_overall o""", p, lines + CATEGORY_INVESTMENT_SQL))(
        wh(report_category_investment))
    register("report_freight_matrix", O.with_warehouse("", p, lines + _matrix_pivot_sql(
        O.ratio_sql("sum(CAST(l.freight_value * 100 AS BIGINT))", "count(l.freight_value) * 100", 2), p)
        ))(wh(report_freight_matrix))
    register("report_delivery_matrix", O.with_warehouse("", p, lines + _matrix_pivot_sql(
        O.ratio_sql("sum(l.delivery_days)", "count(l.delivery_days)", 6), p)))(wh(report_delivery_matrix))
    register("report_region_pairs", O.with_warehouse(REGION_PAIRS_SQL, p, lines))(wh(report_region_pairs))
    register("audit_cost_basis", O.with_warehouse(COST_BASIS_SQL, p, lines))(wh(audit_cost_basis))
    register("audit_tier_basis", O.with_warehouse(_tier_basis_sql(p), p, lines))(wh(audit_tier_basis))
    register("role_playing_dates", O.with_warehouse(ROLE_DATES_SQL, p))(wh(role_playing_dates))
