"""Independent SQL oracle (DuckDB dialect) for every registered query.

The driver registers the base parquet tables as views; each oracle statement
re-derives the raw marketplace tables (fixture CTEs, FIXTURES.md §C) and the
warehouse tables with plain SQL — window ``row_number`` keys, ``arg_min``,
``GROUP BY ROLLUP`` — written independently of the DataFrame plans.  Output
columns carry the same names and explicit types as the Spark results.
"""

from __future__ import annotations

from decimal import Decimal

from stardw.functions import lookups as L
from stardw.params import FIXTURE_PARAMS, Params
from stardw.sources.fixtures import FIXTURE_NATION_STATE, FIXTURE_TRANSLATION, IDLE, UNKNOWN, UNKNOWN_ORDER


def _values(rows, fmt) -> str:
    return ",".join(fmt(r) for r in rows)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


FIXTURE_CTES = f"""
fx_translation AS (
  SELECT product_category_name, arg_max(product_category_name_english, pos) AS product_category_name_english
  FROM (VALUES {_values(enumerate(FIXTURE_TRANSLATION), lambda r: f"({r[0]},{_q(r[1][0])},{_q(r[1][1])})")})
  AS t(pos, product_category_name, product_category_name_english) GROUP BY product_category_name),
fx_state AS (
  SELECT * FROM (VALUES {_values(FIXTURE_NATION_STATE, lambda r: f"({r[0]},{_q(r[1])})")}) AS t(nk, state)),
fx_customers AS (
  SELECT c_custkey AS customer_id,
         concat('U', CAST(CASE WHEN c_custkey % 10 = 9 THEN c_custkey - 1 ELSE c_custkey END AS VARCHAR)) AS customer_unique_id,
         lower(n_name) AS customer_city, state AS customer_state
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN fx_state ON c_nationkey = nk),
fx_sellers AS (
  SELECT s_suppkey AS seller_id, lower(n_name) AS seller_city, state AS seller_state
  FROM (SELECT s_suppkey, s_nationkey FROM supplier UNION ALL
        SELECT s_suppkey + {IDLE}, s_nationkey FROM supplier WHERE s_suppkey % 10 = 0 UNION ALL
        SELECT s_suppkey, (s_nationkey + 5) % 25 FROM supplier WHERE s_suppkey % 9 = 4 UNION ALL
        SELECT NULL, s_nationkey FROM supplier WHERE s_suppkey = 1) s
       LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN fx_state ON s_nationkey = nk),
fx_one_seller AS (
  SELECT * FROM fx_sellers WHERE seller_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY seller_id ORDER BY seller_city NULLS LAST, seller_state NULLS LAST) = 1),
fx_products AS (
  SELECT p_partkey AS product_id, CASE WHEN p_size = 50 THEN NULL ELSE p_brand END AS product_category_name
  FROM (SELECT p_partkey, p_size, p_brand FROM part UNION ALL
        SELECT p_partkey + {IDLE}, p_size, p_brand FROM part WHERE p_partkey % 20 = 0 UNION ALL
        SELECT p_partkey, p_size, 'Brand#13' FROM part WHERE p_partkey % 15 = 4 UNION ALL
        SELECT NULL, p_size, p_brand FROM part WHERE p_partkey = 1) p),
fx_one_product AS (
  SELECT * FROM fx_products WHERE product_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY product_category_name NULLS LAST) = 1),
fx_base_orders AS (
  SELECT o_orderkey AS order_id,
         CASE WHEN o_orderkey % 71 = 5 THEN NULL WHEN o_orderkey % 67 = 5 THEN o_custkey + {UNKNOWN} ELSE o_custkey END AS customer_id,
         CASE WHEN o_orderkey % 61 = 5 THEN NULL
              ELSE o_orderdate + INTERVAL '1' SECOND * CAST(o_orderkey * 7919 % 86400 AS INT) END AS order_purchase_timestamp,
         o_orderdate + INTERVAL '1' DAY AS order_approved_at,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate + INTERVAL '1' DAY * CAST(o_orderkey % 40 AS INT)
              + INTERVAL '1' SECOND * CAST(o_orderkey * 104729 % 86400 AS INT) END AS order_delivered_customer_date,
         CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderdate + INTERVAL '25' DAY END AS order_estimated_delivery_date
  FROM orders),
fx_orders AS (
  SELECT * FROM fx_base_orders
  UNION ALL SELECT * REPLACE (NULL AS customer_id, NULL AS order_purchase_timestamp) FROM fx_base_orders WHERE order_id % 19 = 3
  UNION ALL SELECT * REPLACE (order_purchase_timestamp + INTERVAL '1' DAY AS order_purchase_timestamp)
            FROM fx_base_orders WHERE order_id % 23 = 3),
fx_base_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id,
         CASE WHEN l_orderkey % 97 = 5 THEN NULL WHEN l_orderkey % 89 = 5 THEN l_partkey + {UNKNOWN} ELSE l_partkey END AS product_id,
         CASE WHEN l_orderkey % 103 = 5 THEN NULL WHEN l_orderkey % 101 = 5 THEN l_suppkey + {UNKNOWN} ELSE l_suppkey END AS seller_id,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS price, CAST(l_quantity AS DECIMAL(10,2)) AS freight_value
  FROM lineitem),
fx_items AS (
  SELECT * FROM fx_base_items
  UNION ALL SELECT * REPLACE (NULL AS product_id) FROM fx_base_items WHERE order_id % 17 = 3
  UNION ALL SELECT * REPLACE (seller_id + {UNKNOWN} AS seller_id) FROM fx_base_items WHERE order_id % 13 = 3
  UNION ALL SELECT * REPLACE (order_id + {UNKNOWN_ORDER} AS order_id) FROM fx_base_items
            WHERE order_id % 83 = 3 AND order_item_id = 1),
fx_first_items AS (
  SELECT order_id, order_item_id, product_id, seller_id, price, freight_value FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id
                                 ORDER BY product_id NULLS FIRST, seller_id NULLS FIRST, price NULLS FIRST,
                                          freight_value NULLS FIRST) AS rn
    FROM fx_items) x WHERE rn = 1),
fx_reviews AS (
  SELECT o_orderkey AS order_id, CAST(1 + o_orderkey % 5 AS INT) AS review_score FROM orders WHERE o_orderkey % 7 <> 0
  UNION ALL
  SELECT o_orderkey, CAST(1 + (o_orderkey + 2) % 5 AS INT) FROM orders WHERE o_orderkey % 11 = 0)"""


# ---------------------------------------------------------------- SQL renderings of the business rules

def dec(v: Decimal | int) -> str:
    d = Decimal(str(v))
    digits = max(len(d.as_tuple().digits), 1)
    scale = max(-d.as_tuple().exponent, 0)
    return f"CAST({d} AS DECIMAL({max(digits, scale + 1)},{scale}))"


def region_sql(col: str) -> str:
    by_region: dict[str, list[str]] = {}
    for st, rg in L.STATE_REGION.items():
        by_region.setdefault(rg, []).append(st)
    whens = " ".join(f"WHEN {col} IN ({','.join(_q(s) for s in sts)}) THEN {_q(rg)}"
                     for rg, sts in by_region.items())
    return f"(CASE {whens} ELSE {_q(L.REGION_DEFAULT)} END)"


def group_sql(col: str) -> str:
    whens = []
    for grp, kws in L.CATEGORY_GROUP_KEYWORDS:
        cond = " OR ".join(f"contains(lower({col}), {_q(k)})" for k in kws)
        whens.append(f"WHEN {cond} THEN {_q(grp)}")
    return f"(CASE {' '.join(whens)} ELSE {_q(L.GROUP_DEFAULT)} END)"


def age_group_sql(col: str) -> str:
    whens = " ".join(f"WHEN {col} > {lo} AND {col} <= {hi} THEN {_q(lab)}" for lo, hi, lab in L.AGE_BINS)
    return f"(CASE {whens} ELSE {_q(L.AGE_OUT_OF_RANGE)} END)"


def hash_sql(key: str, seed: int, part: int) -> str:
    return (f"CAST(('0x' || substr(md5(concat('{seed}:', CAST({key} AS VARCHAR))), {8 * part + 1}, 8)) AS BIGINT)")


def ratio_sql(num: str, den: str, scale: int, precision: int = 18) -> str:
    """Exact half-up num/den at ``scale`` decimals (integral num/den)."""
    n = f"CAST({num} AS HUGEINT)"
    d = f"CAST({den} AS HUGEINT)"
    q = f"(sign({n}) * ((abs({n}) * 2 * {10 ** scale} + {d}) // (2 * {d})))"
    return (f"CAST(CASE WHEN {d} > 0 THEN CAST({q} AS DECIMAL(38,0)) * {dec(Decimal(1).scaleb(-scale))} END "
            f"AS DECIMAL({precision},{scale}))") if scale else f"CAST(CASE WHEN {d} > 0 THEN {q} END AS DECIMAL({precision},0))"


def cents_sql(col: str) -> str:
    return f"CAST({col} * 100 AS BIGINT)"


def datekey_sql(col: str) -> str:
    return f"CAST(strftime(CAST({col} AS DATE), '%Y%m%d') AS INTEGER)"


def tier_sql(col: str, p: Params) -> str:
    return (f"(CASE WHEN {col} IS NULL OR {col} < {dec(p.tier_bronze)} THEN 'Bronze' "
            f"WHEN {col} < {dec(p.tier_silver)} THEN 'Silver' ELSE 'Gold' END)")


def warehouse_ctes(p: Params) -> str:
    """CTEs w_dim_date, w_dim_customer, w_dim_seller, w_dim_product, w_fact,
    w_cat_ids, w_summary over the fixture CTEs."""
    return f"""
w_date_bounds AS (
  SELECT least(min(CAST(order_purchase_timestamp AS DATE)), min(CAST(order_approved_at AS DATE)),
               min(CAST(order_delivered_customer_date AS DATE)), min(CAST(order_estimated_delivery_date AS DATE))) AS lo,
         greatest(max(CAST(order_purchase_timestamp AS DATE)), max(CAST(order_approved_at AS DATE)),
               max(CAST(order_delivered_customer_date AS DATE)), max(CAST(order_estimated_delivery_date AS DATE))) AS hi
  FROM fx_orders),
w_days AS (
  SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
  FROM w_date_bounds WHERE lo IS NOT NULL),
w_dim_date AS (
  SELECT {datekey_sql('d')} AS sk_date, d AS date, CAST(day(d) AS SMALLINT) AS day,
         CAST(month(d) AS SMALLINT) AS month, strftime(d, '%B') AS month_name,
         CAST(quarter(d) AS SMALLINT) AS quarter, CAST(year(d) AS SMALLINT) AS year,
         strftime(d, '%A') AS day_of_week, isodow(d) >= 6 AS is_weekend
  FROM w_days),
w_cust_profile AS (
  SELECT c.customer_unique_id,
         arg_min(c.customer_city, CASE WHEN c.customer_city IS NOT NULL THEN c.customer_id END) AS customer_city,
         arg_min(c.customer_state, CASE WHEN c.customer_state IS NOT NULL THEN c.customer_id END) AS customer_state,
         count(o.order_purchase_timestamp) AS order_count,
         min(o.order_purchase_timestamp) AS first_order
  FROM fx_customers c LEFT JOIN fx_orders o ON c.customer_id = o.customer_id
  WHERE c.customer_unique_id IS NOT NULL
  GROUP BY c.customer_unique_id),
w_cust_attr AS (
  SELECT *, CAST(18 + {hash_sql('customer_unique_id', p.seed, 0)} % 53 AS SMALLINT) AS customer_age
  FROM w_cust_profile),
w_dim_customer AS (
  SELECT CAST(row_number() OVER (ORDER BY customer_unique_id) AS BIGINT) AS sk_customer,
         customer_unique_id, customer_city, customer_state,
         {region_sql('customer_state')} AS customer_region,
         customer_age,
         {age_group_sql('customer_age')} AS customer_age_group,
         CASE WHEN {hash_sql('customer_unique_id', p.seed, 1)} % 100 < 48 THEN 'M' ELSE 'F' END AS customer_gender,
         CAST(first_order AS DATE) - CAST(60 + {hash_sql('customer_unique_id', p.seed, 2)} % 671 AS INTEGER) AS customer_signup_date,
         CASE WHEN order_count = 1 THEN 'Occasional' WHEN order_count <= 4 THEN 'Regular' ELSE 'Loyal' END AS customer_segment
  FROM w_cust_attr),
w_prod_cat AS (
  SELECT p.product_id, coalesce(t.product_category_name_english, p.product_category_name) AS product_category
  FROM fx_one_product p LEFT JOIN fx_translation t ON p.product_category_name = t.product_category_name),
w_seller_cat_n AS (
  SELECT i.seller_id, pc.product_category, count(*) AS n
  FROM fx_items i LEFT JOIN w_prod_cat pc ON i.product_id = pc.product_id
  WHERE i.seller_id IS NOT NULL AND pc.product_category IS NOT NULL
  GROUP BY i.seller_id, pc.product_category),
w_seller_mode AS (
  SELECT seller_id, product_category AS mode_category FROM (
    SELECT *, row_number() OVER (PARTITION BY seller_id ORDER BY n DESC, product_category) AS rn FROM w_seller_cat_n) x
  WHERE rn = 1),
w_seller_stats AS (
  SELECT seller_id, count(order_item_id) AS total_items, sum(price) AS total_revenue
  FROM fx_items WHERE seller_id IS NOT NULL GROUP BY seller_id),
w_dim_seller AS (
  SELECT CAST(row_number() OVER (ORDER BY s.seller_id) AS BIGINT) AS sk_seller,
         s.seller_id, s.seller_city, s.seller_state,
         {region_sql('s.seller_state')} AS seller_region,
         CASE WHEN st.seller_id IS NULL THEN NULL ELSE coalesce(m.mode_category, 'Unknown') END AS seller_main_category,
         CASE WHEN st.total_items IS NULL OR st.total_items < {p.size_small} THEN 'Small'
              WHEN st.total_items < {p.size_medium} THEN 'Medium' ELSE 'Large' END AS seller_size_category,
         {tier_sql('st.total_revenue', p)} AS seller_tier,
         DATE '{p.seller_epoch.isoformat()}' - CAST(30 + {hash_sql('s.seller_id', p.seed, 3)} % 1066 AS INTEGER) AS seller_join_date
  FROM fx_one_seller s LEFT JOIN w_seller_stats st ON s.seller_id = st.seller_id
       LEFT JOIN w_seller_mode m ON s.seller_id = m.seller_id),
w_list_price AS (
  SELECT product_id,
         CAST(CAST((2 * sum({cents_sql('price')}) + count(price)) // (2 * count(price)) AS DECIMAL(18,0)) * 0.01
              AS DECIMAL(10,2)) AS list_price
  FROM fx_items WHERE product_id IS NOT NULL AND price IS NOT NULL GROUP BY product_id),
w_dim_product AS (
  SELECT CAST(row_number() OVER (ORDER BY pc.product_id) AS BIGINT) AS sk_product,
         pc.product_id, pc.product_category,
         {group_sql('pc.product_category')} AS product_category_group,
         lp.list_price,
         CASE WHEN lp.list_price IS NULL THEN 'Unknown' WHEN lp.list_price < {dec(p.band_budget)} THEN 'Budget'
              WHEN lp.list_price < {dec(p.band_mid)} THEN 'Mid'
              WHEN lp.list_price < {dec(p.band_premium)} THEN 'Premium' ELSE 'Luxury' END AS price_band,
         CAST(round(lp.list_price * {dec(p.cost_ratio)}, 2) AS DECIMAL(10,2)) AS unit_cost,
         coalesce(lp.list_price >= {dec(p.premium_min)}, false) AS is_premium
  FROM w_prod_cat pc LEFT JOIN w_list_price lp ON pc.product_id = lp.product_id),
w_best_review AS (
  SELECT order_id, max(review_score) AS review_score FROM fx_reviews WHERE order_id IS NOT NULL GROUP BY order_id),
w_cust_sk AS (
  SELECT c.customer_id, min(d.sk_customer) AS sk_customer
  FROM fx_customers c JOIN w_dim_customer d ON c.customer_unique_id = d.customer_unique_id
  GROUP BY c.customer_id),
w_valid_orders AS (
  SELECT * FROM (
    SELECT o.*, cs.sk_customer, row_number() OVER (
             PARTITION BY o.order_id ORDER BY o.customer_id, o.order_purchase_timestamp,
             o.order_delivered_customer_date NULLS FIRST, o.order_estimated_delivery_date NULLS FIRST) AS rn
    FROM fx_orders o JOIN w_cust_sk cs ON o.customer_id = cs.customer_id
    WHERE o.order_id IS NOT NULL AND o.order_purchase_timestamp IS NOT NULL) x WHERE rn = 1),
w_valid_lines AS (
  SELECT * FROM (
    SELECT i.*, dp.sk_product, dp.unit_cost, ds.sk_seller, row_number() OVER (
             PARTITION BY i.order_id, i.order_item_id
             ORDER BY i.product_id, i.seller_id, i.price NULLS FIRST, i.freight_value NULLS FIRST) AS rn
    FROM fx_items i JOIN w_dim_product dp ON i.product_id = dp.product_id
         JOIN w_dim_seller ds ON i.seller_id = ds.seller_id
    WHERE i.order_id IS NOT NULL AND i.order_item_id IS NOT NULL) x WHERE rn = 1),
w_fact AS (
  SELECT i.order_id, CAST(i.order_item_id AS SMALLINT) AS order_item_id,
         {datekey_sql('o.order_purchase_timestamp')} AS sk_date_purchase,
         {datekey_sql('o.order_delivered_customer_date')} AS sk_date_delivered,
         {datekey_sql('o.order_estimated_delivery_date')} AS sk_date_estimated_delivery,
         o.sk_customer, i.sk_seller, i.sk_product,
         i.price, i.freight_value,
         CAST(i.price + i.freight_value AS DECIMAL(10,2)) AS revenue,
         CAST(i.price - coalesce(i.unit_cost, 0) AS DECIMAL(10,2)) AS gross_profit,
         i.unit_cost,
         CAST(floor(date_diff('microsecond', o.order_purchase_timestamp, o.order_delivered_customer_date) / 86400000000.0) AS SMALLINT) AS delivery_days,
         CAST(CASE WHEN o.order_delivered_customer_date IS NULL OR o.order_estimated_delivery_date IS NULL THEN NULL
                   WHEN o.order_delivered_customer_date <= o.order_estimated_delivery_date THEN 1 ELSE 0 END AS SMALLINT) AS is_on_time,
         CAST(r.review_score AS SMALLINT) AS review_score
  FROM w_valid_lines i
       JOIN w_valid_orders o ON i.order_id = o.order_id
       LEFT JOIN w_best_review r ON i.order_id = r.order_id),
w_fact_cat AS (
  SELECT f.*, coalesce(dp.product_category, 'Unknown') AS product_category
  FROM w_fact f LEFT JOIN w_dim_product dp ON f.sk_product = dp.sk_product),
w_cat_ids AS (
  SELECT CAST(row_number() OVER (ORDER BY product_category) AS INTEGER) AS sk_product_category, product_category
  FROM (SELECT DISTINCT product_category FROM w_fact_cat) x),
w_summary AS (
  SELECT f.sk_date_purchase AS sk_date, f.sk_seller, c.sk_product_category,
         CAST(count(DISTINCT f.order_id) AS INTEGER) AS orders_count,
         CAST(count(f.order_item_id) AS INTEGER) AS items_count,
         CAST(coalesce(sum(f.revenue), 0) AS DECIMAL(12,2)) AS revenue_total,
         CAST(coalesce(sum(f.freight_value), 0) AS DECIMAL(12,2)) AS freight_total,
         CAST(coalesce(sum(f.gross_profit), 0) AS DECIMAL(12,2)) AS gross_profit_total,
         CAST(count(*) FILTER (WHERE f.is_on_time = 1) AS INTEGER) AS on_time_deliveries,
         CAST(count(f.sk_date_delivered) AS INTEGER) AS delivered_items,
         CAST(coalesce(sum(f.review_score), 0) AS INTEGER) AS review_score_sum,
         CAST(count(f.review_score) AS INTEGER) AS reviews_count
  FROM w_fact_cat f JOIN w_cat_ids c ON f.product_category = c.product_category
  GROUP BY f.sk_date_purchase, f.sk_seller, c.sk_product_category)"""


def with_warehouse(select: str, p: Params = FIXTURE_PARAMS, extra_ctes: str = "") -> str:
    ctes = FIXTURE_CTES + "," + warehouse_ctes(p)
    if extra_ctes:
        ctes += "," + extra_ctes
    return f"WITH {ctes}\n{select}"


def with_fixtures(select: str, extra_ctes: str = "") -> str:
    ctes = FIXTURE_CTES + ("," + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{select}"
