"""Data-quality audits (S8, S9/S10, J16, PK/UNIQUE, summary invariants).

The source relied on database constraints; here they become queries that a
load can run and assert on: every audit returns violation counts that must
be zero.  Each is a single aggregation per table (no self-joins).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stardw import oracle as O
from stardw import schemas as S
from stardw.params import FIXTURE_PARAMS
from stardw.plans.warehouse import Warehouse

ORACLE_NAMES = {
    "dim_date": "w_dim_date", "dim_customer": "w_dim_customer", "dim_seller": "w_dim_seller",
    "dim_product": "w_dim_product", "fact_order_item": "w_fact",
    "fact_daily_seller_category": "w_summary", "dim_product_category": "w_cat_ids",
}


def _union(dfs: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)


# ------------------------------------------------------------------ S8 / A9

def row_count_audit(w: Warehouse) -> DataFrame:
    w.hold_fact()  # the fact is read for itself and for the summary
    return _union([df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
                   for name, df in w.tables().items()])


ROW_COUNT_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS rows FROM {o}" for t, o in ORACLE_NAMES.items())


# ------------------------------------------------------------------ J16

def _unpivoted(w: Warehouse, side: int) -> DataFrame:
    """(fk_name, value, n) of the child (side 0) or parent (side 1) columns of
    all foreign keys: each table is read once and reduced to its distinct values."""
    by_table: dict[str, list[tuple[str, str]]] = {}
    for name, *ends in S.FOREIGN_KEYS:
        table, col = ends[2 * side:2 * side + 2]
        by_table.setdefault(table, []).append((name, col))
    out = []
    for table, keys in by_table.items():
        pairs = F.array(*[F.struct(F.lit(n).alias("fk_name"), F.col(c).cast("long").alias("value")) for n, c in keys])
        out.append(w.tables()[table].select(F.explode(pairs).alias("k")).select("k.fk_name", "k.value").where("value IS NOT NULL"))
    return _union(out).groupBy("fk_name", "value").agg(F.count(F.lit(1)).alias("n"))


def fk_audit(w: Warehouse) -> DataFrame:
    """Non-NULL foreign keys without a parent row (must be 0).  Values are
    counted first (a value on a third of the rows becomes one row per map
    task), so the join sees one row per distinct value of each key."""
    w.hold_fact()
    names = w.dim_date.sparkSession.createDataFrame([(n,) for n, *_ in S.FOREIGN_KEYS], "fk_name string")
    parents = _unpivoted(w, 1).select("fk_name", "value", F.lit(True).alias("hit"))
    found = (_unpivoted(w, 0).join(parents, ["fk_name", "value"], "left").groupBy("fk_name")
             .agg(F.sum("n").alias("checked"), F.sum(F.when(F.col("hit").isNull(), F.col("n"))).alias("orphans")))
    return names.join(found, "fk_name", "left").select(
        "fk_name", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("checked", "orphans")])


FK_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS fk_name, CAST(count(*) AS BIGINT) AS checked, "
    f"CAST(count(*) FILTER (WHERE p.{pc} IS NULL) AS BIGINT) AS orphans "
    f"FROM {ORACLE_NAMES[c]} c LEFT JOIN {ORACLE_NAMES[pt]} p ON c.{cc} = p.{pc} WHERE c.{cc} IS NOT NULL"
    for n, c, cc, pt, pc in S.FOREIGN_KEYS)


# ------------------------------------------------------------------ PK / UNIQUE

def key_audit(w: Warehouse) -> DataFrame:
    """Per key: rows, rows with a NULL key part, distinct non-NULL keys and
    duplicates (rows - null_keys - distinct_keys, must be 0)."""
    out = []
    tables = w.hold_fact().tables()
    for table, keys in S.KEYS.items():
        for key_name, cols in keys:
            any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
            grouped = tables[table].groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
            agg = grouped.agg(
                F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"),
                F.coalesce(F.sum(F.when(any_null, F.col("__n"))), F.lit(0)).alias("null_keys"),
                F.count_if(~any_null).alias("distinct_keys"))
            out.append(agg.select(F.lit(table).alias("table_name"), F.lit(key_name).alias("key_name"),
                                  F.col("rows").cast("long"), F.col("null_keys").cast("long"),
                                  "distinct_keys",
                                  (F.col("rows") - F.col("null_keys") - F.col("distinct_keys"))
                                  .cast("long").alias("duplicates")))
    return _union(out)


def _key_sql() -> str:
    parts = []
    for table, keys in S.KEYS.items():
        for key_name, cols in keys:
            any_null = " OR ".join(f"{c} IS NULL" for c in cols)
            cl = ", ".join(cols)
            parts.append(
                f"SELECT '{table}' AS table_name, '{key_name}' AS key_name, rows, null_keys, distinct_keys, "
                f"rows - null_keys - distinct_keys AS duplicates FROM ("
                f"SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS rows, "
                f"CAST(coalesce(sum(n) FILTER (WHERE {any_null}), 0) AS BIGINT) AS null_keys, "
                f"CAST(count(*) FILTER (WHERE NOT ({any_null})) AS BIGINT) AS distinct_keys "
                f"FROM (SELECT {cl}, count(*) AS n FROM {ORACLE_NAMES[table]} GROUP BY {cl}) g) x")
    return " UNION ALL ".join(parts)


# ------------------------------------------------------------------ NOT NULL / VARCHAR(n)

def _checks(table: str):
    for col, _t, not_null, max_len in S.TABLES[table]:
        if not_null:
            yield col, "not_null", max_len
        if max_len:
            yield col, "max_length", max_len


def constraint_audit(w: Warehouse) -> DataFrame:
    """NOT NULL and VARCHAR(n) length violations per column, one pass per
    table, unpivoted to (table, column, check, violations)."""
    out = []
    for table, df in w.hold_fact().tables().items():
        aggs = []
        for col, check, n in _checks(table):
            cond = F.col(col).isNull() if check == "not_null" else \
                F.length(F.col(col).cast("string")) > n
            aggs.append(F.count_if(cond).alias(f"{col}:{check}"))
        wide = df.agg(*aggs)
        long = wide.unpivot([], wide.columns, "name", "violations")
        out.append(long.select(F.lit(table).alias("table_name"),
                               F.split_part("name", F.lit(":"), F.lit(1)).alias("column_name"),
                               F.split_part("name", F.lit(":"), F.lit(2)).alias("check_name"),
                               F.col("violations").cast("long")))
    return _union(out)


def _constraint_sql() -> str:
    parts = []
    for table in ORACLE_NAMES:
        for col, check, n in _checks(table):
            cond = f"{col} IS NULL" if check == "not_null" else f"length(CAST({col} AS VARCHAR)) > {n}"
            parts.append(f"SELECT '{table}' AS table_name, '{col}' AS column_name, '{check}' AS check_name, "
                         f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS violations FROM {ORACLE_NAMES[table]}")
    return " UNION ALL ".join(parts)


# ------------------------------------------------------------------ summary = detail

def summary_consistency(w: Warehouse) -> DataFrame:
    """The summary must re-add to the detail (same items, money and review
    totals); ``violations`` counts summary rows breaking
    on_time <= delivered <= items or reviews <= items."""
    f = w.hold_fact().fact_order_item.agg(
        F.count(F.lit(1)).alias("items"),
        F.sum("revenue").cast("decimal(28,2)").alias("revenue"),
        F.sum("freight_value").cast("decimal(28,2)").alias("freight"),
        F.sum("gross_profit").cast("decimal(28,2)").alias("gross_profit"),
        F.coalesce(F.sum("review_score"), F.lit(0)).cast("long").alias("review_score_sum"),
        F.lit(0).cast("long").alias("violations"))
    s = w.fact_daily_seller_category
    bad = ((F.col("on_time_deliveries") > F.col("delivered_items"))
           | (F.col("delivered_items") > F.col("items_count"))
           | (F.col("reviews_count") > F.col("items_count")))
    sm = s.agg(
        F.sum("items_count").cast("long").alias("items"),
        F.sum("revenue_total").cast("decimal(28,2)").alias("revenue"),
        F.sum("freight_total").cast("decimal(28,2)").alias("freight"),
        F.sum("gross_profit_total").cast("decimal(28,2)").alias("gross_profit"),
        F.coalesce(F.sum("review_score_sum"), F.lit(0)).cast("long").alias("review_score_sum"),
        F.count_if(bad).alias("violations"))
    return (f.select(F.lit("fact_order_item").alias("source"), "*")
            .unionByName(sm.select(F.lit("fact_daily_seller_category").alias("source"), "*")))


SUMMARY_CONSISTENCY_SQL = """
SELECT 'fact_order_item' AS source, CAST(count(*) AS BIGINT) AS items, CAST(sum(revenue) AS DECIMAL(28,2)) AS revenue,
       CAST(sum(freight_value) AS DECIMAL(28,2)) AS freight, CAST(sum(gross_profit) AS DECIMAL(28,2)) AS gross_profit,
       CAST(coalesce(sum(review_score), 0) AS BIGINT) AS review_score_sum, CAST(0 AS BIGINT) AS violations
FROM w_fact
UNION ALL
SELECT 'fact_daily_seller_category', CAST(sum(items_count) AS BIGINT), CAST(sum(revenue_total) AS DECIMAL(28,2)),
       CAST(sum(freight_total) AS DECIMAL(28,2)), CAST(sum(gross_profit_total) AS DECIMAL(28,2)),
       CAST(coalesce(sum(review_score_sum), 0) AS BIGINT),
       CAST(count(*) FILTER (WHERE on_time_deliveries > delivered_items OR delivered_items > items_count
                                   OR reviews_count > items_count) AS BIGINT)
FROM w_summary"""


def register_all(register, warehouse) -> None:
    p = FIXTURE_PARAMS

    def wh(fn):
        return lambda spark, sf_dir: fn(warehouse(spark, sf_dir))

    register("row_count_audit", O.with_warehouse(ROW_COUNT_SQL, p))(wh(row_count_audit))
    register("fk_audit", O.with_warehouse(FK_SQL, p))(wh(fk_audit))
    register("key_audit", O.with_warehouse(_key_sql(), p))(wh(key_audit))
    register("constraint_audit", O.with_warehouse(_constraint_sql(), p))(wh(constraint_audit))
    register("summary_consistency", O.with_warehouse(SUMMARY_CONSISTENCY_SQL, p))(wh(summary_consistency))
