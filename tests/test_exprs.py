"""Golden rows for the Column-level business rules (default cut-points)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from stardw import DEFAULT_PARAMS as P
from stardw.functions import exprs as X


def one(spark, expr, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr.alias("v")).collect()]


def test_price_band_and_premium(spark):
    rows = [(None,), (Decimal("49.99"),), (Decimal("50.00"),), (Decimal("199.99"),),
            (Decimal("200.00"),), (Decimal("499.99"),), (Decimal("500.00"),)]
    bands = one(spark, X.price_band("p", P), rows, "p decimal(10,2)")
    assert bands == ["Unknown", "Budget", "Mid", "Mid", "Premium", "Premium", "Luxury"]
    prem = one(spark, X.is_premium("p", P), rows, "p decimal(10,2)")
    assert prem == [False, False, False, False, False, False, True]  # NULL price -> False


def test_segment_size_tier(spark):
    seg = one(spark, X.customer_segment("n"), [(0,), (1,), (2,), (4,), (5,)], "n long")
    assert seg == ["Regular", "Occasional", "Regular", "Regular", "Loyal"]  # 0 orders -> Regular
    size = one(spark, X.seller_size("n", P), [(None,), (49,), (50,), (499,), (500,)], "n long")
    assert size == ["Small", "Small", "Medium", "Medium", "Large"]
    tier = one(spark, X.seller_tier("r", P),
               [(None,), (Decimal("4999.99"),), (Decimal("5000"),), (Decimal("49999.99"),), (Decimal("50000"),)],
               "r decimal(20,2)")
    assert tier == ["Bronze", "Bronze", "Silver", "Silver", "Gold"]


def test_age_group_right_closed(spark):
    ages = [(18,), (24,), (25,), (34,), (35,), (64,), (65,), (70,), (None,), (101,)]
    got = one(spark, X.age_group("a"), ages, "a int")
    assert got == ["18-24", "18-24", "25-34", "25-34", "35-44", "55-64", "65+", "65+", "nan", "nan"]


def test_category_group_precedence(spark):
    cats = [("garden_tools",), ("construction_tools_lights",), ("electronics",), ("cds_dvds_musicals",),
            ("party_supplies",), (None,), ("",), ("pet_shop",), ("Brand#23",), ("BABY",)]
    got = one(spark, X.category_group("c"), cats, "c string")
    # garden_tools: Home & Garden precedes Construction ("tool")
    assert got == ["Home & Garden", "Construction", "Electronics", "Books & Media", "Art & Craft",
                   "Other", "Other", "Other", "Other", "Sports & Leisure"]


def test_region(spark):
    got = one(spark, X.region_of("s"), [("SP",), ("AM",), ("ZZ",), (None,), ("DF",)], "s string")
    assert got == ["Southeast", "North", "Other", "Other", "Center-West"]


def test_elapsed_days_floor_and_on_time(spark):
    ts = dt.datetime
    rows = [
        (ts(2017, 1, 1, 23, 0), ts(2017, 1, 2, 1, 0), ts(2017, 1, 2, 0, 0)),   # 2 h over midnight -> 0 days; late
        (ts(2017, 1, 2, 1, 0), ts(2017, 1, 1, 23, 0), ts(2017, 1, 2, 0, 0)),   # -2 h -> -1 day; on time
        (ts(2017, 1, 1, 10, 0), None, ts(2017, 1, 5, 0, 0)),                   # undelivered -> NULL
        (ts(2017, 1, 1, 10, 0), ts(2017, 1, 3, 10, 0), None),                  # no estimate -> NULL flag
        (ts(2017, 1, 1, 10, 0), ts(2017, 1, 3, 10, 0), ts(2017, 1, 3, 10, 0)),  # equal -> on time
        (ts(2017, 1, 1, 10, 0), ts(2017, 1, 1, 10, 0) - dt.timedelta(microseconds=500_000), None),  # -0.5 s -> -1 day
    ]
    schema = "p timestamp_ntz, d timestamp_ntz, e timestamp_ntz"
    assert one(spark, X.elapsed_days("p", "d"), rows, schema) == [0, -1, None, 2, 2, -1]
    assert one(spark, X.on_time_flag("d", "e"), rows, schema) == [0, 1, None, None, 1, None]


def test_date_key(spark):
    got = one(spark, X.date_key("t"), [(dt.datetime(2018, 3, 9, 23, 59),), (None,)], "t timestamp_ntz")
    assert got == [20180309, None]


def test_half_up_ratio_exact(spark):
    rows = [(1, 8), (5, 2), (-5, 2), (7, 0), (2, 3), (1, 128)]
    got = one(spark, X.half_up_ratio("n", "d", 2), rows, "n long, d long")
    assert got == [Decimal("0.13"), Decimal("2.50"), Decimal("-2.50"), None, Decimal("0.67"), Decimal("0.01")]
    got6 = one(spark, X.half_up_ratio("n", "d", 6), [(1, 128)], "n long, d long")
    assert got6 == [Decimal("0.007813")]


def test_simulated_attributes_ranges_and_stability(spark):
    df = spark.range(5000).select(F.concat(F.lit("U"), F.col("id").cast("string")).alias("k"),
                                  F.lit(dt.datetime(2018, 1, 1)).cast("timestamp_ntz").alias("first"))
    out = df.select(X.sim_age("k", P).alias("age"), X.sim_gender("k", P).alias("g"),
                    F.datediff(F.to_date("first"), X.sim_signup_date("k", "first", P)).alias("lead"),
                    F.datediff(F.lit(P.seller_epoch), X.sim_seller_join_date("k", P)).alias("join"))
    r = out.agg(F.min("age"), F.max("age"), F.avg((F.col("g") == "M").cast("int")),
                F.min("lead"), F.max("lead"), F.min("join"), F.max("join")).first()
    assert (r[0], r[1]) == (18, 70)
    assert 0.44 < r[2] < 0.52
    assert 60 <= r[3] and r[4] <= 730 and 30 <= r[5] and r[6] <= 1095
    # independent of partitioning
    a = sorted(out.collect())
    b = sorted(df.repartition(7).select(X.sim_age("k", P).alias("age"), X.sim_gender("k", P).alias("g"),
                                        F.datediff(F.to_date("first"), X.sim_signup_date("k", "first", P)).alias("lead"),
                                        F.datediff(F.lit(P.seller_epoch), X.sim_seller_join_date("k", P)).alias("join"))
               .collect())
    assert a == b


def test_margin_of_large_sums_does_not_overflow(spark):
    from stardw.plans.reports import margin_pct
    top = spark.range(1).select(F.lit(Decimal("99999999.99")).cast("decimal(28,2)").alias("one"))
    sums = top.select((F.col("one") * 10_000_000_000).cast("decimal(28,2)").alias("profit_sum"),
                      (F.col("one") * 10_000_000_000).cast("decimal(28,2)").alias("revenue_sum"))
    assert sums.select(margin_pct()).first()[0] == 100
