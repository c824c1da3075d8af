"""Relational building blocks: keep-first, deterministic first, dense keys."""

import datetime as dt

from pyspark.sql import functions as F

from stardw.operators.aggregates import date_bounds, first_non_null_by
from stardw.operators.keys import dense_key, keep_first


def test_keep_first_order_and_ties(spark):
    df = spark.createDataFrame(
        [(1, 1, "b", 5), (1, 1, "a", 9), (1, 1, "a", 3), (1, 2, "z", 1), (2, 1, None, 7)],
        "k1 int, k2 int, o string, v int")
    got = sorted(keep_first(df, ["k1", "k2"], ["o"]).collect())
    assert [tuple(r) for r in got] == [(1, 1, "a", 3), (1, 2, "z", 1), (2, 1, None, 7)]


def test_keep_first_hot_key(spark):
    # one key with a third of all rows is reduced map-side, result still exact
    df = spark.range(30000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("k"),
                                   (F.col("id") % 1000).alias("o"), F.col("id").alias("v"))
    out = keep_first(df, ["k"], ["o", "v"])
    row = out.where("k = 0").first()
    assert (row["o"], row["v"]) == (0, 0)
    assert out.count() == 20001


def test_first_non_null_by(spark):
    df = spark.createDataFrame([("u", 3, "c3"), ("u", 1, None), ("u", 2, "c2"), ("v", 1, None)],
                               "u string, k int, city string")
    got = {r["u"]: r["c"] for r in df.groupBy("u").agg(first_non_null_by("city", "k").alias("c")).collect()}
    assert got == {"u": "c2", "v": None}


def test_dense_key_over_many_partitions(spark):
    df = spark.range(2000).select(F.format_string("K%05d", (F.col("id") * 7919) % 2000).alias("nk"))
    a = sorted((r["nk"], r["sk"]) for r in dense_key(df, ["nk"], "sk").collect())
    b = sorted((r["nk"], r["sk"]) for r in dense_key(df.repartition(5), ["nk"], "sk").collect())
    assert a == b
    assert [sk for _, sk in a] == list(range(1, 2001))
    assert dense_key(df.limit(0), ["nk"], "sk").count() == 0


def test_date_bounds_skip_nulls(spark):
    df = spark.createDataFrame([(dt.datetime(2017, 1, 5), None), (dt.datetime(2017, 1, 2), dt.datetime(2018, 2, 1)),
                                (None, dt.datetime(2016, 12, 31))], "a timestamp_ntz, b timestamp_ntz")
    r = date_bounds(df, ["a", "b"]).first()
    assert (r["lo"], r["hi"]) == (dt.date(2016, 12, 31), dt.date(2018, 2, 1))

