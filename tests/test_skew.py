"""Skewed inputs: one order, one product and one seller each hold a third of
the order lines.  With broadcasts off and skewed partitions split at run time,
every result must equal the usual plan's."""

import contextlib
import dataclasses
import io

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stardw.params import FIXTURE_PARAMS
from stardw.plans import reports
from stardw.plans.warehouse import Warehouse
from stardw.sources import fixtures as FX

from paths import SF_SMALL

SPLIT = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
         "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
         "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def skewed_raw(spark):
    raw = FX.fixture_tables(spark, SF_SMALL)
    hot_order = raw.orders.where("customer_id < 1000000 AND order_purchase_timestamp IS NOT NULL").agg(F.min("order_id")).first()[0]
    items = FX.fixture_first_items(spark, SF_SMALL).where("product_id < 1000000 AND seller_id < 1000000")
    items = items.withColumn("_r", F.abs(F.xxhash64("order_id", "order_item_id")) % 3)
    items = (items
             .withColumn("seller_id", F.when(F.col("_r") == 0, F.lit(1)).otherwise(F.col("seller_id")))
             .withColumn("product_id", F.when(F.col("_r") == 1, F.lit(7)).otherwise(F.col("product_id")))
             .withColumn("order_item_id", F.when(
                 F.col("_r") == 2,
                 1000 + F.row_number().over(W.partitionBy("_r").orderBy("order_id", "order_item_id")))
                 .otherwise(F.col("order_item_id")))
             .withColumn("order_id", F.when(F.col("_r") == 2, F.lit(hot_order)).otherwise(F.col("order_id")))
             .drop("_r"))
    return dataclasses.replace(raw, items=items.checkpoint())


def snapshot(raw):
    w = Warehouse(raw, FIXTURE_PARAMS)
    fact = sorted((tuple(r) for r in w.fact_order_item.collect()), key=str)
    scatter = sorted(tuple(r) for r in reports.seller_scatter(w).collect())
    matrix = sorted((tuple(r) for r in reports.report_category_tier_matrix(w).collect()), key=str)
    return fact, scatter, matrix


@pytest.fixture(scope="module")
def both_paths(spark):
    raw = skewed_raw(spark)
    normal = snapshot(raw)
    saved = {k: spark.conf.get(k, None) for k in SPLIT}
    for k, v in SPLIT.items():
        spark.conf.set(k, v)
    try:
        split = snapshot(raw)
        df = Warehouse(raw, FIXTURE_PARAMS).fact_order_item
        df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return raw, normal, split, buf.getvalue()


def test_hot_keys_exist(both_paths):
    raw = both_paths[0]
    n = raw.items.count()
    top = raw.items.groupBy("order_id").count().agg(F.max("count")).first()[0]
    assert top * 4 > n  # one order holds about a third of all lines


def test_split_path_equals_usual_path(both_paths):
    _, normal, split, plan = both_paths
    assert normal[0] == split[0] and len(normal[0]) > 0
    assert normal[1] == split[1]
    assert normal[2] == split[2]
    assert "SortMergeJoin(skew=true)" in plan or "skewed" in plan
