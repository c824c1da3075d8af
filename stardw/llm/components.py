"""Connected components by contraction, each round cut by a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stardw.session import scratch_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back."""
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of the
    edges ``a, b``; repeated edges, loops and none at all are fine.

    Each round hooks every node to its smallest neighbour, jumps one pointer,
    and relabels the edges, so their number falls at least by half a round and
    a star is done in one.  Minima are taken with map-side aggregation and hot
    nodes meet in plain joins, which Spark may split.
    """
    labels, rest = None, stored(edges.where("a <> b").distinct(), "cc-edges")
    while not rest.isEmpty():
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("up"))
        hook = stored(hook, "cc-hook")
        up2 = hook.select(F.col("node").alias("up"), F.col("up").alias("up2"))
        jump = stored(hook.join(up2, "up").select("node", F.col("up2").alias("up")), "cc-jump")
        a, b = (jump.select(F.col("node").alias(x), F.col("up").alias(f"{x}_up")) for x in "ab")
        rest = stored(rest.join(a, "a").join(b, "b").where("a_up <> b_up")
                      .select(F.col("a_up").alias("a"), F.col("b_up").alias("b")).distinct(), "cc-edges")
        if labels is None:
            labels = jump.select("node", F.col("up").alias("component"))
        else:
            up = jump.select(F.col("node").alias("component"), F.col("up").alias("next"))
            labels = stored(labels.join(up, "component", "left")
                            .select("node", F.coalesce("next", "component").alias("component")), "cc-labels")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    return labels
