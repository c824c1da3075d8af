"""Records of quoted CSV text, read in parallel.

A quoted field may hold line breaks, so whether a line begins a record depends
on all quotes before it in its file.  Lines are read as text, split by split;
each split reports the parity of its quotes and how many records begin in it
for either state of its start.  A prefix sum over the splits (one row each)
gives every split its state and its first record's number, and from there each
line the number of its record.  Lines that are a record of their own go on as
they are; only the lines of records that hold breaks are brought together.

Quotes are those of RFC 4180: a field with a quote, a separator or a break is
quoted and its quotes are doubled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stardw.operators.lineage import staged


def numbered_lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """``file, block, pos, value``: every line with its file, the start of its
    split in it and an order within the split."""
    lines = spark.read.option("lineSep", "\n").text(list(files))
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("pos"), "value")


def quoted_records(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """``file, record, text``: the records of each file, numbered from 1 in file
    order; breaks inside a record stay, a carriage return that ends it goes.
    A record with an unclosed quote reaches to the end of its file."""
    before = W.partitionBy("file", "block").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    upto = W.partitionBy("file", "block").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = (numbered_lines(spark, files).withColumn("odd", quotes % 2)
             .withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
             .withColumn("even_starts", F.sum(1 - F.col("inside")).over(upto))
             .withColumn("odd_starts", F.sum("inside").over(upto)))
    lines, _ = staged(lines, "csv-lines")
    blocks = lines.groupBy("file", "block").agg((F.sum("odd") % 2).alias("parity"), F.max("even_starts").alias("even"), F.max("odd_starts").alias("odd"))
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)  # one row a split
    state = blocks.withColumn("state", F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2)
    first = state.withColumn("first", F.coalesce(F.sum(F.when(F.col("state") == 0, F.col("even")).otherwise(F.col("odd"))).over(earlier), F.lit(0)))
    placed = lines.join(first.select("file", "block", "state", "first"), ["file", "block"]).select(
        "file", "block", "pos", "value",
        (F.col("first") + F.when(F.col("state") == 0, F.col("even_starts")).otherwise(F.col("odd_starts"))).alias("record"),
        ((F.col("inside") == F.col("state")) & (F.col("odd") == 0)).alias("whole"))
    whole = placed.where("whole").select("file", "record", F.col("value").alias("text"))
    parts = (placed.where("NOT whole").groupBy("file", "record")  # the lines of one record
             .agg(F.array_sort(F.collect_list(F.struct("block", "pos", "value"))).alias("lines"))
             .select("file", "record", F.array_join(F.col("lines.value"), "\n").alias("text")))
    return whole.unionByName(parts).withColumn("text", F.regexp_replace("text", "\r$", ""))
