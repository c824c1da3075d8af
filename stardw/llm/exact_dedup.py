"""Exact dedup: group by 128-bit content hash, compare bytes inside groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stardw.llm.common import LOWER, UPPER


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 keep: str = "max", hash_bits: int = 128) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.
    The stable id that stays is the largest (``keep='max'``) or the smallest of
    its group.  Of repeated rows (same id, same text) one is kept; a null id
    stays only if its group has no other, and is then its own ``keep_id``.
    Empty tables give no rows; other columns of ``docs`` are ignored.

    Rows are grouped by the content hash *and* the text itself, so the hash
    only places rows and equality is byte equality; map-side aggregation folds
    the copies of a hot text before the shuffle.  Rows meet their group again by
    content hash and SHA-256, so that shuffle moves ids and digests only.
    ``hash_bits`` below 128 is for tests of the collision path.
    """
    norm = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)
    content = F.substring(F.md5(norm.cast("binary")), 1, hash_bits // 4)
    best = F.max if keep == "max" else F.min
    groups = (docs.select(F.col(id_col).alias("id"), norm.alias("norm"))
              .withColumn("h", F.substring(F.md5(F.col("norm").cast("binary")), 1, hash_bits // 4))
              .groupBy("h", "norm").agg(best("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
              .select("h", F.sha2(F.col("norm").cast("binary"), 256).alias("g_sha"), "keep_id", "group_size"))
    rows = (docs.select(F.col(id_col).alias("id"), content.alias("h"),
                        F.sha2(norm.cast("binary"), 256).alias("sha"))
            .groupBy("id", "h", "sha").agg(F.count(F.lit(1)).alias("n")))
    joined = rows.join(groups, (rows["h"] == groups["h"]) & (rows["sha"] == groups["g_sha"]))
    return (joined.select("id", "keep_id", "group_size", "sha", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("k"))
            .select(F.col("id").alias("doc_id"), "keep_id", "group_size",
                    (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("k") == 1)).alias("kept"),
                    F.col("sha").alias("text_sha256")))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """The rows of ``docs`` that `exact_groups` keeps, all columns kept; of
    rows that repeat an id and its text one stays."""
    key, sha = (next(x for k in range(9) if (x := f"{name}{'_' * k}") not in docs.columns) for name in ("kept_key", "kept_sha"))
    kept = exact_groups(docs, id_col, text_col, keep).where("kept").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias(key), F.col("text_sha256").alias(sha))
    rows = (docs.withColumn(key, F.coalesce(F.col(id_col).cast("string"), F.lit("")))
            .withColumn(sha, F.sha2(F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER).cast("binary"), 256)))
    return rows.join(kept, [key, sha], "left_semi").dropDuplicates([key, sha]).select(*docs.columns)
