"""Keys and de-duplication.

``dense_key``  — 1..n surrogate keys in natural-key order without funnelling
                 the table through one task (an un-partitioned window would).
``keep_first`` — one row per key, the first by a stated order (insert-ignore
                 semantics), as a hash/sort aggregate with map-side combine so
                 a hot key is collapsed before the shuffle.
``range_tops`` — where to cut a table into ranges of a key with few values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stardw.operators.lineage import staged

_PART, _POS, _CNT = "__part", "__pos", "__cnt"


def dense_key(df: DataFrame, order_cols: Sequence[str], out_col: str, key_type: str = "long") -> DataFrame:
    """Number the rows of ``df`` 1..n in ``order_cols`` order (ties must not
    exist: order by a unique key).

    Range-partition + sort (one shuffle, spread over all tasks), tag each row
    with (partition, position-in-partition), write them as a staged table so
    the tags are stable on re-execution or executor loss, count rows per
    partition (the driver gets one number per partition) and add the running
    counts as constants.  No join stands over the staged table, so the planner
    knows the bytes of what is numbered and readers its columns.
    """
    ordered = (df.orderBy(*order_cols)
               .withColumn(_PART, F.spark_partition_id())
               .withColumn(_POS, F.monotonically_increasing_id()))
    ordered, _ = staged(ordered, f"keyed-{out_col}")
    counts = {r[_PART]: r[_CNT] for r in ordered.groupBy(_PART).agg(F.count(F.lit(1)).alias(_CNT)).collect()}
    offsets, total = [0], 0
    for part in range(max(counts, default=0)):
        total += counts.get(part, 0)
        offsets.append(total)
    before = F.array(*[F.lit(n).cast("long") for n in offsets])[F.col(_PART)]
    local = F.col(_POS) - F.shiftleft(F.col(_PART).cast("long"), 33)
    return ordered.withColumn(out_col, (before + local + 1).cast(key_type)).drop(_PART, _POS)


def keep_first(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Keep one row per ``keys``: the smallest by ``order_cols``
    (ascending, then every remaining column as a deterministic tie-break).

    ``min(struct(...))`` is an aggregate, so Spark pre-aggregates per map task
    (partial aggregation) before the shuffle: a key holding a third of all rows
    is reduced to one row per task, never gathered into one group list.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    packed = F.min(F.struct(*[F.col(c) for c in [*order_cols, *rest]])).alias("__first")
    return (df.groupBy(*keys).agg(packed)
            .select(*keys, *[F.col(f"__first.{c}").alias(c) for c in [*order_cols, *rest]])
            .select(*df.columns))


def range_tops(df: DataFrame, key: str, parts: int) -> list:
    """The greatest values of all but the last of at most ``parts`` ranges of
    ``key`` with about as many rows each.  The driver gets a count per value:
    for keys like the day, whose values do not grow with the rows."""
    if parts < 2:
        return []
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(_CNT)).collect()
    total, seen, share, tops = sum(r[_CNT] for r in counts), 0, 0, []
    for r in sorted(counts, key=lambda r: r[key]):
        seen += r[_CNT]
        if seen * parts // total > share:
            share = seen * parts // total
            tops.append(r[key])
    return tops[:-1]


def in_ranges(key: str, tops: Sequence) -> list[Column]:
    """A condition for each range that ends at ``tops`` and the one beyond, in
    order: a row meets one of them, one without a key the first."""
    if not tops:
        return [F.lit(True)]
    k = F.col(key)
    return [k.isNull() | (k <= tops[0]), *[(k > a) & (k <= b) for a, b in zip(tops, tops[1:])], k > tops[-1]]


def keep_known_first(df: DataFrame, key: str, order_cols: Sequence[str]) -> DataFrame:
    """`keep_first` for the members of a dimension: rows with a NULL key are
    refused, and of a key's rows the smallest by ``order_cols`` stays, a known
    value before NULL."""
    flags = {f"__no_{c}": F.col(c).isNull() for c in order_cols}
    ordered = [x for c in order_cols for x in (f"__no_{c}", c)]
    return keep_first(df.where(F.col(key).isNotNull()).withColumns(flags), [key], ordered).drop(*flags)
