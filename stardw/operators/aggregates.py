"""Deterministic aggregates (A1, A5).

Spark's ``first`` depends on row order; it is replaced by an order-independent
formulation (the deterministic mode, A2, is part of ``dims.seller_stats``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_non_null_by(value: str, order: str) -> Column:
    """A1/T4: the first non-NULL ``value`` by ``order``.  The ordering key is
    NULLed where the value is NULL, so ``min_by`` never picks a NULL value
    while a non-NULL one exists."""
    return F.min_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order)))


def date_bounds(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A5: one-row (lo, hi) over several date/timestamp columns in one pass
    (``least``/``greatest`` skip NULLs)."""
    lo = F.least(*[F.min(F.to_date(c)) for c in cols]) if len(cols) > 1 else F.min(F.to_date(cols[0]))
    hi = F.greatest(*[F.max(F.to_date(c)) for c in cols]) if len(cols) > 1 else F.max(F.to_date(cols[0]))
    return df.agg(lo.alias("lo"), hi.alias("hi"))
