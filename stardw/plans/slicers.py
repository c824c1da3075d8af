"""R2: report slicers that cascade through every report.

``slice_warehouse`` returns a view of the warehouse whose order-line fact and
daily summary keep only the chosen purchase period, category groups and item
categories; the dimensions are shared.  Every report function applied to the view is sliced.

* the period is a range on the order-preserving YYYYMMDD key, pushed into
  the parquet scan of a stored fact (file and row-group skipping on its
  date-sorted layout);
* groups and categories become a semi-join with the product dimension (or the
  category map for the summary); a fact that is not stored yet carries them.  A product without a category is sliced as
  "Unknown", the name the reports show.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stardw import schemas as S
from stardw.functions import exprs as X
from stardw.plans.warehouse import Warehouse


def date_key_range(col: str, lo: dt.date, hi: dt.date) -> Column:
    """A calendar period as a range on a YYYYMMDD smart key."""
    return F.col(col).between(int(lo.strftime("%Y%m%d")), int(hi.strftime("%Y%m%d")))


class SlicedWarehouse(Warehouse):
    """Lazy sliced view: dimensions are the base warehouse's, facts are
    filtered on first access (a report that reads only the order-line fact
    never builds the summary)."""

    def __init__(self, base: Warehouse, lo: dt.date | None, hi: dt.date | None,
                 groups: Sequence[str] | None, categories: Sequence[str] | None = None):
        super().__init__(base.raw, base.params)
        self.base, self.lo, self.hi = base, lo, hi
        self.groups, self.categories = list(groups or []), list(categories or [])

    @cached_property
    def dim_date(self) -> DataFrame:
        return self.base.dim_date

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self.base.dim_customer

    @cached_property
    def dim_seller(self) -> DataFrame:
        return self.base.dim_seller

    @cached_property
    def dim_product(self) -> DataFrame:
        return self.base.dim_product

    @property
    def dim_product_category(self) -> DataFrame:
        return self.base.dim_product_category

    def _period(self, col: str) -> Column | None:
        if self.lo is None and self.hi is None:
            return None
        return date_key_range(col, self.lo or dt.date(1, 1, 1), self.hi or dt.date(9999, 12, 31))

    def _chosen(self, categories: DataFrame, group: Column) -> DataFrame | None:
        """Rows of a table of categories that the slicers let through (None: all)."""
        if not self.groups and not self.categories:
            return None
        if self.groups:
            categories = categories.where(group.isin(self.groups))
        if self.categories:
            categories = categories.where(F.coalesce("product_category", F.lit("Unknown")).isin(self.categories))
        return categories

    @cached_property
    def fact_order_item(self) -> DataFrame:
        return self._sliced_fact()

    def fact_lines(self, *product_attrs: str) -> DataFrame:
        if self.builds_fact:
            return self._sliced_fact(*product_attrs)
        return self.fact_order_item.join(self.dim_product.select("sk_product", *product_attrs), "sk_product")

    def hold_fact(self) -> Warehouse:
        self.base.hold_fact()
        return self

    def _sliced_fact(self, *product_attrs: str) -> DataFrame:
        """The sliced fact; if the base builds it, its lines carry what is
        sliced by, and the ``product_attrs``."""
        period = self._period("sk_date_purchase")
        if self.base.builds_fact and (self.groups or self.categories):
            lines = self.base.fact_lines(*dict.fromkeys(["product_category", "product_category_group", *product_attrs]))
            lines = lines if period is None else lines.where(period)
            return (self._chosen(lines, F.col("product_category_group"))
                    .select(*S.column_order("fact_order_item"), *product_attrs))
        fact = self.base.fact_lines(*product_attrs) if product_attrs else self.base.fact_order_item
        fact = fact if period is None else fact.where(period)
        products = self._chosen(self.base.dim_product, F.col("product_category_group"))
        if products is not None:
            fact = fact.join(products.select("sk_product"), "sk_product", "left_semi")
        return fact

    @property
    def fact_daily_seller_category(self) -> DataFrame:
        summary = self.base.fact_daily_seller_category
        period = self._period("sk_date")
        if period is not None:
            summary = summary.where(period)
        cats = self._chosen(self.base.dim_product_category, X.category_group("product_category"))
        if cats is not None:
            summary = summary.join(cats.select("sk_product_category"), "sk_product_category", "left_semi")
        return summary


def slice_warehouse(w: Warehouse, period_from: dt.date | None = None, period_to: dt.date | None = None,
                    groups: Sequence[str] | None = None, categories: Sequence[str] | None = None) -> Warehouse:
    return SlicedWarehouse(w, period_from, period_to, groups, categories)


def sliced(w: Warehouse) -> Warehouse:
    """The warehouse under the period and group slicers of its ``Params``."""
    p = w.params
    return slice_warehouse(w, p.period_from, p.period_to, p.slicer_groups)


def item_sliced(w: Warehouse) -> Warehouse:
    """The warehouse under the period and item-category slicers of its ``Params``."""
    p = w.params
    return slice_warehouse(w, p.period_from, p.period_to, categories=p.slicer_categories)
