"""The star schema as a lazily built set of DataFrames.

``Warehouse`` builds each table on first access and then reuses it, so a
report that needs only the fact and two dimensions never builds the others.
The dense-key steps write their dimension once (staged table), and so does
``hold_fact`` the fact for those that read it repeatedly; everything else stays
a lazy plan until an action runs.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import DataFrame

from stardw.operators.lineage import staged
from stardw.params import Params
from stardw.plans import dims, facts
from stardw.sources.raw import RawTables


class Warehouse:
    def __init__(self, raw: RawTables, params: Params):
        self.raw = raw
        self.params = params

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.build_dim_date(self.raw.orders)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dims.build_dim_customer(self.raw.customers, self.raw.orders, self.params)

    @cached_property
    def dim_seller(self) -> DataFrame:
        r = self.raw
        return dims.build_dim_seller(r.sellers, r.items, r.products, r.translation, self.params)

    @cached_property
    def dim_product(self) -> DataFrame:
        r = self.raw
        return dims.build_dim_product(r.products, r.items, r.translation, self.params)

    def _build_fact(self, *product_attrs: str, days: tuple[_dt.date, _dt.date] | None = None) -> DataFrame:
        r = self.raw
        return facts.build_fact_order_item(
            r.orders, r.items, r.customers, r.reviews, self.dim_customer, self.dim_seller, self.dim_product, product_attrs,
            days)

    @cached_property
    def fact_order_item(self) -> DataFrame:
        return self._build_fact()

    def fact_lines(self, *product_attrs: str) -> DataFrame:
        """The order-line fact with columns of each line's product.  A fact that
        is built here carries them from its own join with the products; one
        that is given (stored, sliced) is joined with them."""
        held = self.__dict__.get("_held_lines")
        if held is not None and set(product_attrs) <= set(held.columns):
            return held
        if self.builds_fact:
            return self._build_fact(*product_attrs)
        return self.fact_order_item.join(self.dim_product.select("sk_product", *product_attrs), "sk_product")

    @property
    def builds_fact(self) -> bool:
        return "_given_fact" not in self.__dict__

    def hold_fact(self) -> "Warehouse":
        """Write the fact, with its lines' categories, as a staged table that
        all later readers share: for what reads it more than once."""
        if self.builds_fact:
            held, _ = staged(self._build_fact("product_category"), "fact-lines")
            self.use("fact_order_item", held.drop("product_category"))
            self.__dict__["_held_lines"] = held
        return self

    @cached_property
    def _summary(self) -> tuple[DataFrame, DataFrame]:
        own = self.builds_fact or "_held_lines" in self.__dict__
        return facts.build_fact_daily_seller_category(
            self.fact_lines("product_category") if own else self.fact_order_item, self.dim_product)

    def daily_summary(self, first: _dt.date, last: _dt.date) -> tuple[DataFrame, DataFrame]:
        """The daily summary and its category map for a reader of the days
        ``first`` to ``last`` (others may be in it).  The period is in the
        summary's key, so where the summary is built for this reader alone the
        predicate is applied to the orders it is built from."""
        if self.builds_fact and not {"_summary", "_stored_summary", "_stored_category"} & set(self.__dict__):
            lines = self._build_fact("product_category", days=(first, last))
            return facts.build_fact_daily_seller_category(lines, self.dim_product)
        return self.fact_daily_seller_category, self.dim_product_category

    @property
    def fact_daily_seller_category(self) -> DataFrame:
        stored = self.__dict__.get("_stored_summary")
        return stored if stored is not None else self._summary[0]

    @property
    def dim_product_category(self) -> DataFrame:
        stored = self.__dict__.get("_stored_category")
        return stored if stored is not None else self._summary[1]

    def use(self, table: str, df: DataFrame) -> "Warehouse":
        """Replace a table by an already built one (e.g. read back from
        storage); later tables are built from it."""
        if table == "fact_daily_seller_category":
            self.__dict__["_stored_summary"] = df
        elif table == "dim_product_category":
            self.__dict__["_stored_category"] = df
        else:
            self.__dict__[table] = df
            if table == "fact_order_item":
                self.__dict__["_given_fact"] = True
                self.__dict__.pop("_held_lines", None)
        return self

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_date": self.dim_date,
            "dim_customer": self.dim_customer,
            "dim_seller": self.dim_seller,
            "dim_product": self.dim_product,
            "fact_order_item": self.fact_order_item,
            "fact_daily_seller_category": self.fact_daily_seller_category,
            "dim_product_category": self.dim_product_category,
        }
