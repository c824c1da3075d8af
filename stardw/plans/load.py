"""The whole load (C7): raw tables -> six warehouse tables (+ category map).

Order: dimensions are written first and read back (S7), the fact is built
from the stored dimensions and written, and the summary is aggregated from
the **stored** fact — each stage reads the previous stage's files, so a
lost executor never forces recomputation further back than one stage and
the summary is consistent with the de-duplicated fact.  Every table is a
full refresh (S4).

The fact is built by parts of the orders and laid out and summed up by ranges
of days, with the shuffle files of a part let go before the next: the disk
holds the shuffles of a part, not of the load.  A staged table is removed when
the last that reads it is written.
"""

from __future__ import annotations

import dataclasses

from stardw.operators.keys import in_ranges, range_tops
from stardw.operators.lineage import release, remove, staged, stored_bytes
from stardw.params import Params
from stardw.plans import facts
from stardw.plans.warehouse import Warehouse
from stardw.sources.raw import RawTables
from stardw.sources.warehouse_io import read_table, write_table, write_table_in_ranges

DIMENSIONS = ["dim_date", "dim_customer", "dim_seller", "dim_product"]
#: Parts of the fact and ranges of its days at most (each reads the staged
#: lines or fact, and a range shuffles less), and the bytes of staged lines that
#: are worth one.
PARTS, RANGES, PART_BYTES = 8, 4, 16 << 20


def load_warehouse(raw: RawTables, params: Params, base: str) -> Warehouse:
    """Build and write every table under ``base``; returns a Warehouse whose
    tables read the written files."""
    spark = raw.orders.sparkSession
    # the raw lines feed the seller, product and fact builds: read once into a
    # narrow table, removed when the load is done
    items, path = staged(raw.items, "load-lines")
    source, raw = raw, dataclasses.replace(raw, items=items)
    w = Warehouse(raw, params)
    for t in DIMENSIONS:
        write_table(getattr(w, t), base, t)
        w.use(t, read_table(spark, base, t))
        release(spark)
    parts = max(1, min(PARTS, stored_bytes(spark, path) // PART_BYTES))
    fact, fact_path = facts.stage_fact_order_item(
        raw.orders, raw.items, raw.customers, raw.reviews, w.dim_customer, w.dim_seller, w.dim_product, parts)
    remove(spark, path)
    tops = range_tops(fact, "sk_date_purchase", min(RANGES, parts))
    write_table_in_ranges(fact, base, "fact_order_item", tops)
    remove(spark, fact_path)
    by_name, names_path = facts.stage_summary_by_name(
        read_table(spark, base, "fact_order_item"), w.dim_product, in_ranges("sk_date_purchase", tops))
    summary, categories = facts.number_categories(by_name)
    write_table_in_ranges(summary, base, "fact_daily_seller_category", tops)
    write_table(categories, base, "dim_product_category")
    remove(spark, names_path)
    release(spark)
    stored = Warehouse(source, params)
    for t in [*DIMENSIONS, "fact_order_item", "fact_daily_seller_category", "dim_product_category"]:
        stored.use(t, read_table(spark, base, t))
    return stored

