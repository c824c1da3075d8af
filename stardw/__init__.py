"""stardw — a Spark-native star-schema warehouse for marketplace data.

Raw customer / order / order-line / product / seller / review / category
translation tables are turned into a date, customer, seller and product
dimension, an order-line fact and a daily seller-by-category summary, and
seller / category / region / delivery / profitability reports are answered
over them.  Everything is a lazy DataFrame plan; Catalyst and AQE choose the
physical strategy.

Layout
------
functions/  fixed lookup values and Column-level expressions (no UDFs)
sources/    raw-table readers (CSV, parquet-derived fixtures) and warehouse IO
            (write, read back, insert-ignore append, JDBC, catalog tables)
operators/  reusable relational building blocks (dense keys, keep-first,
            deterministic first, lineage cuts)
plans/      dimension / fact / report / slicer / audit plans and the whole load
streaming/  incremental (micro-batch) insert-ignore append into the fact
``python -m stardw`` runs the whole load from CSV files.
"""

from stardw.params import DEFAULT_PARAMS, FIXTURE_PARAMS, Params

__all__ = ["Params", "DEFAULT_PARAMS", "FIXTURE_PARAMS"]
