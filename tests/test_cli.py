"""The command line runs the whole load from CSV files and reports row counts."""

import contextlib
import io

from stardw.__main__ import main
from stardw.session import scratch_dir
from stardw.sources import fixtures as FX
from stardw.sources.csv import write_csv_table

from paths import SF_SMALL


def test_cli_load_from_csv(spark):
    raw_dir = scratch_dir(spark, "cli-raw")
    raw = FX.fixture_tables(spark, SF_SMALL)
    for name, df in raw.as_dict().items():
        write_csv_table(df, f"{raw_dir}/{name}.csv")
    from stardw.session import scale_conf
    saved = {k: spark.conf.get(k, None) for k in scale_conf(1)}
    buf = io.StringIO()
    try:
        with contextlib.redirect_stdout(buf):
            main(["--raw-dir", raw_dir, "--warehouse", scratch_dir(spark, "cli-dw"), "--input-gb", "0.01"])
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    counts = {line.split()[0]: int(line.split()[1].replace(",", "")) for line in buf.getvalue().splitlines()
              if line.strip()}
    assert 0 < counts["fact_order_item"] < raw.items.select("order_id", "order_item_id").distinct().count()  # unknown keys go
    sellers = raw.sellers.where("seller_id IS NOT NULL").select("seller_id").distinct().count()  # one row per id
    assert counts["dim_seller"] == sellers and counts["dim_date"] > 0
    assert set(counts) == {"dim_date", "dim_customer", "dim_seller", "dim_product", "fact_order_item",
                           "fact_daily_seller_category", "dim_product_category"}
