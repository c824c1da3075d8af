"""What a plan reads, moves and builds once, whatever the size of the tables."""

import contextlib
import io


from stardw.operators.keys import dense_key
from stardw.params import FIXTURE_PARAMS
from stardw.plans import audit, dims, facts, reports
from stardw.plans.slicers import item_sliced
from stardw.plans.warehouse import Warehouse
from stardw.sources import fixtures as FX

from paths import SF_SMALL


def explained(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("extended")
    return buf.getvalue().split("== Physical Plan ==")[0].split("== Optimized Logical Plan ==")[1]


def test_numbered_rows_stand_over_a_table_of_known_bytes(spark):
    df = spark.createDataFrame([(x, f"n{x}") for x in (5, 3, 9, 1)], "k long, name string")
    keyed = dense_key(df, ["k"], "sk")
    assert sorted((r.k, r.sk) for r in keyed.collect()) == [(1, 1), (3, 2), (5, 3), (9, 4)]
    assert "Join" not in explained(keyed) and "Relation" in explained(keyed)
    assert dense_key(df.where("k < 0"), ["k"], "sk").collect() == []


def test_seller_lines_are_moved_once(spark):
    raw = FX.fixture_tables(spark, SF_SMALL)
    assert "Aggregate [seller_id" not in explained(dims.seller_stats(raw.items, raw.products, raw.translation)).split("Join")[-1]


def test_audits_build_the_fact_once(spark):
    w = Warehouse(FX.fixture_tables(spark, SF_SMALL), FIXTURE_PARAMS)
    counts = {r.table_name: r.rows for r in audit.row_count_audit(w).collect()}
    files = w.fact_order_item.inputFiles()
    assert files and all("fact-lines" in f for f in files)
    assert counts["fact_order_item"] == Warehouse(w.raw, FIXTURE_PARAMS).fact_order_item.count()


def test_built_lines_carry_their_product(spark):
    w = Warehouse(FX.fixture_tables(spark, SF_SMALL), FIXTURE_PARAMS)
    joined = w.fact_order_item.join(w.dim_product.select("sk_product", "product_category", "list_price"), "sk_product")
    lines = w.fact_lines("product_category", "list_price")
    assert explained(lines).count("Join") == explained(w.fact_order_item).count("Join")
    assert lines.count() == joined.count() and lines.exceptAll(joined.select(lines.columns)).isEmpty()
    one, two = (sorted(map(str, facts.daily_summary_by_name(f, w.dim_product).collect())) for f in (w.fact_order_item, lines.drop("list_price")))
    assert one == two
    held = Warehouse(w.raw, FIXTURE_PARAMS).hold_fact()  # sliced by a semi-join
    one, two = (sorted(map(str, reports.seller_scatter(item_sliced(x)).collect())) for x in (w, held))
    assert one == two and one


def test_stream_batches_do_not_grow_in_number(spark, monkeypatch):
    from stardw import catalog
    from stardw.streaming import append
    calls, real = [], append.append_ignore
    monkeypatch.setattr(append, "append_ignore", lambda *a: (calls.append(1), real(*a))[1])
    saved = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in saved}
    try:
        for k, v in saved.items():
            spark.conf.set(k, v)
        rows = catalog.queries()["fact_stream_append"](spark, SF_SMALL)
        assert rows.count() == rows.select("order_id", "order_item_id").distinct().count() > 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(calls) <= 2 * catalog.STREAM_FILES / 4
