"""Warehouse invariants on the driver tables: keys, foreign keys, NOT NULL /
length constraints, summary = detail, and independence from the number of
shuffle partitions."""

from decimal import Decimal

from stardw.catalog import warehouse
from stardw.plans import audit

from paths import SF_SMALL


def test_audits_are_clean(spark):
    w = warehouse(spark, SF_SMALL)
    assert all(r["orphans"] == 0 for r in audit.fk_audit(w).collect())
    keys = audit.key_audit(w).collect()
    assert all(r["duplicates"] == 0 and r["null_keys"] == 0 for r in keys)
    assert all(r["violations"] == 0 for r in audit.constraint_audit(w).collect())
    s = {r["source"]: r for r in audit.summary_consistency(w).collect()}
    f, d = s["fact_order_item"], s["fact_daily_seller_category"]
    for m in ("items", "revenue", "freight", "gross_profit", "review_score_sum"):
        assert f[m] == d[m], m
    assert d["violations"] == 0


def test_dense_keys_are_dense(spark):
    w = warehouse(spark, SF_SMALL)
    for t, k in [("dim_customer", "sk_customer"), ("dim_seller", "sk_seller"), ("dim_product", "sk_product")]:
        ks = sorted(r[0] for r in getattr(w, t).select(k).collect())
        assert ks == list(range(1, len(ks) + 1)), t


def test_same_result_for_1_and_8_shuffle_partitions(spark):
    def snapshot():
        w = warehouse(spark, SF_SMALL)
        return sorted(tuple(r) for r in w.fact_daily_seller_category.collect())
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = snapshot()
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        eight = snapshot()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert one == eight and len(one) > 0
    assert sum(r[5] for r in one) > Decimal(0)


def test_date_spine_is_gap_free_and_covers_every_fact_date(spark):
    from pyspark.sql import functions as F
    w = warehouse(spark, SF_SMALL)
    r = w.dim_date.agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("lo"), F.max("date").alias("hi"),
                       F.count_distinct("date").alias("d")).first()
    assert r["n"] == r["d"] == (r["hi"] - r["lo"]).days + 1
    keys = {row[0] for row in w.dim_date.select("sk_date").collect()}
    for col in ("sk_date_purchase", "sk_date_delivered", "sk_date_estimated_delivery"):
        used = {row[0] for row in w.fact_order_item.select(col).distinct().collect() if row[0] is not None}
        assert used <= keys, col


def test_slicers_cascade_and_push_down(spark):
    import contextlib
    import datetime as dt
    import io

    from pyspark.sql import functions as F

    from stardw.params import FIXTURE_PARAMS
    from stardw.plans.load import load_warehouse
    from stardw.plans.slicers import slice_warehouse
    from stardw.session import scratch_dir
    from stardw.sources import fixtures as FX

    stored = load_warehouse(FX.fixture_tables(spark, SF_SMALL), FIXTURE_PARAMS, scratch_dir(spark, "slicers"))
    v = slice_warehouse(stored, dt.date(1996, 1, 1), dt.date(1997, 6, 30), ["Electronics", "Fashion"])
    fact_rev = v.fact_order_item.agg(F.sum("revenue")).first()[0]
    summ_rev = v.fact_daily_seller_category.agg(F.sum("revenue_total")).first()[0]
    assert fact_rev == summ_rev and fact_rev > 0
    full = stored.fact_order_item.agg(F.sum("revenue")).first()[0]
    assert fact_rev < full
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        v.fact_order_item.explain("formatted")
    plan = buf.getvalue()
    assert "GreaterThanOrEqual(sk_date_purchase,19960101)" in plan
    assert "LessThanOrEqual(sk_date_purchase,19970630)" in plan
