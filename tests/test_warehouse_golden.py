"""Hand-written raw rows through the CSV source and the whole warehouse:
the edge cases of the source pipeline's rules (default cut-points)."""

import datetime as dt
from decimal import Decimal

import pytest

from stardw import DEFAULT_PARAMS
from stardw.plans.warehouse import Warehouse
from stardw.sources.csv import read_raw_csv

FILES = {
    "customers.csv": """customer_id,customer_unique_id,customer_city,customer_state
c1,u1,sao paulo,SP
c2,u1,NA,SP
c3,u2,,XX
c4,u3,rio,RJ
c5,u4,None,None
""",
    "orders.csv": """order_id,customer_id,order_purchase_timestamp,order_approved_at,order_delivered_customer_date,order_estimated_delivery_date
o1,c1,2017-01-01 23:00:00,2017-01-02 00:00:00,2017-01-02 01:00:00,2017-01-02 00:00:00
o2,c2,2017-01-03 10:00:00,,,2017-01-10 00:00:00
o3,c3,2017-02-01 12:00:00,,2017-02-01 10:00:00,2017-02-05 00:00:00
o4,c4,2017-03-01 08:00:00,,2017-03-04 08:00:00,2017-03-10 00:00:00
o5,c4,2017-03-02 08:00:00,,,n/a
o6,c4,2017-03-03 08:00:00,,,
o7,c4,2017-03-04 08:00:00,,,
o8,c4,2017-03-05 08:00:00,,,
o9,c3,not a date,,,
""",
    "items.csv": """order_id,order_item_id,product_id,seller_id,price,freight_value,shipping_limit_date
o1,1,p1,s1,100.00,10.00,x
o1,1,p2,s1,50.00,5.00,x
o1,2,p2,s1,55.00,5.00,x
o2,1,p3,s2,20.00,2.00,x
o3,1,p2,s2,600.00,20.00,x
o4,1,p1,s3,10.00,1.00,x
o9,1,p1,s3,10.00,1.00,x
""",
    "products.csv": """product_id,product_category_name,product_weight_g
p1,cat_pt1,100
p2,cama_mesa,200
p3,,300
p4,cat_pt1,400
""",
    "sellers.csv": """seller_id,seller_city,seller_state
s1,campinas,SP
s2,niteroi,RJ
s3,nowhere,XX
s4,lonely,NULL
""",
    "reviews.csv": """review_id,order_id,review_score,review_comment_message
r1,o1,3,"fine
but slow"
r2,o1,5,"great"
r3,o3,4,NaN
r4,o4,,
""",
    "translation.csv": """product_category_name,product_category_name_english
cat_pt1,electronics
cat_pt1,audio
""",
}


@pytest.fixture(scope="module")
def wh(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("raw")
    for name, text in FILES.items():
        (d / name).write_text(text)
    raw = read_raw_csv(spark, str(d))
    return Warehouse(raw, DEFAULT_PARAMS)


def rows_by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_dim_date_spans_all_order_dates(wh):
    dd = wh.dim_date.orderBy("date").collect()
    assert dd[0]["date"] == dt.date(2017, 1, 1) and dd[-1]["date"] == dt.date(2017, 3, 10)
    assert len(dd) == 69 and dd[0]["sk_date"] == 20170101
    assert dd[0]["day_of_week"] == "Sunday" and dd[0]["is_weekend"] and dd[0]["month_name"] == "January"
    assert dd[0]["quarter"] == 1


def test_dim_customer(wh):
    c = rows_by(wh.dim_customer, "customer_unique_id")
    assert [c[u]["sk_customer"] for u in ["u1", "u2", "u3", "u4"]] == [1, 2, 3, 4]
    assert c["u1"]["customer_city"] == "sao paulo"          # first non-null by customer id ("NA" -> NULL)
    assert c["u1"]["customer_segment"] == "Regular"         # 2 orders
    assert c["u2"]["customer_city"] is None                  # empty cell -> NULL
    assert c["u2"]["customer_region"] == "Other"             # unknown state
    assert c["u2"]["customer_segment"] == "Occasional"       # unparsable purchase is not counted
    assert c["u3"]["customer_segment"] == "Loyal"            # 5 orders
    assert c["u4"]["customer_segment"] == "Regular"          # 0 orders
    assert c["u4"]["customer_signup_date"] is None and c["u4"]["customer_state"] is None
    lead = (dt.date(2017, 1, 1) - c["u1"]["customer_signup_date"]).days
    assert 60 <= lead <= 730


def test_dim_seller(wh):
    s = rows_by(wh.dim_seller, "seller_id")
    # dimension stats see every raw line (only the fact ignores repeated keys):
    # s1 sold p1 (audio) once and p2 (cama_mesa) twice
    assert s["s1"]["seller_main_category"] == "cama_mesa"
    assert s["s2"]["seller_main_category"] == "cama_mesa"    # NULL category ignored by the mode
    assert s["s4"]["seller_main_category"] is None           # no items -> NULL, not "Unknown"
    assert s["s4"]["seller_size_category"] == "Small" and s["s4"]["seller_tier"] == "Bronze"
    assert s["s4"]["seller_region"] == "Other"
    assert s["s2"]["seller_tier"] == "Bronze" and s["s2"]["seller_region"] == "Southeast"


def test_dim_product(wh):
    p = rows_by(wh.dim_product, "product_id")
    assert p["p2"]["list_price"] == Decimal("235.00")        # (50 + 55 + 600) / 3, every raw line
    assert p["p2"]["unit_cost"] == Decimal("141.00")
    assert p["p1"]["list_price"] == Decimal("40.00") and p["p1"]["price_band"] == "Budget"
    assert p["p2"]["price_band"] == "Premium" and p["p2"]["product_category_group"] == "Other"  # untranslated
    assert p["p1"]["product_category"] == "audio" and p["p1"]["product_category_group"] == "Electronics"
    assert p["p4"]["list_price"] is None and p["p4"]["price_band"] == "Unknown"
    assert p["p4"]["is_premium"] is False and p["p4"]["unit_cost"] is None
    assert p["p3"]["product_category"] is None and p["p3"]["product_category_group"] == "Other"


def test_fact(wh):
    f = {(r["order_id"], r["order_item_id"]): r.asDict() for r in wh.fact_order_item.collect()}
    assert set(f) == {("o1", 1), ("o1", 2), ("o2", 1), ("o3", 1), ("o4", 1)}   # o9: no purchase date
    l1 = f[("o1", 1)]
    assert l1["price"] == Decimal("100.00")                  # first repeated line kept
    assert l1["revenue"] == Decimal("110.00") and l1["review_score"] == 5   # best of two reviews
    assert l1["delivery_days"] == 0 and l1["is_on_time"] == 0  # 2 h, after a midnight estimate
    assert l1["sk_date_purchase"] == 20170101 and l1["sk_date_delivered"] == 20170102
    o3 = f[("o3", 1)]
    assert o3["delivery_days"] == -1 and o3["is_on_time"] == 1
    assert o3["gross_profit"] == Decimal("459.00")
    o2 = f[("o2", 1)]
    assert o2["is_on_time"] is None and o2["delivery_days"] is None and o2["sk_date_delivered"] is None
    assert o2["unit_cost"] == Decimal("12.00") and o2["gross_profit"] == Decimal("8.00")
    assert f[("o4", 1)]["review_score"] is None              # empty score cell


def test_summary(wh):
    s = wh.fact_daily_seller_category.collect()
    cats = {r["product_category"]: r["sk_product_category"] for r in wh.dim_product_category.collect()}
    assert cats == {"Unknown": 1, "audio": 2, "cama_mesa": 3}  # code-point order
    jan1 = [r for r in s if r["sk_date"] == 20170101]
    assert len(jan1) == 2 and sum(r["orders_count"] for r in jan1) == 2
    o2 = [r for r in s if r["sk_date"] == 20170103][0]
    assert o2["review_score_sum"] == 0 and o2["reviews_count"] == 0   # no review -> 0, not NULL
    assert o2["delivered_items"] == 0 and o2["on_time_deliveries"] == 0


LOST = {  # a valid and an invalid copy of one key: the valid one stays, whichever sorts first
    "line with NULL product": ("items.csv", "o2,1,NA,s2,1.00,1.00,x\n"),
    "line with unknown product": ("items.csv", "o2,1,a0,s2,1.00,1.00,x\n"),
    "line with unknown seller": ("items.csv", "o2,1,p3,a0,1.00,1.00,x\n"),
    "order with NULL purchase time": ("orders.csv", "o2,c2,,,,\n"),
    "order with NULL customer": ("orders.csv", "o2,,2017-01-03 10:00:00,,,\n"),
    "order with unknown customer": ("orders.csv", "o2,a0,2017-01-03 10:00:00,,,\n"),
}


@pytest.mark.parametrize("case", sorted(LOST))
def test_invalid_copy_never_displaces_a_valid_one(spark, tmp_path, case):
    name, line = LOST[case]
    for f, text in FILES.items():
        (tmp_path / f).write_text(text + (line if f == name else ""))
    (row,) = Warehouse(read_raw_csv(spark, str(tmp_path)), DEFAULT_PARAMS).fact_order_item.where("order_id = 'o2'").collect()
    assert (row["price"], row["freight_value"]) == (Decimal("20.00"), Decimal("2.00"))
    assert row["sk_date_purchase"] == 20170103


def test_repeated_ids_null_ids_and_wide_values(spark):
    """One row per natural id, the smallest known attributes first; values
    wider than their column are audited, not fatal."""
    from stardw.plans.audit import constraint_audit, key_audit
    from stardw.plans.warehouse import Warehouse
    from stardw.sources.raw import RAW_SCHEMAS, RawTables
    ts = dt.datetime(2017, 5, 1, 10)
    rows = {
        "customers": [("c1", "u1", "x", "SP")],
        "orders": [("o1", "c1", ts, ts, ts, ts)],
        "items": [("o1", 40000, "p1", "s1", Decimal("10.00"), Decimal("1.00")), ("o1", 2, "p1", "s1", Decimal("99999999.99"), Decimal("5.00"))],
        "products": [("p1", "toys"), ("p1", "auto"), ("p1", None), (None, "toys"), ("p2", None), ("p2", None)],
        "sellers": [("s1", None, "AC"), ("s1", "b", "SP"), ("s1", "a", None), ("s1", "a", "RJ"), (None, "a", "SP"), ("s2", None, None)],
        "reviews": [("o1", 70000)], "translation": [],
    }
    w = Warehouse(RawTables(**{k: spark.createDataFrame(v, RAW_SCHEMAS[k]) for k, v in rows.items()}), DEFAULT_PARAMS)
    assert sorted((r.seller_id, r.seller_city, r.seller_state) for r in w.dim_seller.collect()) == [("s1", "a", "RJ"), ("s2", None, None)]
    assert sorted((r.product_id, r.product_category) for r in w.dim_product.collect()) == [("p1", "auto"), ("p2", None)]
    fact = sorted((r.order_item_id or 0, r.revenue, r.review_score) for r in w.fact_order_item.collect())
    assert fact == [(0, Decimal("11.00"), None), (2, None, None)]
    found = {(r.table_name, r.column_name): r.violations for r in constraint_audit(w).collect() if r.violations}
    assert found[("fact_order_item", "order_item_id")] == 1 and found[("fact_order_item", "revenue")] == 1
    assert {r.table_name for r in key_audit(w).collect() if r.duplicates} == set()


def test_load_in_parts_is_the_whole_load(spark, wh, tmp_path, monkeypatch):
    """The fact by parts of the orders, layout and summary by ranges of days:
    the rows of the tables built at once, in files of one range each, and no
    staged table of the load is left."""
    import os

    from stardw.plans import load
    from stardw.session import ensure_checkpoint_dir
    scratch = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(scratch))
    monkeypatch.setattr(load, "PART_BYTES", 1)
    built, real = [], load.facts.fact_rows
    monkeypatch.setattr(load.facts, "fact_rows", lambda items, keyed, *a: built.append(keyed.count()) or real(items, keyed, *a))
    stored = load.load_warehouse(wh.raw, DEFAULT_PARAMS, str(tmp_path))
    assert len(built) == load.PARTS and sum(built) == 8 and max(built) < 8
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(scratch)) - before}
    assert not left & {"load-lines", "keyed-orders", "fact-parts", "summary-by-name"}
    for name, whole in wh.tables().items():
        got = stored.tables()[name].select(*whole.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect())), name
    days = stored.fact_order_item.selectExpr("input_file_name() f", "sk_date_purchase d").groupBy("f").agg({"d": "min"}).collect()
    assert len(days) > 1


def test_ranges_take_every_row_once(spark):
    from stardw.operators.keys import in_ranges, range_tops
    days = [None, None, *[1] * 50, 2, 3, *[4] * 9, *range(10, 40)]
    df = spark.createDataFrame([(d,) for d in days], "day int")
    for parts in (1, 2, 3, 8, 500):
        tops = range_tops(df, "day", parts)
        assert tops == sorted(set(tops)) and len(tops) < max(parts, 2) and (tops or parts == 1)
        got = [x.day for of in in_ranges("day", tops) for x in df.where(of).collect()]
        assert sorted(map(str, got)) == sorted(map(str, days))
    assert range_tops(df.limit(0), "day", 8) == []
