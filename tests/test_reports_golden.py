"""Reports on the hand-written golden warehouse, against hand-computed values
(independent of the SQL oracle).  Default cut-points: every seller is Bronze.

Fact lines (price, freight, revenue, gross profit, review, on-time):
  o1/1 p1 s1 100 10 110   76 5 0     o1/2 p2 s1  55  5  60 -86 5 0
  o2/1 p3 s2  20  2  22    8 - -     o3/1 p2 s2 600 20 620 459 4 1
  o4/1 p1 s3  10  1  11  -14 - 1
"""

import dataclasses
import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from stardw import DEFAULT_PARAMS
from stardw.plans import facts
from stardw.plans import reports as R
from stardw.plans.warehouse import Warehouse
from stardw.sources.csv import read_raw_csv

from test_warehouse_golden import FILES


@pytest.fixture(scope="module")
def wh(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("raw_reports")
    for name, text in FILES.items():
        (d / name).write_text(text)
    return Warehouse(read_raw_csv(spark, str(d)), DEFAULT_PARAMS)


def test_tier_value(wh):
    (r,) = R.report_tier_value(wh).collect()
    assert (r["seller_tier"], r["sellers"], r["items"]) == ("Bronze", 3, 5)
    assert (r["revenue"], r["gross_profit"]) == (D("823.00"), D("443.00"))
    assert (r["revenue_per_seller"], r["gross_profit_per_seller"]) == (D("274.33"), D("147.67"))


def test_category_tier_matrix(wh):
    rows = {(r["product_category"], r["seller_tier"], r["level"]): r for r in R.report_category_tier_matrix(wh).collect()}
    audio = rows[("audio", "Bronze", 0)]
    assert (audio["revenue"], audio["gross_profit"], audio["items"]) == (D("121.00"), D("62.00"), 2)
    assert audio["margin_pct"] == D("51.239669") and audio["mean_review"] == D("5.000000")
    assert audio["on_time_rate"] == D("0.500000")
    unknown = rows[("Unknown", "Bronze", 0)]
    assert unknown["mean_review"] is None and unknown["on_time_rate"] is None
    assert unknown["margin_pct"] == D("36.363636")
    total = rows[(None, None, 3)]
    assert (total["revenue"], total["items"]) == (D("823.00"), 5)
    assert total["margin_pct"] == D("53.827461") and total["mean_review"] == D("4.666667")
    assert rows[("cama_mesa", None, 1)]["revenue"] == D("680.00")


def test_monthly_and_incomplete_month(wh):
    got = {(r["year"], r["month"]): (r["revenue"], r["is_incomplete_month"])
           for r in R.report_monthly_tier_revenue(wh).collect()}
    assert got == {(2017, 1): (D("192.00"), False), (2017, 2): (D("620.00"), False),
                   (2017, 3): (D("11.00"), True)}


def test_region_on_time(wh):
    got = {r["seller_region"]: r for r in R.report_region_on_time(wh).collect()}
    se = got["Southeast"]
    assert (se["items"], se["delivered_items"], se["on_time_items"]) == (4, 3, 1)
    assert se["on_time_rate"] == D("0.333333") and se["on_time_rate_delivered"] == D("0.333333")
    assert se["delivered_share"] == D("0.750000") and se["flagged_share"] == D("0.750000")
    assert got["Other"]["on_time_rate"] == D("1.000000")


def test_seller_decisions(wh):
    assert [r["seller_id"] for r in R.report_growth_sellers(wh).collect()] == ["s1"]
    assert R.report_risk_sellers(wh).count() == 0
    assert R.report_tier_moves(wh).count() == 0      # no Silver or Gold sellers


def test_cost_basis(wh):
    got = {r["product_category"]: r for r in R.audit_cost_basis(wh).collect()}
    assert (got["audio"]["negative_profit_lines"], got["audio"]["negative_profit_total"],
            got["audio"]["below_list_lines"]) == (1, D("-14.00"), 1)
    assert (got["cama_mesa"]["negative_profit_lines"], got["cama_mesa"]["below_list_lines"]) == (1, 1)
    assert (got["Unknown"]["negative_profit_lines"], got["Unknown"]["below_list_lines"]) == (0, 0)


def test_freight_matrix(wh):
    got = {r["customer_region"]: r.asDict() for r in R.report_freight_matrix(wh).collect()}
    assert got["Southeast"]["Southeast"] == D("5.67") and got["Southeast"]["Other"] == D("1.00")
    assert got["Other"]["Southeast"] == D("20.00") and got["Other"]["North"] is None


def test_daily_summary_report(wh):
    p = DEFAULT_PARAMS.with_(focus_group="Electronics", focus_year=2017, focus_quarter=1)
    w = Warehouse(wh.raw, p)
    got = {r["date"]: r for r in R.report_daily_group_quarter(w).collect()}
    # audio (Electronics) lines: 2017-01-01 (o1/1, late) and 2017-03-01 (o4/1, on time)
    assert set(got) == {dt.date(2017, 1, 1), dt.date(2017, 3, 1)}
    assert got[dt.date(2017, 1, 1)]["revenue"] == D("110.00") and got[dt.date(2017, 1, 1)]["on_time_rate"] == D("0.000000")
    assert got[dt.date(2017, 3, 1)]["on_time_rate"] == D("1.000000")


def test_daily_summary_report_builds_the_days_of_its_quarter(wh, monkeypatch):
    """The report's summary holds its quarter alone; which copy of an order
    stays is settled first, also where the copies lie in different quarters."""
    moved = wh.raw.orders.withColumn("order_purchase_timestamp", F.expr("order_purchase_timestamp - INTERVAL 40 DAYS"))
    raw = dataclasses.replace(wh.raw, orders=wh.raw.orders.unionByName(moved))
    held, real = {}, facts.staged

    def staged(df, name):
        out = real(df, name)
        held[name] = out[0]
        return out
    monkeypatch.setattr(facts, "staged", staged)
    found = 0
    for year, quarter in ((2016, 4), (2017, 1)):
        p = DEFAULT_PARAMS.with_(focus_group="Electronics", focus_year=year, focus_quarter=quarter)
        whole = Warehouse(raw, p)
        assert whole.fact_daily_seller_category.count() > 0
        want = R.report_daily_group_quarter(whole).collect()
        held.clear()
        got = R.report_daily_group_quarter(Warehouse(raw, p)).collect()
        assert sorted(got) == sorted(want)
        keys = [r["sk_date_purchase"] for r in held["summary-by-name"].collect()]
        assert all(k // 10000 == year and (k // 100 % 100 + 2) // 3 == quarter for k in keys)
        found += len(got)
    assert found > 0
