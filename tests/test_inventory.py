"""Daily stock and run rates on tiny frames."""

from pyspark.sql import functions as F

from rollwise.operators.inventory import (daily_stock, inventory_lines, inventory_report,
                                          latest_before, with_run_rates)
from rollwise.specs import BLINKIT, INSTAMART, ZEPTO

from .frames import D, catalogue, cities, feed


def blinkit_inv(spark, rows):
    return feed(spark, "blinkit", "inventory", rows)


def by_date(df):
    return {str(r["reportdate"]): r for r in df.collect()}


def test_run_rate_first_gap_rise_and_same_day_rows(spark):
    f = blinkit_inv(spark, [
        ("A1", "WH", D(2026, 2, 1), "t1", "Soap", 5.0, 100.0),
        ("A1", "WH", D(2026, 2, 1), "t1", "Soap", None, 20.0),     # same day: summed
        ("A1", "WH", D(2026, 2, 5), "t1", "Soap", 5.0, 90.0),      # gap of days, not divided
        ("A1", "WH", D(2026, 2, 6), "t1", "Soap", 5.0, 150.0),     # restock: 0
        ("A1", "WH", D(2026, 2, 3), "t1", "Soap", 5.0, 110.0),     # arrives out of order
    ])
    out = by_date(inventory_report(f, cities(spark), catalogue(spark), BLINKIT))
    assert out["2026-02-01"]["backendinvqty"] == 120.0 and out["2026-02-01"]["total_quantity"] == 125.0
    assert out["2026-02-01"]["run_rate_backend"] == 0.0
    assert out["2026-02-03"]["run_rate_backend"] == 10.0 and out["2026-02-03"]["run_rate_total"] == 10.0
    assert out["2026-02-05"]["run_rate_backend"] == 20.0
    assert out["2026-02-06"]["run_rate_backend"] == 0.0
    # Blinkit maps the facility name (not a city) through the city map: 'WH' is unmapped.
    assert out["2026-02-01"]["brands_choice"] == "Unknown" and out["2026-02-01"]["productid"] == "P1"


def test_two_tenants_same_item_and_facility_are_separate_series(spark):
    f = blinkit_inv(spark, [
        ("A1", "Pune", D(2026, 2, 1), "t1", "Soap", 0.0, 100.0),
        ("A1", "Pune", D(2026, 2, 2), "t1", "Soap", 0.0, 60.0),
        ("A1", "Pune", D(2026, 2, 1), "t2", "Soap", 0.0, 10.0),
        ("A1", "Pune", D(2026, 2, 2), "t2", "Soap", 0.0, 5.0),
    ])
    out = {(r["organizationid"], str(r["reportdate"])): r["run_rate_backend"]
           for r in inventory_report(f, cities(spark), catalogue(spark), BLINKIT).collect()}
    assert out == {("t1", "2026-02-01"): 0.0, ("t1", "2026-02-02"): 40.0,
                   ("t2", "2026-02-01"): 0.0, ("t2", "2026-02-02"): 5.0}


def test_unmatched_defaults_differ_by_marketplace(spark):
    b = blinkit_inv(spark, [("ZZ", None, D(2026, 2, 1), "t1", None, None, None)])
    r = inventory_report(b, cities(spark), catalogue(spark), BLINKIT).first()
    assert (r["productid"], r["backendfacilityname"], r["itemname"], r["category"]) == ("", "Unknown", "Unknown", "Unknown")
    assert r["total_quantity"] == 0.0 and r["active"] is False
    i = feed(spark, "instamart", "inventory", [("ZZ", None, D(2026, 2, 1), "t1", "WH", 7.0)])
    r = inventory_report(i, cities(spark), catalogue(spark), INSTAMART).first()
    assert r["productid"] == "Unknown" and r["frontendinvqty"] == 0.0 and r["total_quantity"] == 7.0
    z = feed(spark, "zepto", "inventory", [("a1", "S1", D(2026, 2, 1), "t1", "Soap", "FC", "FB", 3.0, "Pune")])
    r = inventory_report(z, cities(spark), catalogue(spark), ZEPTO).first()
    assert r["itemid"] == "a1" and r["category"] == "Cat" and r["brands_choice"] == "WEST"


def test_range_rebuild_with_last_snapshots_equals_full(spark):
    rows = [("A1", "WH", D(2026, m, d), "t1", "Soap", 0.0, float(1000 - 30 * m - d))
            for m in (1, 2) for d in (5, 20)]
    f = blinkit_inv(spark, rows)
    full = by_date(inventory_report(f, cities(spark), catalogue(spark), BLINKIT))
    daily = daily_stock(inventory_lines(f, cities(spark), catalogue(spark), BLINKIT))
    feb = f.filter(F.col("reportDate") >= F.lit(D(2026, 2, 1)))
    last = latest_before(daily, D(2026, 2, 1))
    part = by_date(inventory_report(feb, cities(spark), catalogue(spark), BLINKIT, last_snapshots=last))
    assert set(part) == {"2026-02-05", "2026-02-20"}
    for d in part:
        assert part[d].asDict() == full[d].asDict()
    alone = by_date(inventory_report(feb, cities(spark), catalogue(spark), BLINKIT))
    assert alone["2026-02-05"]["run_rate_backend"] == 0.0 != full["2026-02-05"]["run_rate_backend"]


def test_both_run_rates_share_one_window(spark):
    f = blinkit_inv(spark, [("A1", "WH", D(2026, 2, 1), "t1", "Soap", 1.0, 1.0)])
    plan = with_run_rates(daily_stock(inventory_lines(f, cities(spark), catalogue(spark), BLINKIT)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Window [") == 1
