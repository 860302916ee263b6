"""R1-R3, R10, R11 on tiny frames: every default branch and join edge."""

import pytest

from rollwise.operators.enrich import DuplicateDimensionKeys, check_dimensions
from rollwise.operators.sales import merge_states, sales_report, sales_states, sales_strict
from rollwise.specs import BLINKIT, ZEPTO

from .frames import D, catalogue, cities, feed, sku


def blinkit(spark, rows):
    return feed(spark, "blinkit", "sales", rows)


def test_join_defaults_and_measures(spark):
    f = blinkit(spark, [
        ("A1", D(2026, 2, 2), "t1", "Soap", 2.0, 118.0, "Pune"),      # matched
        ("A1", D(2026, 2, 2), "t1", None, None, 118.0, "Pune"),       # same key: summed
        ("ZZ", D(2026, 2, 2), "t1", "Odd", 1.0, 50.0, "Nowhere"),     # unmatched city and SKU
    ])
    out = {r["itemid"]: r for r in sales_report(f, cities(spark), catalogue(spark), BLINKIT).collect()}
    a = out["A1"]
    assert (a["brands_choice"], a["category"], a["productid"], a["itemname"]) == ("WEST", "Cat", "P1", "Soap")
    assert a["qty"] == 2.0 and a["gmv"] == 236.0
    assert a["net"] == pytest.approx(236.0 * 0.9 / 1.18, abs=1e-6)
    assert a["taxes_paid"] == pytest.approx(236.0 * 0.9 / 1.18 * 0.18, abs=1e-6)
    assert a["cogs"] == 10.5 and a["tax_rate"] == 18.0 and a["active"] is True
    z = out["ZZ"]
    assert (z["brands_choice"], z["category"], z["brand"], z["productid"]) == ("Unknown",) * 4
    assert z["net"] == 50.0 and z["taxes_paid"] == 0.0 and z["margin"] == 0.0 and z["active"] is False


def test_two_tenants_share_an_item_id(spark):
    f = blinkit(spark, [
        ("A1", D(2026, 2, 2), "t1", "Soap", 1.0, 100.0, "Pune"),
        ("A1", D(2026, 2, 2), "t2", "Soap", 1.0, 100.0, "Pune"),
    ])
    out = {r["organizationid"]: r for r in sales_report(f, cities(spark), catalogue(spark), BLINKIT).collect()}
    assert out["t1"]["brands_choice"] == "WEST" and out["t2"]["brands_choice"] == "WEST-2"
    assert out["t1"]["productid"] == "P1" and out["t2"]["productid"] == "P2"
    assert out["t2"]["net"] == pytest.approx(100 * 0.8 / 1.18, abs=1e-6)


def test_timestamps_within_a_day_group_to_the_date(spark):
    f = spark.createDataFrame(
        [("A1", "2026-02-02 08:00:00", "t1", "Soap", 1.0, 10.0, "Pune"),
         ("A1", "2026-02-02 21:30:00", "t1", "Soap", 1.0, 10.0, "Pune")],
        "itemId string, reportDate string, organizationId string, itemName string, qtySold double, "
        "mrp double, cityName string").selectExpr("itemId", "cast(reportDate as timestamp) as reportDate",
                                                   "organizationId", "itemName", "qtySold", "mrp", "cityName")
    out = sales_report(f, cities(spark), catalogue(spark), BLINKIT).collect()
    assert len(out) == 1 and out[0]["qty"] == 2.0 and str(out[0]["reportdate"]) == "2026-02-02"


def test_zepto_mixed_case_sku_and_feed_fallbacks(spark):
    f = feed(spark, "zepto", "sales", [
        ("a1", D(2026, 2, 2), "t1", "Soap", "FC", "FS", "FB", 1.0, 10.0, 10.0, "Pune"),
        ("Q9", D(2026, 2, 2), "t1", "Odd", "FC", None, "FB", 1.0, 5.0, 5.0, "Pune"),
    ])
    out = {r["itemid"]: r for r in sales_report(f, cities(spark), catalogue(spark), ZEPTO).collect()}
    assert out["a1"]["category"] == "Cat" and out["a1"]["productid"] == "A1"   # lower = lower
    q = out["q9"]
    assert (q["category"], q["subcategory"], q["brand"]) == ("FC", "Unknown", "FB")
    assert q["mrp"] == 5.0


def test_bad_tax_text_defaults_to_zero_but_stays_null_in_strict(spark):
    cat = catalogue(spark, [sku("t1", "A1", taxes="n/a", margin=None)])
    f = blinkit(spark, [("A1", D(2026, 2, 2), "t1", "Soap", 0.0, 100.0, "Pune")])
    r = sales_report(f, cities(spark), cat, BLINKIT).first()
    assert r["tax_rate"] == 0.0 and r["net"] == 100.0
    s = sales_strict(f, cities(spark), cat, BLINKIT).first()
    assert s["tax_rate"] is None and s["net"] is None and s["mrp"] is None   # 100 / 0 -> NULL


def test_strict_keeps_nulls_and_states_have_same_values(spark):
    f = blinkit(spark, [("ZZ", D(2026, 2, 2), "t1", None, 2.0, 30.0, "Nowhere")])
    s = sales_strict(f, cities(spark), catalogue(spark), BLINKIT).first().asDict()
    assert s["brands_choice"] is None and s["category"] is None and s["itemname"] is None
    assert s["gmv"] == 30.0 and s["mrp"] == 15.0 and s["net"] is None
    st = merge_states(sales_states(f, cities(spark), catalogue(spark), BLINKIT)).first().asDict()
    assert st == s


def test_duplicate_dimension_rows_fail_inside_the_plan(spark):
    twice = catalogue(spark).unionByName(catalogue(spark))
    f = blinkit(spark, [("A1", D(2026, 2, 2), "t1", "Soap", 2.0, 30.0, "Pune")])
    with pytest.raises(Exception, match="static_combined_data: duplicate key"):
        sales_report(f, cities(spark), twice, BLINKIT).collect()
    with pytest.raises(Exception, match="static_city_mapping: duplicate key"):
        sales_report(f, cities(spark).unionByName(cities(spark)), catalogue(spark), BLINKIT).collect()


def test_duplicate_dimension_rows_are_rejected(spark):
    cat = catalogue(spark, [sku("t1", "A1"), sku("t1", "A1", prid="P9")])
    with pytest.raises(DuplicateDimensionKeys):
        check_dimensions(cities(spark), cat, BLINKIT)
    check_dimensions(cities(spark), catalogue(spark), BLINKIT)


def test_nulls_and_partial_options(spark):
    f = blinkit(spark, [
        ("A1", D(2026, 2, 2), "t1", "Soap", 1.0, 10.0, "Pune"),
        ("A1", D(2026, 2, 2), "t1", None, 1.0, 20.0, "Pune"),
    ])
    strict = sales_report(f, cities(spark), catalogue(spark), BLINKIT, nulls="strict").collect()
    assert [r.asDict() for r in strict] == [r.asDict() for r in sales_strict(f, cities(spark), catalogue(spark), BLINKIT).collect()]
    part = sales_report(f, cities(spark), catalogue(spark), BLINKIT, partial=True)
    assert part.count() == 2            # one row per item-name variant
    from rollwise.operators.sales import rollup_sales
    merged = rollup_sales(part, BLINKIT).collect()
    assert len(merged) == 1 and merged[0]["gmv"] == 30.0 and merged[0]["itemname"] == "Soap"
    with pytest.raises(ValueError):
        sales_report(f, cities(spark), catalogue(spark), BLINKIT, nulls="lenient")
