"""One representative line per key, and the zepto price lookup."""

from rollwise.operators.fulfillment import daily_min_price, fulfillment_report
from rollwise.specs import BLINKIT, INSTAMART, ZEPTO

from .frames import D, catalogue, cities, feed

EPOCH = D(1970, 1, 1)


def test_one_line_per_key_keeps_its_own_measures(spark):
    f = feed(spark, "blinkit", "fulfillment", [
        ("A1", "PO1", "t1", "OPEN", D(2026, 2, 2), "Soap", 5.0, None, None, "Pune", 10.0, 4.0, 50.0),
        ("A1", "PO1", "t1", "OPEN", D(2026, 2, 2), "Soap", 5.0, D(2026, 2, 4), None, "Pune", 8.0, 0.0, 40.0),
    ])
    rows = fulfillment_report(f, cities(spark), catalogue(spark), BLINKIT).collect()
    assert len(rows) == 1
    r = rows[0]
    # Smallest line by (facility, quantity, ...): the 8-unit line, whole.
    assert (r["quantity"], r["grn_quantity"], r["total_amount"], r["fill_rate_sku"]) == (8.0, 8.0, 40.0, 1.0)
    assert r["appointmentdate"] == D(2026, 2, 4) and r["expirydate"] == EPOCH
    assert (r["brands_choice"], r["brand_internal_sku_code"], r["productid"]) == ("WEST", "INT1", "P1")


def test_nothing_ordered_gives_zero_fill_rate_and_defaults(spark):
    f = feed(spark, "instamart", "fulfillment", [
        ("ZZ", "PO2", "t1", None, D(2026, 2, 2), None, None, None, None, None, 0.0, None, None),
    ])
    r = fulfillment_report(f, cities(spark), catalogue(spark), INSTAMART).first()
    assert (r["po_status"], r["itemname"], r["productid"], r["backendfacilityname"]) == ("Unknown",) * 4
    assert (r["fill_rate_sku"], r["grn_quantity"], r["mrp"], r["total_amount"]) == (0.0, 0.0, 0.0, 0.0)
    assert r["brands_choice"] == "Unknown" and r["appointmentdate"] == EPOCH


def test_zepto_prices_from_daily_minimum_sales_price(spark):
    sales = feed(spark, "zepto", "sales", [
        ("A1", D(2026, 2, 2), "t1", "Soap", None, None, None, 1.0, 12.0, 12.0, "Pune"),
        ("a1", D(2026, 2, 2), "t2", "Soap", None, None, None, 1.0, 9.0, 9.0, "Pune"),
    ])
    f = feed(spark, "zepto", "fulfillment", [
        ("A1", "PO3", "t1", D(2026, 2, 2), "Soap", None, "WH", 10.0, 7.0, 0.7, "Pune"),
        ("A1", "PO4", "t1", D(2026, 2, 9), "Soap", D(2026, 2, 10), "WH", 10.0, None, None, "Pune"),
    ])
    prices = daily_min_price(sales, ZEPTO)
    out = {r["ponumber"]: r for r in fulfillment_report(f, cities(spark), catalogue(spark), ZEPTO, prices).collect()}
    assert out["PO3"]["mrp"] == 9.0 and out["PO3"]["total_amount"] == 90.0
    assert out["PO3"]["grn_quantity"] == 7.0 and out["PO3"]["fill_rate_sku"] == 0.7
    assert out["PO4"]["mrp"] == 0.0 and out["PO4"]["fill_rate_sku"] == 0.0
    assert out["PO3"]["po_status"] == "Unknown" and out["PO3"]["expirydate"] == EPOCH
    assert out["PO4"]["appointmentdate"] == D(2026, 2, 10) and out["PO3"]["itemid"] == "a1"
