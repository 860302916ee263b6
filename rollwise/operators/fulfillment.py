"""Fulfillment reports R7-R9: one row per purchase-order line key.

The reference keeps "any" line of a key (A5). We keep one representative line:
the smallest ``struct`` of its measures, so ordered, received and fill rate come
from the same line and the pick is deterministic and mergeable (the min of
partial mins is the global min). It is an ordinary aggregate, so a hot key is
reduced map-side before the shuffle.

Zepto prices its lines from the sales feed's smallest daily price per SKU (M8,
A12): pre-aggregated first, then left-joined on (sku, day).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import fill_rate, po_amount, received_quantity, zero_if_null
from ..functions.defaults import NO_DATE, UNKNOWN
from ..specs import PlatformSpec
from .enrich import CITY, SKU, enrich


FUL_KEYS = ["itemid", "ponumber", "po_status", "brand_internal_sku_code", "brands_choice",
            "organizationid", "orderdate"]
#: What a price is looked up by.
PRICED = ["itemid", "orderdate"]
# Order of the representative-line comparison (all fields are non-NULL).
FUL_LINE = ["backendfacilityname", "quantity", "grn_quantity", "total_amount", "fill_rate_sku",
            "mrp", "appointmentdate", "expirydate", "itemname", "productid"]
_MEASURES = ["itemname", "productid", "mrp", "appointmentdate", "expirydate", "backendfacilityname",
             "quantity", "grn_quantity", "total_amount", "fill_rate_sku"]
BLINKIT_COLUMNS = ["itemid", "ponumber", "brand_internal_sku_code", "brands_choice",
                   "organizationid", "po_status", "orderdate"] + _MEASURES
OTHER_COLUMNS = ["itemid", "ponumber", "po_status", "brand_internal_sku_code", "brands_choice",
                 "organizationid", "orderdate"] + _MEASURES


def fulfillment_columns(spec: PlatformSpec) -> list[str]:
    return BLINKIT_COLUMNS if spec.name == "blinkit" else OTHER_COLUMNS


def daily_min_price(sales_feed: DataFrame, spec: PlatformSpec) -> DataFrame:
    """M8: smallest unit price per lower-cased SKU and day (across tenants, as the reference)."""
    s = spec.sales
    return (sales_feed.groupBy(F.lower(F.col(s.item)).alias("sku"),
                               F.to_date(F.col(s.date)).alias("orderdate"))
            .agg(F.min(F.col(s.unit_price)).alias("mrp")))


def _date_or_epoch(c: Column) -> Column:
    return F.coalesce(F.to_date(c), F.lit(NO_DATE))


def fulfillment_lines(feed: DataFrame, cities: DataFrame, catalogue: DataFrame, spec: PlatformSpec,
                      prices: DataFrame | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    s = spec.fulfillment
    e = enrich(feed, cities, catalogue, spec, city_col=s.city, item_col=s.item)
    if s.unit_price is None:
        if prices is None:
            raise ValueError(f"{spec.name} fulfillment needs daily_min_price(sales feed)")
        p = prices.select(F.col("sku").alias("_p_sku"), F.col("orderdate").alias("_p_day"), F.col("mrp").alias("_p_mrp"))
        sku = F.col("_sku_key") if spec.lower_sku else F.lower(F.col(s.item).cast("string"))
        e = e.join(p, (sku == p["_p_sku"])
                   & (F.to_date(F.col(s.date)) == p["_p_day"]), "left")
        price = zero_if_null(F.col("_p_mrp").cast("double"))
    else:
        price = zero_if_null(F.col(s.unit_price).cast("double"))
    ordered = zero_if_null(F.col(s.ordered).cast("double"))
    if s.received is not None:
        received = zero_if_null(F.col(s.received).cast("double"))
        rate = zero_if_null(F.col(s.fill_rate).cast("double"))
    else:
        received = received_quantity(F.col(s.ordered), F.col(s.remaining))
        rate = fill_rate(F.col(s.ordered), F.col(s.remaining))
    amount = (zero_if_null(F.col(s.amount).cast("double")) if s.amount
              else po_amount(price, F.col(s.ordered)))
    cols = {
        "itemid": F.col("_sku_key"),
        "ponumber": F.col(s.po),
        "po_status": F.coalesce(F.col(s.status), F.lit(UNKNOWN)) if s.status else F.lit(UNKNOWN),
        "brand_internal_sku_code": F.coalesce(F.col(SKU + "brand_internal_sku_code"), F.lit(UNKNOWN)),
        "brands_choice": F.coalesce(F.col(CITY + "brands_choice"), F.lit(UNKNOWN)),
        "organizationid": F.col("organizationId").cast("string"),
        "orderdate": F.to_date(F.col(s.date)),
        "itemname": F.coalesce(F.col(s.name), F.lit(UNKNOWN)),
        "productid": F.coalesce(F.col(SKU + "productid"), F.lit(UNKNOWN)),
        "mrp": price,
        "appointmentdate": _date_or_epoch(F.col(s.appointment)),
        "expirydate": _date_or_epoch(F.col(s.expiry)) if s.expiry else F.lit(NO_DATE),
        "backendfacilityname": F.coalesce(F.col(s.facility), F.lit(UNKNOWN)),
        "quantity": ordered,
        "grn_quantity": received,
        "total_amount": amount,
        "fill_rate_sku": rate,
    }
    return e.select(*[c.alias(n) for n, c in cols.items()], *carry)


def representative_line(lines: DataFrame, spec: PlatformSpec, extra_keys: tuple[str, ...] = (), merging: bool = False) -> DataFrame:
    """A5: one line per key (also merges partial rows of the same schema). ``merging``: the rows are partial rows, about one
    per key and load, so they are shuffled first and sorted once; by item and day where the price is per item and day, so that
    ``repriced`` finds them in place and in order."""
    keys = [*FUL_KEYS, *extra_keys]
    if merging:
        priced = spec.fulfillment.unit_price is None
        keys = [*PRICED, *[k for k in keys if k not in PRICED]] if priced else keys
        lines = lines.repartition(*(PRICED if priced else keys))
    picked = lines.groupBy(*keys).agg(F.min(F.struct(*FUL_LINE)).alias("_line"))
    return picked.select(*keys, *[F.col("_line." + c).alias(c) for c in FUL_LINE]) \
                 .select(*fulfillment_columns(spec), *extra_keys)


def repriced(report: DataFrame, prices: DataFrame, spec: PlatformSpec) -> DataFrame:
    """The report with each line's price and amount from ``prices`` (0 where there is none). All lines of a key
    have one price (its SKU's of its day), so which of them stands for the key does not depend on it."""
    p = prices.select(F.col("sku").alias("_p_sku"), F.col("orderdate").alias("_p_day"), F.col("mrp").alias("_p_mrp"))
    sku = F.col("itemid") if spec.lower_sku else F.lower("itemid")
    out = report.join(p, (sku == p["_p_sku"]) & (report["orderdate"] == p["_p_day"]), "left")
    price = zero_if_null(F.col("_p_mrp").cast("double"))
    return (out.withColumn("mrp", price).withColumn("total_amount", po_amount(F.col("mrp"), F.col("quantity")))
            .select(*fulfillment_columns(spec)))


def fulfillment_report(feed: DataFrame, cities: DataFrame, catalogue: DataFrame, spec: PlatformSpec,
                       prices: DataFrame | None = None) -> DataFrame:
    """R7-R9 (R9 needs ``prices=daily_min_price(zepto sales feed)``)."""
    return representative_line(fulfillment_lines(feed, cities, catalogue, spec, prices), spec)
