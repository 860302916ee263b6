"""Per-marketplace column mapping of the three feeds (the tables of SURVEY §2.1 as data).

The three marketplaces share one builder per report kind; they differ only in
which feed column plays which role, which dimension columns they read, and a
few defaults. ``None`` means the marketplace has no such column.
"""

from __future__ import annotations

from dataclasses import dataclass

from .functions.defaults import BLINKIT_INVENTORY_NO_PRODUCT_ID, UNKNOWN


@dataclass(frozen=True)
class SalesCols:
    item: str
    date: str
    name: str
    qty: str
    gmv: str
    city: str
    unit_price: str | None            # any(mrp) column of the report; None: no such column
    category_fallback: str | None = None
    subcategory_fallback: str | None = None
    brand_fallback: str | None = None


@dataclass(frozen=True)
class InventoryCols:
    item: str
    facility: str
    date: str
    name: str
    city: str                         # joined to the city map
    backend: str
    frontend: str | None              # None: front-end stock is the constant 0.0
    front_in_total: bool              # total = front + back (blinkit) or back only
    category_fallback: str | None = None
    brand_fallback: str | None = None
    productid_default: str = UNKNOWN


@dataclass(frozen=True)
class FulfillmentCols:
    item: str
    po: str
    status: str | None                # None: constant 'Unknown'
    date: str
    name: str
    facility: str
    city: str
    ordered: str
    remaining: str | None             # blinkit/instamart: received = ordered - remaining
    received: str | None              # zepto: received given by the feed
    fill_rate: str | None             # zepto: fill rate given by the feed
    amount: str | None                # None: price x ordered, price from the sales feed
    unit_price: str | None            # None: daily minimum sales price
    appointment: str
    expiry: str | None                # None: constant 1970-01-01


@dataclass(frozen=True)
class PlatformSpec:
    name: str
    city_col: str                     # static_city_mapping column holding this marketplace's city
    sku_col: str                      # static_combined_data column holding its SKU code
    productid_col: str
    margin_col: str
    active_col: str
    lower_sku: bool                   # SKU keys compared lower-cased on both sides
    sales: SalesCols
    inventory: InventoryCols
    fulfillment: FulfillmentCols


BLINKIT = PlatformSpec(
    name="blinkit", city_col="blinkit", sku_col="blinkit_sku_code", productid_col="blinkit_prid",
    margin_col="blinkit_margin", active_col="blinkit_active", lower_sku=False,
    sales=SalesCols(item="itemId", date="reportDate", name="itemName", qty="qtySold", gmv="mrp",
                    city="cityName", unit_price=None),
    inventory=InventoryCols(item="itemId", facility="backendFacilityName", date="reportDate",
                            name="itemName", city="backendFacilityName", backend="backendInvQty",
                            frontend="frontendInvQty", front_in_total=True,
                            productid_default=BLINKIT_INVENTORY_NO_PRODUCT_ID),
    fulfillment=FulfillmentCols(item="itemId", po="poNumber", status="poState", date="orderDate",
                                name="name", facility="facilityName", city="facilityName",
                                ordered="unitsOrdered", remaining="remainingQuantity", received=None,
                                fill_rate=None, amount="totalAmount", unit_price="mrp",
                                appointment="appointmentDate", expiry="expiryDate"),
)

INSTAMART = PlatformSpec(
    name="instamart", city_col="instamart", sku_col="instamart_sku_code",
    productid_col="instamart_item_code", margin_col="instamart_margin",
    active_col="instamart_active", lower_sku=False,
    sales=SalesCols(item="itemCode", date="reportDate", name="productName", qty="finalQtyYesterday",
                    gmv="finalGmvYesterday", city="city", unit_price="finalMrp"),
    inventory=InventoryCols(item="itemCode", facility="warehouseName", date="reportDate",
                            name="productName", city="warehouseName", backend="warehouseSOH",
                            frontend=None, front_in_total=False),
    fulfillment=FulfillmentCols(item="itemId", po="poNumber", status="status", date="poDate",
                                name="name", facility="facilityName", city="facilityName",
                                ordered="unitsOrdered", remaining="remainingQuantity", received=None,
                                fill_rate=None, amount="totalAmount", unit_price="mrp",
                                appointment="appointmentDate", expiry="expiryDate"),
)

ZEPTO = PlatformSpec(
    name="zepto", city_col="zepto", sku_col="zepto_sku_code", productid_col="zepto_sku_code",
    margin_col="zepto_margin", active_col="zepto_active", lower_sku=True,
    sales=SalesCols(item="skuNumber", date="reportDate", name="skuName", qty="salesQuantity",
                    gmv="grossMerchandiseValue", city="city", unit_price="mrp",
                    category_fallback="skuCategory", subcategory_fallback="skuSubCategory",
                    brand_fallback="brandName"),
    inventory=InventoryCols(item="skuId", facility="storeName", date="reportDate", name="skuName",
                            city="city", backend="totalQuantity", frontend=None,
                            front_in_total=False, category_fallback="skuCategory",
                            brand_fallback="brandName"),
    fulfillment=FulfillmentCols(item="skuId", po="poCode", status=None, date="poDate",
                                name="skuName", facility="warehouseName", city="city",
                                ordered="poQuantity", remaining=None, received="grnQuantity",
                                fill_rate="skuLevelFillRate", amount=None, unit_price=None,
                                appointment="grnDate", expiry=None),
)

PLATFORMS = {s.name: s for s in (BLINKIT, INSTAMART, ZEPTO)}


def platform(name: str) -> PlatformSpec:
    return PLATFORMS[name]
