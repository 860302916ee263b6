"""Declared schemas of the marketplace feeds, the dimensions and the targets.

The reference has no DDL for its inputs; these list every column its SQL
reads, with the type the use implies. Feeds read from storage are read with
these schemas (no inference); dates may also arrive as timestamps or text,
since every report applies ``to_date``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

FEEDS = {
    ("blinkit", "sales"): "itemId string, reportDate date, organizationId string, itemName string, "
                          "qtySold double, mrp double, cityName string",
    ("instamart", "sales"): "itemCode string, reportDate date, organizationId string, productName string, "
                            "finalQtyYesterday double, finalMrp double, finalGmvYesterday double, city string",
    ("zepto", "sales"): "skuNumber string, reportDate date, organizationId string, skuName string, "
                        "skuCategory string, skuSubCategory string, brandName string, "
                        "salesQuantity double, mrp double, grossMerchandiseValue double, city string",
    ("blinkit", "inventory"): "itemId string, backendFacilityName string, reportDate date, "
                              "organizationId string, itemName string, frontendInvQty double, "
                              "backendInvQty double",
    ("instamart", "inventory"): "itemCode string, productName string, reportDate date, "
                                "organizationId string, warehouseName string, warehouseSOH double",
    ("zepto", "inventory"): "skuId string, storeName string, reportDate date, organizationId string, "
                            "skuName string, skuCategory string, brandName string, "
                            "totalQuantity double, city string",
    ("blinkit", "fulfillment"): "itemId string, poNumber string, organizationId string, poState string, "
                                "orderDate date, name string, mrp double, appointmentDate date, "
                                "expiryDate date, facilityName string, unitsOrdered double, "
                                "remainingQuantity double, totalAmount double",
    ("instamart", "fulfillment"): "itemId string, poNumber string, organizationId string, status string, "
                                  "poDate date, name string, mrp double, appointmentDate date, "
                                  "expiryDate date, facilityName string, unitsOrdered double, "
                                  "remainingQuantity double, totalAmount double",
    ("zepto", "fulfillment"): "skuId string, poCode string, organizationId string, poDate date, "
                              "skuName string, grnDate date, warehouseName string, poQuantity double, "
                              "grnQuantity double, skuLevelFillRate double, city string",
}

CITY_MAPPING = "organizationid string, blinkit string, instamart string, zepto string, brand_s_choice string"

CATALOGUE = (
    "organizationid string, blinkit_sku_code string, instamart_sku_code string, zepto_sku_code string, "
    "blinkit_prid string, instamart_item_code string, brand_internal_sku_code string, category string, "
    "sub__category string, brand string, cogs string, taxes string, blinkit_margin double, "
    "instamart_margin double, zepto_margin double, blinkit_active bigint, instamart_active bigint, "
    "zepto_active bigint"
)

TARGETS = "organizationid string, platformid string, date timestamp, totaltarget double"


def feed_schema(marketplace: str, kind: str) -> StructType:
    return StructType.fromDDL(FEEDS[(marketplace, kind)])


def read_feed(spark: SparkSession, path: str, marketplace: str, kind: str) -> DataFrame:
    return spark.read.schema(FEEDS[(marketplace, kind)]).parquet(path)


def read_dimensions(spark: SparkSession, cities_path: str, catalogue_path: str) -> tuple[DataFrame, DataFrame]:
    return (spark.read.schema(CITY_MAPPING).parquet(cities_path),
            spark.read.schema(CATALOGUE).parquet(catalogue_path))
