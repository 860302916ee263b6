"""Marketplace feeds, dimensions and targets derived from the TPC-H-like tables.

The reference ships no data. Its feeds are rebuilt from the driver's tables by
the fixed mapping below (lineitem joined to orders, supplier and nation). All
of it is one lazy Spark plan per feed: nothing is collected and the work grows
with the tables.

Fixed values of the mapping (they decide which join branches are exercised):
  marketplace by l_returnflag: A -> blinkit, R -> instamart, N -> zepto (every line
           belongs to one marketplace, each feed is that third of the table)
  tenants: 'org-' || (o_custkey % 3)          -> org-0, org-1, org-2
  SKU: 'SKU-' || l_partkey; zepto lower-cases it on even line numbers
  item name NULL when l_partkey % 7 = 0, else 'Item ' || l_partkey
  sales / front-end quantity NULL on line 5; ordered 0.0 and remaining NULL on line 7
  appointment / expiry / grn dates NULL on line 6
  purchase order: 'PO-' || l_orderkey
  city map: nations with n_nationkey % 6 = 5 left out, so that some cities are unmapped
           (their feed rows stay); brand_s_choice = region name
  catalogue: all parts but those with p_partkey % 11 = 7, and for org-2 but those with
           p_partkey % 10 in (8, 9), so that some SKUs are unlisted;
           category NULL for p_partkey % 10 = 3, brand NULL for 5, margin NULL for 4
           taxes '5', '12', '18' for p_partkey % 3 = 0, 1, 2; margin = 5 + p_partkey % 40
  targets: platform 'zepto' when o_orderkey % 4 = 0, else 'blinkit'
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MARKETPLACE_FLAG = {"blinkit": "A", "instamart": "R", "zepto": "N"}
TENANTS = ("org-0", "org-1", "org-2")
#: Parts that the catalogue does not hold, by a modulus: their number grows with the table.
UNLISTED = (11, 7)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _week(ts: Column) -> Column:
    return F.date_trunc("week", ts).cast("date")


def _text(prefix: str, n: Column) -> Column:
    return F.concat(F.lit(prefix), n.cast("string"))


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def line_base(spark: SparkSession, sf_dir: str, marketplace: str) -> DataFrame:
    """lineitem of one marketplace with its order, supplier city and derived keys."""
    flag = MARKETPLACE_FLAG[marketplace]
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate",
    ).filter(F.col("l_returnflag") == F.lit(flag))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus", "o_orderdate")
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), "n_name")
    supplier_city = (
        table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
        .join(nation, "s_nationkey")
        .select("l_suppkey", "n_name")
    )
    # lineitem x orders is the big join; Spark broadcasts the supplier side while it is small.
    j = li.join(orders, "l_orderkey").join(supplier_city, "l_suppkey")
    k = F.col("l_partkey")
    ln = F.col("l_linenumber")
    sku = _text("SKU-", k)
    return j.select(
        "*",
        sku.alias("_sku"),
        F.when(ln % 2 == 0, F.lower(sku)).otherwise(sku).alias("_sku_mixed"),
        _text("org-", F.col("o_custkey") % 3).alias("_org"),
        _null_when(F.col("l_partkey") % 7 == 0, _text("Item ", k)).alias("_name"),
        _null_when(ln == 5, F.col("l_quantity")).alias("_qty"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("_unit_price"),
        _week(F.col("l_shipdate")).alias("_ship_week"),
        _week(F.col("o_orderdate")).alias("_po_week"),
        _text("FeedCat-", k).alias("_feed_cat"),
        _text("FeedSub-", k).alias("_feed_sub"),
        _text("FeedBrand-", k).alias("_feed_brand"),
    )


# --------------------------------------------------------------------- sales
def sales_feed(spark: SparkSession, sf_dir: str, marketplace: str) -> DataFrame:
    b = line_base(spark, sf_dir, marketplace)
    common = dict(reportDate=F.col("_ship_week"), organizationId=F.col("_org"))
    if marketplace == "blinkit":
        cols = dict(itemId=F.col("_sku"), **common, itemName=F.col("_name"),
                    qtySold=F.col("_qty"), mrp=F.col("l_extendedprice"), cityName=F.col("n_name"))
    elif marketplace == "instamart":
        cols = dict(itemCode=F.col("_sku"), **common, productName=F.col("_name"),
                    finalQtyYesterday=F.col("_qty"), finalMrp=F.col("_unit_price"),
                    finalGmvYesterday=F.col("l_extendedprice"), city=F.col("n_name"))
    else:
        line4 = F.col("l_linenumber") == 4
        cols = dict(skuNumber=F.col("_sku_mixed"), **common, skuName=F.col("_name"),
                    skuCategory=_null_when(line4, F.col("_feed_cat")),
                    skuSubCategory=_null_when(line4, F.col("_feed_sub")),
                    brandName=_null_when(line4, F.col("_feed_brand")),
                    salesQuantity=F.col("_qty"), mrp=F.col("_unit_price"),
                    grossMerchandiseValue=F.col("l_extendedprice"), city=F.col("n_name"))
    return b.select(*[c.alias(n) for n, c in cols.items()])


# ----------------------------------------------------------------- inventory
def inventory_feed(spark: SparkSession, sf_dir: str, marketplace: str) -> DataFrame:
    b = line_base(spark, sf_dir, marketplace)
    stock = F.floor(F.col("l_extendedprice") / 100).cast("double")
    common = dict(reportDate=F.col("_ship_week"), organizationId=F.col("_org"))
    if marketplace == "blinkit":
        cols = dict(itemId=F.col("_sku"), backendFacilityName=F.col("n_name"), **common,
                    itemName=F.col("_name"), frontendInvQty=F.col("_qty"), backendInvQty=stock)
    elif marketplace == "instamart":
        cols = dict(itemCode=F.col("_sku"), productName=F.col("_name"), **common,
                    warehouseName=F.col("n_name"), warehouseSOH=stock)
    else:
        line4 = F.col("l_linenumber") == 4
        cols = dict(skuId=F.col("_sku_mixed"), storeName=F.col("n_name"), **common,
                    skuName=F.col("_name"), skuCategory=_null_when(line4, F.col("_feed_cat")),
                    brandName=_null_when(line4, F.col("_feed_brand")), totalQuantity=stock,
                    city=F.col("n_name"))
    return b.select(*[c.alias(n) for n, c in cols.items()])


# --------------------------------------------------------------- fulfillment
def fulfillment_feed(spark: SparkSession, sf_dir: str, marketplace: str) -> DataFrame:
    b = line_base(spark, sf_dir, marketplace)
    ln = F.col("l_linenumber")
    ordered = F.when(ln == 7, F.lit(0.0)).otherwise(F.col("l_quantity"))
    remaining = _null_when(ln == 7, F.floor(F.col("l_quantity") * F.col("l_discount") * 5).cast("double"))
    appointment = _null_when(ln == 6, F.date_add(F.col("_po_week"), ln))
    expiry = _null_when(ln == 6, F.date_add(F.col("_po_week"), F.lit(30)))
    po = _text("PO-", F.col("l_orderkey"))
    common = dict(organizationId=F.col("_org"))
    if marketplace in ("blinkit", "instamart"):
        status = {"blinkit": "poState", "instamart": "status"}[marketplace]
        date = {"blinkit": "orderDate", "instamart": "poDate"}[marketplace]
        cols = {"itemId": F.col("_sku"), "poNumber": po, **common, status: F.col("o_orderstatus"),
                date: F.col("_po_week"), "name": F.col("_name"), "mrp": F.col("_unit_price"),
                "appointmentDate": appointment, "expiryDate": expiry,
                "facilityName": F.col("n_name"), "unitsOrdered": ordered,
                "remainingQuantity": remaining, "totalAmount": F.col("l_extendedprice")}
    else:
        grn = F.coalesce(ordered, F.lit(0.0)) - F.coalesce(remaining, F.lit(0.0))
        fill = F.coalesce(F.lit(1.0) - F.try_divide(F.coalesce(remaining, F.lit(0.0)),
                                                    F.nullif(ordered, F.lit(0.0))), F.lit(0.0))
        cols = {"skuId": F.col("_sku_mixed"), "poCode": po, **common, "poDate": F.col("_po_week"),
                "skuName": F.col("_name"), "grnDate": appointment,
                "warehouseName": F.col("n_name"), "poQuantity": ordered, "grnQuantity": grn,
                "skuLevelFillRate": fill, "city": F.col("n_name")}
    return b.select(*[c.alias(n) for n, c in cols.items()])


# ---------------------------------------------------------------- dimensions
def _tenants() -> Column:
    return F.explode(F.array(*[F.lit(t) for t in TENANTS]))


def city_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    nation = table(spark, sf_dir, "nation").filter(F.col("n_nationkey") % 6 != 5)
    n = nation.join(region, "n_regionkey")
    return n.select(
        _tenants().alias("organizationid"),
        F.col("n_name").alias("blinkit"),
        F.col("n_name").alias("instamart"),
        F.col("n_name").alias("zepto"),
        F.col("r_name").alias("brand_s_choice"),
    )


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    part = table(spark, sf_dir, "part").filter(p % UNLISTED[0] != UNLISTED[1])
    margin = _null_when(p % 10 == 4, (F.lit(5) + p % 40).cast("double"))
    active = (p % 2).cast("bigint")
    # a join with the tenants and not explode: after explode Spark takes the rows of all tenants for the few
    # bytes of the table, and would broadcast it at any size; so it measures the rows before it does.
    tenants = spark.range(len(TENANTS)).select(
        F.element_at(F.array(*[F.lit(t) for t in TENANTS]), F.col("id").cast("int") + 1).alias("organizationid"))
    rows = part.crossJoin(tenants).filter(
        ~((F.col("organizationid") == F.lit("org-2")) & (p % 10).isin(8, 9)))
    return rows.select(
        "organizationid",
        _text("SKU-", p).alias("blinkit_sku_code"),
        _text("SKU-", p).alias("instamart_sku_code"),
        _text("SKU-", p).alias("zepto_sku_code"),
        _text("PRID-", p).alias("blinkit_prid"),
        _text("IMC-", p).alias("instamart_item_code"),
        _text("INT-", p).alias("brand_internal_sku_code"),
        _null_when(p % 10 == 3, F.col("p_type")).alias("category"),
        F.col("p_name").alias("sub__category"),
        _null_when(p % 10 == 5, F.col("p_brand")).alias("brand"),
        F.col("p_retailprice").cast("string").alias("cogs"),
        F.when(p % 3 == 0, F.lit("5")).when(p % 3 == 1, F.lit("12")).otherwise(F.lit("18")).alias("taxes"),
        margin.alias("blinkit_margin"),
        margin.alias("instamart_margin"),
        margin.alias("zepto_margin"),
        active.alias("blinkit_active"),
        active.alias("instamart_active"),
        active.alias("zepto_active"),
    )


def revenue_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        _text("org-", F.col("o_custkey") % 3).alias("organizationid"),
        F.when(F.col("o_orderkey") % 4 == 0, F.lit("zepto")).otherwise(F.lit("blinkit")).alias("platformid"),
        F.col("o_orderdate").alias("date"),
        F.col("o_totalprice").alias("totaltarget"),
    )


FEEDS = {"sales": sales_feed, "inventory": inventory_feed, "fulfillment": fulfillment_feed}


def feed(spark: SparkSession, sf_dir: str, kind: str, marketplace: str) -> DataFrame:
    return FEEDS[kind](spark, sf_dir, marketplace)
