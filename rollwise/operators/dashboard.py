"""The dashboard questions, as DataFrame functions over the sales report.

Each takes the report (a lazily built one, or one read back with
``read_report`` so the month partitions are pruned), a tenant and an inclusive
``DateWindow``. The tenant and date predicates are on plain columns so
Catalyst pushes them to the parquet scan; a hash aggregation follows (per-item
text attributes go through the two-level ``rollup``). Group keys are the
coalesced values (one 'Unknown' row), and sums are exact, so totals do not
depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import exact_sum, platform_margin_row
from ..functions.defaults import MISSING_PRODUCT_ID, UNCATEGORISED, UNKNOWN
from ..windows import DateWindow
from .rollup import rollup


def _total(col: Column) -> Column:
    """COALESCE(SUM(x), 0) with an exact sum."""
    return F.coalesce(exact_sum(col), F.lit(0.0))


def _zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0.0))


def _scope(report: DataFrame, org: str, window: DateWindow | None) -> DataFrame:
    pred = F.col("organizationid") == F.lit(org)
    if window is not None:
        pred = pred & window.contains(F.col("reportdate"))
    return report.filter(pred)


def _or(col: str, default: str) -> Column:
    return F.coalesce(F.col(col), F.lit(default))


def brand_daily_sales(report: DataFrame, org: str, window: DateWindow) -> DataFrame:
    """Gmv by brand x day."""
    return (_scope(report, org, window)
            .groupBy(_or("brand", UNKNOWN).alias("brand"), F.col("reportdate").alias("date"))
            .agg(_total(F.col("gmv")).alias("total_sales"))
            .orderBy("date"))


def subcategory_list(catalogue: DataFrame, org: str) -> DataFrame:
    """Distinct subcategories of the tenant's catalogue (NULL is a value)."""
    return (catalogue.filter(F.col("organizationid") == F.lit(org))
            .select(F.col("sub__category").alias("subcategory")).distinct())


def item_pnl(report: DataFrame, org: str, window: DateWindow) -> DataFrame:
    """D3 (and D4 with ``window.shift_months(-1)``): per-item P&L."""
    rows = _scope(report, org, window).select(
        "itemid", "productid", "category", "subcategory", "itemname", "gmv", "qty", "taxes_paid", "net",
        platform_margin_row(F.col("gmv"), F.col("margin")).alias("platform_margin"))
    per_item = rollup(rows, ["itemid"], ["productid", "category", "subcategory", "itemname"],
                      ["gmv", "qty", "taxes_paid", "net", "platform_margin"])
    return (per_item.select(
                "itemid",
                F.coalesce(F.col("productid"), F.lit(MISSING_PRODUCT_ID)).alias("productid"),
                F.coalesce(F.col("category"), F.lit(UNCATEGORISED)).alias("category"),
                F.coalesce(F.col("subcategory"), F.lit(UNCATEGORISED)).alias("subcategory"),
                F.coalesce(F.col("itemname"), F.lit(UNKNOWN)).alias("itemname"),
                _zero(F.col("gmv")).alias("mrp"),
                _zero(F.col("qty")).alias("qty"),
                _zero(F.col("taxes_paid")).alias("taxes"),
                _zero(F.col("net")).alias("net_sales"),
                _zero(F.col("platform_margin")).alias("platform_margin"))
            .orderBy("category", "subcategory", "itemname"))


def item_pnl_previous_month(report: DataFrame, org: str, window: DateWindow) -> DataFrame:
    """D4."""
    return item_pnl(report, org, window.shift_months(-1))


def city_list(report: DataFrame, org: str) -> DataFrame:
    """Distinct known cities of the tenant, sorted (no date window). The
    reference's ``MIN(x) ... GROUP BY x`` is ``x`` itself: a hash distinct."""
    return (report.filter((F.col("organizationid") == F.lit(org)) & F.col("brands_choice").isNotNull())
            .select(F.col("brands_choice").alias("city")).distinct()
            .orderBy("city"))


def city_category_totals(report: DataFrame, org: str, window: DateWindow) -> DataFrame:
    """Gmv and quantity by city x category."""
    return (_scope(report, org, window)
            .groupBy(_or("brands_choice", UNKNOWN).alias("city"), _or("category", UNKNOWN).alias("category"))
            .agg(_total(F.col("gmv")).alias("total_mrp"), _total(F.col("qty")).alias("total_qty"))
            .orderBy("city", "category"))


def city_category_daily(report: DataFrame, org: str, window: DateWindow) -> DataFrame:
    """Gmv by city x category x day."""
    return (_scope(report, org, window)
            .groupBy(_or("brands_choice", UNKNOWN).alias("city"),
                     _or("category", UNKNOWN).alias("category"), F.col("reportdate"))
            .agg(_total(F.col("gmv")).alias("total_mrp"))
            .orderBy("city", "category", "reportdate"))


def city_sales(report: DataFrame, org: str, window: DateWindow) -> DataFrame:
    """D8 (and D9 on an earlier window): gmv by city."""
    return (_scope(report, org, window)
            .groupBy(_or("brands_choice", UNKNOWN).alias("city"))
            .agg(_total(F.col("gmv")).alias("sales")))


def city_sales_comparison(report: DataFrame, org: str, window: DateWindow) -> DataFrame:
    """D9."""
    return city_sales(report, org, window)


def item_sales(report: DataFrame, org: str, window: DateWindow) -> DataFrame:
    """Gmv by item with its smallest product id and name."""
    rows = _scope(report, org, window).select("itemid", "productid", "itemname", "gmv")
    per_item = rollup(rows, ["itemid"], ["productid", "itemname"], ["gmv"])
    return (per_item.select("itemid", "productid",
                            F.coalesce(F.col("itemname"), F.lit(UNKNOWN)).alias("itemname"),
                            _zero(F.col("gmv")).alias("sales"))
            .orderBy("itemid"))


def daily_category_totals(report: DataFrame, org: str, window: DateWindow) -> DataFrame:
    """D11 (and D12 shifted back a month): gmv, quantity and net by day x category."""
    return (_scope(report, org, window)
            .groupBy(F.col("reportdate"), _or("category", UNCATEGORISED).alias("category"))
            .agg(_total(F.col("gmv")).alias("total_mrp"), _total(F.col("qty")).alias("total_qty"),
                 _total(F.col("net")).alias("net_sales"))
            .orderBy("reportdate", "category"))


def daily_category_totals_previous_month(report: DataFrame, org: str, window: DateWindow) -> DataFrame:
    """D12."""
    return daily_category_totals(report, org, window.shift_months(-1))


def daily_target(targets: DataFrame, org: str, platform: str, window: DateWindow) -> DataFrame:
    """Smallest revenue target per day for a tenant and marketplace."""
    pred = ((F.col("organizationid") == F.lit(org)) & (F.col("platformid") == F.lit(platform))
            & window.contains_ts(F.col("date")))
    return (targets.filter(pred)
            .groupBy(F.to_date(F.col("date")).alias("date"))
            .agg(F.min("totaltarget").alias("target")))
