"""Inventory reports R4-R6: daily stock per item x facility with depletion run rates.

Plan: feed -> left joins -> ``groupBy`` to one row per (tenant, item,
facility, day) (partial aggregation combines a hot key map-side) -> one
window partitioned by (tenant, item, facility) ordered by day. Both run rates
share one window spec, so Catalyst plans one shuffle + sort for them. The
window input has one row per key and day, so a partition holds at most as
many rows as there are days, however skewed the feed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import depletion, zero_if_null
from ..functions.defaults import UNKNOWN
from ..specs import PlatformSpec
from .enrich import CITY, SKU, enrich
from .rollup import rollup

# The item comes first: rows are sorted by these, and the first column settles most comparisons.
INV_SERIES = ["itemid", "backendfacilityname", "organizationid"]
INV_KEYS = [*INV_SERIES, "reportdate"]
INV_ANY = ["itemname", "productid", "category", "subcategory", "brand",
           "brand_internal_sku_code", "brands_choice", "active"]
INV_SUM = ["total_quantity", "frontendinvqty", "backendinvqty"]
INVENTORY_COLUMNS = [
    "itemid", "backendfacilityname", "reportdate", "itemname", "productid", "category",
    "subcategory", "brand", "organizationid", "brand_internal_sku_code", "brands_choice", "active",
    "total_quantity", "frontendinvqty", "backendinvqty", "run_rate_backend", "run_rate_total",
]


def _known(*cols: Column) -> Column:
    return F.coalesce(*cols, F.lit(UNKNOWN))


def inventory_lines(feed: DataFrame, cities: DataFrame, catalogue: DataFrame,
                    spec: PlatformSpec, carry: tuple[str, ...] = ()) -> DataFrame:
    s = spec.inventory
    e = enrich(feed, cities, catalogue, spec, city_col=s.city, item_col=s.item)
    back = zero_if_null(F.col(s.backend).cast("double"))
    front = zero_if_null(F.col(s.frontend).cast("double")) if s.frontend else F.lit(0.0)
    total = (front + back) if s.front_in_total else back
    cat = [F.col(SKU + "category")] + ([F.col(s.category_fallback)] if s.category_fallback else [])
    brand = [F.col(SKU + "brand")] + ([F.col(s.brand_fallback)] if s.brand_fallback else [])
    cols = {
        "organizationid": F.col("organizationId").cast("string"),
        "itemid": F.col("_sku_key"),
        "backendfacilityname": _known(F.col(s.facility)),
        "reportdate": F.to_date(F.col(s.date)),
        "itemname": _known(F.col(s.name)),
        "productid": F.coalesce(F.col(SKU + "productid"), F.lit(s.productid_default)),
        "category": _known(*cat),
        "subcategory": _known(F.col(SKU + "subcategory")),
        "brand": _known(*brand),
        "brand_internal_sku_code": _known(F.col(SKU + "brand_internal_sku_code")),
        "brands_choice": _known(F.col(CITY + "brands_choice")),
        "active": F.coalesce(F.col(SKU + "active"), F.lit(0)) != 0,
        "total_quantity": total,
        "frontendinvqty": front,
        "backendinvqty": back,
    }
    return e.select(*[c.alias(n) for n, c in cols.items()], *carry)


def daily_stock(lines: DataFrame, extra_keys: tuple[str, ...] = (), final: bool = True,
                states: bool = False) -> DataFrame:
    """One row per (tenant, item, facility, day); also merges partial daily rows.
    ``final=False`` and ``states=True`` give partial daily rows (see ``rollup``)."""
    # Clustered by series: the run-rate window then needs no shuffle of its own.
    return rollup(lines, [*INV_KEYS, *extra_keys], INV_ANY, INV_SUM, cluster_by=INV_SERIES, final=final, states=states)


def _rated(daily: DataFrame) -> DataFrame:
    w = Window.partitionBy(*INV_SERIES).orderBy("reportdate")
    return daily.select(
        "*",
        depletion(F.lag("backendinvqty", 1, 0.0).over(w), F.col("backendinvqty")).alias("run_rate_backend"),
        depletion(F.lag("total_quantity", 1, 0.0).over(w), F.col("total_quantity")).alias("run_rate_total"),
    )


def with_run_rates(daily: DataFrame, last_snapshots: DataFrame | None = None) -> DataFrame:
    """Depletion since the previous available snapshot (0 for the first one).

    ``last_snapshots``: when only a date range is rebuilt, the latest earlier daily
    row of each series (see ``latest_before``). It feeds the lag of the range's
    first day and is not returned.
    """
    if last_snapshots is None:
        return _rated(daily).select(*INVENTORY_COLUMNS)
    both = daily.withColumn("_prior", F.lit(False)).unionByName(
        last_snapshots.select(*daily.columns).withColumn("_prior", F.lit(True)))
    return _rated(both).filter(~F.col("_prior")).select(*INVENTORY_COLUMNS)


def inventory_report(feed: DataFrame, cities: DataFrame, catalogue: DataFrame,
                     spec: PlatformSpec, last_snapshots: DataFrame | None = None) -> DataFrame:
    """R4-R6."""
    return with_run_rates(daily_stock(inventory_lines(feed, cities, catalogue, spec)), last_snapshots)


def of_series(rows: DataFrame, others: DataFrame, how: str) -> DataFrame:
    """Rows whose series ``others`` has (``left_semi``) or has not (``left_anti``); a null equals a null."""
    named = others.select(*[F.col(c).alias("_" + c) for c in INV_SERIES]).distinct()
    return rows.join(named, reduce(Column.__and__, [F.col(c).eqNullSafe(F.col("_" + c)) for c in INV_SERIES]), how)


def latest_before(daily: DataFrame, day) -> DataFrame:
    """Latest daily row per series strictly before ``day`` (one ``max_by`` aggregate:
    partial aggregation keeps a single candidate per series and task)."""
    rest = [c for c in daily.columns if c not in INV_SERIES]
    latest = (daily.filter(F.col("reportdate") < F.lit(day))
              .groupBy(*INV_SERIES)
              .agg(F.max_by(F.struct(*rest), F.col("reportdate")).alias("_r")))
    return latest.select(*INV_SERIES, *[F.col("_r." + c).alias(c) for c in rest]).select(*daily.columns)
