"""Sales reports: R1-R3 (defaults, mergeable), R10 (strict stored view), R11 (strict states).

One plan per report: feed -> two broadcast/shuffled left joins -> a hash
aggregation whose partial step runs before the shuffle, so a hot item or
tenant is combined map-side (``rollup``). Attributes are "any" in the reference; ``min``
makes them deterministic and mergeable. Money sums are exact.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.measures import net_sales, rejected, taxes_paid, to_double, unit_price, zero_if_null
from ..functions.defaults import UNKNOWN
from ..specs import PlatformSpec
from .enrich import CITY, SKU, enrich
from .rollup import Arrange, rollup, state_order

SALES_KEYS = ["organizationid", "reportdate", "itemid", "brands_choice"]
SALES_ANY = ["category", "subcategory", "brand", "productid", "itemname",
             "brand_internal_sku_code", "cogs", "margin", "tax_rate", "active"]
SALES_SUM = ["qty", "gmv", "net", "taxes_paid"]
#: The feed's tenant as the catalogue is joined on it: of lines, not of partial rows.
JOINED = "_joined_org"


def sales_columns(spec: PlatformSpec) -> list[str]:
    """Output columns in the order of the report table of the marketplace."""
    sums = ["qty", "mrp", "gmv", "net", "taxes_paid"] if spec.sales.unit_price else SALES_SUM
    return SALES_KEYS + SALES_ANY + sums


def _first_known(*cols: Column) -> Column:
    return F.coalesce(*cols, F.lit(UNKNOWN))


def _fallback(scd_col: str, feed_col: str | None) -> Column:
    cols = [F.col(SKU + scd_col)] + ([F.col(feed_col)] if feed_col else [])
    return _first_known(*cols)


#: What an observation of a default report counts: feed lines whose text became 0 because it is no number.
REJECTS = {"cogs": "cogs_rejected", "taxes": "taxes_rejected"}


def reject_counts(seen: Observation) -> dict[str, int]:
    """The counts of an observation whose report has been computed; 0 where Spark had nothing to compute (a feed that it
    knows to be empty is not planned, and its observation not filled)."""
    try:
        found = seen.get
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() != "AssertionError":
            raise
        found = {}
    return {n: found.get(n, 0) for n in REJECTS.values()}


def sales_lines(feed: DataFrame, cities: DataFrame, catalogue: DataFrame,
                spec: PlatformSpec, carry: tuple[str, ...] = (), rejects: Observation | None = None,
                count_rejects: bool = False) -> DataFrame:
    """One enriched row per feed row, defaults applied (the view's SELECT before GROUP BY).
    ``carry``: feed columns passed through unchanged (e.g. a split key). ``rejects`` counts lines (``REJECTS``)
    while the report is computed, without a job of its own; a filter on the report is then not pushed below.
    ``count_rejects`` gives them as columns instead (0 or 1 in a line)."""
    s = spec.sales
    e = enrich(feed, cities, catalogue, spec, city_col=s.city, item_col=s.item)
    if rejects is not None:
        e = e.observe(rejects, *[F.count_if(rejected(F.col(SKU + c))).alias(n) for c, n in REJECTS.items()])
    margin = zero_if_null(F.col(SKU + "margin"))
    tax = zero_if_null(to_double(F.col(SKU + "taxes")))
    gmv = zero_if_null(F.col(s.gmv).cast("double"))
    cols = {
        "organizationid": _first_known(F.col("organizationId")),
        "reportdate": F.to_date(F.col(s.date)),
        "itemid": F.col("_sku_key"),
        "brands_choice": _first_known(F.col(CITY + "brands_choice")),
        "category": _fallback("category", s.category_fallback),
        "subcategory": _fallback("subcategory", s.subcategory_fallback),
        "brand": _fallback("brand", s.brand_fallback),
        "productid": _first_known(F.col(SKU + "productid")),
        "itemname": _first_known(F.col(s.name)),
        "brand_internal_sku_code": _first_known(F.col(SKU + "brand_internal_sku_code")),
        "cogs": zero_if_null(to_double(F.col(SKU + "cogs"))),
        "margin": margin,
        "tax_rate": tax,
        "active": F.coalesce(F.col(SKU + "active"), F.lit(0)) != 0,
        "qty": zero_if_null(F.col(s.qty).cast("double")),
        "gmv": gmv,
        "net": net_sales(gmv, margin, tax),
        "taxes_paid": taxes_paid(gmv, margin, tax),
    }
    if s.unit_price:
        cols["mrp"] = zero_if_null(F.col(s.unit_price).cast("double"))
    cols[JOINED] = F.col("organizationId")
    if count_rejects:
        cols |= {n: rejected(F.col(SKU + c)).cast("bigint") for c, n in REJECTS.items()}
    return e.select(*[c.alias(n) for n, c in cols.items()], *carry)


def rollup_sales(lines: DataFrame, spec: PlatformSpec, extra_keys: tuple[str, ...] = (),
                 final: bool = True, states: bool = False, arrange: Arrange | None = None) -> DataFrame:
    """Group enriched lines or partial rows into report rows; ``final=False`` gives partial
    rows, ``states=True`` merged partial rows, ``arrange`` rows placed as they are stored (see ``rollup``)."""
    mins = SALES_ANY + (["mrp"] if spec.sales.unit_price else [])
    near = (JOINED,) if JOINED in lines.columns else ()
    counts = tuple(n for n in REJECTS.values() if n in lines.columns)
    keys = sorted(SALES_KEYS, key="itemid".__ne__)  # sorted by these: the item settles most comparisons
    out = rollup(lines, [*keys, *extra_keys], mins, SALES_SUM, final=final, states=states, near=near, arrange=arrange,
                 counts=counts)
    columns = [*state_order(sales_columns(spec), SALES_SUM, states or not final), *extra_keys]
    return out.select(*columns, *[c for c in out.columns if arrange and c not in columns])


def sales_report(feed: DataFrame, cities: DataFrame, catalogue: DataFrame,
                 spec: PlatformSpec, nulls: str = "default", partial: bool = False,
                 rejects: Observation | None = None, arrange: Arrange | None = None) -> DataFrame:
    """R1-R3. ``rejects``: see ``sales_lines``; its counts are there once the report has been computed. ``arrange``: see
    ``rollup``.

    ``nulls="strict"``: the NULL-keeping variant (R10's columns and rules).
    ``partial=True``: mergeable partial rows of one load (``rollup_sales`` merges them)."""
    if nulls == "strict":
        return rollup_strict(strict_sales_lines(feed, cities, catalogue, spec), STRICT_REDSHIFT_COLUMNS,
                             final=not partial, arrange=arrange)
    if nulls != "default":
        raise ValueError(f"nulls must be 'default' or 'strict', not {nulls!r}")
    if arrange is None or rejects is None:
        return rollup_sales(sales_lines(feed, cities, catalogue, spec, rejects=rejects), spec, final=not partial, arrange=arrange)
    # the rows may be computed once more to find where to place them: counts are taken after that
    out = rollup_sales(sales_lines(feed, cities, catalogue, spec, count_rejects=True), spec, arrange=arrange)
    seen = out.observe(rejects, *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in REJECTS.values()])
    return seen.drop(*REJECTS.values())


# ----------------------------------------------------------- strict variants
STRICT_REDSHIFT_COLUMNS = [
    "itemid", "brands_choice", "reportdate", "productid", "itemname", "category", "subcategory",
    "organizationid", "brand_internal_sku_code", "cogs", "margin", "tax_rate", "active", "brand",
    "qty", "mrp", "gmv", "net", "taxes_paid",
]
STRICT_STATES_COLUMNS = [
    "itemid", "brands_choice", "reportdate", "organizationid", "category", "subcategory",
    "itemname", "productid", "brand_internal_sku_code", "brand", "margin", "tax_rate", "cogs",
    "active", "qty", "mrp", "gmv", "net", "taxes_paid",
]
STRICT_KEYS = ["itemid", "brands_choice", "reportdate", "organizationid"]
STRICT_ANY = ["productid", "itemname", "category", "subcategory", "brand_internal_sku_code",
              "cogs", "margin", "tax_rate", "active", "brand", "mrp"]


def strict_sales_lines(feed: DataFrame, cities: DataFrame, catalogue: DataFrame,
                       spec: PlatformSpec, carry: tuple[str, ...] = ()) -> DataFrame:
    """No defaults: an unmatched SKU leaves margin, tax and therefore net NULL."""
    s = spec.sales
    e = enrich(feed, cities, catalogue, spec, city_col=s.city, item_col=s.item)
    margin = F.col(SKU + "margin")
    tax = to_double(F.col(SKU + "taxes"))
    gmv = F.col(s.gmv).cast("double")
    cols = {
        "itemid": F.col(s.item if spec.lower_sku else "_sku_key"),
        "brands_choice": F.col(CITY + "brands_choice"),
        "reportdate": F.to_date(F.col(s.date)),
        "organizationid": F.col("organizationId"),
        "productid": F.col(SKU + "productid"),
        "itemname": F.col(s.name),
        "category": F.col(SKU + "category"),
        "subcategory": F.col(SKU + "subcategory"),
        "brand_internal_sku_code": F.col(SKU + "brand_internal_sku_code"),
        "cogs": to_double(F.col(SKU + "cogs")),
        "margin": margin,
        "tax_rate": tax,
        "active": F.col(SKU + "active"),
        "brand": F.col(SKU + "brand"),
        "qty": F.col(s.qty).cast("double"),
        "mrp": unit_price(gmv, F.col(s.qty)),
        "gmv": gmv,
        "net": net_sales(gmv, margin, tax),
        "taxes_paid": taxes_paid(gmv, margin, tax),
        JOINED: F.col("organizationId"),
    }
    return e.select(*[c.alias(n) for n, c in cols.items()], *carry)


def rollup_strict(lines: DataFrame, columns: list[str], extra_keys: tuple[str, ...] = (),
                  final: bool = True, states: bool = False, arrange: Arrange | None = None) -> DataFrame:
    """Group strict lines or their states into rows; ``states=True`` gives mergeable states, ``arrange`` rows placed as
    they are stored (see ``rollup``)."""
    near = (JOINED,) if JOINED in lines.columns else ()
    out = rollup(lines, [*STRICT_KEYS, *extra_keys], STRICT_ANY, SALES_SUM, final=final, states=states, near=near, arrange=arrange)
    columns = [*state_order(columns, SALES_SUM, states or not final), *extra_keys]
    return out.select(*columns, *[c for c in out.columns if arrange and c not in columns])


def sales_strict(feed: DataFrame, cities: DataFrame, catalogue: DataFrame,
                 spec: PlatformSpec, arrange: Arrange | None = None) -> DataFrame:
    """The stored (Redshift) view; unit price = MIN(revenue / quantity). ``arrange``: see ``rollup``."""
    return rollup_strict(strict_sales_lines(feed, cities, catalogue, spec), STRICT_REDSHIFT_COLUMNS, arrange=arrange)


def sales_states(feed: DataFrame, cities: DataFrame, catalogue: DataFrame,
                 spec: PlatformSpec, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """The aggregate-state (ClickHouse) select: one row of states per key, sums as exact
    pairs. ``merge_states`` turns states of any number of loads into final rows."""
    lines = strict_sales_lines(feed, cities, catalogue, spec, extra_keys)
    return rollup_strict(lines, STRICT_STATES_COLUMNS, extra_keys, states=True)


def merge_states(states: DataFrame) -> DataFrame:
    """R11's final rows from its states."""
    return rollup_strict(states, STRICT_STATES_COLUMNS)
