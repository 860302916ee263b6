"""Derived measures (M1-M9) and the exact sum used for every money total.

All of these return ``Column`` expressions built from ``pyspark.sql.functions``
so they stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .defaults import PERCENT

# Sums are exact: a value is its whole part (a bigint) and its fraction in integer
# nano-units (a bigint below 1e9, rounded half-up from the double's exact fraction).
# Both are added as bigints, so a total does not depend on the order in which
# partitions, micro-batches or partial tables are added up: a merged incremental
# table equals the batch rollup bit for bit. Partial rows and partial tables keep the
# pair (columns ``<name>__whole`` and ``<name>__nano``); only the final rows of a
# report hold doubles.
#
# The pair has fixed width, so the aggregation stays a hash aggregate. Partial rows are
# carried (``carried``), so a group may have 9.2e9 rows per partial and as many
# partials; the whole parts may add up to 9.2e18. Anything beyond, and any NaN or
# infinite value, raises instead of giving a wrong total.
NANO = 1_000_000_000
LARGEST = 9.0e18
WHOLE, FRACTION = "__whole", "__nano"


def _finite(x: Column) -> Column:
    # NaN compares above every number, so it fails the bound as well
    message = F.concat(F.lit("cannot be summed exactly: "), x.cast("string"))
    return F.when(x.isNull() | (F.abs(x) < F.lit(LARGEST)), x).otherwise(F.raise_error(message).cast("double"))


def whole_part(x: Column) -> Column:
    """The largest integer not above a double (bigint)."""
    return F.floor(_finite(x.cast("double"))).cast("bigint")


def nano_part(x: Column) -> Column:
    """What a double exceeds that integer by, in 1e-9, rounded half-up (0 to 1e9)."""
    d = x.cast("double")
    return F.floor((d - F.floor(d).cast("double")) * F.lit(float(NANO)) + F.lit(0.5)).cast("bigint")


def state_columns(name: str) -> list[str]:
    """The columns that hold the exact sum ``name`` in partial rows."""
    return [name + WHOLE, name + FRACTION]


def sum_states(name: str, from_states: bool) -> list[Column]:
    """Aggregates of the pair of ``name``, over its values or over pairs."""
    whole, nano = state_columns(name)
    x = F.col(name)
    parts = (F.col(whole), F.col(nano)) if from_states else (whole_part(x), nano_part(x))
    return [F.sum(parts[0]).alias(whole), F.sum(parts[1]).alias(nano)]


def carried(whole: Column, nano: Column) -> tuple[Column, Column]:
    """The same pair with a fraction below 1."""
    rest = F.pmod(nano, F.lit(NANO).cast("bigint"))
    # a multiple of 1e9 of at most 9.2e9 units: the nearest integer of the quotient is exact
    over = F.rint((nano - rest).cast("double") / F.lit(float(NANO))).cast("bigint")
    return whole + over, rest


def state_total(whole: Column, nano: Column) -> Column:
    """The pair as a double (one rounding of each part)."""
    w, n = carried(whole, nano)
    return w.cast("double") + n.cast("double") / F.lit(float(NANO))


def exact_sum(x: Column) -> Column:
    """Order-independent sum of a double column (NULLs skipped, NULL if none)."""
    return state_total(F.sum(whole_part(x)), F.sum(nano_part(x)))


def zero_if_null(x: Column) -> Column:
    return F.coalesce(x, F.lit(0.0))


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields NULL for a zero divisor instead of failing (ANSI)."""
    return F.try_divide(num, den)


def net_sales(gmv: Column, margin_pct: Column, tax_pct: Column) -> Column:
    """M1: gmv * (1 - margin/100) / (1 + tax/100)."""
    return safe_div(gmv * (F.lit(1) - margin_pct / F.lit(PERCENT)), F.lit(1) + tax_pct / F.lit(PERCENT))


def taxes_paid(gmv: Column, margin_pct: Column, tax_pct: Column) -> Column:
    """M2: net_sales * tax/100."""
    return net_sales(gmv, margin_pct, tax_pct) * (tax_pct / F.lit(PERCENT))


def platform_margin_row(gmv: Column, margin_pct: Column) -> Column:
    """M3 per row: gmv * coalesce(margin, 0) / 100 (summed by the caller)."""
    return gmv * F.coalesce(margin_pct, F.lit(0.0)) / F.lit(float(PERCENT))


def unit_price(revenue: Column, quantity: Column) -> Column:
    """M4: line revenue / quantity, NULL when the quantity is zero or NULL."""
    return safe_div(revenue.cast("double"), quantity.cast("double"))


def fill_rate(ordered: Column, remaining: Column) -> Column:
    """M5: 1 - remaining/ordered; 0 when nothing was ordered."""
    o = zero_if_null(ordered).cast("double")
    r = zero_if_null(remaining).cast("double")
    return F.coalesce(F.lit(1.0) - safe_div(r, F.nullif(o, F.lit(0.0))), F.lit(0.0))


def received_quantity(ordered: Column, remaining: Column) -> Column:
    """M6: ordered - remaining, NULLs as zero."""
    return (zero_if_null(ordered) - zero_if_null(remaining)).cast("double")


def depletion(previous: Column, current: Column) -> Column:
    """Stock that left since the previous snapshot, never negative."""
    return F.greatest(previous - current, F.lit(0.0))


def po_amount(price: Column, ordered: Column) -> Column:
    """M9: price x ordered, NULLs as zero."""
    return zero_if_null(price).cast("double") * zero_if_null(ordered).cast("double")


def to_double(text: Column) -> Column:
    """Numeric text from a dimension (COGS, TAXES) as double; bad text -> NULL."""
    return text.try_cast("double")


def rejected(text: Column) -> Column:
    """Whether a text is there but is no number (``to_double`` drops it)."""
    return text.isNotNull() & to_double(text).isNull()


def yyyymm(d: Column) -> Column:
    """Month partition value of a date, e.g. 199802."""
    return (F.year(d) * 100 + F.month(d)).cast("int")
