"""Named entry points: one function per report of the reference, plus the
incremental loads. Each is the shared builder with the marketplace's spec.

    from rollwise import reports
    df = reports.blinkit_sales_report(feed, cities, catalogue)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from .operators.fulfillment import daily_min_price, fulfillment_report
from .operators.inventory import inventory_report
from .operators.sales import sales_report, sales_states, sales_strict
from .specs import BLINKIT, INSTAMART, ZEPTO
from .streaming.incremental import stream_report
from .streaming.run_rate import run_rate_stream


# R1-R3 -------------------------------------------------------------------
def blinkit_sales_report(feed: DataFrame, cities: DataFrame, catalogue: DataFrame,
                         rejects: Observation | None = None) -> DataFrame:
    return sales_report(feed, cities, catalogue, BLINKIT, rejects=rejects)


def instamart_sales_report(feed: DataFrame, cities: DataFrame, catalogue: DataFrame,
                           rejects: Observation | None = None) -> DataFrame:
    return sales_report(feed, cities, catalogue, INSTAMART, rejects=rejects)


def zepto_sales_report(feed: DataFrame, cities: DataFrame, catalogue: DataFrame,
                       rejects: Observation | None = None) -> DataFrame:
    return sales_report(feed, cities, catalogue, ZEPTO, rejects=rejects)


# R4-R6 -------------------------------------------------------------------
def blinkit_inventory_report(feed: DataFrame, cities: DataFrame, catalogue: DataFrame,
                             last_snapshots: DataFrame | None = None) -> DataFrame:
    return inventory_report(feed, cities, catalogue, BLINKIT, last_snapshots)


def instamart_inventory_report(feed: DataFrame, cities: DataFrame, catalogue: DataFrame,
                               last_snapshots: DataFrame | None = None) -> DataFrame:
    return inventory_report(feed, cities, catalogue, INSTAMART, last_snapshots)


def zepto_inventory_report(feed: DataFrame, cities: DataFrame, catalogue: DataFrame,
                           last_snapshots: DataFrame | None = None) -> DataFrame:
    return inventory_report(feed, cities, catalogue, ZEPTO, last_snapshots)


# R7-R9 -------------------------------------------------------------------
def blinkit_fulfillment_report(feed: DataFrame, cities: DataFrame, catalogue: DataFrame) -> DataFrame:
    return fulfillment_report(feed, cities, catalogue, BLINKIT)


def instamart_fulfillment_report(feed: DataFrame, cities: DataFrame, catalogue: DataFrame) -> DataFrame:
    return fulfillment_report(feed, cities, catalogue, INSTAMART)


def zepto_fulfillment_report(feed: DataFrame, cities: DataFrame, catalogue: DataFrame,
                             sales_feed: DataFrame) -> DataFrame:
    """Priced from the Zepto sales feed's smallest daily price per SKU."""
    return fulfillment_report(feed, cities, catalogue, ZEPTO, daily_min_price(sales_feed, ZEPTO))


# R10-R11 -----------------------------------------------------------------
def blinkit_sales_strict(feed: DataFrame, cities: DataFrame, catalogue: DataFrame) -> DataFrame:
    return sales_strict(feed, cities, catalogue, BLINKIT)


def blinkit_sales_states(feed: DataFrame, cities: DataFrame, catalogue: DataFrame) -> DataFrame:
    return sales_states(feed, cities, catalogue, BLINKIT)


# I1-I3, I8 ---------------------------------------------------------------
_SPECS = {"blinkit": BLINKIT, "instamart": INSTAMART, "zepto": ZEPTO}


def incremental_sales(spark: SparkSession, marketplace: str, feed_path: str, feed_schema: StructType,
                      cities: DataFrame, catalogue: DataFrame, table: str, checkpoint: str,
                      **kw) -> StreamingQuery:
    return stream_report(spark, "sales", _SPECS[marketplace], feed_path, feed_schema, cities,
                         catalogue, table, checkpoint, **kw)


def incremental_inventory(spark: SparkSession, marketplace: str, feed_path: str, feed_schema: StructType,
                          cities: DataFrame, catalogue: DataFrame, table: str, checkpoint: str,
                          **kw) -> StreamingQuery:
    return stream_report(spark, "inventory", _SPECS[marketplace], feed_path, feed_schema, cities,
                         catalogue, table, checkpoint, **kw)


def incremental_fulfillment(spark: SparkSession, marketplace: str, feed_path: str,
                            feed_schema: StructType, cities: DataFrame, catalogue: DataFrame,
                            table: str, checkpoint: str, sales_feed: DataFrame | None = None,
                            **kw) -> StreamingQuery:
    return stream_report(spark, "fulfillment", _SPECS[marketplace], feed_path, feed_schema, cities,
                         catalogue, table, checkpoint, sales_feed=sales_feed, **kw)


def live_run_rates(spark: SparkSession, marketplace: str, feed_path: str, feed_schema: StructType,
                   cities: DataFrame, catalogue: DataFrame, out: str, checkpoint: str,
                   **kw) -> StreamingQuery:
    return run_rate_stream(spark, _SPECS[marketplace], feed_path, feed_schema, cities, catalogue,
                           out, checkpoint, **kw)
