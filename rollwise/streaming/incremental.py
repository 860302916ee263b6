"""The nine insert-triggered views as Structured Streaming jobs.

Each micro-batch of new feed files is enriched against the dimensions as they are at
that moment (a view's inserts join the tables of the moment), reduced to partial rows
and written to its own batch folders with overwrite. A replayed batch after a failure
rewrites the same folders, so the table is exactly-once without a transactional sink;
readers merge all batches (``plans.incremental``). The dimensions' keys are checked once per set of files
they are read from, not in every batch.

Zepto fulfillment prices its lines from the sales feed's smallest price per SKU and day. The sales stream
keeps these in a table of their own (``stream_prices``: partial minima by month); a batch of purchase orders
opens the months it has orders of. Lines are stored with the prices known when they arrived. A
sales row that arrives later can only lower a price: a read with the price table (``read_priced``) prices
every line anew, so that it equals the batch report in whatever order sales and orders came;
a read without it keeps the price of the line's arrival.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from .. import schemas
from ..functions.measures import yyyymm
from ..operators.enrich import Checked, check_dimensions, checked
from ..operators.fulfillment import daily_min_price, repriced
from ..operators.sales import reject_counts
from ..plans import files
from ..plans.incremental import held_months, merge_rows, partial_rows, read_merged, read_partials, write_batch
from ..specs import PlatformSpec, platform
from ..windows import DateWindow

#: A dimension or feed, or how to read it anew.
Source = DataFrame | Callable[[], DataFrame]


def current(source: Source) -> DataFrame:
    """The rows as they are now. A loader is called; a frame over files that were replaced
    since it was made would fail, so streams should be given loaders."""
    return source() if callable(source) else source


class Dimensions:
    """Both dimensions for the batches of a stream: read anew in each, and their keys checked again
    only when they come from other files than before (always, if Spark cannot tell the files). Runs of a stream that follow
    each other in one application may share one."""

    def __init__(self, cities: Source, catalogue: Source, spec: PlatformSpec):
        self.sources, self.spec = (cities, catalogue), spec
        self.seen: tuple | None = None

    def now(self) -> tuple[Checked, Checked]:
        c, k = (current(s) for s in self.sources)
        held = tuple(tuple(sorted(d.inputFiles())) for d in (c, k))
        if held != self.seen or not all(held):
            out = checked(c, k, self.spec)
            self.seen = held
            return out
        return Checked(c), Checked(k)


def prices_for(batch: DataFrame, spec: PlatformSpec, sales_feed: DataFrame) -> DataFrame:
    """Smallest daily prices of the SKUs and days the batch asks for, from the sales feed itself."""
    zs = platform("zepto")
    item, day = F.lower(F.col(zs.sales.item)), F.to_date(F.col(zs.sales.date))
    asked = _asked(batch, spec)
    sales = sales_feed.join(asked, (item == F.col("_sku")) & (day == F.col("_day")), "left_semi")
    return daily_min_price(sales, zs)


def _asked(batch: DataFrame, spec: PlatformSpec) -> DataFrame:
    s = spec.fulfillment
    return batch.select(F.lower(F.col(s.item).cast("string")).alias("_sku"), F.to_date(F.col(s.date)).alias("_day")).distinct()


def read_prices(spark: SparkSession, root: str, months: list[int] | None = None) -> DataFrame:
    """The smallest price of each SKU and day from a price table, only of these months."""
    rows = _price_rows(spark, root, months)
    return merge_rows(rows, "prices", platform("zepto"))


def _price_rows(spark: SparkSession, root: str, months: list[int] | None) -> DataFrame:
    if not files.has_data(spark, f"{root.rstrip('/')}/batches") or months == []:
        return spark.createDataFrame([], "sku string, orderdate date, mrp double")
    span = (min(months), max(months)) if months else None
    return read_partials(spark, root, "prices", span, only=months)


def stored_prices_for(batch: DataFrame, spec: PlatformSpec, root: str) -> DataFrame:
    """The batch's prices from the price table: the months of its orders are opened, no others."""
    spark, asked = batch.sparkSession, _asked(batch, spec)
    months = sorted(r["m"] for r in asked.select(yyyymm(F.col("_day")).alias("m")).distinct().collect() if r["m"])
    rows = _price_rows(spark, root, months)
    rows = rows.join(asked, (F.col("sku") == F.col("_sku")) & (F.col("orderdate") == F.col("_day")), "left_semi")
    return merge_rows(rows, "prices", platform("zepto"))


def read_priced(spark: SparkSession, root: str, price_root: str, spec: PlatformSpec,
                window: DateWindow | None = None) -> DataFrame:
    """The merged fulfillment report with the prices of now: the price of a line's SKU and day does not
    decide which line stands for a key, so it can be put in after the merge."""
    held = read_merged(spark, root, "fulfillment", spec, window)
    months = None
    if window is not None:
        first, last = window.months()
        months = [m for m in held_months(spark, price_root) if first <= m <= last]
    return repriced(held, read_prices(spark, price_root, months), spec)


def _start(spark: SparkSession, feed_path: str, schema: StructType, each: Callable[[DataFrame, int], None], checkpoint: str,
           max_files_per_trigger: int | None, available_now: bool, processing_time: str | None) -> StreamingQuery:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    w = reader.parquet(feed_path).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def stream_report(spark: SparkSession, kind: str, spec: PlatformSpec, feed_path: str,
                  feed_schema: StructType | None, cities: Source | Dimensions, catalogue: Source | None, root: str,
                  checkpoint: str, sales_feed: Source | None = None,
                  max_files_per_trigger: int | None = None, available_now: bool = True,
                  processing_time: str | None = None, check_dims: bool = False,
                  price_root: str | None = None,
                  on_rejects: Callable[[int, dict[str, int]], None] | None = None) -> StreamingQuery:
    """Start the incremental load of one report; returns the running query. The dimensions (or both of them in ``cities``)
    are read in every micro-batch; a duplicate key fails the batch. ``check_dims`` checks in every batch, also
    where the files are the same. Zepto fulfillment takes its prices from ``price_root``
    (``stream_prices``) or, without one, from ``sales_feed``. ``on_rejects`` is given each sales batch's id and its counts of
    COGS and TAXES texts that became 0, gathered by the batch's own write."""
    dims = cities if isinstance(cities, Dimensions) else Dimensions(cities, catalogue, spec)

    def each(batch: DataFrame, batch_id: int) -> None:
        c, k = dims.now()
        if check_dims:
            check_dimensions(c.rows, k.rows, spec)
        prices = None
        if kind == "fulfillment" and spec.fulfillment.unit_price is None:
            prices = (stored_prices_for(batch, spec, price_root) if price_root
                      else prices_for(batch, spec, current(sales_feed)))
        rejects = Observation() if on_rejects and kind == "sales" else None
        write_batch(partial_rows(kind, batch, c, k, spec, prices, rejects=rejects), root, kind, batch_id)
        if rejects:
            on_rejects(batch_id, reject_counts(rejects))

    schema = feed_schema or schemas.feed_schema(spec.name, kind)   # declared, never inferred
    return _start(spark, feed_path, schema, each, checkpoint, max_files_per_trigger, available_now, processing_time)


def stream_prices(spark: SparkSession, feed_path: str, feed_schema: StructType | None, root: str, checkpoint: str,
                  max_files_per_trigger: int | None = None, available_now: bool = True,
                  processing_time: str | None = None) -> StreamingQuery:
    """Start the incremental price table of the Zepto sales feed: per load the smallest price of each
    SKU and day, by month. ``compact_months(..., "prices", ...)`` keeps a month at one row per SKU and day."""
    spec = platform("zepto")

    def each(batch: DataFrame, batch_id: int) -> None:
        write_batch(daily_min_price(batch, spec), root, "prices", batch_id)

    return _start(spark, feed_path, feed_schema or schemas.feed_schema("zepto", "sales"), each, checkpoint,
                  max_files_per_trigger, available_now, processing_time)
