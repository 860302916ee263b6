"""I8: live stock run rates as inventory snapshots arrive.

The reference computes the run rate with a window inside an insert-triggered view, which
only sees the inserted block (a daily load gets run rate 0). Here every micro-batch is
reduced to daily sums per series (a JVM hash aggregate with partial sums before the
shuffle, however many lines a series has) and added to an incremental inventory table.
The days the batch touched, and for each series the day after them, are then rated again
from the merged days and emitted. So days that arrive late, or in parts over several
batches, are merged in and the following day is corrected; nothing is dropped.

What a batch reads does not grow with the table's age: the sums of its series (a semi-join) in the months
from its own first one on, and the closing before (``plans.snapshots``), which holds the day
that the first of them compares with. A batch of current data reads the current month; one with
late days reads from their month on. The stream keeps the table that way itself: it closes
the month before as soon as a batch starts a new one, and merges the loads of the months after every
``compact_every`` batches.

An emission is written to its own ``batch_id`` folder; the newest one of a day counts.
A replayed batch rewrites its folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from .. import schemas
from ..functions.measures import depletion, state_columns
from ..operators.enrich import check_dimensions
from ..operators.inventory import INV_KEYS, INV_SERIES
from ..operators.rollup import rollup
from ..plans import tablelog
from ..plans.incremental import (BATCH, close_month, compact_months, held_months, partial_rows, partials_before,
                                 read_partials, write_batch)
from ..plans.snapshots import closing_before
from ..sources.report_io import MONTH
from ..specs import PlatformSpec
from ..windows import first_day
from .incremental import Dimensions, Source, _start

STOCK = ["backendinvqty", "total_quantity"]
RATES = [*STOCK, "run_rate_backend", "run_rate_total"]


def rated_days(spark: SparkSession, root: str, batch_id: int, months: list[int]) -> DataFrame:
    """Current rates of the days that load ``batch_id`` (of ``months``) touched and, per series, of the day after each."""
    state = tablelog.read_state(spark, root)
    columns = [*INV_KEYS, *(x for c in STOCK for x in state_columns(c))]
    mine = spark.read.parquet(f"{root.rstrip('/')}/batches").filter(F.col(MONTH).isin(*months) & (F.col(BATCH) == batch_id))
    parts = read_partials(spark, root, "inventory", (months[0], 999912), state, batch_id, new_load=batch_id)
    parts = parts.select(*columns, (~F.col("_new")).alias("_old"))
    if held_months(spark, root)[0] < months[0]:
        before = partials_before(spark, root, first_day(months[0]), state, batch_id)
        parts = parts.unionByName(before.select(*columns, F.lit(True).alias("_old")))
    parts = parts.join(mine.select(*INV_SERIES).distinct(), INV_SERIES, "left_semi")
    days = rollup(parts, INV_KEYS, ["_old"], STOCK, cluster_by=INV_SERIES)
    w = Window.partitionBy(*INV_SERIES).orderBy("reportdate")
    rated = days.select(
        *INV_KEYS, *STOCK, "_old", F.lag("_old", 1, True).over(w).alias("_old_before"),
        depletion(F.lag("backendinvqty", 1, 0.0).over(w), F.col("backendinvqty")).alias("run_rate_backend"),
        depletion(F.lag("total_quantity", 1, 0.0).over(w), F.col("total_quantity")).alias("run_rate_total"))
    return rated.filter("NOT (_old AND _old_before)").select(*INV_SERIES, "reportdate", *RATES)


def close_behind(spark: SparkSession, root: str, spec: PlatformSpec, months: list[int]) -> None:
    """Close the newest month before ``months`` unless it has been: batches of ``months`` then read no month before."""
    earlier = [m for m in held_months(spark, root) if m < months[0]]
    if earlier:
        closed = closing_before(tablelog.read_state(spark, root), months[0])
        if closed is None or closed < earlier[-1]:
            close_month(spark, root, spec, earlier[-1])


def run_rate_stream(spark: SparkSession, spec: PlatformSpec, feed_path: str, feed_schema: StructType | None,
                    cities: Source, catalogue: Source, root: str, checkpoint: str,
                    max_files_per_trigger: int | None = None, available_now: bool = True,
                    processing_time: str | None = None, check_dims: bool = False, compact_every: int = 20) -> StreamingQuery:
    """Start the stream; ``root`` gets the daily table (``days``) and the emissions (``live``)."""
    days = f"{root.rstrip('/')}/days"
    dims = Dimensions(cities, catalogue, spec)

    def each(batch: DataFrame, batch_id: int) -> None:
        c, k = dims.now()
        if check_dims:
            check_dimensions(c.rows, k.rows, spec)
        months = write_batch(partial_rows("inventory", batch, c, k, spec), days, "inventory", batch_id)
        if not months:  # no line with a date
            return
        close_behind(spark, days, spec, months)
        rated_days(spark, days, batch_id, months).write.mode("overwrite").parquet(
            f"{root.rstrip('/')}/live/{BATCH}={batch_id}")
        if batch_id % compact_every == compact_every - 1:
            compact_months(spark, days, "inventory", spec, 0, 999912)

    schema = feed_schema or schemas.feed_schema(spec.name, "inventory")   # declared, never inferred
    return _start(spark, feed_path, schema, each, checkpoint, max_files_per_trigger, available_now, processing_time)


def current_run_rates(spark: SparkSession, root: str) -> DataFrame:
    """The newest emission of every (series, day)."""
    rows = spark.read.parquet(f"{root.rstrip('/')}/live")
    keys = [*INV_SERIES, "reportdate"]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*RATES), BATCH).alias("_v"))
    return newest.select("organizationid", "itemid", "backendfacilityname", "reportdate", *[F.col("_v." + v).alias(v) for v in RATES])
