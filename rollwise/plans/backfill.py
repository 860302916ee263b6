"""Rebuild report months from the feeds, and refresh the stored strict view.

A backfill of a month range replaces exactly these months (also those left without rows),
so running it twice equals running it once, and it never adds on top of rows written by a
stream (each writes its own table, see ``plans.incremental``). Every job writes new versions and
ends in one log entry (``sources.report_io``): killed before, it has changed nothing.

An inventory rebuild of a range needs the last daily row of every series before the range (its
first run rate compares with it) and corrects the first row after it. Both come from edge
snapshots (``plans.snapshots``): a closing of the month before and an opening of the month after,
which the rebuild leaves behind for the next one; months between the range and the nearest
snapshot are read as well. The months that hold a row whose rate changes are rewritten with it.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..functions.measures import depletion, yyyymm
from ..operators.enrich import catalogue_dim, checked, city_dim
from ..operators.fulfillment import fulfillment_report
from ..operators.inventory import (INV_ANY, INV_KEYS, INV_SERIES, INV_SUM, INVENTORY_COLUMNS, daily_stock, inventory_lines,
                                   inventory_report, latest_before, of_series, with_run_rates)
from ..operators.rollup import Arrange
from ..operators.sales import reject_counts, sales_report, sales_strict
from ..sources.report_io import MONTH, MONTHS, arranged, current_rows, version_path, write_report, write_version
from ..specs import PlatformSpec
from ..windows import first_day, month_after, month_before, month_window
from . import tablelog
from .snapshots import (CLOSINGS, DAYS, OPENINGS, closing_before, drop_snapshots, first_rows, opening_after, snapshot_path,
                        write_snapshot)
from .tablelog import Section, State


def feed_date(kind: str, spec: PlatformSpec) -> str:
    return getattr(spec, kind).date


def build_report(kind: str, spec: PlatformSpec, feed: DataFrame, cities: DataFrame,
                 catalogue: DataFrame, prices: DataFrame | None = None,
                 last_snapshots: DataFrame | None = None, rejects: Observation | None = None,
                 arrange: Arrange | None = None) -> DataFrame:
    if kind == "sales":
        return sales_report(feed, cities, catalogue, spec, rejects=rejects, arrange=arrange)
    if kind == "inventory":
        return inventory_report(feed, cities, catalogue, spec, last_snapshots)
    if kind == "fulfillment":
        return fulfillment_report(feed, cities, catalogue, spec, prices)
    raise ValueError(kind)


DAILY = [*INV_KEYS, *INV_ANY, *INV_SUM]
#: What an opening holds of the first later row of a series.
STOCK = ["backendinvqty", "total_quantity"]
RATES = ["run_rate_backend", "run_rate_total"]


def _snapshot(spark: SparkSession, out: str, state: State, section: str, month: int) -> DataFrame:
    return spark.read.parquet(snapshot_path(out, section, month, state.section(section)[month]))


def last_rows(spark: SparkSession, out: str, state: State, month: int) -> DataFrame:
    """The last daily row of every series in the months before ``month``: the nearest closing and the months since."""
    c = closing_before(state, month)
    rows = current_rows(spark, out, state, (month_after(c) if c else 0, month_before(month))).select(*DAILY)
    if c is not None:
        rows = rows.unionByName(_snapshot(spark, out, state, CLOSINGS, c))
    return latest_before(rows, first_day(month))


def next_rows(spark: SparkSession, out: str, state: State, month: int) -> DataFrame:
    """The first row of every series in the months after ``month``, with its month: the nearest opening and the months before it."""
    columns = [*INV_SERIES, "reportdate", MONTH, *STOCK, *RATES]
    o = opening_after(state, month)
    rows = current_rows(spark, out, state, (month_after(month), month_before(o) if o else 999912)).select(*columns)
    if o is not None:
        rows = rows.unionByName(_snapshot(spark, out, state, OPENINGS, o).select(*columns))
    return first_rows(rows)


def _rebuild_inventory(spark: SparkSession, spec: PlatformSpec, feed: DataFrame, cities: DataFrame, catalogue: DataFrame,
                       out: str, months: tuple[int, int], partitions: int | None, base: State) -> None:
    first, last = months
    version = tablelog.new_version()
    before = month_before(first)
    seed = (_snapshot(spark, out, base, CLOSINGS, before) if before in base.section(CLOSINGS)
            else write_snapshot(last_rows(spark, out, base, first), out, CLOSINGS, before, version))
    # stored, so that the range's series are known when the seed is joined to them
    daily = write_snapshot(daily_stock(inventory_lines(feed, cities, catalogue, spec)), out, DAYS, last, version)
    new = write_version(with_run_rates(daily, of_series(seed, daily, "left_semi")), out, "inventory", version, partitions)
    # the seed has one row of each series: only those of the range's series give way to a later one
    rows = of_series(seed, daily, "left_anti").unionByName(latest_before(daily, first_day(month_after(last))).select(*DAILY))
    closing = write_snapshot(rows, out, CLOSINGS, last, version)
    # the first later row of a series follows the closing: its rates are worked out again
    prior = closing.select(*INV_SERIES, *[F.col(c).alias("_" + c) for c in STOCK])
    rate = lambda c: depletion(F.coalesce(F.col("_" + c), F.lit(0.0)), F.col(c))
    later = next_rows(spark, out, base, last).join(prior, INV_SERIES, "left")
    later = later.withColumns({"_rate_back": rate("backendinvqty"), "_rate_total": rate("total_quantity")})
    # a new series starts from no stock: both rates are 0 there, as is the formula
    moved = (F.col("_rate_back") != F.col("run_rate_backend")) | (F.col("_rate_total") != F.col("run_rate_total"))
    opening = write_snapshot(later.select(*INV_SERIES, "reportdate", MONTH, *STOCK, F.col("_rate_back").alias(RATES[0]),
                                          F.col("_rate_total").alias(RATES[1]), moved.alias("moved")),
                             out, OPENINGS, month_after(last), version)
    fixed = opening.filter("moved")
    where = sorted(r[MONTH] for r in fixed.select(MONTH).distinct().collect())  # at most all months
    if where:
        right = fixed.select(*INV_SERIES, "reportdate", *[F.col(c).alias("_" + c) for c in RATES])
        held = current_rows(spark, out, base, (where[0], where[-1])).filter(F.col(MONTH).isin(*where)).join(right, [*INV_SERIES, "reportdate"], "left")
        write_version(held.withColumns({c: F.coalesce("_" + c, c) for c in RATES}).select(*INVENTORY_COLUMNS), out,
                      "inventory", version, partitions)

    def change(sections: dict[str, Section]) -> None:
        held = sections.setdefault(MONTHS, {})
        for m in [m for m in held if first <= m <= last]:
            del held[m]
        held.update({m: [version] for m in (*new, *where)})
        drop_snapshots(sections, first, max([last, *where]))
        sections[CLOSINGS].update({last: version} | ({} if before in sections[CLOSINGS] else {before: version}))
        sections[OPENINGS][month_after(last)] = version

    # the snapshots rest on every month outside the range too
    tablelog.commit(spark, out, base, change, lambda now: tablelog.changed(base, now, MONTHS))


def backfill(spark: SparkSession, kind: str, spec: PlatformSpec, feed: DataFrame,
             cities: DataFrame, catalogue: DataFrame, out: str,
             months: tuple[int, int] | None = None, prices: DataFrame | None = None,
             partitions: int | None = None, check_dims: bool = True) -> dict[str, int]:
    """Recompute report months from the feed and replace them in ``out`` (the whole table
    without ``months``). ``check_dims``: fail on duplicate dimension keys first. ``tablelog.Conflict`` is raised, and
    nothing changed, if another job has meanwhile replaced what this one builds on. Returns the counts of
    COGS and TAXES texts that became 0 (``operators.sales.REJECTS``), gathered by the write; of other kinds none."""
    if check_dims:
        cities, catalogue = checked(cities, catalogue, spec)
    if months is not None:
        feed = feed.filter(month_window(*months).contains(F.to_date(F.col(feed_date(kind, spec)))))
        base = tablelog.read_state(spark, out)
        if kind == "inventory" and base.section(MONTHS):
            _rebuild_inventory(spark, spec, feed, cities, catalogue, out, months, partitions, base)
            return {}
    rejects = Observation() if kind == "sales" else None
    arrange = arranged(kind, partitions) if kind == "sales" else None
    write_report(build_report(kind, spec, feed, cities, catalogue, prices, rejects=rejects, arrange=arrange), out, kind, partitions=partitions,
                 months=months, overwrite_mode="dynamic" if months else "static")
    return reject_counts(rejects) if rejects else {}


def refresh_strict_view(spark: SparkSession, spec: PlatformSpec, feed: DataFrame,
                        cities: DataFrame, catalogue: DataFrame, out: str, check_dims: bool = True) -> None:
    """Rebuild the stored strict view as a whole."""
    if check_dims:
        cities, catalogue = checked(cities, catalogue, spec)
    write_report(sales_strict(feed, cities, catalogue, spec, arranged("sales_strict")), out, "sales_strict",
                 overwrite_mode="static")


# ------------------------------------------------------- refresh by change
#: The log's section: 0 -> [version of the list of feed files, fingerprint of the dimensions].
SOURCES = "sources"
_FILE = ["file_path", "file_size", "file_modification_time"]


def _files(rows: DataFrame, *more: Column) -> DataFrame:
    return rows.select(*[F.col(f"_metadata.{c}").alias(c) for c in _FILE], *more)


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """The parquet files below ``path``, by listing: none is opened."""
    return _files(spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
                  .option("recursiveFileLookup", "true").load(path))


def _fingerprint(cities: DataFrame, catalogue: DataFrame, spec: PlatformSpec) -> str:
    dims = (city_dim(cities, spec), catalogue_dim(catalogue, spec))
    totals = [d.agg(F.count("*"), F.bit_xor(F.xxhash64(*d.columns)), F.sum(F.xxhash64(*d.columns).cast("decimal(38,0)"))).first()
              for d in dims]
    return "/".join(":".join(str(x) for x in t) for t in totals)


def refresh_changed_months(spark: SparkSession, spec: PlatformSpec, feed_path: str, cities: DataFrame,
                           catalogue: DataFrame, out: str, feed_schema: StructType | None = None) -> list[int]:
    """I7 by change: bring the stored strict view up to date with the feed's files; returns the months rewritten.

    The table keeps a list of the feed files it was made from, with size, time and the months in each. Files that
    are new, changed or gone give the months to rewrite, and only files with rows of these months are read again.
    Other dimension rows than last time, or no list yet, rewrite everything. ``Conflict`` is raised, and nothing changed, if
    another job has meanwhile refreshed the table."""
    dimensions = checked(cities, catalogue, spec)
    base, version = tablelog.read_state(spark, out), tablelog.new_version()
    schema, date = feed_schema or schemas.feed_schema(spec.name, "sales"), spec.sales.date
    read = lambda *paths: spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)
    month = F.coalesce(yyyymm(F.to_date(F.col(date))), F.lit(0)).alias(MONTH)
    dims, known = _fingerprint(cities, catalogue, spec), base.section(SOURCES).get(0)
    root = f"{out.rstrip('/')}/_sources"
    whole = known is None or known[1] != dims
    paths = lambda rows: [unquote(r[0]) for r in rows.select("file_path").distinct().collect()]
    if whole:
        held, months = _files(read(feed_path), month).distinct(), None
    else:
        before, now = spark.read.parquet(f"{root}/{known[0]}"), _listed(spark, feed_path)
        gone = before.join(now, _FILE, "left_anti")
        new = paths(now.join(before, _FILE, "left_anti"))
        stay = before.join(now, _FILE, "left_semi")
        held = stay.unionByName(_files(read(*new), month).distinct()) if new else stay
        touched = gone.select(MONTH).unionByName(_files(read(*new), month).select(MONTH)) if new else gone.select(MONTH)
        months = sorted(r[MONTH] for r in touched.distinct().collect())
        if not new and not months:
            return []
    held.write.parquet(f"{root}/{version}")
    if whole:
        feed = read(feed_path)
    else:
        inside = paths(spark.read.parquet(f"{root}/{version}").filter(F.col(MONTH).isin(*months))) if months else []
        feed = (read(*inside) if inside else spark.createDataFrame([], schema)).withColumn("_m", month).filter(F.col("_m").isin(*months)).drop("_m")
    written = write_version(sales_strict(feed, *dimensions, spec, arranged("sales_strict")), out, "sales_strict", version)

    def change(sections: dict[str, Section]) -> None:
        old = sections.get(MONTHS, {})
        sections[MONTHS] = {m: v for m, v in old.items() if not whole and m not in months} | {m: [version] for m in written}
        sections[SOURCES] = {0: [version, dims]}

    tablelog.commit(spark, out, base, change, lambda now: tablelog.changed(base, now, MONTHS) + tablelog.changed(base, now, SOURCES))
    return written if whole else months

