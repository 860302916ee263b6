"""Mergeable partial tables and their merge and compaction.

A partial table holds rows of separate loads (micro-batches, feed splits) whose sums are
exact integer pairs and whose attributes are ``min`` / the smallest line, so merging is
the same aggregation again and any grouping of loads gives the same report.
Inventory partials are daily sums; the run-rate window runs only on the merged days (a
window inside one load would see a single day).

Layout of an incremental table at ``root``::

    root/batches/yyyymm=<m>/batch_id=<n>/     partial rows of load n in month m
    root/_loads/<n>.json                      load n is complete; its months
    root/compacted/yyyymm=<m>/version=<v>/    merged rows of month m
    root/_edges/closings/<c>/<v>/             inventory: the last daily row of each series up to month c
    root/_log/                                the table's state (``plans.tablelog``)

The log says per month which version holds its merged rows and up to which load (``through``); a
reader takes that version and the later complete loads. Both conditions are on partition columns,
so folders of other months, of older versions and of loads already merged are not
opened. A version is never overwritten: a compaction or backfill writes a new one and ends in
one log entry, so readers and a crash in between see the state before. Writers may
interleave: a compaction whose months were changed meanwhile merges again, a backfill that
another backfill of the same month overtook raises ``Conflict``; neither loses a load.

Closings (``plans.snapshots``) give a windowed inventory read its lag without the months before the
window. A closing knows the last load in it; later loads into its months are read beside it, and a
compaction that merges such loads writes the closing anew. ``vacuum`` deletes what the log no longer needs.
"""

from __future__ import annotations

import datetime as dt
import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.enrich import checked
from ..operators.fulfillment import daily_min_price, fulfillment_lines, representative_line
from ..operators.inventory import daily_stock, inventory_lines, latest_before, with_run_rates
from ..operators.sales import rollup_sales, sales_lines
from ..functions.measures import yyyymm
from ..sources.report_io import MONTH, date_column
from ..specs import PlatformSpec
from ..windows import DateWindow, first_day, month_after, month_window, months_between
from . import files, tablelog
from .snapshots import CLOSINGS, closing_before, snapshot_path, unused, write_snapshot
from .tablelog import Conflict, Section, State

KINDS = ("sales", "inventory", "fulfillment")
BATCH = "batch_id"
VERSION = "version"
#: The log's sections: month -> [version, through], month -> version of its last backfill.
MARKS, BACKFILLS = "months", "backfills"
#: How often a compaction starts again when others change its months meanwhile.
TRIES = 5


def partial_rows(kind: str, feed: DataFrame, cities: DataFrame, catalogue: DataFrame,
                 spec: PlatformSpec, prices: DataFrame | None = None,
                 extra_keys: tuple[str, ...] = (), rejects: Observation | None = None) -> DataFrame:
    """Partial rows of one load (``extra_keys``: feed columns kept as extra group keys; ``rejects``: see ``sales_lines``).
    Sales and inventory stop after the hash level of the rollup (one shuffle per
    load); the merge on read finishes it."""
    if kind == "sales":
        return rollup_sales(sales_lines(feed, cities, catalogue, spec, extra_keys, rejects), spec, extra_keys,
                            final=False)
    if kind == "inventory":
        return daily_stock(inventory_lines(feed, cities, catalogue, spec, extra_keys), extra_keys,
                           final=False)
    if kind == "fulfillment":
        return representative_line(fulfillment_lines(feed, cities, catalogue, spec, prices, extra_keys),
                                   spec, extra_keys)
    if kind == "prices":
        return daily_min_price(feed, spec)
    raise ValueError(kind)


def merge_rows(parts: DataFrame, kind: str, spec: PlatformSpec, states: bool = False) -> DataFrame:
    """Merge partial rows into one row per key (no run rates yet); ``states=True`` keeps sums
    as pairs, for writing back."""
    if kind == "sales":
        return rollup_sales(parts, spec, states=states)
    if kind == "inventory":
        return daily_stock(parts, states=states)
    if kind == "prices":
        return parts.groupBy("sku", "orderdate").agg(F.min("mrp").alias("mrp"))
    return representative_line(parts, spec, merging=True)


def merge_partials(parts: DataFrame, kind: str, spec: PlatformSpec,
                   last_snapshots: DataFrame | None = None) -> DataFrame:
    """I4: the final report from any set of partial rows."""
    merged = merge_rows(parts, kind, spec)
    return with_run_rates(merged, last_snapshots) if kind == "inventory" else merged


def split_merge(kind: str, feed: DataFrame, cities: DataFrame, catalogue: DataFrame,
                spec: PlatformSpec, parts: int = 4, prices: DataFrame | None = None) -> DataFrame:
    """Report computed as ``parts`` separate partials (feed split by a row hash) then
    merged: one scan, the split key is an extra group key of the partial aggregate."""
    split = feed.withColumn("_split", F.pmod(F.xxhash64(*feed.columns), F.lit(parts)))
    partial = partial_rows(kind, split, cities, catalogue, spec, prices, ("_split",)).drop("_split")
    return merge_partials(partial, kind, spec)


# ----------------------------------------------------------- table layout
def _folder(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _write_months(rows: DataFrame, path: str, kind: str, column: str, value: int) -> None:
    """Rows below ``path`` by month and ``column``, into folders that no other write has. The rebalance gives a month the files its
    size asks for, large months several."""
    out = rows.withColumn(MONTH, yyyymm(F.col(date_column(kind)))).withColumn(column, F.lit(value).cast("long"))
    out.hint("rebalance", MONTH).write.mode("append").partitionBy(MONTH, column).parquet(path)


def _written_months(spark: SparkSession, path: str, column: str, value: int) -> list[int]:
    """The months that have a folder ``column=value`` (rows without a date are in none)."""
    found = (p.split(f"{MONTH}=", 1)[1].split("/", 1)[0] for p in files.matching(spark, f"{path}/{MONTH}=*/{column}={value}"))
    return sorted(int(m) for m in found if m.isdigit())


def _load_mark(root: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/_loads/{batch_id:020d}.json"


def write_batch(rows: DataFrame, root: str, kind: str, batch_id: int) -> list[int]:
    """Write one load's partial rows and then its mark; replaying the same batch id replaces them. Loads are written in
    the order of their ids. Returns the load's months."""
    spark, path, batch_id = rows.sparkSession, _folder(root, "batches"), int(batch_id)
    mark = _load_mark(root, batch_id)
    files.delete(spark, mark)
    for old in files.matching(spark, f"{path}/{MONTH}=*/{BATCH}={batch_id}"):
        files.delete(spark, old)
    _write_months(rows, path, kind, BATCH, batch_id)
    months = _written_months(spark, path, BATCH, batch_id)
    files.create_text(spark, mark, json.dumps(months))
    return months


def last_load(spark: SparkSession, root: str) -> int:
    """The newest complete load, -1 if there is none."""
    marks = files.matching(spark, f"{root.rstrip('/')}/_loads/*.json")
    return int(marks[-1].rsplit("/", 1)[1].split(".")[0]) if marks else -1


def held_months(spark: SparkSession, root: str) -> list[int]:
    """The months that the table has folders of."""
    found = files.matching(spark, f"{_folder(root, 'batches')}/{MONTH}=*") + files.matching(
        spark, f"{_folder(root, 'compacted')}/{MONTH}=*")
    return sorted({int(m) for m in (p.rsplit("=", 1)[1] for p in found) if m.isdigit()})


def read_marks(spark: SparkSession, root: str) -> dict[int, tuple[int, int]]:
    """month -> (version, through) of the merged months."""
    return {m: tuple(v) for m, v in tablelog.read_state(spark, root).section(MARKS).items()}


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def _within(months: tuple[int, int] | None) -> Column:
    return F.col(MONTH).between(*months) if months else F.lit(True)


def _loads(spark: SparkSession, root: str, condition: Column) -> DataFrame | None:
    """Rows of the loads that meet a condition on month and load, with both columns."""
    path = _folder(root, "batches")
    return spark.read.parquet(path).filter(condition) if files.has_data(spark, path) else None


def _versions(spark: SparkSession, root: str, condition: Column) -> DataFrame | None:
    path = _folder(root, "compacted")
    return spark.read.parquet(path).filter(condition).drop(VERSION) if files.has_data(spark, path) else None


def _union(parts: list[DataFrame | None]) -> DataFrame:
    return reduce(DataFrame.unionByName, [p for p in parts if p is not None])


def read_partials(spark: SparkSession, root: str, kind: str, months: tuple[int, int] | None = None,
                  state: State | None = None, through: int | None = None, new_load: int | None = None,
                  only: list[int] | None = None) -> DataFrame:
    """All partial rows of the table (of months first..last, or of those in ``only``): the log's versions and later
    complete loads (up to ``through``). ``new_load`` adds a column ``_new``: whether the row is that load's."""
    state = state or tablelog.read_state(spark, root)
    through = last_load(spark, root) if through is None else through
    marks, inside = state.section(MARKS), _within(months)
    if months:
        marks = {m: v for m, v in marks.items() if months[0] <= m <= months[1]}
    if only is not None:
        marks = {m: v for m, v in marks.items() if m in only}
        inside = inside & F.col(MONTH).isin(*only)
    merged = _any([(F.col(MONTH) == m) & (F.col(VERSION) == v) for m, (v, _) in sorted(marks.items())])
    later = _any([(F.col(MONTH) == m) & (F.col(BATCH) > t) for m, (_, t) in sorted(marks.items())])
    unmarked = F.col(MONTH).isNull() | ~F.col(MONTH).isin(*marks) if marks else F.lit(True)
    held = _versions(spark, root, inside & merged)
    loads = _loads(spark, root, inside & (F.col(BATCH) <= through) & (unmarked | later))
    if held is None and loads is None:
        raise FileNotFoundError(f"no load has been written to {root}")
    if new_load is not None:
        held = None if held is None else held.withColumn("_new", F.lit(False))
        loads = None if loads is None else loads.withColumn("_new", F.col(BATCH) == new_load)
    return _union([held, None if loads is None else loads.drop(BATCH)]).drop(MONTH)


def partials_before(spark: SparkSession, root: str, start: dt.date, state: State | None = None,
                    through: int | None = None) -> DataFrame:
    """Inventory: partial rows that give the last daily row of every series before ``start``: the
    nearest closing, loads into its months since, and the months from there to the day before ``start``."""
    state = state or tablelog.read_state(spark, root)
    through = last_load(spark, root) if through is None else through
    eve = start - dt.timedelta(days=1)
    month = eve.year * 100 + eve.month
    c = closing_before(state, start.year * 100 + start.month)
    between = None
    if c is None or c < month:
        between = read_partials(spark, root, "inventory", (month_after(c) if c else 0, month), state, through).filter(
            F.col("reportdate") < F.lit(start))
    if c is None:
        return between
    version, upto = state.section(CLOSINGS)[c]
    late = _loads(spark, root, F.col(MONTH).between(0, c) & (F.col(BATCH) > upto) & (F.col(BATCH) <= through))
    closing = spark.read.parquet(snapshot_path(root, CLOSINGS, c, version))
    return _union([closing, None if late is None else late.drop(BATCH, MONTH), between])


def read_merged(spark: SparkSession, root: str, kind: str, spec: PlatformSpec,
                window: DateWindow | None = None) -> DataFrame:
    """The current report from the partial table, optionally for a date window (only the
    window's months are read).

    For inventory, the run rate of the window's first day needs the latest earlier day of each series: it comes
    from the months since the nearest closing (``partials_before``); later months are not read."""
    state, through = tablelog.read_state(spark, root), last_load(spark, root)
    if window is None:
        return merge_partials(read_partials(spark, root, kind, None, state, through), kind, spec)
    day, (first, last) = F.col(date_column(kind)), window.months()
    inside = read_partials(spark, root, kind, (first, last), state, through).filter(window.contains(day))
    if kind != "inventory":
        return merge_partials(inside, kind, spec)
    before = partials_before(spark, root, window.start, state, through)
    return merge_partials(inside, kind, spec, last_snapshots=latest_before(merge_rows(before, kind, spec), window.start))


def _last_loads(spark: SparkSession, root: str, months: tuple[int, int], through: int) -> dict[int, int]:
    """month -> its newest complete load, from the names of the folders."""
    out: dict[int, int] = {}
    for path in files.matching(spark, f"{_folder(root, 'batches')}/{MONTH}=*/{BATCH}=*"):
        month, load = (part.split("=", 1)[1] for part in path.rsplit("/", 2)[1:])
        if month.isdigit() and months[0] <= int(month) <= months[1] and int(load) <= through:
            out[int(month)] = max(out.get(int(month), -1), int(load))
    return out


def _closed(spark: SparkSession, root: str, spec: PlatformSpec, parts: DataFrame, month: int, version: int) -> None:
    """Write the closing of ``month`` from partial rows up to it."""
    merged = merge_rows(parts, "inventory", spec, states=True)
    write_snapshot(latest_before(merged, first_day(month_after(month))), root, CLOSINGS, month, version)


def close_month(spark: SparkSession, root: str, spec: PlatformSpec, month: int) -> None:
    """Inventory: write the closing of ``month``, from the nearest earlier one and the months since, unless the one there is
    holds every load (a backfill of its months takes it away)."""
    for _ in range(TRIES):
        base, through, version = tablelog.read_state(spark, root), last_load(spark, root), tablelog.new_version()
        if base.section(CLOSINGS).get(month, [0, None])[1] == through:  # a compaction has just written it
            return
        _closed(spark, root, spec, partials_before(spark, root, first_day(month_after(month)), base, through), month, version)

        def change(sections: dict[str, Section]) -> None:
            sections.setdefault(CLOSINGS, {})[month] = [version, through]
        try:
            tablelog.commit(spark, root, base, change, lambda now: [m for s in (MARKS, BACKFILLS) for m in tablelog.changed(
                base, now, s) if m <= month])
            return
        except Conflict:
            continue
    raise Conflict(f"{root}: months up to {month} keep changing")


def _compacted(spark: SparkSession, root: str, kind: str, spec: PlatformSpec, first_month: int, last_month: int) -> list[int]:
    base, through = tablelog.read_state(spark, root), last_load(spark, root)
    marks = base.section(MARKS)
    last = {m: b for m, b in _last_loads(spark, root, (first_month, last_month), through).items()
            if m not in marks or b > marks[m][1]}
    if not last:
        return []
    day = F.col(date_column(kind))
    held = _versions(spark, root, _any([(F.col(MONTH) == m) & (F.col(VERSION) == marks[m][0]) for m in sorted(last) if m in marks]))
    loads = _loads(spark, root, _any([(F.col(MONTH) == m) & (F.col(BATCH) <= b) & (F.col(BATCH) > (marks[m][1] if m in marks else -1))
                                      for m, b in sorted(last.items())]))
    parts = _union([held, None if loads is None else loads.drop(BATCH)]).filter(day.isNotNull()).drop(MONTH)
    version = tablelog.new_version()
    _write_months(merge_rows(parts, kind, spec, states=True), _folder(root, "compacted"), kind, VERSION, version)
    # closings beside which these loads were read take them in
    behind = {c: v for c, v in base.section(CLOSINGS).items() if any(m <= c and b > v[1] for m, b in last.items())}
    for c, (old, upto) in behind.items():
        late = _loads(spark, root, F.col(MONTH).between(0, c) & (F.col(BATCH) > upto) & (F.col(BATCH) <= through))
        _closed(spark, root, spec, spark.read.parquet(snapshot_path(root, CLOSINGS, c, old)).unionByName(late.drop(BATCH, MONTH)), c, version)

    def change(sections: dict[str, Section]) -> None:
        sections.setdefault(MARKS, {}).update({m: [version, b] for m, b in last.items()})
        held = sections.setdefault(CLOSINGS, {})
        for c in [c for c, v in held.items() if any(m <= c and b > v[1] for m, b in last.items())]:
            if held[c] == base.section(CLOSINGS).get(c):
                held[c] = [version, through]
            else:  # written meanwhile, without these loads
                del held[c]

    tablelog.commit(spark, root, base, change, lambda now: tablelog.changed(base, now, MARKS, last))
    return sorted(last)


def compact_months(spark: SparkSession, root: str, kind: str, spec: PlatformSpec,
                   first_month: int, last_month: int) -> list[int]:
    """I5 for a month range in one job: months with loads above their mark are merged with
    what their mark holds (also rows that came only through a backfill) into a new version.
    Returns these months.

    The last load of each month is fixed first, so loads landing meanwhile stay visible
    to readers as later loads. If another writer changes one of the months meanwhile, they are merged again."""
    for _ in range(TRIES):
        try:
            return _compacted(spark, root, kind, spec, first_month, last_month)
        except Conflict:
            continue
    raise Conflict(f"{root}: months {first_month} to {last_month} keep changing")


def compact_month(spark: SparkSession, root: str, kind: str, spec: PlatformSpec, month: int) -> None:
    """Merge one month's loads into a new version. Of inventory the month is closed too."""
    if compact_months(spark, root, kind, spec, month, month) and kind == "inventory":
        close_month(spark, root, spec, month)


def backfill_months(spark: SparkSession, root: str, kind: str, spec: PlatformSpec, feed: DataFrame,
                    cities: DataFrame, catalogue: DataFrame, months: tuple[int, int],
                    prices: DataFrame | None = None, check_dims: bool = True) -> None:
    """I6 into an incremental table: recompute months first..last (yyyymm) from the feed as
    their new version, superseding every load and version so far, also where the feed has
    no rows any more (the month is then empty). Of inventory the last month is closed again.

    Meant for closed months: rows of those months that a stream loads *after* this call
    (batch id above the mark) are added on top, so the feed read here must not contain them.
    ``Conflict`` is raised, and nothing changed, if another backfill has meanwhile replaced one of the months."""
    if check_dims:
        cities, catalogue = checked(cities, catalogue, spec)
    base, last = tablelog.read_state(spark, root), last_load(spark, root)
    day = F.to_date(F.col(getattr(spec, kind).date))
    inside = feed.filter(month_window(*months).contains(day))
    rows = merge_rows(partial_rows(kind, inside, cities, catalogue, spec, prices), kind, spec, states=True)
    version, through = tablelog.new_version(), months_between(*months)
    _write_months(rows, _folder(root, "compacted"), kind, VERSION, version)

    def change(sections: dict[str, Section]) -> None:
        sections.setdefault(MARKS, {}).update({m: [version, last] for m in through})
        sections.setdefault(BACKFILLS, {}).update(dict.fromkeys(through, version))
        sections[CLOSINGS] = {c: v for c, v in sections.get(CLOSINGS, {}).items() if c < months[0]}

    # a compaction that came between has merged what this version replaces, or loads after it, which stay in place
    tablelog.commit(spark, root, base, change, lambda now: tablelog.changed(base, now, BACKFILLS, through))
    if kind == "inventory":
        close_month(spark, root, spec, months[1])


def vacuum(spark: SparkSession, root: str) -> None:
    """Delete versions and closings that the log does not name and loads that are merged or superseded (no writer, and
    no reader of an older state, may be running)."""
    state = tablelog.read_state(spark, root)
    for month, (version, through) in state.section(MARKS).items():
        for name, column, gone in (("compacted", VERSION, lambda v: v != version), ("batches", BATCH, lambda b: b <= through)):
            for path in files.matching(spark, f"{_folder(root, name)}/{MONTH}={month}/{column}=*"):
                if gone(int(path.rsplit("=", 1)[1])):
                    files.delete(spark, path)
    for path in unused(spark, root, state, lambda v: v[0]):
        files.delete(spark, path)
    for path in files.matching(spark, f"{root.rstrip('/')}/_loads/*.json")[:-1]:
        files.delete(spark, path)
    tablelog.prune(spark, root)
