"""Month-partitioned, clustered, versioned report tables on parquet, and pruned reads.

Layout::

    <path>/version=<v>/yyyymm=<m>/part-*.parquet    rows of month m as write v left them
    <path>/_log/                                    which versions are the table (``plans.tablelog``)

A write goes to folders of its own and becomes the table by one log entry at its end: a job
that is killed before leaves the old table readable, and readers never see half a write. Before the write
the rows are range-partitioned on (month, table sort key) and sorted within each task,
so every file covers a narrow key range: parquet min/max statistics then skip
row groups for tenant and date predicates, and a month is spread over many
tasks instead of landing in one. A backfill of a month range replaces exactly these
months, also those that have no rows any more; one of the whole table replaces it. Which months a
write has rows of is read off its folders: the report is planned and run once. ``vacuum_report``
deletes what the log no longer names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.measures import yyyymm
from ..operators.enrich import SKU, catalogue_dim, dimension_rows
from ..operators.rollup import Arrange
from ..plans import files, tablelog
from ..plans.tablelog import Section, State
from ..specs import PlatformSpec
from ..windows import DateWindow

MONTH = "yyyymm"
VERSION = "version"
#: The log's section of a report table: month -> its versions.
MONTHS = "months"

# Date column and sort key of each report table (the tables' ORDER BY clauses).
LAYOUT = {
    "sales": ("reportdate", ["organizationid", "reportdate", "itemid"]),
    "sales_strict": ("reportdate", ["itemid", "reportdate"]),
    "inventory": ("reportdate", ["organizationid", "reportdate", "active", "backendfacilityname", "itemid"]),
    "fulfillment": ("orderdate", ["organizationid", "orderdate", "brands_choice", "ponumber",
                                  "po_status", "brand_internal_sku_code", "itemid"]),
    "prices": ("orderdate", ["sku", "orderdate"]),
}


def date_column(kind: str) -> str:
    return LAYOUT[kind][0]


def arranged(kind: str, partitions: int | None = None) -> Arrange:
    """Month column + range partitioning on the sort key, for rows that are still to be merged (``rollup``)."""
    def place(df: DataFrame) -> tuple[DataFrame, list[str]]:
        date, sort = LAYOUT[kind]
        out = df.withColumn(MONTH, F.coalesce(yyyymm(F.col(date)), F.lit(0)))  # rows without a date are month 0
        keys = [MONTH, *sort]
        return (out.repartitionByRange(partitions, *keys) if partitions else out.repartitionByRange(*keys)), keys
    return place


def clustered(df: DataFrame, kind: str, partitions: int | None = None) -> DataFrame:
    """Month column + range partitioning and in-task sort on the sort key. Rows that have been ``arranged`` have the
    month and stay where they are."""
    out = df if MONTH in df.columns else arranged(kind, partitions)(df)[0]
    return out.sortWithinPartitions(MONTH, *LAYOUT[kind][1])


def version_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{VERSION}={version}"


def write_version(df: DataFrame, path: str, kind: str, version: int, partitions: int | None = None,
                  max_records_per_file: int = 5_000_000) -> list[int]:
    """Write rows as version ``version`` of their months, not yet part of the table; returns the months written."""
    (clustered(df, kind, partitions).write.mode("append").option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(MONTH).parquet(version_path(path, version)))
    found = files.matching(df.sparkSession, f"{version_path(path, version)}/{MONTH}=*")
    return sorted(int(p.rsplit("=", 1)[1]) for p in found)


def write_report(df: DataFrame, path: str, kind: str, mode: str = "overwrite",
                 partitions: int | None = None, max_records_per_file: int = 5_000_000,
                 overwrite_mode: str = "dynamic", months: tuple[int, int] | None = None) -> None:
    """Write by column name, partitioned by month.

    With ``mode="overwrite"`` only the months present in ``df`` are replaced, and those of the range
    ``months`` that are not present are removed; ``overwrite_mode="static"`` replaces the whole
    table. ``mode="append"`` adds to the months. ``Conflict`` is raised, and nothing changed, if another
    writer has meanwhile replaced one of these months."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be 'overwrite' or 'append', not {mode!r}")
    spark = df.sparkSession
    base, version = tablelog.read_state(spark, path), tablelog.new_version()
    new = write_version(df, path, kind, version, partitions, max_records_per_file)

    def change(sections: dict[str, Section]) -> None:
        if overwrite_mode == "static" and mode == "overwrite":
            sections.clear()
        held = sections.setdefault(MONTHS, {})
        if mode == "append":
            held.update({m: [*held.get(m, []), version] for m in new})
            return
        if months:
            for m in [m for m in held if months[0] <= m <= months[1]]:
                del held[m]
        held.update({m: [version] for m in new})

    static = overwrite_mode == "static"
    mine = lambda now: {m for m in {*new, *now.section(MONTHS)} if static or m in new or (
        months and months[0] <= m <= months[1])}
    clashes = lambda now: [] if mode == "append" else tablelog.changed(base, now, MONTHS, mine(now))
    tablelog.commit(spark, path, base, change, clashes)


def current_rows(spark: SparkSession, path: str, state: State | None = None,
                 months: tuple[int, int] | None = None) -> DataFrame:
    """The table's rows (of months first..last) with their month. The log says which folders hold them: others are
    not listed, so that a read of few months does not depend on the table's size."""
    state = state or tablelog.read_state(spark, path)
    if not state.number:
        raise FileNotFoundError(f"no report has been written to {path}")
    by_version: dict[int, list[int]] = {}
    for m, versions in sorted(state.section(MONTHS).items()):
        for v in versions:
            by_version.setdefault(v, []).append(m)
    if months is None:
        folders = [version_path(path, v) for v in by_version]
        inside = F.lit(True)
    else:
        by_version = {v: [m for m in ms if months[0] <= m <= months[1]] for v, ms in by_version.items()}
        folders = [f"{version_path(path, v)}/{MONTH}={m}" for v, ms in by_version.items() for m in ms]
        inside = F.col(MONTH).between(*months)
    named = [F.col(MONTH).isin(*ms) & (F.col(VERSION) == v) for v, ms in by_version.items() if ms]
    if not folders:  # the columns of any version, and no row
        folders = files.matching(spark, f"{path.rstrip('/')}/{VERSION}=*")
    rows = spark.read.option("basePath", path).parquet(*folders)
    return rows.filter(inside & reduce(lambda a, b: a | b, named, F.lit(False))).drop(VERSION)


def vacuum_report(spark: SparkSession, path: str) -> None:
    """Delete versions that the log does not name (no writer, and no reader of an older state, may be running)."""
    held = {(v, m) for m, versions in tablelog.read_state(spark, path).section(MONTHS).items() for v in versions}
    for folder in files.matching(spark, f"{path.rstrip('/')}/{VERSION}=*/{MONTH}=*"):
        version, month = (int(part.split("=", 1)[1]) for part in folder.rsplit("/", 2)[1:])
        if (version, month) not in held:
            files.delete(spark, folder)
    for folder in files.matching(spark, f"{path.rstrip('/')}/{VERSION}=*"):
        if not files.matching(spark, f"{folder}/{MONTH}=*") and held:
            files.delete(spark, folder)
    tablelog.prune(spark, path)


#: The bucket of a row, as Spark counts it; not stored.
BUCKET = "_bucket"


def colocated(kind: str, buckets: int, key: str = "itemid") -> Arrange:
    """Rows by month and bucket, for rows that are still to be merged (``rollup``)."""
    def place(df: DataFrame) -> tuple[DataFrame, list[str]]:
        date, _ = LAYOUT[kind]
        out = df.withColumns({MONTH: yyyymm(F.col(date)), BUCKET: F.pmod(F.hash(key), F.lit(buckets))})
        return out.repartition(MONTH, BUCKET), [MONTH, BUCKET, key, date]
    return place


def write_colocated(df: DataFrame, table: str, path: str, kind: str, buckets: int,
                    key: str = "itemid") -> None:
    """The stored view's DISTKEY(itemid) / SORTKEY(itemid, date) as a bucketed table,
    so later joins and aggregations on the item read without a shuffle. A bucket of a month is one file: its rows are brought
    together first, unless they have been placed so (``colocated``)."""
    date, _ = LAYOUT[kind]
    rows = df if BUCKET in df.columns else colocated(kind, buckets, key)(df)[0]
    (rows.drop(BUCKET).write.mode("overwrite")
     .option("path", path).partitionBy(MONTH).bucketBy(buckets, key).sortBy(key, date)
     .saveAsTable(table))


def write_colocated_catalogue(catalogue: DataFrame, spec: PlatformSpec, table: str, path: str, buckets: int) -> None:
    """The catalogue bucketed by item as the view is (the same number of ``buckets``), columns as in the view."""
    rows = catalogue_dim(dimension_rows(catalogue), spec)
    names = {"key": "itemid", "org": "organizationid"}
    plain = [F.col(c).alias(names.get(c.removeprefix(SKU), c.removeprefix(SKU))) for c in rows.columns]
    placed = rows.select(*plain).repartition(buckets, "itemid")  # a bucket is one file
    (placed.write.mode("overwrite").option("path", path).bucketBy(buckets, "itemid").sortBy("itemid")
     .saveAsTable(table))


def with_catalogue_of_now(view: DataFrame, catalogue: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of the co-located view with the item's ``columns`` of the co-located catalogue, as ``<column>_now``: bucket to
    bucket, nothing is shuffled, unless the catalogue is small enough for Spark to broadcast.

    The item is the only join key, as the buckets are by item alone; the tenant is compared within an item (as many
    rows as tenants that list it), in a form that is not taken for a second key."""
    now = catalogue.select(F.col("itemid").alias("_item"), F.col("organizationid").alias("_tenant"),
                           *[F.col(c).alias(f"{c}_now") for c in columns])
    tenant = F.col("organizationid").isNotNull() & F.nullif("organizationid", "_tenant").isNull()
    return view.join(now, (F.col("itemid") == F.col("_item")) & tenant, "left").drop("_item", "_tenant")


def read_report(spark: SparkSession, path: str, kind: str, window: DateWindow | None = None) -> DataFrame:
    """Read a report; with a window, only its months (partition filter), and the date predicate is
    pushed to the parquet scan. Spark does not derive the month bound from the date
    predicate by itself, so both are added here."""
    if window is None:
        return current_rows(spark, path).drop(MONTH)
    df = current_rows(spark, path, months=window.months())
    return df.filter(window.contains(F.col(date_column(kind)))).drop(MONTH)
