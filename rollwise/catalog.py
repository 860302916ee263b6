"""Named queries over a TESTDATA folder: each builds feeds from the given tables
and runs one report, dashboard or job. Used by ``__spark_entry__`` and the bench."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from .operators import dashboard as D
from .operators.enrich import checked, checked_keys
from .operators.fulfillment import daily_min_price, fulfillment_report
from .operators.inventory import inventory_report
from .operators.rollup import Arrange
from .operators.sales import (STRICT_REDSHIFT_COLUMNS, STRICT_STATES_COLUMNS, merge_states, sales_report,
                              sales_states, sales_strict)
from .plans import files
from .plans.backfill import backfill, refresh_changed_months, refresh_strict_view
from .plans.incremental import (KINDS, backfill_months, close_month, compact_month, compact_months, partial_rows,
                                read_merged, split_merge, write_batch)
from .session import apply_conf, scratch_path, unsorted_write
from .sources import fixtures as fx
from .sources.report_io import (colocated, read_report, with_catalogue_of_now, write_colocated,
                                write_colocated_catalogue)
from .streaming.incremental import Dimensions, read_prices, read_priced, stream_prices, stream_report
from .streaming.run_rate import current_run_rates, run_rate_stream
from .specs import platform
from .windows import DateWindow

# Parameters of the dashboard checks (one tenant, the reference's windows moved
# into the years the test data covers).
ORG, WINDOW, WINDOW_D8, WINDOW_D9 = O.ORG, O.WINDOW, O.WINDOW_D8, O.WINDOW_D9
FEB = (199802, 199802)
MARKETPLACES = ("blinkit", "instamart", "zepto")
LOADS = 3

Query = Callable[[SparkSession, str], DataFrame]


def dims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return fx.city_mapping(spark, sf_dir), fx.catalogue(spark, sf_dir)


def build_sales(spark: SparkSession, sf_dir: str, mkt: str) -> DataFrame:
    apply_conf(spark)
    cities, cat = dims(spark, sf_dir)
    return sales_report(fx.sales_feed(spark, sf_dir, mkt), cities, cat, platform(mkt))


def _strict(spark: SparkSession, sf_dir: str, arrange: Arrange | None = None) -> DataFrame:
    apply_conf(spark)
    return sales_strict(fx.sales_feed(spark, sf_dir, "blinkit"), *dims(spark, sf_dir), platform("blinkit"), arrange)


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of four loads (the feed split by a row hash), merged to final rows."""
    apply_conf(spark)
    feed = fx.sales_feed(spark, sf_dir, "blinkit")
    feed = feed.withColumn("_load", F.pmod(F.xxhash64(*feed.columns), F.lit(4)))
    return merge_states(sales_states(feed, *dims(spark, sf_dir), platform("blinkit"), ("_load",)).drop("_load"))


_stored: dict[tuple[str, str], str] = {}


def stored_sales(spark: SparkSession, sf_dir: str, window: DateWindow | None = None) -> DataFrame:
    """The Blinkit sales report as a table (written once per application and folder), as
    the dashboards read it: only the window's months."""
    apply_conf(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        out = scratch_path(spark, "dashboards", "blinkit_sales")
        backfill(spark, "sales", platform("blinkit"), fx.sales_feed(spark, sf_dir, "blinkit"), *dims(spark, sf_dir), out)
        _stored[key] = out
    return read_report(spark, _stored[key], "sales", window)


def _dash(fn, window: DateWindow | None = None, reads: DateWindow | None = None) -> Query:
    """A dashboard on the stored table; ``reads``: the window whose months it needs, if another."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        report = stored_sales(spark, sf_dir, reads or window)
        return fn(report, ORG, window) if window is not None else fn(report, ORG)
    return q


def _d8_from_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D8 straight from the feed, in one plan."""
    return D.city_sales(build_sales(spark, sf_dir, "blinkit"), ORG, WINDOW_D8)


def _d2(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_conf(spark)
    return D.subcategory_list(fx.catalogue(spark, sf_dir), ORG)


def _d13(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_conf(spark)
    return D.daily_target(fx.revenue_targets(spark, sf_dir), ORG, "blinkit", WINDOW)


def _sales(mkt: str) -> Query:
    return lambda spark, sf_dir: build_sales(spark, sf_dir, mkt)


def build_inventory(spark: SparkSession, sf_dir: str, mkt: str) -> DataFrame:
    apply_conf(spark)
    cities, cat = dims(spark, sf_dir)
    return inventory_report(fx.inventory_feed(spark, sf_dir, mkt), cities, cat, platform(mkt))


def build_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_conf(spark)
    return daily_min_price(fx.sales_feed(spark, sf_dir, "zepto"), platform("zepto"))


def build_fulfillment(spark: SparkSession, sf_dir: str, mkt: str) -> DataFrame:
    apply_conf(spark)
    cities, cat = dims(spark, sf_dir)
    prices = build_prices(spark, sf_dir) if mkt == "zepto" else None
    return fulfillment_report(fx.fulfillment_feed(spark, sf_dir, mkt), cities, cat, platform(mkt), prices)


def queries() -> dict[str, Query]:
    previous = WINDOW.shift_months(-1)
    q: dict[str, Query] = {
        "r1_blinkit_sales_report": _sales("blinkit"),
        "r2_instamart_sales_report": _sales("instamart"),
        "r3_zepto_sales_report": _sales("zepto"),
        "r4_blinkit_inventory_report": lambda s, d: build_inventory(s, d, "blinkit"),
        "r5_instamart_inventory_report": lambda s, d: build_inventory(s, d, "instamart"),
        "r6_zepto_inventory_report": lambda s, d: build_inventory(s, d, "zepto"),
        "r7_blinkit_fulfillment_report": lambda s, d: build_fulfillment(s, d, "blinkit"),
        "r8_instamart_fulfillment_report": lambda s, d: build_fulfillment(s, d, "instamart"),
        "r9_zepto_fulfillment_report": lambda s, d: build_fulfillment(s, d, "zepto"),
        "m8_daily_min_price": build_prices,
        "r10_blinkit_sales_strict": _strict,
        "r11_blinkit_sales_states": _states,
        "d1_brand_daily_sales": _dash(D.brand_daily_sales, WINDOW),
        "d2_subcategory_list": _d2,
        "d3_item_pnl": _dash(D.item_pnl, WINDOW),
        "d4_item_pnl_previous_month": _dash(D.item_pnl_previous_month, WINDOW, previous),
        "d5_city_list": _dash(D.city_list),
        "d6_city_category_totals": _dash(D.city_category_totals, WINDOW),
        "d7_city_category_daily": _dash(D.city_category_daily, WINDOW),
        "d8_city_sales": _dash(D.city_sales, WINDOW_D8),
        "d8_city_sales_from_feed": _d8_from_feed,
        "d9_city_sales_comparison": _dash(D.city_sales_comparison, WINDOW_D9),
        "d10_item_sales": _dash(D.item_sales, WINDOW_D8),
        "d11_daily_category_totals": _dash(D.daily_category_totals, WINDOW),
        "d12_daily_category_totals_previous_month": _dash(D.daily_category_totals_previous_month, WINDOW, previous),
        "d13_daily_target": _d13,
    }
    q.update((k, f) for k, (f, _) in jobs().items())
    return q


def oracle_sql() -> dict[str, str]:
    sql = {f"r{i + 1}_{m}_sales_report": O.sales_report(m) for i, m in enumerate(MARKETPLACES)}
    sql |= {f"r{i + 4}_{m}_inventory_report": O.inventory_report(m) for i, m in enumerate(MARKETPLACES)}
    sql |= {f"r{i + 7}_{m}_fulfillment_report": O.fulfillment_report(m) for i, m in enumerate(MARKETPLACES)}
    sql |= {
        "m8_daily_min_price": O.daily_min_price(),
        "r10_blinkit_sales_strict": O.strict_sales(STRICT_REDSHIFT_COLUMNS),
        "r11_blinkit_sales_states": O.strict_sales(STRICT_STATES_COLUMNS),
    }
    sql |= O.dashboards()
    sql["d8_city_sales_from_feed"] = sql["d8_city_sales"]
    sql.update((k, text) for k, (_, text) in jobs().items())
    return sql


# ------------------------------------------------------- tables and streams
# These run a job into a fresh folder below the shared checkpoint root and
# return the table read back, so the check compares what a reader would see.
def _inputs(spark: SparkSession, sf_dir: str, kind: str, mkt: str):
    apply_conf(spark)
    cities, cat = dims(spark, sf_dir)
    feed = fx.feed(spark, sf_dir, kind, mkt)
    prices = build_prices(spark, sf_dir) if (kind == "fulfillment" and mkt == "zepto") else None
    return feed, cities, cat, prices


def _staged(feed: DataFrame, path: str) -> DataFrame:
    """The feed as files (the production shape)."""
    feed.write.parquet(path)
    return feed.sparkSession.read.parquet(path)


def _staged_loads(feed: DataFrame, path: str, loads: int) -> list[DataFrame]:
    """The feed as files, those of each load in a folder of its own, so that a load reads its own rows."""
    with unsorted_write(feed.sparkSession):
        feed.withColumn("_load", _load(feed, loads)).write.partitionBy("_load").parquet(path)
    staged = feed.sparkSession.read.schema(feed.withColumn("_load", F.lit(0)).schema).parquet(path)
    return [staged.filter(F.col("_load") == i).drop("_load") for i in range(loads)]


def _arrive(rows: DataFrame, staged: str, load: int, feed: str) -> None:
    """The files of a staged load move into the feed's folder, not written again (those of different loads bear the same names);
    a load without rows arrives as an empty file."""
    spark = rows.sparkSession
    found = files.matching(spark, f"{staged}/_load={load}/*.parquet")
    for path in found:
        files.move(spark, path, f"{feed}/load-{load}-{path.rsplit('/', 1)[1]}")
    if not found:
        rows.write.mode("append").parquet(feed)


def _load(feed: DataFrame, loads: int) -> Column:
    """The load a row arrives with: by a hash of the row, so every day is spread over all loads."""
    return F.pmod(F.xxhash64(*feed.columns), F.lit(loads))


def _dimensions(spark: SparkSession, sf_dir: str, mkt: str) -> Dimensions:
    return Dimensions(lambda: fx.city_mapping(spark, sf_dir), lambda: fx.catalogue(spark, sf_dir), platform(mkt))


def _in_feb(feed_date: str) -> Column:
    return F.to_date(F.col(feed_date)).between(F.lit(WINDOW.start.replace(day=1)), F.lit(WINDOW.end))


def _split_merge(kind: str, mkt: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        feed, cities, cat, prices = _inputs(spark, sf_dir, kind, mkt)
        return split_merge(kind, feed, cities, cat, platform(mkt), 4, prices)
    return q


def _backfill_roundtrip(kind: str, mkt: str) -> Query:
    """Backfill all months, rebuild Feb-Mar 1998 again (idempotent), read the table back."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        feed, cities, cat, prices = _inputs(spark, sf_dir, kind, mkt)
        cities, cat = checked(cities, cat, platform(mkt))
        out = scratch_path(spark, "backfill", f"{mkt}_{kind}")
        backfill(spark, kind, platform(mkt), feed, cities, cat, out, prices=prices)
        backfill(spark, kind, platform(mkt), feed, cities, cat, out, months=(199802, 199803), prices=prices)
        return read_report(spark, out, kind)
    return q


def _rebuild_changed_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table built while Feb 1998 had other stock, then Feb rebuilt from the true feed: later
    months' first run rates must follow."""
    feed, cities, cat, _ = _inputs(spark, sf_dir, "inventory", "blinkit")
    s = platform("blinkit").inventory
    wrong = feed.withColumn(s.backend, F.when(_in_feb(s.date), F.col(s.backend) * 2 + 500).otherwise(F.col(s.backend)))
    cities, cat = checked(cities, cat, platform("blinkit"))
    out = scratch_path(spark, "rebuild", "changed")
    backfill(spark, "inventory", platform("blinkit"), wrong, cities, cat, out)
    backfill(spark, "inventory", platform("blinkit"), feed, cities, cat, out, months=FEB)
    return read_report(spark, out, "inventory")


def _rebuild_emptied_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feb 1998 rebuilt from a feed that has no row of it any more."""
    feed, cities, cat, _ = _inputs(spark, sf_dir, "sales", "instamart")
    spec = platform("instamart")
    out = scratch_path(spark, "rebuild", "emptied")
    backfill(spark, "sales", spec, feed, cities, cat, out)
    backfill(spark, "sales", spec, feed.filter(~_in_feb(spec.sales.date)), cities, cat, out, months=FEB)
    return read_report(spark, out, "sales")


def _refresh_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed, cities, cat, _ = _inputs(spark, sf_dir, "sales", "blinkit")
    out = scratch_path(spark, "strict_view")
    refresh_strict_view(spark, platform("blinkit"), feed, cities, cat, out)
    refresh_strict_view(spark, platform("blinkit"), feed, cities, cat, out)
    return read_report(spark, out, "sales_strict")


def _colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strict view as a bucketed table, read back."""
    name = "rollwise_strict_" + scratch_path(spark).rsplit("/", 1)[1]
    write_colocated(_strict(spark, sf_dir, colocated("sales_strict", 16)), name, scratch_path(spark, "colocated"), "sales_strict", buckets=16)
    return spark.table(name).select(*STRICT_REDSHIFT_COLUMNS)


#: Catalogue columns that the co-located join looks up anew.
NOW = ["category", "brand", "margin"]


def _colocated_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strict view and the catalogue, both bucketed by item, joined bucket to bucket."""
    unique = scratch_path(spark).rsplit("/", 1)[1]
    view, items = f"rollwise_view_{unique}", f"rollwise_catalogue_{unique}"
    write_colocated(_strict(spark, sf_dir, colocated("sales_strict", 16)), view, scratch_path(spark, "colocated_view"), "sales_strict", buckets=16)
    write_colocated_catalogue(fx.catalogue(spark, sf_dir), platform("blinkit"), items, scratch_path(spark, "colocated_catalogue"), buckets=16)
    joined = with_catalogue_of_now(spark.table(view), spark.table(items), NOW)
    return joined.select("organizationid", "itemid", "reportdate", "brands_choice", "gmv", *[f"{c}_now" for c in NOW])


def _refresh_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strict view made from the feed's files while Feb and Mar 1998 were not there yet, then refreshed twice: with their
    files (these months alone are rewritten) and with nothing new."""
    feed, cities, cat, _ = _inputs(spark, sf_dir, "sales", "blinkit")
    base, spec = scratch_path(spark, "strict_by_change"), platform("blinkit")
    feed = _staged(feed, base + "/staged")
    late = F.to_date(F.col(spec.sales.date)).between(F.lit(DateWindow("1998-02-01", "1998-03-31").start),
                                                     F.lit(DateWindow("1998-02-01", "1998-03-31").end))
    refresh = lambda: refresh_changed_months(spark, spec, base + "/feed", cities, cat, base + "/view", feed.schema)
    feed.filter(~late).write.mode("append").parquet(base + "/feed")
    refresh()
    feed.filter(late).write.mode("append").parquet(base + "/feed")
    again, nothing = refresh(), refresh()
    if again != [199802, 199803] or nothing:
        raise RuntimeError(f"months rewritten: {again}, {nothing}")
    return read_report(spark, base + "/view", "sales_strict")


def _price_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Zepto sales feed in three loads, streamed into the price table, merged in part, read."""
    feed, _, _, _ = _inputs(spark, sf_dir, "sales", "zepto")
    base = scratch_path(spark, "prices")
    for i, rows in enumerate(_staged_loads(feed, base + "/staged", LOADS)):
        _arrive(rows, base + "/staged", i, base + "/feed")
        stream_prices(spark, base + "/feed", rows.schema, base + "/table", base + "/checkpoint").awaitTermination()
        if i == 1:
            compact_months(spark, base + "/table", "prices", platform("zepto"), 199601, 199712)
    return read_prices(spark, base + "/table")


def _compacted(kind: str, mkt: str) -> Query:
    """Three loads, two months compacted, a fourth load, merged read."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        feed, cities, cat, prices = _inputs(spark, sf_dir, kind, mkt)
        spec = platform(mkt)
        cities, cat = checked_keys(cities, cat, spec)
        root = scratch_path(spark, "partials", f"{mkt}_{kind}")
        for i, rows in enumerate(_staged_loads(feed, root + "/feed", LOADS + 1)):
            write_batch(partial_rows(kind, rows, cities, cat, spec, prices), root, kind, i)
            if i == LOADS - 1:
                for month in (199802, 199601):
                    compact_month(spark, root, kind, spec, month)
        return read_merged(spark, root, kind, spec)
    return q


def _merged_window(kind: str, mkt: str) -> Query:
    """Loads, one earlier month compacted, merged read of a window (the lag of its first day seeded)."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        feed, cities, cat, prices = _inputs(spark, sf_dir, kind, mkt)
        spec = platform(mkt)
        cities, cat = checked_keys(cities, cat, spec)
        root = scratch_path(spark, "window", f"{mkt}_{kind}")
        for i, rows in enumerate(_staged_loads(feed, root + "/feed", LOADS)):
            write_batch(partial_rows(kind, rows, cities, cat, spec, prices), root, kind, i)
        compact_month(spark, root, kind, spec, 199801)
        return read_merged(spark, root, kind, spec, WINDOW)
    return q


def _closed_window(mkt: str) -> Query:
    """Inventory loads, a month closed after the second, the third load late for it, a compaction that takes in
    what the closing lacks, merged read of the window after: the window's months and one closing are opened."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        feed, cities, cat, _ = _inputs(spark, sf_dir, "inventory", mkt)
        spec = platform(mkt)
        cities, cat = checked_keys(cities, cat, spec)
        root = scratch_path(spark, "closed_window", mkt)
        for i, rows in enumerate(_staged_loads(feed, root + "/feed", LOADS)):
            write_batch(partial_rows("inventory", rows, cities, cat, spec), root, "inventory", i)
            if i == 1:
                close_month(spark, root, spec, 199801)
        compact_months(spark, root, "inventory", spec, 199701, 199712)
        return read_merged(spark, root, "inventory", spec, WINDOW)
    return q


def _backfill_into_stream_table(kind: str, mkt: str, compact: bool) -> Query:
    """Loads for everything but part of Feb 1998, Feb 1998 backfilled from the whole feed
    (superseding its earlier load), a later load, and optionally compaction of both kinds of
    months, merged read."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        feed, cities, cat, prices = _inputs(spark, sf_dir, kind, mkt)
        spec = platform(mkt)
        cities, cat = checked_keys(cities, cat, spec)
        root = scratch_path(spark, "backfill_stream", f"{mkt}_{kind}")
        feed = _staged(feed, root + "/feed")
        feb, load = _in_feb(getattr(spec, kind).date), _load(feed, 2)
        add = lambda rows, i: write_batch(partial_rows(kind, rows, cities, cat, spec, prices), root, kind, i)
        add(feed.filter(~feb & (load == 0)), 0)
        add(feed.filter(feb & (load == 0)), 1)
        backfill_months(spark, root, kind, spec, feed, cities, cat, FEB, prices)
        if compact:
            compact_month(spark, root, kind, spec, 199801)
            compact_month(spark, root, kind, spec, 199802)
        add(feed.filter(~feb & (load == 1)), 2)
        if compact:
            for month in (199801, 199802, 199803):
                compact_month(spark, root, kind, spec, month)
        return read_merged(spark, root, kind, spec)
    return q


def _emptied_stream_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads, Feb 1998 compacted, then backfilled from a feed without rows of it."""
    feed, cities, cat, _ = _inputs(spark, sf_dir, "sales", "zepto")
    spec = platform("zepto")
    cities, cat = checked(cities, cat, spec)
    root = scratch_path(spark, "emptied_stream")
    loads = _staged_loads(feed, root + "/feed", 2)
    for i, rows in enumerate(loads):
        write_batch(partial_rows("sales", rows, cities, cat, spec), root, "sales", i)
    compact_month(spark, root, "sales", spec, 199802)
    backfill_months(spark, root, "sales", spec, loads[0].unionByName(loads[1]).filter(~_in_feb(spec.sales.date)), cities, cat, FEB)
    return read_merged(spark, root, "sales", spec)


def _priced_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zepto purchase orders and sales both arrive in loads, the sales of each step after its orders, so that
    prices are late for every load: the merged read with the price table is the report all the same."""
    feed, _, _, _ = _inputs(spark, sf_dir, "fulfillment", "zepto")
    base = scratch_path(spark, "stream", "zepto_priced")
    orders = _staged_loads(feed, base + "/staged", LOADS)
    sales = _staged_loads(fx.sales_feed(spark, sf_dir, "zepto"), base + "/staged_sales", LOADS)
    dimensions = _dimensions(spark, sf_dir, "zepto")
    for i, (order, sale) in enumerate(zip(orders, sales, strict=True)):
        _arrive(order, base + "/staged", i, base + "/feed")
        _arrive(sale, base + "/staged_sales", i, base + "/sales")
        stream_report(spark, "fulfillment", platform("zepto"), base + "/feed", order.schema, dimensions, None, base + "/table",
                      base + "/checkpoint", price_root=base + "/prices").awaitTermination()
        stream_prices(spark, base + "/sales", sale.schema, base + "/prices", base + "/checkpoint_prices").awaitTermination()
    return read_priced(spark, base + "/table", base + "/prices", platform("zepto"))


def _stream(kind: str, mkt: str) -> Query:
    """The feed arrives as files in loads, each streamed by a run of its own from the same
    checkpoint; merged read."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        feed, _, _, _ = _inputs(spark, sf_dir, kind, mkt)
        base = scratch_path(spark, "stream", f"{mkt}_{kind}")
        sales = (lambda: fx.sales_feed(spark, sf_dir, "zepto")) if (kind == "fulfillment" and mkt == "zepto") else None
        dimensions = _dimensions(spark, sf_dir, mkt)
        for i, rows in enumerate(_staged_loads(feed, base + "/staged", LOADS)):
            _arrive(rows, base + "/staged", i, base + "/feed")
            stream_report(spark, kind, platform(mkt), base + "/feed", rows.schema, dimensions, None, base + "/table",
                          base + "/checkpoint", sales_feed=sales).awaitTermination()
        return read_merged(spark, base + "/table", kind, platform(mkt))
    return q


def _run_rate_stream(mkt: str) -> Query:
    """Snapshots arrive out of order: every load holds rows of all days, so most days are late
    or added to in each run. The newest emission of each day."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        feed, cities, cat, _ = _inputs(spark, sf_dir, "inventory", mkt)
        base = scratch_path(spark, "run_rate", mkt)
        for i, rows in enumerate(_staged_loads(feed, base + "/staged", LOADS)):
            _arrive(rows, base + "/staged", i, base + "/feed")
            run_rate_stream(spark, platform(mkt), base + "/feed", rows.schema, cities, cat, base + "/out",
                            base + "/checkpoint").awaitTermination()
        return current_run_rates(spark, base + "/out")
    return q


def jobs() -> dict[str, tuple[Query, str]]:
    """name -> (query, oracle) of the jobs."""
    report = {"sales": O.sales_report, "inventory": O.inventory_report, "fulfillment": O.fulfillment_report}
    out: dict[str, tuple[Query, str]] = {}
    #: The marketplace whose query bears the plain name; the others add theirs.
    plain = {"i6_backfill": {"sales": "blinkit", "inventory": "blinkit", "fulfillment": "instamart"},
             "incremental": {"sales": "blinkit", "inventory": "blinkit", "fulfillment": "zepto"}}
    number = {"sales": 1, "fulfillment": 2, "inventory": 3}
    for kind in KINDS:
        for mkt in MARKETPLACES:
            suffix = lambda group: "" if plain[group][kind] == mkt else f"_{mkt}"
            out[f"i6_backfill_{kind}{suffix('i6_backfill')}"] = (_backfill_roundtrip(kind, mkt), report[kind](mkt))
            out[f"i{number[kind]}_incremental_{kind}{suffix('incremental')}"] = (_stream(kind, mkt), report[kind](mkt))
    for kind, mkt in (("sales", "zepto"), ("inventory", "instamart"), ("fulfillment", "zepto")):
        out[f"i4_merge_partials_{kind}"] = (_split_merge(kind, mkt), report[kind](mkt))
        out[f"i4_merged_window_{kind}"] = (_merged_window(kind, mkt), O.inside(report[kind](mkt), kind, WINDOW))
    for kind, mkt in (("sales", "instamart"), ("inventory", "zepto"), ("fulfillment", "blinkit")):
        out[f"i5_compact_month_{kind}"] = (_compacted(kind, mkt), report[kind](mkt))
        out[f"i5_compact_after_backfill_{kind}"] = (_backfill_into_stream_table(kind, mkt, True), report[kind](mkt))
    for mkt in MARKETPLACES:
        suffix = "" if mkt == "blinkit" else f"_{mkt}"
        out[f"i8_run_rate_stream{suffix}"] = (_run_rate_stream(mkt), O.run_rates(mkt))
    feb = DateWindow("1998-02-01", "1998-02-31")
    out |= {
        "i6_backfill_into_stream_table": (_backfill_into_stream_table("sales", "blinkit", False), O.sales_report("blinkit")),
        "i6_rebuild_changed_month": (_rebuild_changed_month, O.inventory_report("blinkit")),
        "i6_rebuild_emptied_month": (_rebuild_emptied_month, O.outside(O.sales_report("instamart"), "sales", feb)),
        "i6_emptied_month_of_stream_table": (_emptied_stream_month, O.outside(O.sales_report("zepto"), "sales", feb)),
        "i7_refresh_strict_view": (_refresh_strict, O.strict_sales(STRICT_REDSHIFT_COLUMNS)),
        "i7_refresh_changed_months": (_refresh_changed, O.strict_sales(STRICT_REDSHIFT_COLUMNS)),
        "s9_colocated_strict_view": (_colocated, O.strict_sales(STRICT_REDSHIFT_COLUMNS)),
        "s9_colocated_join": (_colocated_join, O.strict_with_catalogue()),
        "i3_closed_window_inventory": (_closed_window("zepto"), O.inside(O.inventory_report("zepto"), "inventory", WINDOW)),
        "i2_price_table": (_price_stream, O.daily_min_price()),
        "i2_incremental_fulfillment_late_prices": (_priced_stream, O.fulfillment_report("zepto")),
    }
    return out
