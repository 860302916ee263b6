"""Steps that decide how jobs grow: what is checked, shuffled or read once."""

import datetime as dt
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from rollwise import catalog
from rollwise.operators.enrich import DuplicateDimensionKeys, assert_unique, checked, checked_keys
from rollwise.operators.fulfillment import repriced
from rollwise.operators.inventory import daily_stock, inventory_lines, inventory_report, of_series
from rollwise.plans import files, tablelog
from rollwise.plans.backfill import backfill
from rollwise.plans.incremental import merge_partials, merge_rows, partial_rows, read_merged
from rollwise.plans.snapshots import CLOSINGS, snapshot_path
from rollwise.session import apply_conf, scratch_path
from rollwise.sources.report_io import read_report
from rollwise.specs import BLINKIT, ZEPTO
from rollwise.streaming import incremental as streams
from rollwise.streaming.incremental import Dimensions, stream_report

from .conftest import rows
from .frames import catalogue, cities, feed, sku
from .test_plans import jobs_started, plan_text
from .test_scale import shuffled  # noqa: F401

D = dt.date
STOCK = [(i, f, D(2026, m, d), org, "Soap", 1.0, float(900 - 40 * m - d - 7 * len(i)))
         for i, f, org, months in (("A1", "F1", "t1", (1, 2, 3)), ("B22", "F1", "t1", (1, 3)), ("A1", "F2", None, (1, 2)),
                                   ("C333", None, "t2", (2,)), ("A1", "F1", "t2", (1,)))
         for m in months for d in (4, 19)]


def test_checked_dimensions_are_not_checked_again(spark):
    once = checked(cities(spark), catalogue(spark), BLINKIT)
    assert jobs_started(spark, lambda: checked(*once, BLINKIT)) == 0
    null = [sku("t1", None), sku("t1", None)]
    lenient = checked_keys(cities(spark), catalogue(spark, null), BLINKIT)
    with pytest.raises(DuplicateDimensionKeys):
        checked(*lenient, BLINKIT)


def test_unique_keys_are_told_by_their_hashes_alone(spark):
    dim = spark.createDataFrame([("a", "b"), ("b", "a"), (None, "a"), ("a", None), (None, None)], "x string, y string")
    assert_unique(dim, ["x", "y"], "texts")  # a null adds nothing to a hash: equal hashes here, different keys
    with pytest.raises(DuplicateDimensionKeys, match="'b', 'a'"):
        assert_unique(dim.unionByName(dim.filter("x = 'b'")), ["x", "y"], "texts")


def test_a_range_reads_only_the_earlier_rows_of_its_series(spark):
    c, k, f = cities(spark), catalogue(spark), feed(spark, "blinkit", "inventory", STOCK)
    daily = daily_stock(inventory_lines(f, c, k, BLINKIT))
    later = daily.filter(F.col("reportdate") >= D(2026, 2, 1))
    early = daily.filter(F.col("reportdate") == D(2026, 1, 19))
    names = lambda df: {(r["itemid"], r["backendfacilityname"], r["organizationid"]) for r in df.collect()}
    there = {("A1", "F1", "t1"), ("B22", "F1", "t1"), ("A1", "F2", None)}
    assert names(of_series(early, later, "left_semi")) == there
    assert names(of_series(early, later, "left_anti")) == {("A1", "F1", "t2")}


def test_a_rebuilt_range_and_its_closing_hold_every_series_once(spark):
    c, k, f = cities(spark), catalogue(spark), feed(spark, "blinkit", "inventory", STOCK)
    out = scratch_path(spark, "test-rebuilt")
    wrong = f.withColumn("backendInvQty", F.when(F.month("reportDate") == 2, 5.0).otherwise(F.col("backendInvQty")))
    backfill(spark, "inventory", BLINKIT, wrong, c, k, out)
    backfill(spark, "inventory", BLINKIT, f, c, k, out, months=(202602, 202602))
    assert rows(read_report(spark, out, "inventory")) == rows(inventory_report(f, c, k, BLINKIT))
    version = tablelog.read_state(spark, out).section(CLOSINGS)[202602]
    held = spark.read.parquet(snapshot_path(out, CLOSINGS, 202602, version))
    got = {(r["itemid"], r["backendfacilityname"], r["organizationid"], r["reportdate"]) for r in held.collect()}
    assert held.count() == len(got) == 5 and got == {
        ("A1", "F1", "t1", D(2026, 2, 19)), ("B22", "F1", "t1", D(2026, 1, 19)), ("A1", "F2", None, D(2026, 2, 19)),
        ("C333", "Unknown", "t2", D(2026, 2, 19)), ("A1", "F1", "t2", D(2026, 1, 19))}


def test_a_staged_load_reads_its_own_rows(spark):
    f = feed(spark, "blinkit", "inventory", STOCK)
    loads = catalog._staged_loads(f, scratch_path(spark, "test-staged"), 3)
    assert all("PartitionFilters: [isnotnull(_load" in plan_text(df) for df in loads)
    for i, df in enumerate(loads):
        assert df.columns == f.columns and rows(df) == rows(f.filter(catalog._load(f, 3) == i))


def test_a_staged_load_arrives_without_being_written_again(spark):
    f, base = feed(spark, "blinkit", "inventory", STOCK), scratch_path(spark, "test-arrive")
    loads = catalog._staged_loads(f.filter(catalog._load(f, 3) != 0), base + "/staged", 3)
    staged = {i: [p.rsplit("/", 1)[1] for p in files.matching(spark, f"{base}/staged/_load={i}/*.parquet")] for i in range(3)}
    for i, df in enumerate(loads):
        catalog._arrive(df, base + "/staged", i, base + "/feed")
        assert not files.matching(spark, f"{base}/staged/_load={i}/*.parquet")
    arrived = [p.rsplit("/", 1)[1] for p in files.matching(spark, base + "/feed/*.parquet")]
    moved = {f"load-{i}-{n}" for i, names in staged.items() for n in names}
    assert moved < set(arrived) and len(arrived) == len(moved) + 1  # the first load has no rows, but a file
    assert rows(spark.read.schema(f.schema).parquet(base + "/feed")) == rows(f.filter(catalog._load(f, 3) != 0))
    first, second = files.matching(spark, base + "/feed/*.parquet")[:2]
    with pytest.raises(OSError):
        files.move(spark, first, second)


def test_staged_loads_are_not_sorted(spark, monkeypatch):
    seen, real = [], catalog.unsorted_write
    name = "spark.sql.maxConcurrentOutputFileWriters"

    @contextmanager
    def watched(session):
        with real(session):
            seen.append(session.conf.get(name))
            yield
    monkeypatch.setattr(catalog, "unsorted_write", watched)
    before = spark.conf.get(name)
    catalog._staged_loads(feed(spark, "blinkit", "inventory", STOCK), scratch_path(spark, "test-unsorted"), 3)
    assert seen == ["16"] and spark.conf.get(name) == before


def test_shuffled_dimensions_are_hashed_and_not_sorted(shuffled):  # noqa: F811
    apply_conf(shuffled)
    shuffled.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")  # what it measures is small here
    try:
        df = merge_partials(partial_rows("inventory", feed(shuffled, "blinkit", "inventory", STOCK), *checked(
            cities(shuffled), catalogue(shuffled), BLINKIT), BLINKIT), "inventory", BLINKIT)
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "ShuffledHashJoin" in text and "SortMergeJoin" not in text
    finally:
        shuffled.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_runs_of_a_stream_may_share_their_checked_dimensions(spark, monkeypatch):
    looked, real = [], streams.checked
    monkeypatch.setattr(streams, "checked", lambda *a: looked.append(1) or real(*a))
    base = scratch_path(spark, "test-shared")
    for name, df in (("cities", cities(spark)), ("catalogue", catalogue(spark))):
        df.write.parquet(f"{base}/{name}")
    dims = Dimensions(lambda: spark.read.parquet(base + "/cities"), lambda: spark.read.parquet(base + "/catalogue"), BLINKIT)
    f = feed(spark, "blinkit", "inventory", STOCK)
    for i in range(2):
        f.filter(catalog._load(f, 2) == i).write.mode("append").parquet(base + "/feed")
        stream_report(spark, "inventory", BLINKIT, base + "/feed", f.schema, dims, None, base + "/table",
                      base + "/checkpoint").awaitTermination()
    assert len(looked) == 1
    assert rows(read_merged(spark, base + "/table", "inventory", BLINKIT)) == rows(
        inventory_report(f, cities(spark), catalogue(spark), BLINKIT))


def test_merged_orders_are_priced_where_they_were_merged(shuffled):  # noqa: F811
    from rollwise.operators.fulfillment import FUL_KEYS, FUL_LINE
    types = dict.fromkeys([*FUL_KEYS, *FUL_LINE], "string") | dict.fromkeys(
        ("quantity", "grn_quantity", "total_amount", "fill_rate_sku", "mrp"), "double") | dict.fromkeys(
        ("orderdate", "appointmentdate", "expirydate"), "date")
    parts = shuffled.createDataFrame([], ", ".join(f"{c} {t}" for c, t in types.items()))
    prices = shuffled.createDataFrame([], "sku string, orderdate date, mrp double")
    text = plan_text(repriced(merge_rows(parts, "fulfillment", ZEPTO), prices, ZEPTO), "simple")
    assert text.count("Exchange ") == 2 and text.count("Sort [") == 2  # the orders once, the prices once
