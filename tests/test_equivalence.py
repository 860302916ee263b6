"""Equivalences: increments merge to the batch report in any order, replays and
compaction change nothing, the streamed run rate equals the batch window."""

import itertools

import pytest
from pyspark.sql import functions as F

from rollwise.operators.fulfillment import daily_min_price
from rollwise.plans.backfill import backfill, build_report
from rollwise.plans.incremental import (compact_month, merge_partials, partial_rows, read_merged,
                                        write_batch)
from rollwise.session import scratch_path
from rollwise.sources import fixtures as fx
from rollwise.sources.report_io import read_report
from rollwise.specs import platform
from rollwise.streaming.run_rate import current_run_rates, run_rate_stream

from .conftest import SF_SMALL, rows
from .frames import D, catalogue, cities, feed

CASES = [("sales", "zepto"), ("inventory", "blinkit"), ("fulfillment", "zepto")]


@pytest.fixture(scope="module")
def dims(spark):
    return fx.city_mapping(spark, SF_SMALL), fx.catalogue(spark, SF_SMALL)


def _inputs(spark, kind, mkt):
    f = fx.feed(spark, SF_SMALL, kind, mkt)
    prices = daily_min_price(fx.sales_feed(spark, SF_SMALL, "zepto"), platform("zepto")) \
        if (kind, mkt) == ("fulfillment", "zepto") else None
    return f, prices


@pytest.mark.parametrize("kind,mkt", CASES)
def test_merged_increments_equal_batch_in_any_order(spark, dims, kind, mkt):
    cities_, cat = dims
    f, prices = _inputs(spark, kind, mkt)
    f = f.cache()
    spec = platform(mkt)
    batch = rows(build_report(kind, spec, f, cities_, cat, prices))
    load = F.pmod(F.xxhash64(*f.columns), F.lit(3))
    parts = [partial_rows(kind, f.filter(load == i), cities_, cat, spec, prices).cache() for i in range(3)]
    for order in itertools.islice(itertools.permutations(range(3)), 0, 6, 2):
        union = parts[order[0]].unionByName(parts[order[1]]).unionByName(parts[order[2]])
        assert rows(merge_partials(union, kind, spec)) == batch
    for p in parts:
        p.unpersist()
    f.unpersist()


def test_backfill_twice_equals_once_and_month_rebuild_keeps_table(spark, dims):
    cities_, cat = dims
    spec = platform("blinkit")
    f = fx.inventory_feed(spark, SF_SMALL, "blinkit").cache()
    out = scratch_path(spark, "test-backfill")
    backfill(spark, "inventory", spec, f, cities_, cat, out)
    once = rows(read_report(spark, out, "inventory"))
    backfill(spark, "inventory", spec, f, cities_, cat, out)
    backfill(spark, "inventory", spec, f, cities_, cat, out, months=(199802, 199803))
    assert rows(read_report(spark, out, "inventory")) == once
    assert once == rows(build_report("inventory", spec, f, cities_, cat))


def test_compaction_changes_nothing_and_replay_overwrites(spark, dims):
    cities_, cat = dims
    spec = platform("instamart")
    f = fx.sales_feed(spark, SF_SMALL, "instamart").cache()
    root = scratch_path(spark, "test-partials")
    load = F.pmod(F.xxhash64(*f.columns), F.lit(2))
    for i in range(2):
        write_batch(partial_rows("sales", f.filter(load == i), cities_, cat, spec), root, "sales", i)
    before = rows(read_merged(spark, root, "sales", spec))
    # replay of batch 1 (same id) must not double it
    write_batch(partial_rows("sales", f.filter(load == 1), cities_, cat, spec), root, "sales", 1)
    assert rows(read_merged(spark, root, "sales", spec)) == before
    for m in (199802, 199601, 199705):
        compact_month(spark, root, "sales", spec, m)
    assert rows(read_merged(spark, root, "sales", spec)) == before
    from rollwise.plans.incremental import compact_months
    compact_months(spark, root, "sales", spec, 199501, 199812)   # a range, one job
    assert rows(read_merged(spark, root, "sales", spec)) == before
    assert before == rows(build_report("sales", spec, f, cities_, cat))


def test_run_rate_stream_places_late_days_and_rerates_the_next(spark):
    cities_, cat = cities(spark), catalogue(spark)
    spec = platform("blinkit")
    base = scratch_path(spark, "test-run-rate")
    batches = [
        [("A1", "Pune", D(2026, 2, 1), "t1", "Soap", 1.0, 100.0),
         ("A1", "Pune", D(2026, 2, 2), "t1", "Soap", 1.0, 80.0)],
        [("A1", "Pune", D(2026, 2, 2), "t1", "Soap", 0.0, 5.0),      # same day as before: added
         ("A1", "Pune", D(2026, 2, 4), "t1", "Soap", 1.0, 60.0),
         ("A1", "Pune", D(2026, 2, 1), "t2", "Soap", 0.0, 7.0)],
        [("A1", "Pune", D(2026, 2, 3), "t1", "Soap", 1.0, 70.0)],    # late, between known days
        [("A1", "Pune", D(2026, 1, 31), "t1", "Soap", 1.0, 130.0)],  # late, before all of them
    ]
    for i, b in enumerate(batches):
        feed(spark, "blinkit", "inventory", b).coalesce(1).write.mode("append").parquet(base + "/feed")
        run_rate_stream(spark, spec, base + "/feed", None, cities_, cat, base + "/out", base + "/ckpt").awaitTermination()
        known = feed(spark, "blinkit", "inventory", [r for x in batches[:i + 1] for r in x])
        want = {(r["organizationid"], r["reportdate"]): (r["backendinvqty"], r["run_rate_backend"], r["run_rate_total"])
                for r in build_report("inventory", spec, known, cities_, cat).collect()}
        live = {(r["organizationid"], r["reportdate"]): (r["backendinvqty"], r["run_rate_backend"], r["run_rate_total"])
                for r in current_run_rates(spark, base + "/out").collect()}
        assert live == want
    # the last batch only emitted the day it brought and the one after
    last = spark.read.parquet(base + "/out/live").filter("batch_id = 3").collect()
    assert sorted(str(r["reportdate"]) for r in last) == ["2026-01-31", "2026-02-01"]


def _inv(spark, rows):
    return feed(spark, "blinkit", "inventory", [("A1", "WH", d, "t1", "Soap", 0.0, q) for d, q in rows])


def test_month_rebuild_corrects_the_first_later_run_rate(spark):
    spec = platform("blinkit")
    c, k = cities(spark), catalogue(spark)
    old = [(D(2026, 1, 5), 100.0), (D(2026, 2, 5), 90.0), (D(2026, 4, 1), 30.0), (D(2026, 4, 2), 20.0)]
    new = [(D(2026, 1, 5), 100.0), (D(2026, 2, 7), 60.0), (D(2026, 4, 1), 30.0), (D(2026, 4, 2), 20.0)]
    for changed in (new, [old[0], *old[2:]]):   # other stock; the month without any row
        out = scratch_path(spark, "test-later-rate")
        backfill(spark, "inventory", spec, _inv(spark, old), c, k, out)
        backfill(spark, "inventory", spec, _inv(spark, changed), c, k, out, months=(202602, 202602))
        assert rows(read_report(spark, out, "inventory")) == rows(build_report("inventory", spec, _inv(spark, changed), c, k))


def _sale(spark, rows):
    return feed(spark, "blinkit", "sales", [("A1", d, "t1", "Soap", 1.0, v, "Pune") for d, v in rows])


def gmv(df):
    return {str(r["reportdate"]): r["gmv"] for r in df.collect()}


def test_compaction_keeps_what_only_a_backfill_brought(spark):
    from rollwise.plans.incremental import backfill_months
    spec = platform("blinkit")
    c, k = cities(spark), catalogue(spark)
    root = scratch_path(spark, "test-keep")
    write_batch(partial_rows("sales", _sale(spark, [(D(2026, 2, 1), 10.0)]), c, k, spec), root, "sales", 0)
    backfill_months(spark, root, "sales", spec, _sale(spark, [(D(2026, 2, 1), 40.0), (D(2026, 2, 9), 60.0)]), c, k, (202602, 202602))
    want = {"2026-02-01": 40.0, "2026-02-09": 60.0}
    assert gmv(read_merged(spark, root, "sales", spec)) == want
    compact_month(spark, root, "sales", spec, 202602)
    assert gmv(read_merged(spark, root, "sales", spec)) == want
    write_batch(partial_rows("sales", _sale(spark, [(D(2026, 2, 9), 5.0)]), c, k, spec), root, "sales", 1)
    for _ in range(2):
        compact_month(spark, root, "sales", spec, 202602)
        assert gmv(read_merged(spark, root, "sales", spec)) == want | {"2026-02-09": 65.0}
    # the month's feed is now empty
    backfill_months(spark, root, "sales", spec, _sale(spark, [(D(2026, 3, 1), 1.0)]), c, k, (202602, 202602))
    assert gmv(read_merged(spark, root, "sales", spec)) == {}


def test_unreadable_files_raise_instead_of_reading_as_nothing(spark):
    spec = platform("blinkit")
    c, k = cities(spark), catalogue(spark)
    root = scratch_path(spark, "test-broken")
    write_batch(partial_rows("sales", _sale(spark, [(D(2026, 2, 1), 10.0)]), c, k, spec), root, "sales", 0)
    compact_month(spark, root, "sales", spec, 202602)
    import glob
    from rollwise.session import local_path
    for f in glob.glob(local_path(root) + "/compacted/*/*/*.parquet"):
        with open(f, "wb") as h:
            h.write(b"not parquet")
    with pytest.raises(Exception):
        read_merged(spark, root, "sales", spec).collect()
    with pytest.raises(FileNotFoundError):
        read_merged(spark, root + "/nowhere", "sales", spec)


def test_stream_sees_dimensions_replaced_between_batches(spark):
    from rollwise.streaming.incremental import stream_report
    from .frames import sku
    spec = platform("blinkit")
    base = scratch_path(spark, "test-dims")
    load = lambda: spark.read.parquet(base + "/catalogue")

    def step(day, keys):
        catalogue(spark, keys).write.mode("overwrite").parquet(base + "/catalogue")
        _sale(spark, [(day, 10.0)]).write.mode("append").parquet(base + "/feed")
        stream_report(spark, "sales", spec, base + "/feed", None, lambda: cities(spark), load, base + "/t",
                      base + "/c").awaitTermination()
    step(D(2026, 2, 1), [sku("t1", "A1", category="Old")])
    step(D(2026, 2, 2), [sku("t1", "A1", category="New")])
    got = {str(r["reportdate"]): r["category"] for r in read_merged(spark, base + "/t", "sales", spec).collect()}
    assert got == {"2026-02-01": "Old", "2026-02-02": "New"}
    with pytest.raises(Exception, match="duplicate key"):
        step(D(2026, 2, 3), [sku("t1", "A1"), sku("t1", "A1", prid="P9")])


def test_windowed_read_of_incremental_inventory_seeds_the_lag(spark, dims):
    from rollwise.windows import DateWindow
    cities_, cat = dims
    spec = platform("zepto")
    f = fx.inventory_feed(spark, SF_SMALL, "zepto")
    root = scratch_path(spark, "test-window-read")
    load = F.pmod(F.xxhash64(*f.columns), F.lit(2))
    for i in range(2):
        write_batch(partial_rows("inventory", f.filter(load == i), cities_, cat, spec), root, "inventory", i)
    compact_month(spark, root, "inventory", spec, 199712)
    w = DateWindow("1998-01-01", "1998-03-31")
    got = rows(read_merged(spark, root, "inventory", spec, w))
    full = build_report("inventory", spec, f, cities_, cat)
    want = rows(full.filter(w.contains(F.col("reportdate"))))
    assert got == want and len(got) > 0


# Property: any assignment of feed rows to loads merges to the batch report.
from hypothesis import given, settings, strategies as st  # noqa: E402

_ROWS = [("A1", D(2026, 2, d % 3 + 1), "t1" if d % 4 else "t2", ["Soap", None, "Bar"][d % 3],
          float(d % 5), 10.0 + d * 0.37, ["Pune", "Nowhere"][d % 2]) for d in range(24)]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=3), min_size=len(_ROWS), max_size=len(_ROWS)))
def test_any_split_into_loads_merges_to_batch(spark, assignment):
    from rollwise.specs import BLINKIT
    cities_, cat = cities(spark), catalogue(spark)
    f = feed(spark, "blinkit", "sales", _ROWS)
    batch = rows(build_report("sales", BLINKIT, f, cities_, cat))
    parts = None
    for load in sorted(set(assignment)):
        sub = feed(spark, "blinkit", "sales", [r for r, a in zip(_ROWS, assignment) if a == load])
        p = partial_rows("sales", sub, cities_, cat, BLINKIT)
        parts = p if parts is None else parts.unionByName(p)
    assert rows(merge_partials(parts, "sales", BLINKIT)) == batch


def test_backfill_months_into_a_streamed_table(spark, dims):
    """H3: a backfilled month supersedes the batches written before it; later
    batches add on top; the result equals the batch report."""
    from rollwise.plans.incremental import backfill_months
    cities_, cat = dims
    spec = platform("blinkit")
    f = fx.sales_feed(spark, SF_SMALL, "blinkit").cache()
    root = scratch_path(spark, "test-backfill-months")
    day = F.to_date(F.col("reportDate"))
    feb = day.between(F.lit(D(1998, 2, 1)), F.lit(D(1998, 2, 28)))
    load = F.pmod(F.xxhash64(*f.columns), F.lit(2))
    # two streamed loads cover everything except half of February's rows...
    write_batch(partial_rows("sales", f.filter(~feb & (load == 0)), cities_, cat, spec), root, "sales", 0)
    write_batch(partial_rows("sales", f.filter(feb & (load == 0)), cities_, cat, spec), root, "sales", 1)
    # ...February is rebuilt from the full feed (supersedes batch 1's February rows)...
    backfill_months(spark, root, "sales", spec, f, cities_, cat, (199802, 199802))
    # ...and the rest arrives later.
    write_batch(partial_rows("sales", f.filter(~feb & (load == 1)), cities_, cat, spec), root, "sales", 2)
    assert rows(read_merged(spark, root, "sales", spec)) == rows(build_report("sales", spec, f, cities_, cat))
    f.unpersist()


def test_stream_reads_with_the_declared_feed_schema(spark, dims):
    from rollwise.streaming.incremental import stream_report
    cities_, cat = dims
    spec = platform("instamart")
    f = fx.sales_feed(spark, SF_SMALL, "instamart")
    base = scratch_path(spark, "test-declared-schema")
    f.repartition(2).write.parquet(base + "/feed")
    q = stream_report(spark, "sales", spec, base + "/feed", None, cities_, cat, base + "/t", base + "/c",
                      max_files_per_trigger=1)
    q.awaitTermination()
    assert rows(read_merged(spark, base + "/t", "sales", spec)) == rows(build_report("sales", spec, f, cities_, cat))
