"""Tables of versions and loads: atomic log entries, writers that are killed or interleave, edge snapshots
that bound what a window, a range backfill and a micro-batch read, and the price table."""

import re

import pytest
from pyspark.sql import functions as F

from rollwise.operators.fulfillment import daily_min_price
from rollwise.plans import files, incremental as inc, snapshots, tablelog
from rollwise.plans.backfill import backfill, build_report, last_rows, next_rows
from rollwise.plans.incremental import (backfill_months, close_month, compact_month, compact_months, partial_rows,
                                        read_merged, vacuum, write_batch)
from rollwise.session import scratch_path
from rollwise.sources import report_io
from rollwise.sources.report_io import read_report, vacuum_report, write_report, write_version
from rollwise.specs import BLINKIT, ZEPTO
from rollwise.streaming import incremental as streams
from rollwise.streaming.incremental import read_priced, stream_prices, stream_report
from rollwise.streaming.run_rate import current_run_rates, rated_days, run_rate_stream
from rollwise.windows import DateWindow

from .conftest import rows
from .frames import D, catalogue, cities, feed, sku


def files_opened(df):
    """The files that the scans of a frame's plan open, after partition pruning."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.inputPlan()
    leaves, paths = plan.collectLeaves(), set()
    for scan in (leaves.apply(i) for i in range(leaves.size())):
        if scan.getClass().getSimpleName() == "FileSourceScanExec":
            folders = scan.relation().location().listFiles(scan.partitionFilters(), scan.dataFilters())
            for held in (folders.apply(i).files() for i in range(folders.size())):
                paths |= {held.apply(i).getPath().toString() for i in range(held.size())}
    return paths


def months_opened(df):
    """(months, snapshots) of the files a frame's plan opens."""
    paths = files_opened(df)
    return ({int(m) for p in paths for m in re.findall(r"yyyymm=(\d+)", p)},
            {(s, int(m)) for p in paths for s, m in re.findall(r"_edges/(\w+)/(\d+)/", p)})


def sale(spark, rows_):
    return feed(spark, "blinkit", "sales", [("A1", d, "t1", "Soap", 1.0, v, "Pune") for d, v in rows_])


def stock(spark, rows_):
    return feed(spark, "blinkit", "inventory", [(i, "WH", d, "t1", "Soap", 0.0, q) for i, d, q in rows_])


def gmv(df):
    return {str(r["reportdate"]): r["gmv"] for r in df.collect()}


# ------------------------------------------------------------------- the log
def test_a_file_is_created_only_once(spark):
    path = scratch_path(spark, "test-create") + "/a/1.json"
    assert files.create_text(spark, path, "first") and not files.create_text(spark, path, "second")
    assert files.read_text(spark, path) == "first"
    assert files.matching(spark, path.rsplit("/", 1)[0] + "/.*") == []


def test_commits_of_two_writers_both_count_unless_they_clash(spark):
    root = scratch_path(spark, "test-log")
    base = tablelog.read_state(spark, root)
    assert base.number == 0
    put = lambda m, v: lambda s: s.setdefault("months", {}).update({m: v})
    clash = lambda *ms: lambda now: tablelog.changed(base, now, "months", ms)
    tablelog.commit(spark, root, base, put(202601, 1), clash(202601))
    tablelog.commit(spark, root, base, put(202602, 2), clash(202602))     # from the same base, another month
    assert tablelog.read_state(spark, root) == tablelog.State(2, {"months": {202601: 1, 202602: 2}})
    with pytest.raises(tablelog.Conflict, match="202601"):
        tablelog.commit(spark, root, base, put(202601, 3), clash(202601))
    assert tablelog.read_state(spark, root).number == 2
    for _ in range(12):
        tablelog.commit(spark, root, tablelog.read_state(spark, root), put(202603, 1))
    tablelog.prune(spark, root)
    assert tablelog.read_state(spark, root).number == 14
    assert len(files.matching(spark, root + "/_log/*.json")) == tablelog.KEPT


# -------------------------------------------------------------- report tables
def test_a_killed_write_leaves_the_old_table_and_vacuum_removes_its_files(spark, monkeypatch):
    c, k = cities(spark), catalogue(spark)
    out = scratch_path(spark, "test-killed")
    backfill(spark, "sales", BLINKIT, sale(spark, [(D(2026, 1, 1), 5.0), (D(2026, 2, 1), 10.0)]), c, k, out)
    want = {"2026-01-01": 5.0, "2026-02-01": 10.0}

    def killed(*args):
        raise KeyboardInterrupt
    monkeypatch.setattr(tablelog, "commit", killed)
    changed = sale(spark, [(D(2026, 2, 1), 99.0), (D(2026, 3, 1), 1.0)])
    for months in (None, (202602, 202603)):
        with pytest.raises(KeyboardInterrupt):
            backfill(spark, "sales", BLINKIT, changed, c, k, out, months=months)
        assert gmv(read_report(spark, out, "sales")) == want
    monkeypatch.undo()
    # the data files of the killed writes are there, but not part of the table
    assert len(files.matching(spark, out + "/version=*/yyyymm=202602")) == 3
    vacuum_report(spark, out)
    assert len(files.matching(spark, out + "/version=*/yyyymm=202602")) == 1
    assert not files.matching(spark, out + "/version=*/yyyymm=202603")
    assert gmv(read_report(spark, out, "sales")) == want
    backfill(spark, "sales", BLINKIT, changed, c, k, out, months=(202602, 202603))
    assert gmv(read_report(spark, out, "sales")) == {"2026-01-01": 5.0, "2026-02-01": 99.0, "2026-03-01": 1.0}


def test_append_adds_and_overwrite_replaces_months(spark):
    c, k = cities(spark), catalogue(spark)
    out = scratch_path(spark, "test-modes")
    build = lambda rows_: build_report("sales", BLINKIT, sale(spark, rows_), c, k)
    with pytest.raises(FileNotFoundError):
        read_report(spark, out, "sales")
    write_report(build([(D(2026, 1, 1), 5.0), (D(2026, 2, 1), 6.0)]), out, "sales")
    write_report(build([(D(2026, 2, 2), 7.0)]), out, "sales", mode="append")
    assert gmv(read_report(spark, out, "sales")) == {"2026-01-01": 5.0, "2026-02-01": 6.0, "2026-02-02": 7.0}
    write_report(build([(D(2026, 2, 3), 8.0)]), out, "sales")
    assert gmv(read_report(spark, out, "sales")) == {"2026-01-01": 5.0, "2026-02-03": 8.0}
    write_report(build([]), out, "sales", months=(202602, 202602))
    assert gmv(read_report(spark, out, "sales")) == {"2026-01-01": 5.0}
    write_report(build([(D(2026, 5, 1), 9.0)]), out, "sales", overwrite_mode="static")
    assert gmv(read_report(spark, out, "sales")) == {"2026-05-01": 9.0}
    with pytest.raises(ValueError):
        write_report(build([]), out, "sales", mode="ignore")


def test_two_backfills_of_one_month_do_not_mix(spark, monkeypatch):
    c, k = cities(spark), catalogue(spark)
    out = scratch_path(spark, "test-two-backfills")
    backfill(spark, "sales", BLINKIT, sale(spark, [(D(2026, 2, 1), 1.0), (D(2026, 3, 1), 1.0)]), c, k, out)
    real = report_io.write_version

    def overtaken(*args, **kw):
        monkeypatch.undo()
        backfill(spark, "sales", BLINKIT, sale(spark, [(D(2026, 2, 1), 2.0)]), c, k, out, months=(202602, 202602))
        return real(*args, **kw)
    monkeypatch.setattr(report_io, "write_version", overtaken)
    with pytest.raises(tablelog.Conflict):
        backfill(spark, "sales", BLINKIT, sale(spark, [(D(2026, 2, 1), 3.0)]), c, k, out, months=(202602, 202602))
    assert gmv(read_report(spark, out, "sales")) == {"2026-02-01": 2.0, "2026-03-01": 1.0}
    # another month is no clash
    monkeypatch.setattr(report_io, "write_version", overtaken)
    backfill(spark, "sales", BLINKIT, sale(spark, [(D(2026, 3, 1), 4.0)]), c, k, out, months=(202603, 202603))
    assert gmv(read_report(spark, out, "sales")) == {"2026-02-01": 2.0, "2026-03-01": 4.0}


YEARS = [(i, D(2024 + n // 12, n % 12 + 1, 5), 1000.0 - 7 * n - ord(i[0])) for n in range(30) for i in ("A1", "B2")
         if not (i == "B2" and n in (13, 14, 20))]


def test_a_range_rebuild_opens_its_months_and_a_snapshot_on_each_side(spark):
    c, k = cities(spark), catalogue(spark)
    out = scratch_path(spark, "test-edges")
    backfill(spark, "inventory", BLINKIT, stock(spark, YEARS), c, k, out)
    now = list(YEARS)
    for step, change in enumerate([0.0, 55.0, -30.0]):
        now = [(i, d, q + change) if d.year * 100 + d.month == 202503 else (i, d, q) for i, d, q in now]
        if step == 2:
            now = [r for r in now if not (r[0] == "A1" and r[1].month == 3 and r[1].year == 2025)]
        base = tablelog.read_state(spark, out)
        before, after = last_rows(spark, out, base, 202503), next_rows(spark, out, base, 202503)
        if step:  # the first rebuild has left its snapshots
            assert months_opened(before) == (set(), {("closings", 202502)})
            # its corrections rewrote April, so the opening is its own
            assert months_opened(after) == (set(), {("openings", 202504)})
        backfill(spark, "inventory", BLINKIT, stock(spark, now), c, k, out, months=(202503, 202503))
        assert rows(read_report(spark, out, "inventory")) == rows(build_report("inventory", BLINKIT, stock(spark, now), c, k))
    # a rebuild before them takes both out; what lies between is read
    backfill(spark, "inventory", BLINKIT, stock(spark, now), c, k, out, months=(202501, 202501))
    state = tablelog.read_state(spark, out)
    assert set(state.section(snapshots.CLOSINGS)) == {202412, 202501}
    assert months_opened(last_rows(spark, out, state, 202503)) == ({202502}, {("closings", 202501)})
    assert rows(read_report(spark, out, "inventory")) == rows(build_report("inventory", BLINKIT, stock(spark, now), c, k))
    vacuum_report(spark, out)
    assert rows(read_report(spark, out, "inventory")) == rows(build_report("inventory", BLINKIT, stock(spark, now), c, k))


# --------------------------------------------------------- incremental tables
def load(spark, root, batch, rows_):
    return write_batch(partial_rows("inventory", stock(spark, rows_), cities(spark), catalogue(spark), BLINKIT), root,
                       "inventory", batch)


def test_a_windowed_read_opens_its_months_and_one_closing(spark):
    root = scratch_path(spark, "test-closings")
    for i in range(3):
        load(spark, root, i, [r for n, r in enumerate(YEARS) if n % 3 == i])
    w = DateWindow("2026-03-01", "2026-04-31")
    want = lambda extra=(): rows(build_report("inventory", BLINKIT, stock(spark, [*YEARS, *extra]), cities(spark),
                                              catalogue(spark)).filter(w.contains(F.col("reportdate"))))
    assert rows(read_merged(spark, root, "inventory", BLINKIT, w)) == want()
    close_month(spark, root, BLINKIT, 202602)
    read = read_merged(spark, root, "inventory", BLINKIT, w)
    assert months_opened(read) == ({202603, 202604}, {("closings", 202602)}) and rows(read) == want()
    # loads into closed months: a later day of a closed series, more stock of its last day, an old day
    late = [("A1", D(2026, 2, 20), 11.0), ("B2", D(2026, 2, 5), 500.0), ("A1", D(2024, 1, 9), 3.0)]
    load(spark, root, 3, late)
    read = read_merged(spark, root, "inventory", BLINKIT, w)
    assert months_opened(read) == ({202401, 202602, 202603, 202604}, {("closings", 202602)}) and rows(read) == want(late)
    # a compaction that merges them writes the closing anew
    assert compact_months(spark, root, "inventory", BLINKIT, 202601, 202612) == [202601, 202602, 202603, 202604, 202605, 202606]
    state = tablelog.read_state(spark, root)
    assert state.section(snapshots.CLOSINGS)[202602][1] == 3
    read = read_merged(spark, root, "inventory", BLINKIT, w)
    assert months_opened(read) == ({202603, 202604}, {("closings", 202602)}) and rows(read) == want(late)
    vacuum(spark, root)
    assert rows(read_merged(spark, root, "inventory", BLINKIT, w)) == want(late)
    # a backfill of an earlier month takes the closing out and makes its own
    backfill_months(spark, root, "inventory", BLINKIT, stock(spark, [*YEARS, *late]), cities(spark), catalogue(spark), (202512, 202601))
    assert set(tablelog.read_state(spark, root).section(snapshots.CLOSINGS)) == {202601}
    read = read_merged(spark, root, "inventory", BLINKIT, w)
    assert months_opened(read) == ({202602, 202603, 202604}, {("closings", 202601)}) and rows(read) == want(late)


def test_an_incomplete_load_is_not_read(spark, monkeypatch):
    c, k = cities(spark), catalogue(spark)
    root = scratch_path(spark, "test-incomplete")
    add = lambda i, v: write_batch(partial_rows("sales", sale(spark, [(D(2026, 2, i + 1), v)]), c, k, BLINKIT), root, "sales", i)
    assert add(0, 1.0) == [202602]

    def killed(*args):
        raise KeyboardInterrupt
    monkeypatch.setattr(inc.files, "create_text", killed)
    with pytest.raises(KeyboardInterrupt):
        add(1, 9.0)
    monkeypatch.undo()
    assert gmv(read_merged(spark, root, "sales", BLINKIT)) == {"2026-02-01": 1.0}
    compact_month(spark, root, "sales", BLINKIT, 202602)
    add(1, 2.0)   # the replay
    assert gmv(read_merged(spark, root, "sales", BLINKIT)) == {"2026-02-01": 1.0, "2026-02-02": 2.0}


def test_a_compaction_and_a_backfill_that_interleave_lose_nothing(spark, monkeypatch):
    c, k = cities(spark), catalogue(spark)
    real = inc._write_months

    def table():
        root = scratch_path(spark, "test-interleaved")
        add = lambda i, d, v: write_batch(partial_rows("sales", sale(spark, [(d, v)]), c, k, BLINKIT), root, "sales", i)
        add(0, D(2026, 2, 1), 1.0)
        add(1, D(2026, 3, 1), 5.0)
        return root, add

    def between(then):
        """Run ``then`` when the next version has been written but not committed."""
        def write(*args):
            monkeypatch.undo()
            real(*args)
            then()
        monkeypatch.setattr(inc, "_write_months", write)

    truth = sale(spark, [(D(2026, 2, 1), 40.0), (D(2026, 2, 9), 60.0)])
    # a backfill commits while a compaction of its month runs: the compaction merges again
    root, add = table()
    between(lambda: backfill_months(spark, root, "sales", BLINKIT, truth, c, k, (202602, 202602)))
    compact_months(spark, root, "sales", BLINKIT, 202602, 202603)
    want = {"2026-02-01": 40.0, "2026-02-09": 60.0, "2026-03-01": 5.0}
    assert gmv(read_merged(spark, root, "sales", BLINKIT)) == want
    # a load lands and is compacted while a backfill runs: it stays on top of the backfilled month
    root, add = table()

    def land():
        add(2, D(2026, 2, 9), 7.0)
        compact_month(spark, root, "sales", BLINKIT, 202602)
    between(land)
    backfill_months(spark, root, "sales", BLINKIT, truth, c, k, (202602, 202602))
    want = {"2026-02-01": 40.0, "2026-02-09": 67.0, "2026-03-01": 5.0}
    assert gmv(read_merged(spark, root, "sales", BLINKIT)) == want
    compact_month(spark, root, "sales", BLINKIT, 202602)
    assert gmv(read_merged(spark, root, "sales", BLINKIT)) == want
    # of two backfills the later one fails
    root, add = table()
    between(lambda: backfill_months(spark, root, "sales", BLINKIT, truth, c, k, (202602, 202602)))
    with pytest.raises(tablelog.Conflict, match="202602"):
        backfill_months(spark, root, "sales", BLINKIT, sale(spark, [(D(2026, 2, 1), -1.0)]), c, k, (202602, 202602))
    assert gmv(read_merged(spark, root, "sales", BLINKIT)) == {"2026-02-01": 40.0, "2026-02-09": 60.0, "2026-03-01": 5.0}


# ------------------------------------------------------------- live run rates
def test_a_micro_batch_reads_its_months_and_one_closing_however_old_the_table_is(spark):
    base = scratch_path(spark, "test-bounded")
    c, k = cities(spark), catalogue(spark)
    days = base + "/out/days"
    opened, known = [], []
    for n in range(5):
        month = [(i, D(2025, n + 1, d), 900.0 - 31 * n - d) for i in ("A1", "B2") for d in (3, 9)]
        known += month
        stock(spark, month).coalesce(1).write.mode("append").parquet(base + "/feed")
        run_rate_stream(spark, BLINKIT, base + "/feed", None, c, k, base + "/out", base + "/ckpt", compact_every=3).awaitTermination()
        read = rated_days(spark, days, n, [202501 + n])
        opened.append(months_opened(read))
        want = {(r["itemid"], r["reportdate"]): r["run_rate_backend"]
                for r in build_report("inventory", BLINKIT, stock(spark, known), c, k).collect()}
        live = {(r["itemid"], r["reportdate"]): r["run_rate_backend"] for r in current_run_rates(spark, base + "/out").collect()}
        assert live == want
    assert opened[0] == ({202501}, set())
    assert opened[1:] == [({202501 + n}, {("closings", 202500 + n)}) for n in range(1, 5)]
    # a late day reads from its month on, beside the closing before it
    late = [("A1", D(2025, 3, 5), 400.0)]
    stock(spark, late).coalesce(1).write.mode("append").parquet(base + "/feed")
    run_rate_stream(spark, BLINKIT, base + "/feed", None, c, k, base + "/out", base + "/ckpt", compact_every=3).awaitTermination()
    assert months_opened(rated_days(spark, days, 5, [202503])) == ({202503, 202504, 202505}, {("closings", 202502)})
    live = {(r["itemid"], r["reportdate"]): r["run_rate_backend"] for r in current_run_rates(spark, base + "/out").collect()}
    assert live == {(r["itemid"], r["reportdate"]): r["run_rate_backend"]
                    for r in build_report("inventory", BLINKIT, stock(spark, known + late), c, k).collect()}
    emitted = spark.read.parquet(base + "/out/live").filter("batch_id = 5").collect()
    assert sorted(str(r["reportdate"]) for r in emitted) == ["2025-03-05", "2025-03-09"]


def test_dimension_keys_are_checked_once_per_set_of_files(spark, monkeypatch):
    base = scratch_path(spark, "test-checked")
    looked = []
    real = streams.checked
    monkeypatch.setattr(streams, "checked", lambda *a: looked.append(1) or real(*a))
    cities(spark).write.parquet(base + "/cities")
    catalogue(spark).write.parquet(base + "/catalogue")
    dims = streams.Dimensions(lambda: spark.read.parquet(base + "/cities"), lambda: spark.read.parquet(base + "/catalogue"), BLINKIT)
    for _ in range(3):
        dims.now()
    assert len(looked) == 1
    catalogue(spark, [sku("t1", "A1"), sku("t1", "A1", prid="P9")]).write.mode("overwrite").parquet(base + "/catalogue")
    for _ in range(2):   # found again until the files are mended
        with pytest.raises(ValueError, match="duplicate key"):
            dims.now()
    catalogue(spark).write.mode("overwrite").parquet(base + "/catalogue")
    dims.now()
    assert len(looked) == 4


# ---------------------------------------------------------------- price table
def zepto_sales(spark, rows_):
    return feed(spark, "zepto", "sales", [("a1", d, "t1", "Soap", "C", "S", "B", 1.0, p, 10.0, "Pune") for d, p in rows_])


def orders(spark, rows_):
    return feed(spark, "zepto", "fulfillment", [("A1", po, "t1", d, "Soap", d, "WH", 4.0, 3.0, 75.0, "Pune") for po, d in rows_])


def test_price_table_opens_the_months_asked_for_and_late_sales_lower_the_price(spark):
    base = scratch_path(spark, "test-prices")
    c, k = cities(spark), catalogue(spark)
    sold = [[(D(2026, 1, 5), 30.0), (D(2026, 2, 5), 20.0), (D(2026, 3, 5), 9.0)], [(D(2026, 2, 5), 25.0)], [(D(2026, 2, 5), 12.0), (D(2026, 4, 1), 2.0)]]

    def sell(i):
        zepto_sales(spark, sold[i]).coalesce(1).write.mode("append").parquet(base + "/sales")
        stream_prices(spark, base + "/sales", None, base + "/prices", base + "/ckpt-prices").awaitTermination()

    def order(rows_):
        orders(spark, rows_).coalesce(1).write.mode("append").parquet(base + "/orders")
        stream_report(spark, "fulfillment", ZEPTO, base + "/orders", None, c, k, base + "/t", base + "/ckpt",
                      price_root=base + "/prices").awaitTermination()

    def priced(df):
        return {r["ponumber"]: (r["mrp"], r["total_amount"]) for r in df.collect()}

    placed = [("P0", D(2026, 2, 5))]
    order(placed)   # before any sale is known
    assert priced(read_merged(spark, base + "/t", "fulfillment", ZEPTO)) == {"P0": (0.0, 0.0)}
    sell(0)
    sell(1)
    batch = orders(spark, [("P1", D(2026, 2, 5)), ("P2", D(2026, 2, 6))])
    opened = streams.stored_prices_for(batch, ZEPTO, base + "/prices")
    assert {int(m) for p in files_opened(opened) for m in re.findall(r"/prices/batches/yyyymm=(\d+)", p)} == {202602}
    more = [("P1", D(2026, 2, 5)), ("P2", D(2026, 2, 6)), ("P3", D(2026, 3, 5)), ("P3", D(2026, 3, 5))]
    order(more)
    placed += more
    stored = {"P0": (0.0, 0.0), "P1": (20.0, 80.0), "P2": (0.0, 0.0), "P3": (9.0, 36.0)}
    assert priced(read_merged(spark, base + "/t", "fulfillment", ZEPTO)) == stored
    sell(2)   # later than the orders of its day
    assert priced(read_merged(spark, base + "/t", "fulfillment", ZEPTO)) == stored
    now = read_priced(spark, base + "/t", base + "/prices", ZEPTO)
    assert priced(now)["P0"] == priced(now)["P1"] == (12.0, 48.0)
    every = zepto_sales(spark, [r for load_ in sold for r in load_])
    want = rows(build_report("fulfillment", ZEPTO, orders(spark, placed), c, k, daily_min_price(every, ZEPTO)))
    assert rows(now) == want
    w = DateWindow("2026-02-01", "2026-02-31")
    part = read_priced(spark, base + "/t", base + "/prices", ZEPTO, w)
    assert {int(m) for p in files_opened(part) for m in re.findall(r"yyyymm=(\d+)", p)} == {202602}
    assert rows(part) == [r for r in want if r["orderdate"].month == 2]
    compact_months(spark, base + "/prices", "prices", ZEPTO, 0, 999912)
    assert rows(read_priced(spark, base + "/t", base + "/prices", ZEPTO)) == want
