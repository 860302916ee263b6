"""Bench: report builds, dashboard queries and streaming loads at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints ONE JSON line. The production shape is timed: the marketplace feeds are
first staged as parquet files from the TPC-H-like tables (``stage_feeds``, the
fixture cost, reported but not in the total), one untimed warm-up build of
each report runs (JIT and codegen; steady state is what is timed), then

* ``R*``  build each report from its feed + dimensions and write it as a
          month-partitioned, clustered table (the backfill job),
* ``D*``  run each dashboard query on the written Blinkit sales table, reading
          only the window's months (collect included),
* ``I*``  run the streaming loads over the staged feed files (a quarter of them per
          micro-batch); ``I*_read`` reads the merged table back, apart;
          ``per_micro_batch_sec`` has the mean trigger time of each load,
* ``E2E_*`` run a few registered queries straight from the TPC-H-like tables
          (feed derivation joins included).

Results that are not written are sent to the ``noop`` sink, which computes every column.

``value`` is the sum of the R, D, I and E2E timings in seconds.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rollwise.operators import dashboard as D  # noqa: E402
from rollwise.operators.fulfillment import daily_min_price  # noqa: E402
from rollwise.operators.sales import sales_states  # noqa: E402
from rollwise.plans.backfill import backfill, build_report, refresh_strict_view  # noqa: E402
from rollwise.plans.incremental import read_merged  # noqa: E402
from rollwise.session import build_session, scratch_path  # noqa: E402
from rollwise.sources import fixtures as fx  # noqa: E402
from rollwise.sources.report_io import read_report, write_report  # noqa: E402
from rollwise.specs import platform  # noqa: E402
from rollwise.streaming.incremental import stream_report  # noqa: E402
from rollwise.streaming.run_rate import current_run_rates, run_rate_stream  # noqa: E402
from rollwise.windows import DateWindow  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
MKTS = ("blinkit", "instamart", "zepto")
KINDS = ("sales", "inventory", "fulfillment")
ORG = "org-1"
WINDOW = DateWindow("1998-02-02", "1998-02-31")
WINDOW_D8 = DateWindow("1998-02-02", "1998-02-20")
WINDOW_D9 = DateWindow("1996-12-02", "1996-12-20")


def sf_of(path: str) -> float | str:
    name = os.path.basename(path.rstrip("/"))
    try:
        return float(name.replace("sf", ""))
    except ValueError:
        return name


def main() -> None:
    spark = build_session(f"local[{CPUS}]", max(CPUS * 2, 8), app="rollwise-bench",
                          driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_path(spark, "bench")
    times: dict[str, float] = {}

    def compute(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    def timed(name: str, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    # ---- stage the feeds and dimensions as files (fixture cost) -------------
    def stage():
        for kind in KINDS:
            for m in MKTS:
                fx.feed(spark, SF_DIR, kind, m).repartition(8).write.parquet(f"{root}/feeds/{m}_{kind}")
        fx.city_mapping(spark, SF_DIR).write.parquet(f"{root}/dims/cities")
        fx.catalogue(spark, SF_DIR).write.parquet(f"{root}/dims/catalogue")
        fx.revenue_targets(spark, SF_DIR).write.parquet(f"{root}/dims/targets")
    t0 = time.perf_counter()
    stage()
    stage_sec = round(time.perf_counter() - t0, 3)

    def feed(m, kind):
        return spark.read.parquet(f"{root}/feeds/{m}_{kind}")
    cities = spark.read.parquet(f"{root}/dims/cities")
    cat = spark.read.parquet(f"{root}/dims/catalogue")
    targets = spark.read.parquet(f"{root}/dims/targets")
    prices = daily_min_price(feed("zepto", "sales"), platform("zepto"))

    # ---- warm-up (not timed): JVM code paths and codegen of each report kind -
    t0 = time.perf_counter()
    for kind in KINDS:
        for m in MKTS:
            compute(build_report(kind, platform(m), feed(m, kind), cities, cat,
                                 prices if (kind, m) == ("fulfillment", "zepto") else None))
    warm_sec = round(time.perf_counter() - t0, 3)

    # ---- reports ------------------------------------------------------------
    n = 1
    for kind in KINDS:
        for m in MKTS:
            out = f"{root}/reports/{m}_{kind}"
            timed(f"R{n}_{m}_{kind}", lambda: backfill(
                spark, kind, platform(m), feed(m, kind), cities, cat, out,
                prices=prices if (kind, m) == ("fulfillment", "zepto") else None))
            n += 1
    timed("R10_blinkit_sales_strict", lambda: refresh_strict_view(
        spark, platform("blinkit"), feed("blinkit", "sales"), cities, cat, f"{root}/reports/strict"))
    timed("R11_blinkit_sales_states", lambda: write_report(
        sales_states(feed("blinkit", "sales"), cities, cat, platform("blinkit")),
        f"{root}/reports/states", "sales"))
    # the same build without the clustered write, for comparison with R1 and R4
    for kind in ("sales", "inventory"):
        timed(f"BUILD_blinkit_{kind}", lambda: compute(build_report(
            kind, platform("blinkit"), feed("blinkit", kind), cities, cat)))
    timed("I6_backfill_month_inventory", lambda: backfill(
        spark, "inventory", platform("blinkit"), feed("blinkit", "inventory"), cities, cat,
        f"{root}/reports/blinkit_inventory", months=(199802, 199802)))

    # ---- dashboards on the written Blinkit sales table ----------------------
    sales_path = f"{root}/reports/blinkit_sales"

    def rep(w: DateWindow | None):
        return read_report(spark, sales_path, "sales", w)
    prev = WINDOW.shift_months(-1)
    dash = {
        "D1_brand_daily_sales": lambda: D.brand_daily_sales(rep(WINDOW), ORG, WINDOW),
        "D2_subcategory_list": lambda: D.subcategory_list(cat, ORG),
        "D3_item_pnl": lambda: D.item_pnl(rep(WINDOW), ORG, WINDOW),
        "D4_item_pnl_previous_month": lambda: D.item_pnl(rep(prev), ORG, prev),
        "D5_city_list": lambda: D.city_list(rep(None), ORG),
        "D6_city_category_totals": lambda: D.city_category_totals(rep(WINDOW), ORG, WINDOW),
        "D7_city_category_daily": lambda: D.city_category_daily(rep(WINDOW), ORG, WINDOW),
        "D8_city_sales": lambda: D.city_sales(rep(WINDOW_D8), ORG, WINDOW_D8),
        "D9_city_sales_comparison": lambda: D.city_sales(rep(WINDOW_D9), ORG, WINDOW_D9),
        "D10_item_sales": lambda: D.item_sales(rep(WINDOW_D8), ORG, WINDOW_D8),
        "D11_daily_category_totals": lambda: D.daily_category_totals(rep(WINDOW), ORG, WINDOW),
        "D12_daily_category_totals_previous_month": lambda: D.daily_category_totals(rep(prev), ORG, prev),
        "D13_daily_target": lambda: D.daily_target(targets, ORG, "blinkit", WINDOW),
    }
    for name, q in dash.items():
        timed(name, lambda: q().collect())

    # ---- streaming loads over the staged feed files -------------------------
    per_batch: dict[str, float] = {}

    def batch_seconds(sq) -> float:
        """Mean wall time of the query's micro-batches that read data."""
        ms = [p["durationMs"]["triggerExecution"] for p in sq.recentProgress
              if p.get("numInputRows", 0) > 0]
        return round(sum(ms) / len(ms) / 1000, 3) if ms else 0.0

    def files_per_batch(path: str) -> int:
        return max(1, len(spark.read.parquet(path).inputFiles()) // 4)

    def stream(kind, m, name):
        base = f"{root}/streams/{m}_{kind}"
        path = f"{root}/feeds/{m}_{kind}"
        schema = spark.read.parquet(path).schema

        def run():
            sq = stream_report(spark, kind, platform(m), path, schema, cities, cat, base + "/table",
                               base + "/checkpoint", sales_feed=feed("zepto", "sales"),
                               max_files_per_trigger=files_per_batch(path))
            sq.awaitTermination()
            per_batch[name] = batch_seconds(sq)
        timed(name, run)
        timed(name + "_read", lambda: compute(read_merged(spark, base + "/table", kind, platform(m))))

    stream("sales", "blinkit", "I1_incremental_sales")
    stream("fulfillment", "zepto", "I2_incremental_fulfillment")
    stream("inventory", "blinkit", "I3_incremental_inventory")

    def run_rates():
        path = f"{root}/feeds/blinkit_inventory"
        base = f"{root}/streams/run_rate"
        sq = run_rate_stream(spark, platform("blinkit"), path, spark.read.parquet(path).schema,
                             cities, cat, base + "/out", base + "/checkpoint",
                             max_files_per_trigger=files_per_batch(path))
        sq.awaitTermination()
        per_batch["I8_run_rate_stream"] = batch_seconds(sq)
        compute(current_run_rates(spark, base + "/out"))
    timed("I8_run_rate_stream", run_rates)

    # ---- end to end from the TPC-H-like tables (what __spark_entry__ runs) ---
    from rollwise import catalog
    qs = catalog.queries()
    for key in ("r1_blinkit_sales_report", "r4_blinkit_inventory_report",
                "r9_zepto_fulfillment_report", "d8_city_sales_from_feed"):
        timed("E2E_" + key, lambda: compute(qs[key](spark, SF_DIR)))

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "rollwise_total_sec", "value": total, "unit": "sec",
                      "queries": times, "per_micro_batch_sec": per_batch,
                      "stage_feeds_sec": stage_sec, "warmup_sec": warm_sec, "sf": sf_of(SF_DIR),
                      "cpus": CPUS, "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
