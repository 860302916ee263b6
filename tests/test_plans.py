"""Plan shape: pruning and pushdown reach the scans, building a report starts no job,
reports are clustered on write."""

import contextlib
import io

from pyspark.sql import functions as F

from rollwise import catalog
from rollwise.operators import dashboard as Dash
from rollwise.plans.backfill import backfill
from rollwise.plans.incremental import compact_month, partial_rows, read_merged, read_partials, vacuum, write_batch
from rollwise.session import scratch_path
from rollwise.sources import fixtures as fx
from rollwise.sources.report_io import read_report
from rollwise.specs import platform
from rollwise.windows import DateWindow

from .conftest import SF_CHECK, SF_SMALL


def plan_text(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_dashboard_on_table_prunes_months_and_pushes_predicates(spark):
    out = scratch_path(spark, "test-plan")
    backfill(spark, "sales", platform("blinkit"), fx.sales_feed(spark, SF_SMALL, "blinkit"),
             fx.city_mapping(spark, SF_SMALL), fx.catalogue(spark, SF_SMALL), out)
    w = DateWindow("1998-02-02", "1998-02-31")
    text = plan_text(Dash.city_sales(read_report(spark, out, "sales", w), "org-1", w))
    assert "PartitionFilters: [isnotnull(yyyymm" in text and "199802" in text
    assert "EqualTo(organizationid,org-1)" in text
    assert "GreaterThanOrEqual(reportdate,1998-02-02)" in text
    assert "LessThanOrEqual(reportdate,1998-02-28)" in text
    # only the columns the query needs are read
    assert "ReadSchema: struct<organizationid:string,reportdate:date,brands_choice:string,gmv:double>" in text


def test_feed_filter_and_columns_reach_lineitem_scan(spark):
    text = plan_text(catalog.queries()["r1_blinkit_sales_report"](spark, SF_SMALL))
    assert "EqualTo(l_returnflag,A)" in text
    assert "l_comment" not in text and "l_tax" not in text
    assert "BroadcastHashJoin LeftOuter" in text


def test_dashboard_predicates_pushed_through_report_build(spark):
    text = plan_text(catalog.queries()["d8_city_sales_from_feed"](spark, SF_SMALL))
    # tenant predicate reaches the orders scan side, date window the lineitem side
    assert "org-1" in text and "1998-02-02" in text


def test_registered_dashboards_read_the_stored_table_by_month(spark):
    text = plan_text(catalog.queries()["d1_brand_daily_sales"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(yyyymm" in text and "199802" in text and "lineitem" not in text


def jobs_started(spark, build):
    """Number of Spark jobs that ``build`` starts."""
    sc = spark.sparkContext
    sc.setJobGroup("build", "build")
    build()
    started = len(sc.statusTracker().getJobIdsForGroup("build"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    return started


def test_building_a_report_starts_no_job_beyond_reading_schemas(spark):
    feeds = {k: fx.feed(spark, SF_SMALL, k, "zepto") for k in ("sales", "inventory", "fulfillment")}
    c, k = fx.city_mapping(spark, SF_SMALL), fx.catalogue(spark, SF_SMALL)
    spec = platform("zepto")
    from rollwise.operators.fulfillment import daily_min_price
    from rollwise.plans.backfill import build_report

    def build():
        for kind, feed in feeds.items():
            build_report(kind, spec, feed, c, k, daily_min_price(feeds["sales"], spec) if kind == "fulfillment" else None)
    assert jobs_started(spark, build) == 0


def test_merged_read_opens_only_the_months_versions_and_loads_it_needs(spark):
    f = fx.inventory_feed(spark, SF_SMALL, "zepto")
    c, k, spec = fx.city_mapping(spark, SF_SMALL), fx.catalogue(spark, SF_SMALL), platform("zepto")
    root = scratch_path(spark, "test-pruned")
    for i in range(2):
        write_batch(partial_rows("inventory", f, c, k, spec), root, "inventory", i)
    compact_month(spark, root, "inventory", spec, 199802)
    w = DateWindow("1998-02-01", "1998-02-31")
    text = plan_text(read_merged(spark, root, "inventory", spec, w))
    filters = [line for line in text.splitlines() if line.startswith("PartitionFilters")]
    # the window's version and later loads, and for the lag the loads of the months before (there is no closing of them)
    assert len(filters) == 3 and all("yyyymm" in x for x in filters)
    assert sum("199802" in x for x in filters) == 2 and sum("199801" in x for x in filters) == 1
    # the compacted month's loads are not opened at all, and vacuum may delete them
    read = read_partials(spark, root, "inventory", (199802, 199802)).select(F.input_file_name().alias("f"))
    opened = {r["f"] for r in read.collect()}
    assert opened and all("/compacted/yyyymm=199802/" in x for x in opened)
    from .conftest import rows
    before = rows(read_merged(spark, root, "inventory", spec))
    vacuum(spark, root)
    from rollwise.plans.files import matching
    assert not matching(spark, root + "/batches/yyyymm=199802/*")
    assert rows(read_merged(spark, root, "inventory", spec)) == before


def test_report_write_is_range_clustered(spark):
    from rollwise.sources.report_io import clustered
    df = catalog.queries()["r1_blinkit_sales_report"](spark, SF_SMALL)
    text = plan_text(clustered(df, "sales"))
    assert "Arguments: rangepartitioning(yyyymm#" in text
    assert "Arguments: [yyyymm#" in text and "ASC NULLS FIRST], false, 0" in text


def test_rollup_over_feed_rows_is_a_hash_aggregate(spark):
    text = plan_text(catalog.queries()["r1_blinkit_sales_report"](spark, SF_SMALL))
    # level 1 (over every feed row) hash-aggregates with text attributes as keys;
    # the sort-based min runs only over the reduced rows.
    # The tree prints top-down: the hash aggregate must sit below (after) the sort one.
    assert text.index("HashAggregate (") > text.index("SortAggregate (")


def test_colocated_sink_is_bucketed_by_item(spark):
    from rollwise.operators.sales import sales_strict
    from rollwise.sources.report_io import write_colocated
    f = fx.sales_feed(spark, SF_SMALL, "blinkit")
    df = sales_strict(f, fx.city_mapping(spark, SF_SMALL), fx.catalogue(spark, SF_SMALL), platform("blinkit"))
    path = scratch_path(spark, "test-bucketed")
    write_colocated(df, "strict_view_test", path, "sales_strict", buckets=4)
    t = spark.table("strict_view_test")
    assert t.count() == df.count()
    # an aggregation on the bucket key needs no shuffle
    text = plan_text(t.groupBy("itemid").count())
    assert "Exchange" not in text.split("== Physical Plan ==")[1].split("\n\n")[0]
    spark.sql("DROP TABLE strict_view_test")


def test_dimension_join_without_broadcast_gives_the_same_rows(spark):
    from rollwise.operators.enrich import enrich
    from .conftest import rows
    f = fx.sales_feed(spark, SF_SMALL, "blinkit")
    c, k = fx.city_mapping(spark, SF_SMALL), fx.catalogue(spark, SF_SMALL)
    spec = platform("blinkit")
    small = rows(enrich(f, c, k, spec, city_col="cityName", item_col="itemId"))
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = enrich(f, c, k, spec, city_col="cityName", item_col="itemId")
        text = plan_text(big)
        assert "SortMergeJoin LeftOuter" in text and "BroadcastHashJoin LeftOuter" not in text
        assert rows(big) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_catalogue_grows_with_the_parts(spark):
    for sf in (SF_SMALL, SF_CHECK):
        parts = spark.read.parquet(sf + "/part.parquet").count()
        listed = fx.catalogue(spark, sf).select("zepto_sku_code").distinct().count()
        assert 0.85 * parts < listed < parts


def test_checkpoint_folder_is_required_off_local_mode(spark):
    import pytest
    from types import SimpleNamespace
    from rollwise.session import checkpoint_root
    conf = SimpleNamespace(get=lambda k, d: d)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(SimpleNamespace(sparkContext=sc))


def test_package_is_shipped_to_python_workers_once(spark):
    from rollwise.session import _shipped, ship_package
    ship_package(spark)
    ship_package(spark)
    assert spark.sparkContext.applicationId in _shipped

    def name(_):
        import rollwise.session
        return rollwise.session.__name__
    assert spark.sparkContext.parallelize([0], 1).map(name).collect() == ["rollwise.session"]
