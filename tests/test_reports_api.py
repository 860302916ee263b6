"""The named entry points give the same rows as the registered queries."""

from rollwise import catalog, reports
from rollwise.operators.sales import merge_states
from rollwise.sources import fixtures as fx

from .conftest import SF_SMALL, rows


def test_named_builders_match_registered_queries(spark):
    c, k = fx.city_mapping(spark, SF_SMALL), fx.catalogue(spark, SF_SMALL)
    q = catalog.queries()
    pairs = [
        (reports.instamart_sales_report(fx.sales_feed(spark, SF_SMALL, "instamart"), c, k),
         "r2_instamart_sales_report"),
        (reports.zepto_inventory_report(fx.inventory_feed(spark, SF_SMALL, "zepto"), c, k),
         "r6_zepto_inventory_report"),
        (reports.zepto_fulfillment_report(fx.fulfillment_feed(spark, SF_SMALL, "zepto"), c, k,
                                          fx.sales_feed(spark, SF_SMALL, "zepto")),
         "r9_zepto_fulfillment_report"),
        (merge_states(reports.blinkit_sales_states(fx.sales_feed(spark, SF_SMALL, "blinkit"), c, k)),
         "r11_blinkit_sales_states"),
    ]
    for df, key in pairs:
        assert rows(df) == rows(q[key](spark, SF_SMALL))


def test_named_incremental_load_merges_to_the_batch_report(spark):
    from rollwise.plans.backfill import build_report
    from rollwise.plans.incremental import read_merged
    from rollwise.session import scratch_path
    from rollwise.specs import ZEPTO
    c, k = fx.city_mapping(spark, SF_SMALL), fx.catalogue(spark, SF_SMALL)
    f = fx.inventory_feed(spark, SF_SMALL, "zepto")
    base = scratch_path(spark, "test-named-stream")
    f.repartition(3).write.parquet(base + "/feed")
    q = reports.incremental_inventory(spark, "zepto", base + "/feed", None, c, k, base + "/t", base + "/c")
    q.awaitTermination()
    assert rows(read_merged(spark, base + "/t", "inventory", ZEPTO)) == rows(build_report("inventory", ZEPTO, f, c, k))
