"""How often rows are shuffled and what is sent to the driver, with the same rows as before."""

import glob

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from rollwise.operators.enrich import DuplicateDimensionKeys, checked_keys
from rollwise.operators.sales import reject_counts, sales_report, sales_strict
from rollwise.plans import tablelog
from rollwise.plans.backfill import backfill
from rollwise.plans.incremental import close_month, compact_month, merge_rows, partial_rows, read_merged, write_batch
from rollwise.plans.snapshots import CLOSINGS
from rollwise.session import local_path, scratch_path
from rollwise.sources import fixtures as fx
from rollwise.sources.report_io import arranged, clustered, colocated, read_report, write_colocated
from rollwise.specs import BLINKIT, platform

from .conftest import SF_SMALL, rows
from .frames import D, catalogue, cities, feed, sku
from .test_plans import plan_text

MANY = [("A1", D(2026, m, d), t, "Soap" if d % 2 else "Tea", 2.0, 10.0 * d + m, "Pune") for m in (1, 2, 3) for d in range(1, 20)
        for t in ("t1", "t2", None)]


@pytest.fixture
def shuffled(spark):
    """Every join as it is planned for large dimensions."""
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def above_the_join(df):
    return plan_text(df, "simple").split("SortMergeJoin", 1)[0]


@pytest.mark.parametrize("kind,mkt", [("sales", "blinkit"), ("inventory", "zepto"), ("fulfillment", "instamart")])
def test_partial_rows_are_reduced_where_the_catalogue_join_placed_them(shuffled, kind, mkt):
    c, k = checked_keys(fx.city_mapping(shuffled, SF_SMALL), fx.catalogue(shuffled, SF_SMALL), platform(mkt))
    parts = partial_rows(kind, fx.feed(shuffled, SF_SMALL, kind, mkt), c, k, platform(mkt))
    assert "Aggregate" in above_the_join(parts) and "Exchange" not in above_the_join(parts)


@pytest.mark.parametrize("kind,mkt", [("sales", "blinkit"), ("inventory", "zepto"), ("fulfillment", "instamart")])
def test_partial_rows_are_shuffled_and_sorted_once_to_be_merged(spark, kind, mkt):
    c, k = fx.city_mapping(spark, SF_SMALL), fx.catalogue(spark, SF_SMALL)
    path = scratch_path(spark, "test-merge")
    partial_rows(kind, fx.feed(spark, SF_SMALL, kind, mkt), c, k, platform(mkt)).write.parquet(path)
    text = plan_text(merge_rows(spark.read.parquet(path), kind, platform(mkt)), "simple")
    assert text.count("Exchange ") == 1 and text.count("Sort [") == 1


def test_a_backfill_merges_rows_where_it_stores_them_and_counts_each_line_once(shuffled):
    spark = shuffled
    bad = [sku("t1", "A1", cogs="12,50", taxes="18"), sku("t2", "A1", cogs="", taxes="n/a")]
    c, k, f = cities(spark), catalogue(spark, bad), feed(spark, "blinkit", "sales", MANY).repartition(3)
    placed = clustered(sales_report(f, *checked_keys(c, k, BLINKIT), BLINKIT, arrange=arranged("sales")), "sales")
    above = above_the_join(placed)
    assert above.count("Exchange ") == 1 and "rangepartitioning" in above and above.count("Sort [") == 1
    out = scratch_path(spark, "test-arranged")
    assert backfill(spark, "sales", BLINKIT, f, c, k, out) == {"cogs_rejected": 114, "taxes_rejected": 57}
    seen = Observation()
    assert rows(read_report(spark, out, "sales")) == rows(sales_report(f, c, k, BLINKIT, rejects=seen))
    assert reject_counts(seen) == {"cogs_rejected": 114, "taxes_rejected": 57}
    assert seen.get["cogs_rejected"] == 114


def test_a_bucket_of_a_month_is_one_file(spark):
    c, k, f = cities(spark), catalogue(spark), feed(spark, "blinkit", "sales", MANY).repartition(4)
    strict = sales_strict(f, c, k, BLINKIT)
    held = strict.repartition(7).localCheckpoint()
    for name, df in (("plain", held), ("placed", sales_strict(f, c, k, BLINKIT, colocated("sales_strict", 2)))):
        path = scratch_path(spark, "test-bucket-files")
        write_colocated(df, f"bucket_files_{name}", path, "sales_strict", buckets=2)
        assert len(glob.glob(local_path(path) + "/yyyymm=*/*.parquet")) == 3  # one item, three months
        assert rows(spark.table(f"bucket_files_{name}").select(*strict.columns)) == rows(strict)
        spark.sql(f"DROP TABLE bucket_files_{name}")


def test_a_catalogue_is_not_taken_for_the_size_of_its_table(spark):
    size = lambda df: int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    k = fx.catalogue(spark, SF_SMALL)
    texts = k.select(F.sum(sum((F.length(F.col(c)) for c, t in k.dtypes if t == "string"), F.lit(0)))).first()[0]
    assert size(k) > texts / 3


def test_keys_checked_once_may_hold_nulls(spark):
    null = [sku(None, "A1"), sku(None, "A1"), sku("t1", None), sku("t1", None), sku("t1", "A1")]
    checked_keys(cities(spark), catalogue(spark, null), BLINKIT)
    with pytest.raises(DuplicateDimensionKeys):
        checked_keys(cities(spark), catalogue(spark, [*null, sku("t1", "A1", prid="P9")]), BLINKIT)


def test_a_closing_that_holds_every_load_is_not_written_again(spark):
    c, k = cities(spark), catalogue(spark)
    root = scratch_path(spark, "test-closing")
    stock = lambda rows_: feed(spark, "blinkit", "inventory", [("A1", "F1", d, "Soap", "t1", 1.0, v) for d, v in rows_])
    add = lambda i, *rows_: write_batch(partial_rows("inventory", stock(rows_), c, k, BLINKIT), root, "inventory", i)
    held = lambda: tablelog.read_state(spark, root).section(CLOSINGS)[202601]
    add(0, (D(2026, 1, 3), 9.0), (D(2026, 2, 3), 4.0))
    close_month(spark, root, BLINKIT, 202601)
    first = held()
    close_month(spark, root, BLINKIT, 202601)
    assert held() == first
    add(1, (D(2026, 1, 9), 7.0))
    compact_month(spark, root, "inventory", BLINKIT, 202601)
    assert held()[1] == 1 and held() != first
    assert [r["run_rate_backend"] for r in read_merged(spark, root, "inventory", BLINKIT).orderBy("reportdate").collect()] == [0.0, 2.0, 3.0]
