import itertools

from pyspark.sql import functions as F

from rollwise.functions import measures as M


def test_exact_sum_ignores_order_and_partitioning(spark):
    vals = [0.1, 0.2, 0.3, 1e-7, 123456.789012, -0.05]
    results = set()
    for perm in itertools.islice(itertools.permutations(vals), 0, 720, 97):
        df = spark.createDataFrame([(v,) for v in perm], "x double").repartition(3)
        results.add(df.agg(M.exact_sum(F.col("x")).alias("s")).first()["s"])
    assert results == {123457.3390121}


def test_sums_are_close_to_unrounded_sums(spark):
    import math
    import random
    rng = random.Random(3)
    for scale in (1e-4, 1.0, 1e7, 1e10, 1e13):
        vals = [rng.uniform(-0.3, 1) * scale for _ in range(3000)]
        df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(5)
        got, exact = df.agg(M.exact_sum(F.col("x")).alias("s")).first()["s"], math.fsum(vals)
        assert abs(got - exact) <= 1e-15 * abs(exact) + 3000 * 0.5e-9


def test_merged_states_equal_one_pass_at_large_totals(spark):
    from rollwise.operators.rollup import rollup
    import random
    rng = random.Random(4)
    vals = [("k", i % 7, "t", rng.choice([3.3e9, 1e13, 0.07, 27399.96]) + rng.random()) for i in range(2000)]
    df = spark.createDataFrame(vals, "k string, part int, name string, v double")
    once = rollup(df, ["k"], ["name"], ["v"]).first()["v"]
    parts = rollup(df, ["k", "part"], ["name"], ["v"], states=True).drop("part")
    again = rollup(rollup(parts, ["k"], ["name"], ["v"], states=True), ["k"], ["name"], ["v"]).first()["v"]
    loose = rollup(rollup(df, ["k", "part"], ["name"], ["v"], final=False).drop("part"), ["k"], ["name"], ["v"]).first()["v"]
    import math
    assert once == again == loose == math.fsum(x[3] for x in vals)


def test_what_cannot_be_summed_exactly_raises(spark):
    import pytest
    for bad in (float("nan"), float("inf"), 1e19, -1e300):
        df = spark.createDataFrame([(1.0,), (bad,)], "x double")
        with pytest.raises(Exception, match="cannot be summed exactly"):
            df.agg(M.exact_sum(F.col("x")).alias("s")).collect()
    df = spark.createDataFrame([(8e18,), (8e18,)], "x double")
    with pytest.raises(Exception, match="(?i)overflow"):
        df.agg(M.exact_sum(F.col("x")).alias("s")).collect()


def test_exact_sum_of_nulls_is_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert df.agg(M.exact_sum(F.col("x")).alias("s")).first()["s"] is None


def test_net_and_tax_with_zero_divisor_is_null(spark):
    df = spark.createDataFrame([(100.0, 10.0, 18.0), (100.0, 0.0, -100.0)], "g double, m double, t double")
    r = df.select(M.net_sales(F.col("g"), F.col("m"), F.col("t")).alias("net"),
                  M.taxes_paid(F.col("g"), F.col("m"), F.col("t")).alias("tax")).collect()
    assert abs(r[0]["net"] - 100 * 0.9 / 1.18) < 1e-12
    assert abs(r[0]["tax"] - 100 * 0.9 / 1.18 * 0.18) < 1e-12
    assert r[1]["net"] is None and r[1]["tax"] is None


def test_fill_rate_and_received(spark):
    df = spark.createDataFrame([(10.0, 2.0), (0.0, None), (None, 3.0), (4.0, None)], "o double, r double")
    out = df.select(M.fill_rate(F.col("o"), F.col("r")).alias("f"),
                    M.received_quantity(F.col("o"), F.col("r")).alias("g")).collect()
    assert [x["f"] for x in out] == [0.8, 0.0, 0.0, 1.0]
    assert [x["g"] for x in out] == [8.0, 0.0, -3.0, 4.0]


def test_depletion_never_negative(spark):
    df = spark.createDataFrame([(10.0, 4.0), (4.0, 10.0)], "p double, c double")
    assert [r[0] for r in df.select(M.depletion(F.col("p"), F.col("c"))).collect()] == [6.0, 0.0]


def test_bad_numeric_text_is_null(spark):
    df = spark.createDataFrame([("12",), ("abc",), (None,)], "t string")
    assert [r[0] for r in df.select(M.to_double(F.col("t"))).collect()] == [12.0, None, None]
