import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollwise.llm import queries
from rollwise.llm import whitening as W


def run(spark, rows, partitions=3, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(partitions)
    df = df.withColumn("id", F.lit("x")).withColumn("n", F.lit(1)).withColumn("component", F.lit(2))
    return W.whitened(df, **options).collect()


def integers(rows):
    good = [(i, v) for i, v, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(len(v) for _, v in good)
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in [*v, *[0.0] * (width - len(v))]] for _, v in good])
    return [i for i, _ in good], x


def check(got, rows, count=32):
    ids, x = integers(rows)
    n, s = len(x), x.sum(0)
    a = (n * x - s) / n
    values, vectors = np.linalg.eigh(a.T @ a / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(count, int((values > 1e-9 * values[0]).sum()))
    assert Counter((r["id"], r["component"]) for r in got) == Counter((i, c) for i in ids for c in range(1, k + 1))
    exact = [sum(int(e) ** 2 for e in row) for row in n * x - s]
    deviation = dict(zip(ids, [e if e < 2**63 else None for e in exact], strict=True))
    assert all(r["n"] == n and r["deviation"] == deviation[r["id"]] for r in got if r["id"] is not None)
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    w = np.zeros((n, k))
    place = {i: j for j, i in enumerate(ids)}
    for r in got:
        w[place[r["id"]], r["component"] - 1] = r["whitened"]
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-9)
    want = a @ vectors[:, :k] / np.sqrt(values[:k])
    sign = np.sign((w * want).sum(0))
    gaps = np.diff(values[: k + 1]) if k < len(values) else np.diff([*values[:k], 0])
    clear = (np.abs(gaps) > 1e-3 * values[0]) & np.concatenate([[True], np.abs(gaps[:-1]) > 1e-3 * values[0]])
    assert np.abs(w * sign - want)[:, clear].max() < 1e-6


def test_random_vectors(spark):
    rng = np.random.default_rng(5)
    scales = np.geomspace(40, 0.4, 12)
    rows = [(i, (rng.normal(0, 1, 12) * scales + 3).astype(np.float32).tolist(), 1) for i in range(700)]
    check(run(spark, rows), rows)
    check(run(spark, rows, count=4), rows, count=4)


def test_ill_conditioned_vectors(spark):
    rng = np.random.default_rng(6)
    turn = np.linalg.qr(rng.normal(size=(6, 6)))[0]
    rows = [(i, ((rng.normal(0, 1, 6) * [4e4, 4e3, 400, 40, 4, 2]) @ turn).astype(np.float32).tolist(), 1) for i in range(500)]
    check(run(spark, rows, 5), rows)


def test_directions_without_variance_have_no_component(spark):
    rng = np.random.default_rng(7)
    base = rng.integers(-9, 9, (300, 4))
    x = np.concatenate([base, base[:, :2] + base[:, 2:], np.full((300, 2), 5)], axis=1)  # rank 4 of 8
    rows = [(i, (row / 4).astype(np.float32).tolist(), 1) for i, row in enumerate(x)]
    got = run(spark, rows)
    assert {r["component"] for r in got} == {1, 2, 3, 4}
    check(got, rows)


def test_fewer_rows_than_dimensions(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(0, 2, 20).astype(np.float32).tolist(), 1) for i in range(6)]
    got = run(spark, rows)
    assert {r["component"] for r in got} == {1, 2, 3, 4, 5}
    check(got, rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(0, 2, 3).astype(np.float32).tolist(), 1) for i in range(60)]
    rows += [(100, None, 1), (101, [1.0, None, 2.0], 1), (102, [float("nan")] * 3, 1), (103, [float("inf"), 1.0, 0.0], 1),
             (104, [], 1), (105, [2.5], 1)]
    check(run(spark, rows), rows)
    twice = run(spark, [*rows, rows[0], (None, [1.0, 1.0, 1.0], 2)])
    assert Counter(r["id"] for r in twice)[0] == 6 and Counter(r["id"] for r in twice)[None] == 3


def test_equal_rows_and_none(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, 1)]) == []
    assert run(spark, [(1, [], 1)]) == []
    assert run(spark, [(i, [1.0, 2.0], 1) for i in range(9)]) == []


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [float(2**26 * (i % 2)), float(i)], 1) for i in range(40)]
    got = {r["id"]: r["deviation"] for r in run(spark, rows)}
    ids, x = integers(rows)
    d = {i: sum(int(e) ** 2 for e in row) for i, row in zip(ids, len(x) * x - x.sum(0), strict=True)}
    assert got == {i: e if e < 2**63 else None for i, e in d.items()} and None in got.values()


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    got = [r.asDict() | {"id": r["vec_id"]} for r in queries.op11_whitening(spark, folder).collect()]
    check(got, [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()])
