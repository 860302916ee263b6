import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rollwise.llm import negatives as N
from rollwise.llm import queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every, positives=5, count=10):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows
            if i is not None and v is not None and lab is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, va, la in dict.fromkeys((i, tuple(v), lab) for i, v, lab in good if i % every == 0):
        scored = sorted((-sum(x * y for x, y in zip(va, v, strict=False)), i, lab) for i, v, lab in good if i != a)
        for p, pid, _ in [s for s in scored if s[2] == la][:positives]:
            inside = [s for s in scored if s[2] != la and 30 * -p <= 100 * -s[0] <= 90 * -p]
            out += [(a, pid, r + 1, i, -p, -s) for r, (s, i, _) in enumerate(inside[:count])]
    return sorted(out)


def run(spark, rows, every, partitions=3):
    df = spark.createDataFrame(rows, "id long, embedding array<float>, label int").repartition(partitions)
    df = df.select(F.col("id").alias("vec_id"), "embedding", "label", F.lit("x").alias("key"), F.lit(1).alias("id"),
                   F.lit(2).alias("score"), F.lit(3).alias("v"), F.lit(4).alias("g"))
    return sorted(tuple(r) for r in N.hard_negatives(df, F.col("vec_id") % every == 0).collect())


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 7, 3), (64, 64, 64), (33, 65, 130), (200, 64, 90), (2, 100, 2)])
def test_strassen_is_exact(shape):
    rng = np.random.default_rng(3)
    m, k, n = shape
    for most in (10, 2**20, 2**28):  # the last is beyond doubles
        a, b = rng.integers(-most, most, (m, k)), rng.integers(-most, most, (k, n))
        want = (a.astype(object) @ b.astype(object)).astype(np.int64)
        assert (N.strassen(a, b, leaf=4) == want).all() and (N.strassen(a, b) == want).all()


def test_large_entries_whose_sums_wrap_on_the_way():
    a = np.full((64, 64), 2**31, np.int64)
    b = np.zeros((64, 64), np.int64)
    b[0] = 2**31 - 1
    assert (N.strassen(a, b, leaf=8) == 2**31 * (2**31 - 1)).all()


def test_random_vectors_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 60)
    monkeypatch.setattr(N, "TILE_ROWS", 4)
    monkeypatch.setattr(N, "TILE_COLUMNS", 16)
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(0, 1, 9) + (i % 4)).astype(np.float32).tolist(), i % 4) for i in range(400)]
    want = brute(rows, 10)
    assert len(want) > 500 and run(spark, rows, 10) == want


def test_hot_labels_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 25)
    rng = random.Random(2)
    rows = [(i, [1.0, 2.0], 1) for i in range(80)] + [(100 + i, [0.5, float(i % 4) / 2], 2 + i % 3) for i in range(60)]
    rows += [(200, None, 1), (201, [1.0, None], 2), (202, [float("nan"), 1.0], 1), (203, [float("inf"), 0.0], 2),
             (204, [], 3), (205, [3.0], 1), (None, [1.0, 1.0], 1), (206, [1.0, 1.0], None), (207, [0.0, 0.0], 2),
             (208, [-1.0, -1.0], 5), (210, [-1.0, -1.5], 5), (209, [1.0, 0.1], 5)]
    rows += rows[90:95]  # repeated rows
    rng.shuffle(rows)
    want = brute(rows, 5)
    assert want and run(spark, rows, 5) == want


def test_few_rows_and_none(spark):
    assert run(spark, [], 1) == []
    assert run(spark, [(0, [1.0], 1)], 1) == []
    rows = [(0, [1.0], 1), (1, [2.0], 1), (2, [1.0], 2), (3, [0.0], 2)]
    assert run(spark, rows, 2) == brute(rows, 2) != []


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.op12_hard_negatives(spark, folder)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
        want = db.execute(queries.OP12_SQL)
        names = [c[0] for c in want.description]
        assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())
