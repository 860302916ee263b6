import math

import duckdb
import numpy as np
from pyspark.sql import functions as F

from rollwise.llm import knn, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every, k=5):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in good:
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in good if i != q)
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


def run(spark, rows, every, partitions=3):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).repartition(partitions)
    df = df.withColumn("id", F.lit(7)).withColumn("score", F.lit("x")).withColumn("q", F.lit(1))
    return {tuple(r) for r in knn.top_k(df, F.col("vec_id") % every == 0).collect()}


def test_random_vectors_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_ROWS", 40)
    monkeypatch.setattr(knn, "BLOCK_QUERIES", 7)
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 3, (6, 8))
    rows = [(i, (centres[i % 6] + rng.normal(0, 0.3, 8)).astype(np.float32).tolist()) for i in range(400)]
    assert run(spark, rows, 10) == brute(rows, 10)


def test_ties_hot_vectors_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_ROWS", 16)
    rows = [(i, [1.0, 2.0]) for i in range(60)] + [(i, [float(i % 3), -1.0]) for i in range(60, 90)]
    rows += [(100, None), (101, [1.0, None]), (102, [float("nan"), 1.0]), (103, [float("inf"), 0.0]),
             (104, []), (105, [3.0]), (None, [1.0, 1.0]), (106, [0.0, 0.0])]
    assert run(spark, rows, 5) == brute(rows, 5)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0]), (1, [2.0]), (2, [-3.0])]
    assert run(spark, rows, 2) == brute(rows, 2)
    assert run(spark, [(0, [1.0])], 1) == set()
    assert run(spark, [], 1) == set()


def test_large_components_stay_exact(spark):
    rows = [(i, [2.0**21 + i, 2.0**21 - 3 * i]) for i in range(12)]
    assert run(spark, rows, 3) == brute(rows, 3)


def test_ids_on_many_rows(spark, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(12)
    centres = rng.normal(0, 8, (5, 4))
    vec = lambda i: (centres[i % 5] + rng.normal(0, 0.05, 4)).astype(np.float32).tolist()
    # an id on a dozen rows near each other, one on a third of all, with equal and different vectors
    same = vec(0)
    rows = [(0, same if i % 2 else [x + i / 500 for x in same]) for i in range(12)]
    rows += [(20, vec(2)) for _ in range(90)] + [(20, same)] + [(i, vec(i)) for i in range(40, 200)]
    got = run(spark, rows, 20)
    want = set()
    good = [(i, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v in rows]
    for q, a in set(good):
        if q % 20 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in good if i != q)
            want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:5])}
    assert got == want and {q for q, *_ in got} >= {0, 20, 40}


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.op3_top_k(spark, folder)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
        want = db.execute(queries.OP3_SQL)
        names = [c[0] for c in want.description]
        assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())
