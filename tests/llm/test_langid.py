import numpy as np
from pyspark.sql import functions as F

from rollwise.llm import langid as L
from rollwise.llm import queries

from .frames import docs


def test_scorer_equals_forward_pass():
    rng = np.random.default_rng(0)
    p = L.new_parameters(3, rng)
    x = rng.integers(0, 256, (5, L.WINDOW)).astype(np.uint8)
    assert np.abs(L.Scorer(p)(x) - L.forward(p, x)[0]).max() < 1e-5


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in L.new_parameters(3, rng).items()}
    x, y = rng.integers(0, 256, (4, L.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 1])
    loss = lambda: -np.log(L.forward(p, x)[0][np.arange(4), y]).mean()
    for k, g in L.gradients(p, x, y).items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        p[k][at] += 1e-6
        up = loss()
        p[k][at] -= 2e-6
        down = loss()
        p[k][at] += 1e-6
        assert abs((up - down) / 2e-6 - g[at]) < 1e-4


def test_held_out_accuracy(spark):
    rows = queries.op7_language(spark, "/root/testdata/sf0.01").collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
             .select("doc_id", "lang").collect()}
    out = [r for r in rows if r["held_out"] and truth[r["doc_id"]]]
    assert len(rows) == len(truth) and len(out) > 150
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in out]) > 0.9


def test_odd_texts(spark):
    texts = [None, "", "123 ...", "the cat and the dog", "le chat et le chien", "the " * 60_000, "ß"]
    df = docs(spark, texts, ids=[None, 1, 1, 3, 4, 5, 6], extra=True)
    labelled = df.withColumn("lang", F.when(F.col("doc_id") == 4, "fr").when(F.col("doc_id") == 3, "en"))
    got = L.predict(df, L.fit(labelled)).collect()
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert len(got) == len(texts) and by[None] == ("und", 0.0) and by[1] == ("und", 0.0)
    assert by[5][0] in ("en", "fr") and all(0 <= s <= 1 for _, s in by.values())
    assert L.fit(labelled.limit(0)) is None
    assert {r["lang_pred"] for r in L.predict(df, None).collect()} == {"und"}
    assert set(L.predict(df, None).columns) == set(df.columns) | {"lang_pred"}
