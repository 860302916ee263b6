"""The pipeline's stages on a small corpus, each against brute force on its own input."""

import re

import corpus_pipeline as P
from rollwise.llm import packing
from rollwise.llm.common import stored
from rollwise.session import scratch_path

from . import test_contamination, test_jaccard, test_lines, test_packing
from .frames import docs


def corpus():
    near = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau " * 3
    lines = test_lines.corpus()[5:25]
    _, items = test_contamination.corpus()
    texts = lines + [None, "", "12345 !!", near + "one", near + "two", near + "one", f"before it {items[5]} after it",
                     "a clean text that stays whole", "ein sauberer Text, der bleibt", "word " * 2000]
    return texts, items


def rows_of(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_every_stage_against_brute_force(spark):
    texts, items = corpus()
    sf_dir = scratch_path(spark, "test-pipeline")
    docs(spark, texts, extra=False, partitions=3).write.parquet(sf_dir + "/documents.parquet")
    test_contamination.item_frame(spark, items).select("item_id", "text").write.parquet(sf_dir + "/benchmark.parquet")
    start = spark.read.parquet(sf_dir + "/documents.parquet")
    assert [len(P.STAGES), *(n for n, _ in P.STAGES)] == [5, "language_id", "line_dedup", "ngram_jaccard_join",
                                                         "benchmark_decontamination", "best_fit_packing"]
    done = [start]
    for name, stage in P.STAGES:
        done.append(stored(stage(spark, done[-1], sf_dir), name))
    assert all(d.columns == start.columns for d in done[:-1])
    _, language, deduped, single, clean, packed = done

    assert rows_of(language) == {i: t for i, t in enumerate(texts) if t and re.search(r"[^\W\d_]", t)}

    before = sorted(rows_of(language).items())
    want = test_lines.brute([i for i, _ in before], [t for _, t in before])
    left = {i: w for (i, t), w in zip(before, want, strict=True) if w == t or re.search(r"[^\W_]", w)}
    assert rows_of(deduped) == left and len(left) < len(before)   # documents that lose every line go
    assert all(r["n_chars"] == len(r["text"]) for r in deduped.collect())

    before = sorted(rows_of(deduped).items())
    groups = test_jaccard.brute([i for i, _ in before], [t for _, t in before])
    assert rows_of(single) == {i: t for i, t in before if any(d == i and c == i for d, _, c in groups)}

    before = sorted(rows_of(single).items())
    leaked = {d for d, _, _, _ in test_contamination.brute([t for _, t in before], items)}
    assert rows_of(clean) == {i: t for k, (i, t) in enumerate(before) if k not in leaked} and leaked

    left = sorted(rows_of(clean).items())
    test_packing.check(packed.collect(), [t for _, t in left], [i for i, _ in left], packing.CAPACITY)

    ran = P.run(spark, sf_dir).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert sorted(map(tuple, ran)) == sorted(
        map(tuple, packed.select("doc_id", "piece", "start", "length", "ids_crc32").collect()))


def test_empty_tables(spark):
    sf_dir = scratch_path(spark, "test-pipeline-empty")
    docs(spark, ["x"]).limit(0).write.parquet(sf_dir + "/documents.parquet")
    test_contamination.item_frame(spark, ["a"]).select("item_id", "text").limit(0).write.parquet(sf_dir + "/benchmark.parquet")
    assert P.run(spark, sf_dir).collect() == []
