import random
import re

from pyspark.sql import functions as F

from rollwise.llm import contamination as D

from .frames import docs


def shingles(text):
    w = [x for x in re.split(r"[^a-z0-9éü]+", (text or "").lower()) if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(texts, items):
    out = set()
    for d, t in enumerate(texts):
        for i, x in enumerate(items):
            a, b = shingles(t), shingles(x)
            if b and 100 * len(a & b) >= 80 * len(b):
                out.add((d, i, len(b), len(a & b)))
    return out


def item_frame(spark, items):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    return df.withColumn("n", F.lit(1)).withColumn("key", F.lit("x")).withColumn("need", F.lit(0))


def corpus():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)] + ["é", "Ü1"]
    say = lambda n: " ".join(rng.choices(words, k=n))
    items = [say(rng.choice([5, 6, 9, 14, 30, 60, 200])) for _ in range(40)] + [None, "", "a b c d", "x x x x x x x x"]
    texts = [None, "", "one two", say(4000), "x " * 9000]
    for _ in range(150):
        item = rng.choice(items[:40]).split()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            item[rng.randrange(len(item))] = rng.choice(words)
        texts.append(f"{say(rng.choice([0, 3, 500]))}, {'  '.join(item).upper()}! {say(rng.choice([0, 3, 200]))}")
    texts += [" ".join(items[0].split()[::-1]), items[1] + "\n" + items[2]]
    return texts, items


def test_equal_to_brute_force(spark):
    texts, items = corpus()
    got = D.leaks(docs(spark, texts, extra=True, partitions=4), item_frame(spark, items)).collect()
    want = brute(texts, items)
    assert {tuple(r)[1:] for r in got} == want and len(got) == len(want) > 60


def test_many_sketches_are_joined_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(D, "SKETCH_ROWS", 0)
    texts, items = corpus()
    got = D.leaks(docs(spark, texts), item_frame(spark, items)).collect()
    assert {tuple(r)[1:] for r in got} == brute(texts, items)


def test_rows_without_leaks_stay(spark):
    items = ["a b c d e f g h i j", None]
    df = docs(spark, ["x a b c d e f g h i j y", "clean text of more than five words", None, "", "x a b c d e f g h i j y"],
              ids=[1, 2, None, None, 1], extra=True)
    left = D.without_leaks(df, item_frame(spark, items))
    assert left.columns == df.columns
    assert sorted(str(r["text"]) for r in left.collect()) == ["", "None", "clean text of more than five words"]
    assert len(D.leaks(df, item_frame(spark, items)).collect()) == 2
    assert D.leaks(df.limit(0), item_frame(spark, items)).collect() == []
    assert D.leaks(df, item_frame(spark, items).limit(0)).collect() == []
