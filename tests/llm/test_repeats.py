import collections
import hashlib
import random

import numpy as np

from rollwise.llm import repeats as R

from .frames import docs


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    count = collections.Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if count[d[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(b for b, g in zip(d, gone, strict=False) if not g)
        runs = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(rng, n, length):
    words = [f"w{i}é" for i in range(60)] + ["the", "a", "\n"]
    passages = [" ".join(rng.choices(words, k=rng.choice([length // 8, length // 4, length]))) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = [" ".join(rng.choices(words, k=rng.randint(0, length // 3)))]
        while rng.random() < 0.6:
            parts += [rng.choice(passages), " ".join(rng.choices(words, k=rng.randint(0, length // 4)))]
        out.append(" ".join(parts))
    return out + [out[0], out[0], None, "", "ab" * length, "z" * (3 * length), "x" + out[1], "q" * (length - 1)]


def test_suffix_order_is_sorted():
    rng = np.random.default_rng(0)
    for n, k in ((1, 1), (2, 1), (50, 2), (300, 1), (400, 3), (500, 200)):
        text = np.append(rng.integers(1, k + 1, n), 0).astype(np.uint8)
        order = R.suffix_order(text, n + 5)
        raw = text.tobytes()
        assert order.tolist() == sorted(range(n + 1), key=lambda i: raw[i:])


def test_repeated_starts():
    rng = random.Random(1)
    for _ in range(40):
        pieces = ["".join(rng.choices("ab", k=rng.randint(6, 60))).encode() for _ in range(rng.randint(1, 6))]
        count = collections.Counter(p[i:i + 6] for p in pieces for i in range(len(p) - 5))
        want = [[count[p[i:i + 6]] > 1 for i in range(len(p) - 5)] for p in pieces]
        assert [f.tolist() for f in R.repeated_starts(pieces, 6)] == want


def check(spark, texts, length, gram, partitions=4):
    df = docs(spark, texts, extra=True, partitions=partitions)
    got = {r["id"]: tuple(r)[1:5] for r in R.remove_repeats(df, length=length, gram=gram).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, length)


def test_equal_to_brute_force(spark):
    rng = random.Random(2)
    check(spark, corpus(rng, 60, 40), 40, 10)
    check(spark, corpus(rng, 40, 400), 400, 100)


def test_names_of_many_segments_are_hashed(spark, monkeypatch):
    monkeypatch.setattr(R, "VARIANTS", 3)
    monkeypatch.setattr(R, "BLOCK_BYTES", 200)
    rng = random.Random(3)
    texts = corpus(rng, 40, 40)
    hot = "h" + " ".join(rng.choices(["p", "qq", "r"], k=30))
    texts += [f"{rng.random()} {hot} {rng.random()} and {rng.random()}" for _ in range(30)]
    check(spark, texts, 40, 10)


def test_odd_tables(spark):
    df = docs(spark, ["a" * 500, "a" * 500, None, "b"], ids=[1, 1, None, None])
    rows = R.remove_repeats(df).collect()
    assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"]) for r in rows) == [(0, 0, 0), (1, 0, 0), (500, 500, 1), (500, 500, 1)]
    assert R.remove_repeats(df.limit(0)).collect() == []
    assert R.remove_repeats(docs(spark, ["short"])).collect()[0]["n_removed"] == 0
