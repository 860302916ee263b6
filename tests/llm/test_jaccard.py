import random
import re

import numpy as np
import pytest

from rollwise.llm import components as C
from rollwise.llm import hashing as H
from rollwise.llm import jaccard as J

from .frames import docs


def shingles(text, width=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)}


def brute(ids, texts, percent=90):
    sets = [shingles(t) for t in texts]
    label = list(range(len(sets)))
    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                label[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(s), least.get(root(i)) if s else d) for i, (d, s) in enumerate(zip(ids, sets, strict=True))),
                  key=str)


def corpus(n=260, seed=4):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Ünïcode", "the", "of"]
    out = [None, "", "  \n ", "one", "ONE", "one two", "one\ttwo", "one two three", "a " * 4000, "a " * 3000,
           "x" * 30_000, "one two"]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 12, 20, 40, 150, 600]))] for _ in range(40)]
    while len(out) < n:
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 8])):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        if rng.random() < 0.2:
            w += rng.choices(vocabulary, k=max(1, len(w) // 20))
        out.append(" ".join(w))
    return out


def test_hashes_do_not_depend_on_place():
    a = H.words([b"Foo bar", b"", b"x foo"])
    b = H.words([b"zzz zz foo"])
    assert a[1].tolist() == [2, 0, 2] and a[0][0] == a[0][3] == b[0][2] and len(set(a[0].tolist())) == 3
    w = H.Prefix(np.frombuffer(b"abcabcabx", np.uint8)).windows(3)
    assert w[0] == w[3] and len(w) == 7 and w[0] != w[6]
    assert H.Prefix(np.frombuffer(b"zabc", np.uint8)).windows(3)[1] == w[0]
    r = H.Prefix(np.frombuffer(b"zabc", np.uint8)).ranges(np.array([1]), np.array([4]))
    assert r[0] == H.Prefix(np.frombuffer(b"qqabcabc", np.uint8)).ranges(np.array([5]), np.array([8]))[0]


@pytest.mark.parametrize("percent", [90, 80])
def test_linked_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    for size in (1, 2, 5, 9, 10, 11, 19, 20, 50, 200, 1500):
        for _ in range(60):
            a = rng.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2)
            b = a.copy()
            change = rng.integers(0, size // 5 + 2)
            b[rng.choice(size, min(size, change), replace=False)] += np.uint64(1)
            b = np.unique(b[: max(1, size - int(rng.integers(0, size // 8 + 1)))])
            a = np.unique(a)
            both = len(np.intersect1d(a, b))
            if 100 * both >= percent * (len(a) + len(b) - both):
                assert len(np.intersect1d(J.signatures(a, percent), J.signatures(b, percent)))


def test_components_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_SETS", 8)
    monkeypatch.setattr(J, "BLOCK_SIGNATURES", 3000)
    monkeypatch.setattr(J, "COLUMNS", 64)
    texts = corpus()
    ids = [None, *range(1, len(texts))]
    random.Random(1).shuffle(ids)
    got = J.components(docs(spark, texts, ids, extra=True, partitions=4)).collect()
    assert sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute(ids, texts)


def test_hot_groups(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_SETS", 16)
    rng = random.Random(2)
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(base)] * 40
    for _ in range(80):
        w = list(base)
        for _ in range(rng.choice([1, 2, 3, 5])):
            w[rng.randrange(120)] = f"z{rng.random()}"
        texts.append(" ".join(w))
    got = J.components(docs(spark, texts, partitions=6)).collect()
    assert sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute(range(120), texts)


def test_keep_one(spark):
    texts = ["a b c d", "a b c d", "a b c d", None, None, "", "q r s", "a b c d"]
    df = docs(spark, texts, [5, 2, 2, 7, 7, None, None, None], extra=True)
    kept = J.keep_one(df)
    assert kept.columns == df.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert got == sorted([(2, "a b c d"), (7, None), (7, None), (None, ""), (None, "q r s")], key=str)
    assert J.keep_one(df.limit(0)).collect() == []


def test_connected_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(260)] + [(i, i + 1) for i in range(400, 460)]
    edges += [(1000, i) for i in range(1001, 1080)] + [(5, 5), (-3, 2000)]
    label = {}
    def root(i):
        label.setdefault(i, i)
        while label[i] != i:
            i = label[i]
        return i
    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            label[y] = x
    want = {i: root(i) for i in label if any(i in e and e[0] != e[1] for e in edges)}
    got = C.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)
    assert C.connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_few_edges_take_their_rounds_in_one_task_and_as_many_by_shuffles(spark, monkeypatch):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 130)] + [(200, 201), (201, 202), (202, 200), (None, 5), (7, 7)]
    df = spark.createDataFrame(edges * 2, "a long, b long").repartition(3)
    sc, status = spark.sparkContext, spark.sparkContext.statusTracker()
    conf = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    want = {x: min(x // 100 * 100, 200) for pair in edges if None not in pair for x in pair}

    def tasks(group):
        sc.setJobGroup(group, group)
        try:
            assert {r["node"]: r["component"] for r in C.connected_components(df).collect()} == want
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        stages = {s for j in status.getJobIdsForGroup(group) for s in status.getJobInfo(j).stageIds}
        return sum(x.numTasks for x in map(status.getStageInfo, stages) if x)

    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        few = tasks("few edges")
        monkeypatch.setattr(C, "FEW", 10)
        many = tasks("many edges")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert few < 150 < many  # the first distinct and the result are shuffled, the rounds between are not



def test_many_different_short_texts_share_no_signature(spark):
    # sets so small that only equal ones link: they are signed by nothing, so none is compared
    sizes = [n for n in range(1, 12) if not any(J.differing(90, int(J.bands(90)[t + 1])) for t in (
        int(np.searchsorted(J.bands(90), n, "right")) - 1, int(np.searchsorted(J.bands(90), n, "right"))))]
    assert sizes[:4] == [1, 2, 3, 4]
    rng = np.random.default_rng(4)
    for n in sizes:
        assert len(J.signatures(np.sort(rng.integers(1, 2**63, n, dtype=np.uint64)), 90)) == 0
    texts = [f"w{i}" for i in range(1000)] + [f"w{i} v{i} u{i} t{i}" for i in range(1000)] + ["w5", "w7 v7 u7 t7"]
    got = {r["id"]: r["component_id"] for r in J.components(docs(spark, texts)).collect()}
    assert got == {i: i for i in range(2000)} | {2000: 5, 2001: 1007}
