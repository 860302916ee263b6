import zlib

import numpy as np
from tokenizers import Tokenizer

from rollwise.llm import packing, token_counts, tokens

from .frames import docs

ODD = ["", "  a  b\n\n c\t d ", "a b c", "it's 's a  b\r\nc", "\n\n", " x", "x \n y", "a\x1cb c", "1,000 + 2 = don't\n- x",
       "a  b 　 d é à b", " ", "x\n", "\nx", "a.b, c'd \"e\"", None, "é è\nà", "a <|endoftext|> b", " \u0085 x"]


def reference():
    t = Tokenizer.from_file(tokens.default_path())
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_the_tokenizers_library(monkeypatch):
    ref = reference()
    rng = np.random.default_rng(2)
    alphabet = list("ab'. \n\t19é ,tsd")
    texts = ODD + ["".join(rng.choice(alphabet, 40)) for _ in range(1500)]
    monkeypatch.setattr(tokens, "STEP_BYTES", 3000)
    flat, sizes = tokens.Ids(tokens.default_path())(texts)
    assert [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])] == [ref(t) for t in texts]


def test_other_tokenizers_go_through_the_library(tmp_path):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    assert tokens.Encoder(path).one("Some words") == t.encode("Some words", add_special_tokens=False).ids


def check(rows, texts, ids, capacity):
    ref = reference()
    want = {}
    for i, t in zip(ids, texts, strict=True):
        own = np.array([*ref(t), 2], "<u4")
        for k, (s, n) in enumerate(packing.cut(len(own), capacity)):
            want[i, k] = (s, n, zlib.crc32(own[s : s + n].tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    assert len(rows) == len(want)
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for o, n in sorted(held):
            assert o == at
            at += n
        assert at <= capacity
    return len(bins)


def test_pack_with_odd_documents(spark):
    texts = ODD + ["word " * n for n in (1, 5, 40, 700, 1023, 1024, 1025, 3000)] * 3
    rows = packing.pack(docs(spark, texts, extra=True, partitions=5)).collect()
    check(rows, texts, range(len(texts)), packing.CAPACITY)
    assert packing.pack(docs(spark, ["a"]).limit(0)).collect() == []


def test_levels_merge_residual_bins_and_pack_tightly(spark, monkeypatch):
    monkeypatch.setattr(packing, "ITEMS", 5)
    rng = np.random.default_rng(5)
    texts = ["a" + " b" * int(n) for n in rng.integers(0, 60, 300)]
    rows = packing.pack(docs(spark, texts, partitions=8), capacity=64).collect()
    bins = check(rows, texts, range(len(texts)), 64)
    total = sum(r["length"] for r in rows)
    assert bins <= 1.1 * total / 64


def test_pieces_of_more_than_half_cannot_be_merged(spark, monkeypatch):
    monkeypatch.setattr(packing, "ITEMS", 5)
    texts = ["a" + " b" * 40] * 40
    assert check(packing.pack(docs(spark, texts, partitions=4), capacity=64).collect(), texts, range(40), 64) == 40


def test_the_climb_goes_on_while_a_level_saves_anything(spark, monkeypatch):
    monkeypatch.setattr(packing, "ITEMS", 4)
    # few small pieces among many that only they can join: most levels save little
    texts = ["a" + " b" * 40] * 60 + ["a" + " b" * 15] * 12 + ["a"] * 30
    rows = packing.pack(docs(spark, texts, partitions=20), capacity=64).collect()
    assert check(rows, texts, range(len(texts)), 64) == 60


def test_token_counts(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK_IDS", 16)
    ref = reference()
    texts = ODD + ["word " * 200, "", None, "", "x", "a b c d e f g h i j k l m n o p"] * 3
    got = token_counts.token_counts(docs(spark, texts, extra=True, partitions=3)).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {i: len(ref(t)) for i, t in enumerate(texts)}
    assert len(got) == len(texts)
    again = token_counts.token_counts(docs(spark, ["a b", "a b", None], ids=[None, 3, 3])).collect()
    assert sorted((r["doc_id"] or -1, r["n_tokens"]) for r in again) == [(-1, 2), (3, 0), (3, 2)]
    assert token_counts.token_counts(docs(spark, ["a"]).limit(0)).collect() == []
