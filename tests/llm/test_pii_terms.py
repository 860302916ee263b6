"""Which terms disclose an entity, when texts are repeated or stand far from it."""

import math
import random
import re

import pytest

from rollwise.llm import pii as P

from .frames import docs


def terms(spark, texts):
    got = {r["id"]: r["spans"] for r in P.find_personal_data(docs(spark, texts)).collect()}
    return [[t[s["start"]:s["end"]] for s in got[i] if s["kind"] == P.TERM] for i, t in enumerate(texts)]


def others(rng, n=60):
    filler = [f"word{c}" for c in "abcdefghij"]
    say = lambda: " ".join(rng.choices(filler, k=8))
    return say, [f"{say()} a{i}@ex.org {say()}" for i in range(n)]


def test_copies_of_one_text_do_not_hide_a_term(spark):
    say, rest = others(random.Random(2))
    texts = [f"{say()} Zorblax jo@ex.org {say()}" for _ in range(5)]
    assert terms(spark, texts + [texts[0]] * 40 + rest) == [["Zorblax"]] * 45 + [[]] * 60


def test_texts_alike_around_the_entity_do_not_hide_a_term(spark):
    say, rest = others(random.Random(3))
    texts = [f"{say()} Zorblax jo@ex.org {say()}" for _ in range(5)]
    alike = [f"{say()} {say()} {texts[0]} {say()} {say()}" for _ in range(5)]
    assert all("Zorblax" in t for t in terms(spark, texts + alike * 4 + rest)[:25])


def test_terms_far_from_the_entity_and_in_other_texts_are_spans(spark):
    say, rest = others(random.Random(4))
    far = " ".join([say()] * 20)
    texts = [f"Zorblax {say()} {far} {say()} jo@ex.org {say()}" for _ in range(6)]
    alone = [f"{say()} zorblax! Zorblaxes {say()} ZORBLAX", "zorblax@ex.org and zorblax"]
    got = terms(spark, texts + alone + rest)
    assert got == [["Zorblax"]] * 6 + [["zorblax", "ZORBLAX"], ["zorblax"]] + [[]] * 60


def test_rare_words_of_near_copies_do_not_disclose(spark):
    rng = random.Random(5)
    say, rest = others(rng)
    base = [f"unusual{a}{b}" for a in "abcdefgh" for b in "abcdefgh"]
    copies = []
    for i in range(40):
        w = list(base)
        w[rng.randrange(64)] = "edit"
        copies.append(" ".join([*w[:32], "jo@ex.org", *w[32:]]))
    assert terms(spark, copies + rest * 6) == [[]] * (40 + 360)


def brute(texts):
    """{(entity, term): (p, bits)} of the different texts, by their definitions."""
    kinds = sorted({t for t in texts if t is not None})
    word, mail = re.compile(r"[^\W\d_]{3,}"), re.compile(r"[a-z0-9]+@[a-z]+\.[a-z]+")
    around, holding, both = {}, {}, {}
    for t in kinds:
        inside = {m[0] for m in mail.finditer(t)}
        for w in {w.lower() for w in word.findall(t)}:
            holding.setdefault(w, set()).add(t)
        for m in mail.finditer(t):  # one a text
            around.setdefault(m[0], set()).add((t[max(0, m.start() - P.NEAR):m.start()], t[m.end():m.end() + P.NEAR]))
        for e in inside:
            for w in {w.lower() for w in word.findall(mail.sub(" ", t))}:
                both.setdefault((e, w), set()).add(t)
    out, total = {}, sum(map(len, around.values()))
    for (e, w), c in both.items():
        p = len(c) / len(holding[w])
        bits = math.log2(p * total / len(around[e]))
        if min(len(c), len(around[e])) >= P.SUPPORT and p >= P.SHARE and bits >= P.BITS:
            out[f"email:{e}", w] = (p, bits)
    return out


def test_probabilities_and_bits_equal_brute_force(spark):
    rng = random.Random(6)
    say = lambda: " ".join(rng.choice("abcdefghijklmnopqrstuvwxy") * 3 + rng.choice("abcdefghijkl") for _ in range(25))
    texts = [f"{say()} noise{i}@ex.org {say()}" for i in range(300)] + [None, "", "", "zoo0@ex.org"]
    for e in range(8):
        for i in range(rng.randint(3, 9)):
            hint = f"Hint{'abcdefgh'[e]}" if i % 4 else ""
            texts.append(f"{hint} {say()} {say()} zoo{e}@ex.org {say()}")
    texts += [f"{say()} Hinta"] * 3 + [f"{say()} hintb" for _ in range(2)] + [f"{say()} Hintc" for _ in range(12)]
    df = docs(spark, texts, extra=True)
    met = P.candidates(P.find_entities(df))
    rows = P.disclosing(met, P.holders(df, met.select("term").distinct())).collect()
    got = {(r["entity"], r["term"]): (r["p"], r["bits"]) for r in rows}
    want = brute(texts)
    assert got.keys() == want.keys() and len(want) > 4
    assert all(got[k] == pytest.approx(want[k]) for k in want)
