import random
import re

from pyspark.sql import functions as F

from rollwise.llm import pii as P

from .frames import docs

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def good(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k in P.KINDS for m in re.finditer(PATTERNS[k], text or "") if good(k, m[0])]


def spans(rows):
    return [[tuple(s) for s in r["spans"]] for r in rows]


CASES = [
    None, "", "none", "é a.b@c.d_e@f.g x", "a@b a@b.c.d.e. x@y.z", "1.2.3.4.5.6.7.8 300.1.1.1 01.002.0003.255", "256.1.1.1",
    "99999999999999999999.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111 1", "4111111111111111", "4111111111111112",
    "+1 (617) 555-2870 x", "+1", "+12 ", "+1234567", "+12345678", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8", "++1 555 555 5555",
    "日本 a@b.co 日本 😀 +44 20 7946 0958", "a" * 60_000, "a." * 30_000 + "@b.c", "1" * 50_000, "1 " * 30_000, "1." * 20_000,
    "x@" + "b." * 20_000 + "c", "+1" + "(" * 50_000, "a@b.c " * 200,
]


def test_base_spans_equal_a_whole_text_search(spark):
    rng = random.Random(5)
    parts = ["a", "@", ".", "b-c", "1", "25", "255", "4111111111111111", " ", "-", "+", "(", ")", "+1", "é", "😀", "\n"]
    texts = CASES + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    got = P.find_entities(docs(spark, texts, extra=True, partitions=4)).orderBy("id").collect()
    for t, s in zip(texts, spans(got), strict=True):
        assert s == brute(t), (t or "")[:200]


def test_terms_that_reveal_an_entity_are_spans(spark):
    rng = random.Random(1)
    filler = [f"word{c}" for c in "abcdefghij"]
    say = lambda: " ".join(rng.choices(filler, k=6))
    texts = [f"{say()} Zorblax jo@ex.org {say()}" for _ in range(6)]  # Zorblax only stands near jo
    texts += [f"{say()} common a{i}@ex.org {say()} common" for i in range(60)]
    texts += [f"{say()} rare kim@ex.org {say()}"] * 9  # copies are one context
    df = docs(spark, texts)
    got = {r["id"]: r["spans"] for r in P.find_personal_data(df).collect()}
    for i, t in enumerate(texts):
        terms = [t[s["start"]:s["end"]] for s in got[i] if s["kind"] == P.TERM]
        assert terms == (["Zorblax"] if i < 6 else [])
        assert [tuple(s) for s in got[i] if s["kind"] != P.TERM] == brute(t)
    found = df.join(P.find_personal_data(df), F.col("id") == F.col("doc_id"))
    clean = {r["doc_id"]: r["t"] for r in found.select("doc_id", P.sanitised(F.col("text"), F.col("spans")).alias("t")).collect()}
    assert clean[0] == texts[0].replace("Zorblax", "[TERM]").replace("jo@ex.org", "[EMAIL]")


def test_odd_tables(spark):
    df = docs(spark, ["a@b.c", "a@b.c", None], ids=[1, 1, None], extra=True)
    assert sorted(map(str, spans(P.find_personal_data(df).collect()))) == ["[('email', 0, 5)]", "[('email', 0, 5)]", "[]"]
    assert P.find_personal_data(df.limit(0)).collect() == []
