"""Personal data: pattern spans, and information-theoretic sanitisation of what gives them away.

DataFrame functions only.

1. *Entities.* Email addresses, IP addresses, card numbers (Luhn) and phone numbers are
   found by expression in the whole text; these spans always stand.
2. *Co-occurrence.* Over the whole corpus, ``d(t)`` counts the different texts that contain term t (a word of three
   letters or more, in lower case), and ``c(t, e)`` those with entity e and, outside any match, t: wherever in the text
   they stand. An entity's contexts are the different surroundings (``NEAR`` code points to either side, up to the next match of its kind) it has.
3. *Disclosure.* A term reveals an entity if meeting it makes the entity likely: ``p(e|t) =
   c(t, e) / d(t)`` of at least ``SHARE``, and a gain of at least ``BITS`` bits over the entity's own
   share of all contexts. The texts with both must differ: in at least ``SUPPORT`` contexts and by their sketches (smallest hash of three words on end), of which there must be ``SUPPORT``
   and ``VARIED`` of the texts, so that near copies of one text do not make its rare words disclosing.
   Every occurrence of such a term, in whatever text, is a span of kind ``term``, to be generalised as well,
   unless it overlaps an entity.

Only what can reach these bounds is paired: entities of enough contexts and bits, terms that no more than 1 / ``SHARE`` times
the entity's texts hold among the texts with entities, then pairs whose share and bits among these texts reach the bounds. Texts are not shuffled for the counts, and ``d(t)`` is counted for terms of such pairs only.

Places count code points, ends are exclusive. Matches are leftmost and non-overlapping
per kind; a match that fails its test is dropped and not tried again. The expressions
are written so that Java's engine takes linear time on long runs and does not recurse: an
email can only start where a run of its characters does, or where the match before ended.

Defined cases: a null or empty text has no spans; null ids keep their rows; repeated
rows are each searched, and count as one text; extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, stored

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
NEAR = 48
SUPPORT, SHARE, BITS, VARIED = 3, 0.5, 3.0, 0.25

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without these cannot hold a match.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
WORD = r"\p{L}{3,}+"


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    back = F.reverse(digits)
    digit = lambda i: F.substring(back, i, F.lit(1)).cast("int")
    value = lambda i: F.when(i % 2 == 1, digit(i)).otherwise(digit(i) * 2 - F.when(digit(i) > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def accepted(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        digits = F.regexp_replace(m, r"[\x20-]", "")
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(F.regexp_replace(m, "[^0-9]", "")).between(8, 15)
    return F.lit(True)


def matches(text: Column, pattern: str | Column) -> Column:
    """All matches with the text around them: array<struct<text, start, end, left, right>>.

    A pattern's matches and the gaps between them give every place: their lengths add up."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, F.lit(pattern), -1)
    kind = "array<struct<text: string, start: int, end: int, left: string, right: string>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gaps"])
        end = begin + F.length(x["found"])
        one = F.struct(x["found"].alias("text"), begin.alias("start"), end.alias("end"), x["gaps"].alias("left"),
                       x["right"].alias("right"))
        return F.struct(end.alias("at"), F.array_append(acc["out"], one).alias("out"))

    n = F.size(found)
    rows = F.arrays_zip(found.alias("found"), F.slice(gaps, F.lit(1), n).alias("gaps"),
                        F.slice(gaps, F.lit(2), n).alias("right"))
    return F.when(n > 0, F.aggregate(rows, start, step)["out"]).otherwise(F.array().cast(kind))


def entities(text: Column, kind: str) -> Column:
    """The accepted matches of one kind."""
    found = F.filter(matches(text, PATTERNS[kind]), lambda m: accepted(kind, m["text"]))
    if HINTS[kind]:
        found = F.when(text.contains(HINTS[kind]), found).otherwise(F.filter(found, lambda m: F.lit(False)))
    return found


def words(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lower)


def sketch(terms: Column) -> Column:
    """The smallest hash of three words on end; near copies mostly share it."""
    three = lambda i: F.xxhash64(*(F.get(terms, i + j) for j in range(3)))
    return F.when(F.size(terms) > 3, F.array_min(F.transform(F.sequence(F.lit(0), F.size(terms) - 3), three))).otherwise(F.xxhash64(terms))


def _named(kind: str) -> Callable[[Column], Column]:
    """Of a match, the entity and a hash of what stands around it."""
    def one(m: Column) -> Column:
        around = F.xxhash64(F.substring(m["left"], -NEAR, NEAR), F.substring(m["right"], 1, NEAR))
        return F.struct(F.concat(F.lit(f"{kind}:"), F.lower(m["text"])).alias("entity"), around.alias("seen"))
    return one


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, id, doc, text): equal rows have one ``key``, equal texts one ``doc``."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")).alias("key"),
                       F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("doc"), text.alias("text"))


def find_entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, id, doc, spans, entities, terms, sketch) per row: accepted spans by kind, then start; of texts with such, the
    entities with hashes of their surroundings, the distinct words outside matches and the sketch."""
    rows = _texts(docs, id_col, text_col)
    for k in KINDS:
        rows = rows.withColumn(k, entities(F.col("text"), k))
    span = lambda k: lambda m: F.struct(F.lit(k).alias("kind"), m["start"].alias("start"), m["end"].alias("end"))
    rows = rows.select(
        "key", "id", "doc", "text", F.concat(*(F.transform(F.col(k), span(k)) for k in KINDS)).alias("spans"),
        F.concat(*(F.transform(F.col(k), _named(k)) for k in KINDS)).alias("entities"))
    outside = F.col("text")
    for k in KINDS:
        outside = F.regexp_replace(outside, PATTERNS[k], " ")
    rows = rows.withColumn("words", F.when(F.size("spans") > 0, words(outside)))
    return rows.select("key", "id", "doc", "spans", "entities", F.array_distinct("words").alias("terms"),
                       sketch(F.col("words")).alias("sketch"))


def candidates(found: DataFrame) -> DataFrame:
    """(entity, term, c, n, total) of the pairs that meet in enough texts, which differ enough."""
    seen = found.select("doc", "sketch", F.explode("entities").alias("e")).select("doc", "sketch", "e.entity", "e.seen")
    contexts = seen.select("entity", "seen").distinct().groupBy("entity").agg(F.count("*").alias("n"))
    total = F.broadcast(contexts.agg(F.sum("n").alias("total")))  # one row
    named = seen.groupBy("doc", "sketch", "entity").agg(F.min("seen").alias("seen"))
    around = (contexts.filter(F.col("n") >= SUPPORT).join(total).filter(F.log2(F.col("total") / F.col("n")) >= BITS)
              .join(named.groupBy("entity").agg(F.count("*").alias("texts")), "entity"))
    named = named.join(around, "entity")
    terms = (found.select("doc", F.explode("terms").alias("term")).distinct()
             .join(named.select("doc").distinct(), "doc", "left_semi"))
    held = terms.groupBy("term").agg(F.count("*").alias("held")).filter(F.col("held") >= SUPPORT)
    pairs = named.join(terms.join(held, "term"), "doc").filter(F.col("held") * SHARE <= F.col("texts"))
    met = pairs.groupBy("entity", "term", "n", "total", "held").agg(
        F.count("*").alias("c"), F.count_distinct("seen").alias("places"), F.count_distinct("sketch").alias("sketches"))
    most = F.col("c") / F.col("held")  # of p: the term is in so many texts at least
    return (met.filter((F.least("places", "sketches") >= SUPPORT) & (F.col("sketches") >= VARIED * F.col("c")))
            .filter((most >= SHARE) & (F.log2(most * F.col("total") / F.col("n")) >= BITS)).drop("places", "sketches", "held"))


def holders(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, term): the different texts that contain each of ``terms`` (term)."""
    said = _texts(docs, id_col, text_col).select("doc", F.explode(F.array_distinct(words(F.col("text")))).alias("term"))
    return said.join(terms, "term", "left_semi").select("doc", "term").distinct()


def disclosing(met: DataFrame, held_by: DataFrame) -> DataFrame:
    """(entity, term, p, bits) of the terms that reveal an entity, from ``candidates`` and the ``holders`` of their terms."""
    p = F.col("c") / F.col("d")
    bits = F.log2(p * F.col("total") / F.col("n"))
    return (met.join(held_by.groupBy("term").agg(F.count("*").alias("d")), "term")
            .select("entity", "term", p.alias("p"), bits.alias("bits"))
            .filter((F.col("p") >= SHARE) & (F.col("bits") >= BITS)))


def _places(text: Column, terms: Column) -> Column:
    """Where any of ``terms`` (letters, so no quoting) stands as a whole word."""
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join(terms, "|"), F.lit(r")(?!\p{L})"))
    found = F.filter(matches(text, pattern), lambda m: F.array_contains(terms, F.lower(m["text"])))
    return F.transform(found, lambda m: F.struct(F.lit(TERM).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<kind, start, end>>) per row of ``docs``: by kind (``KINDS``, then
    ``term``), then start."""
    prepare(docs.sparkSession)
    found = stored(find_entities(docs, id_col, text_col), "pii_entities")
    met = stored(candidates(found), "pii_candidates")
    held_by = stored(holders(docs, met.select("term").distinct(), id_col, text_col), "pii_holders")
    reveal = disclosing(met, held_by).select("term").distinct()
    marked = held_by.join(reveal, "term", "left_semi").groupBy("doc").agg(F.collect_set("term").alias("reveal"))
    terms = (_texts(docs, id_col, text_col).join(marked, "doc")
             .select("key", _places(F.col("text"), F.col("reveal")).alias("places")).groupBy("key").agg(F.first("places").alias("places")))
    free = lambda t: ~F.exists("spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"]))
    none = F.filter(F.col("spans"), lambda s: F.lit(False))
    return found.join(terms, "key", "left").select(
        "id", F.concat("spans", F.coalesce(F.filter("places", free), none)).alias("spans"))


def sanitised(text: Column, spans: Column) -> Column:
    """The text with each span generalised to [KIND]; a span that overlaps one before it goes with it."""
    by_place = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        later = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(later, F.concat(acc["out"], piece)).otherwise(acc["out"]).alias("out"))

    end = F.aggregate(by_place, start, step)
    return F.concat(end["out"], F.substring(text, end["at"] + 1, F.length(text)))
