"""Benchmark decontamination: size-partitioned MinHash containment search.

DataFrame functions only. A document leaks an item if it contains at least ``PERCENT`` of
the item's distinct word shingles.

1. Items fall into size bands (powers of two of their number of shingles). An item's
   sketch is its bottom-k MinHash: the k shingles of the smallest hashes, k given by the
   band. At most ``n - need`` shingles of a leaked item are missing, so k = n - need + 1 and
   more contains at least one that the document has: the search loses nothing. Unlike
   signatures of both sides, this does not weaken as documents get longer than items.
2. All documents' shingles are probed with the sketches; a hit counts only if the
   document is large enough for the item's band. Sketches are broadcast if they are few
   (``SKETCH_ROWS``, counted first), else joined by a shuffle.
3. Candidate pairs are verified on the whole shingle sets.

Words are runs of letters and digits in lower case. Defined cases: a null or empty text,
or one of fewer words than a shingle, has no shingles: such items are not searched, such
documents leak nothing; null ids are kept; repeated rows give a row each; extra columns
are ignored; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, stored

WIDTH, PERCENT = 5, 80
SKETCH_ROWS = 200_000
SEED = 17
NOT_WORD = r"[^\p{L}\p{N}]+"


def word_list(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), NOT_WORD, -1), lambda w: w != "")


def shingles(text: Column, width: int = WIDTH) -> Column:
    """64-bit hashes of the word shingles, in text order; empty if there are too few words."""
    hashed = F.transform(word_list(F.coalesce(text, F.lit(""))), lambda w: F.xxhash64(w))

    def of(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - width),
                           lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(width))))

    # the hashes are bound once, so they are not made anew for each use
    return F.element_at(F.transform(F.array(hashed), lambda h: F.when(
        F.size(h) >= width, of(h)).otherwise(F.array().cast("array<bigint>"))), 1)


def item_sets(items: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """(item, shingles, n, need, sketch) of the items that have shingles."""
    sets = items.select(F.col(f"`{id_col}`").alias("item"),
                        F.array_distinct(shingles(F.col(f"`{text_col}`").cast("string"), width)).alias("shingles"))
    sets = sets.select("*", F.size("shingles").alias("n")).filter("n > 0").distinct()
    need = F.ceil(F.col("n") * percent / 100).cast("int")
    largest = F.pow(F.lit(2), F.floor(F.log2("n")) + 1).cast("int") - 1  # of the size band
    k = F.least(F.col("n"), largest - F.ceil(largest * percent / 100).cast("int") + 1)
    by_hash = F.array_sort(F.transform("shingles", lambda s: F.struct(F.xxhash64(s, F.lit(SEED)).alias("h"), s.alias("s"))))
    return sets.select("item", "shingles", "n", need.alias("need"),
                       F.transform(F.slice(by_hash, F.lit(1), k), lambda x: x["s"]).alias("sketch"))


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(key, id, item, n_item, n_shared): every document row and item it leaks. ``key`` is a hash of id and text."""
    prepare(docs.sparkSession)
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.xxhash64(F.col(f"`{id_col}`"), text).alias("key"), F.col(f"`{id_col}`").alias("id"),
                       text.alias("text"))
    sets = stored(item_sets(items, item_col, item_text_col, width, percent), "leak_items")
    sketch = sets.select("item", "need", F.explode("sketch").alias("s"))
    few = sets.agg(F.sum(F.size("shingles")).alias("n")).first()["n"] or 0
    sized = (lambda df: F.broadcast(df)) if few <= SKETCH_ROWS else (lambda df: df)

    probes = (rows.select("key", shingles(F.col("text"), width).alias("all"))
              .select("key", F.size("all").alias("size"), F.explode("all").alias("s")))
    hits = (probes.join(sized(sketch), "s").filter("size >= need").select("key", "item").distinct()
            .groupBy("key").agg(F.collect_list("item").alias("items")))
    hits = stored(hits, "leak_candidates")
    found = (rows.join(hits, "key")
             .select("key", "id", "items", F.array_distinct(shingles(F.col("text"), width)).alias("own"))
             .select("key", "id", "own", F.explode("items").alias("item")))
    shared = F.size(F.array_intersect("own", "shingles"))
    return (found.join(sized(sets.select("item", "shingles", "n")), "item")
            .select("key", "id", "item", F.col("n").cast("long").alias("n_item"), shared.cast("long").alias("n_shared"))
            .filter(F.col("n_shared") * 100 >= F.col("n_item") * percent))


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no item."""
    keys = leaks(docs, items, id_col, text_col, item_col, item_text_col).select("key").distinct()
    key = F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string"))
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"))
    return named.join(keys, "key", "left_anti").select("row.*")
