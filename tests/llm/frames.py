"""Small document tables with the awkward cases every operator must take."""

from __future__ import annotations

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
#: Names that operators use inside, as extra columns of the input.
CLASHES = ("id", "spans", "bin", "start", "end", "key", "n", "line", "words", "score", "h", "fp", "rank", "kind", "block")


def docs(spark, texts, ids=None, extra=False, partitions=2):
    """A documents table of ``texts``; ``extra`` adds columns with clashing names."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", None, None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)]
    df = spark.createDataFrame(rows, DOCS).repartition(partitions)
    if extra:
        for c in CLASHES:
            df = df.withColumn(c, df["doc_id"])
    return df
