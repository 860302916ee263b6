"""Token counts of the documents in flat token files: separator scan.

A token file is one run of ids, documents divided by an end-of-document id, without any
index. It is kept as blocks of ``BLOCK_IDS`` ids (rows of a table: file, block, bytes),
cut regardless of documents.

1. Each block is searched for separators, vectorised, apart from all others.
2. Blocks are stitched by a prefix scan over their summaries (ids, separators, place of
   the last one): it gives each block the number of documents and the place of the last
   separator before it, also across blocks that hold none.
3. A document's count is the distance of its separator to the one before.

``write_token_files`` makes such files from documents, and keeps the documents' ids in
file order (their order only: no place or length). Defined cases: a null or empty text is
a document of 0 tokens; ids may be null or repeat; extra columns are ignored; an empty
table gives no rows; ids after the last separator of a file belong to no document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from . import tokens
from .common import prepare

BLOCK_IDS = 1 << 17
END_OF_DOCUMENT = 50256
ID_BYTES = 2  # ids below 65,536; 4 for larger vocabularies
NAMES = 4096


def write_token_files(docs: DataFrame, out: str, id_col: str = "doc_id", text_col: str = "text",
                      path: str | None = None, separator: int = END_OF_DOCUMENT, id_bytes: int = ID_BYTES) -> None:
    """One token file per partition, below ``out``: rows (file, block, ids) and, apart
    from them, rows (file, first, names) with the documents' ids in order."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["id"].dataType
    schema = T.StructType([
        T.StructField("file", T.LongType()), T.StructField("block", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("first", T.LongType()), T.StructField("names", T.ArrayType(kind))])
    size = BLOCK_IDS * id_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, file = tokens.ids(path), TaskContext.get().partitionId()
        rest, block, first = b"", 0, 0

        def row(ids: bytes | None, names: pa.Array | None, at: int) -> pa.RecordBatch:
            held = (pa.nulls(1, pa.list_(names_kind)) if names is None
                    else pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names))
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int64()), pa.array([at if ids is not None else None], pa.int64()),
                 pa.array([ids], pa.binary()), pa.array([at if ids is None else None], pa.int64()), held], schema.names)

        for b in batches:
            names_kind = b.column(0).type
            flat, sizes = encode(b.column(1).to_pylist())
            ends = np.cumsum(sizes)
            rest += np.insert(flat, ends, separator).astype(f"<u{id_bytes}").tobytes()
            for i in range(0, len(b), NAMES):
                names = b.column(0).slice(i, NAMES)
                yield row(None, names, first)
                first += len(names)
            at = 0
            while len(rest) - at >= size:
                yield row(rest[at : at + size], None, block)
                at, block = at + size, block + 1
            rest = rest[at:]
        if rest:
            yield row(rest, None, block)

    rows.mapInArrow(run, schema).write.option("compression", "zstd").parquet(out)


def _scan(separator: int, id_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.frombuffer(ids.as_py(), f"<u{id_bytes}") for ids in b.column(2)]
            seps = [np.flatnonzero(ids == separator).astype(np.int32) for ids in found]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(ids) for ids in found], pa.int64()),
                 pa.array(seps, pa.list_(pa.int32()))], ["file", "block", "n", "seps"])

    return run


def count_documents(blocks: DataFrame, separator: int = END_OF_DOCUMENT, id_bytes: int = ID_BYTES) -> DataFrame:
    """(file, ordinal, n_tokens) of every document of the files: ``blocks`` has (file, block, ids)."""
    prepare(blocks.sparkSession)
    found = (blocks.select("file", "block", "ids")
             .mapInArrow(_scan(separator, id_bytes), "file long, block long, n long, seps array<int>"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("n").over(before), F.lit(0))
    found = found.select("*", base.alias("base"),
                         F.coalesce(F.sum(F.size("seps")).over(before), F.lit(0)).alias("ordinal"))
    last = F.col("base") + F.element_at("seps", -1)
    found = found.withColumn("last", F.when(F.size("seps") > 0, last))
    found = found.select("file", "ordinal", "seps", (F.coalesce(F.max("last").over(before), F.lit(-1))
                                                     - F.col("base")).alias("prev"))
    one = F.posexplode(F.transform("seps", lambda s, i: s - F.when(i == 0, F.col("prev")).otherwise(
        F.get("seps", i - 1)) - 1))
    return (found.select("file", "ordinal", one.alias("i", "n_tokens"))
            .select("file", (F.col("ordinal") + F.col("i")).alias("ordinal"), F.col("n_tokens").cast("long")))


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id, file, ordinal, n_tokens): documents written as token files, and counted from them."""
    spark = docs.sparkSession
    out = scratch_path(spark, "llm", "token_files")
    write_token_files(docs, out, id_col, text_col, path)
    files = spark.read.parquet(out)
    names = (files.filter("names IS NOT NULL").select("file", "first", F.posexplode("names").alias("i", id_col))
             .select("file", (F.col("first") + F.col("i")).alias("ordinal"), id_col))
    return (count_documents(files.filter("ids IS NOT NULL")).join(names, ["file", "ordinal"])
            .select(id_col, "file", "ordinal", "n_tokens"))
