"""Best-fit packing of token sequences: hierarchical residual packing.

1. Each partition cuts its documents to pieces and packs them best-fit, longest
   first. Bins with at most ``SLACK`` free places are emitted; the others are residual.
2. Residual bins are items of the next level: spread over as many tasks as their
   number asks for (``ITEMS`` a task), packed best-fit again, and so on up the tree.
   Bins that not even the smallest residual could join are emitted on the way. The last level
   is one task of at most ``ITEMS`` items; the climb also ends when a level saves no bin.

A document is its ids and one end id. A longer document is cut into pieces of the whole
capacity, of which the first may be shorter; nothing else is cut. Pieces of a sequence
have gapless offsets from 0. Bins are fixed by writing each level to the shared
checkpoint folder, so a lost executor cannot renumber them. The same input files in the
same splits give the same packing.

Defined cases: a null or empty text is the end id alone; null ids and repeated rows are
packed like any other row; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tokens
from .common import prepare, stored

CAPACITY = 1024
END_ID = 2
SLACK = 8
ITEMS = 100_000
TASK_BITS = 33
LEVEL_BITS = 56


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, length, capacity))]


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit, longest first: (bin, offset) of each item, and the bins' fill."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    fill: list[int] = []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by free places
    free_mask = 0  # bit f: some bin has f free places
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = free_mask >> size
        if fits and size:
            free = size + (fits & -fits).bit_length() - 1  # the least room that is enough
            b = open_bins[free].pop()
            if not open_bins[free]:
                free_mask &= ~(1 << free)
        else:
            b, free = len(fill), capacity
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        if left := free - size:
            open_bins[left].append(b)
            free_mask |= 1 << left
    return bins, offsets, np.array(fill, np.int64)


PIECES = T.StructType([
    T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("bin", T.LongType()), T.StructField("offset", T.LongType()),
    T.StructField("fill", T.LongType())])


def _pack_partition(path: str | None, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, first = tokens.ids(path), TaskContext.get().partitionId() << TASK_BITS
        held: list[tuple[pa.Array, np.ndarray]] = []
        count, kind = 0, None

        def pack() -> pa.RecordBatch:
            nonlocal first
            ids = pa.concat_arrays([h[0] for h in held])
            piece, start, length, crc = np.concatenate([h[1] for h in held], axis=1)
            bins, offsets, fill = best_fit(length, capacity)
            out = pa.RecordBatch.from_arrays(
                [ids, *(pa.array(c, t) for c, t in ((piece, pa.int32()), (start, pa.int64()), (length, pa.int64()),
                                                    (crc, pa.int64()), (bins + first, pa.int64()),
                                                    (offsets, pa.int64()), (fill[bins], pa.int64())))],
                ["id", *PIECES.names])
            first += len(fill)
            return out

        for b in batches:
            kind = b.column(0).type
            flat, sizes = encode(b.column(1).to_pylist())
            rows, owner, at = [], [], 0
            for i, n in enumerate(sizes.tolist()):
                own = np.append(flat[at : at + n], end_id).astype("<u4")
                at += n
                for k, (s, size) in enumerate(cut(n + 1, capacity)):
                    rows.append((k, s, size, zlib.crc32(own[s : s + size].tobytes())))
                    owner.append(i)
            held.append((b.column(0).take(pa.array(owner, pa.int64())), np.array(rows, np.int64).T))
            count += len(rows)
            if count >= 10 * ITEMS:  # a huge partition is packed in turns
                yield pack()
                held, count = [], 0
        if held:
            yield pack()

    return run


def _pack_bins(level: int, capacity: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = level << LEVEL_BITS | TaskContext.get().partitionId() << TASK_BITS
        items = pd.concat(list(frames) or [pd.DataFrame({"item": [], "size": []}, dtype="int64")])
        bins, offsets, fill = best_fit(items["size"].to_numpy(), capacity)
        yield pd.DataFrame({"item": items["item"].to_numpy(), "bin": bins + first, "shift": offsets, "fill": fill[bins]})

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    ``path``: the tokenizer file, as each machine finds it (default: the public
    byte-level one)."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), *PIECES.fields])
    pieces = stored(rows.mapInArrow(_pack_partition(path, capacity, end_id), schema), "packed_pieces")
    full = F.col("fill") >= capacity - SLACK
    open_items = pieces.filter(~full & (F.col("offset") == 0)).select(F.col("bin").alias("item"), F.col("fill").alias("size"))
    moved = open_items.select(F.col("item").alias("leaf"), F.col("item").alias("bin"), F.lit(0).cast("long").alias("shift"))
    items, before, level = open_items, open_items.count(), 1
    while before:
        tasks = max(1, -(-before // ITEMS))
        packed = stored(items.repartition(tasks, "item").mapInPandas(
            _pack_bins(level, capacity), "item long, bin long, shift long, fill long"), "packed_bins")
        step = packed.select(F.col("item").alias("bin"), F.col("bin").alias("_to"), F.col("shift").alias("_by"))
        moved = stored(moved.join(step, "bin", "left")
                       .select("leaf", F.coalesce("_to", "bin").alias("bin"),
                               (F.col("shift") + F.coalesce("_by", F.lit(0))).alias("shift")), "packed_moves")
        heads = packed.filter(F.col("shift") == 0)
        if tasks == 1 or heads.count() == before:
            break
        items = heads.filter(~full).select(F.col("bin").alias("item"), F.col("fill").alias("size"))
        least = items.agg(F.min("size")).first()[0] or 0
        items = items.filter(F.col("size") + least <= capacity)  # what not even the smallest can join is done
        before, level = items.count(), level + 1
    final = moved.select(F.col("leaf").alias("bin"), F.col("bin").alias("_to"), "shift")
    out = ["id", "piece", "start", "length", "ids_crc32"]
    done = pieces.filter(full).select(*out, F.col("bin").alias("sequence_id"), "offset")
    rest = (pieces.filter(~full).join(final, "bin")
            .select(*out, F.col("_to").alias("sequence_id"), (F.col("offset") + F.col("shift")).alias("offset")))
    return done.unionByName(rest).withColumnRenamed("id", id_col)
