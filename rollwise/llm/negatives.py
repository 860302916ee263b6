"""Hard negatives: anchors against all candidates, in tiles multiplied by Strassen's recursion.

1. Anchors and candidates (rows of integers) are dealt to blocks; a task holds one block of anchors and one of
   candidates and goes over them in tiles.
2. ``strassen`` multiplies two int64 tiles: padded with zeros to even halves, seven products instead of eight,
   recursively. Sums and differences are integers modulo 2^64, so the result is exact wherever the
   true inner product is a long. Leaves are multiplied as doubles where all their sums stay below
   2^53, else as int64.
3. Positives: candidates of the anchor's label. Rows meet by a hash of the label, so an anchor is
   compared only with such candidates; a hot label is many blocks. A block returns a heap of each
   anchor's best ``positives``, and the heaps are merged.
4. Negatives: every positive opens a window of scores; all blocks are multiplied once more and return, per
   window, a heap of the best ``count`` rows of another label within it; the heaps are merged.

All candidates are compared, none is cut off; a heap is as long as the rows that the result may take from it. Ties
go to the smaller id.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take no part; shorter
vectors count as padded with zeros; rows that carry the anchor's id are the anchor itself, neither positive nor
negative; repeated rows are rows of their own among the candidates and one anchor; an id on different rows is an
anchor for each of them (their results are not told apart by columns); a window that is empty or holds no row gives no rows, nor does an anchor without
positives, nor an empty table. Other columns are ignored. Scores must be longs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, stored
from .knn import quantised, usable

#: The most rows of a block, the fewest worth a task of their own, and the most groups of labels.
BLOCK, LEAST, GROUPS = 32768, 2048, 65536
#: Rows and columns of a tile; the side from which tiles are no longer divided.
TILE_ROWS, TILE_COLUMNS, LEAF = 256, 2048, 32
EXACT = 2.0**53
LOWEST = np.iinfo(np.int64).min


# ------------------------------------------------------------- multiplication
def _leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    most = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0))
    if most * a.shape[1] < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b  # modulo 2^64


def _even(m: np.ndarray) -> np.ndarray:
    return np.pad(m, ((0, m.shape[0] % 2), (0, m.shape[1] % 2)))


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices, modulo 2^64."""
    rows, columns = a.shape[0], b.shape[1]
    if min(rows, a.shape[1], columns) <= leaf:
        return _leaf(a, b)
    a, b = _even(a), _even(b)
    i, j, k = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]
    m1 = strassen(a11 + a22, b11 + b22, leaf)
    m2 = strassen(a21 + a22, b11, leaf)
    m3 = strassen(a11, b12 - b22, leaf)
    m4 = strassen(a22, b21 - b11, leaf)
    m5 = strassen(a11 + a12, b22, leaf)
    m6 = strassen(a21 - a11, b11 + b12, leaf)
    m7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * k), np.int64)
    out[:i, :k] = m1 + m4 - m5 + m7
    out[:i, k:] = m3 + m5
    out[i:, :k] = m2 + m4
    out[i:, k:] = m1 - m2 + m3 + m6
    return out[:rows, :columns]


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of integers as an int64 matrix, short ones padded with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = np.asarray(column.flatten())
    return out


# --------------------------------------------------------------------- heaps
def best(scores: np.ndarray, allowed: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, columns) of the ``count`` best allowed scores of every row; ties go to the earlier column."""
    s = np.where(allowed, scores, LOWEST)
    if s.shape[1] > count:
        floor = np.partition(s, s.shape[1] - count, axis=1)[:, s.shape[1] - count]
        at, col = np.nonzero(allowed & (s >= floor[:, None]))
    else:
        at, col = np.nonzero(allowed)
    order = np.lexsort((col, ~s[at, col], at))  # ~ turns the order round without overflow
    at, col = at[order], col[order]
    first = np.searchsorted(at, at)
    keep = np.arange(len(at)) - first < count
    return at[keep], col[keep]


class Heaps:
    """The best ``count`` (score, id) of every key, merged tile by tile."""

    def __init__(self, count: int):
        self.count = count
        self.key, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def push(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        key, score, ids = (np.concatenate(p) for p in ((self.key, key), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, ~score, key))
        key, score, ids = key[order], score[order], ids[order]
        keep = np.arange(len(key)) - np.searchsorted(key, key) < self.count
        self.key, self.score, self.id = key[keep], score[keep], ids[keep]


def _tiles(rows: int, columns: int):
    return ((slice(i, i + TILE_ROWS), slice(j, j + TILE_COLUMNS))
            for i in range(0, rows, TILE_ROWS) for j in range(0, columns, TILE_COLUMNS))


def _ordered(t: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, labels, matrix) by ascending id, so that earlier columns win ties."""
    t = t.sort_by("id")
    return np.asarray(t["id"]), np.asarray(t["label"]), matrix(t["v"], width)


# ------------------------------------------------------------------ the joins
def _blocks(n: Column, cores: int) -> Column:
    """Blocks for n rows: of at most ``BLOCK``, and as many as there are cores if worth it."""
    return F.greatest(F.ceil(n / BLOCK), F.least(F.lit(2 * cores), F.ceil(n / LEAST))).cast("int")


def _met(anchors: DataFrame, rows: DataFrame, cores: int) -> tuple[DataFrame, DataFrame]:
    """Anchors and candidates, each with (g, ab, cb): every anchor of a group ``g`` meets every candidate of it
    in just one pair of blocks."""
    sizes = (rows.groupBy("g").agg(F.count("*").alias("n")).join(anchors.groupBy("g").agg(F.count("*").alias("m")), "g")
             .select("g", F.ceil(F.col("m") / BLOCK).cast("int").alias("abs"), _blocks(F.col("n"), cores).alias("cbs")))
    sizes = F.broadcast(sizes)  # at most GROUPS rows
    deal = lambda of, n: F.pmod(F.xxhash64(*of), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = anchors.join(sizes, "g").withColumn("ab", deal(("key", "g"), "abs")).withColumn("cb", every("cbs"))
    right = rows.join(sizes, "g").withColumn("cb", deal(("id", "v"), "cbs")).withColumn("ab", every("abs"))
    right = right.drop("abs", "cbs")
    return left.drop("abs", "cbs"), right.select(*[F.col(c).alias(c) for c in right.columns])  # columns of its own


def _merged(heaps: DataFrame, keys: list[str], count: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return heaps.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= count)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, count: int = 10, low: int = 30,
                   high: int = 90, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                   scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and each of its best
    ``positives``, the best ``count`` rows of other labels with a score of ``low`` to ``high`` percent of the positive's."""
    spark = vectors.sparkSession
    prepare(spark)
    vec, ident, label = (F.col(f"`{c}`") for c in (vec_col, id_col, label_col))
    rows = stored(vectors.filter(usable(vec) & ident.isNotNull() & label.isNotNull())
                  .select(ident.cast("long").alias("id"), label.alias("label"), quantised(vec, scale).alias("v"),
                          F.coalesce(is_anchor, F.lit(False)).alias("anchor")), "negative_rows")
    total, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    width, cores = width or 1, spark.sparkContext.defaultParallelism
    groups = min(max(math.ceil(total / BLOCK), 2 * cores), GROUPS)
    by_label = rows.withColumn("g", F.pmod(F.xxhash64("label"), F.lit(groups)).cast("int"))
    anchors = by_label.filter("anchor").select("g", F.xxhash64("id", "label", "v").alias("key"), "id", "label", "v").distinct()

    def positive(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, labels, v = _ordered(right, width)
        key, own, of, a = (np.asarray(left["key"]), np.asarray(left["id"]), np.asarray(left["label"]), matrix(left["v"], width))
        heaps = Heaps(positives)
        for r, c in _tiles(len(a), len(v)):
            s = strassen(a[r], np.ascontiguousarray(v[c].T))
            at, col = best(s, (labels[c] == of[r, None]) & (ids[c] != own[r, None]), positives)
            heaps.push(at + r.start, s[at, col], ids[c][col])
        return pa.table({"key": pa.array(key[heaps.key]), "anchor_id": pa.array(own[heaps.key]),
                         "id": pa.array(heaps.id), "score": pa.array(heaps.score)})

    left, right = _met(anchors, by_label.select("g", "id", "label", "v"), cores)
    keys = ("g", "ab", "cb")
    found = (left.groupBy(*keys).cogroup(right.groupBy(*keys))
             .applyInArrow(positive, "key long, anchor_id long, id long, score long"))
    found = _merged(found, ["key"], positives).groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("p"))  # at most ``positives`` of them
    asked = stored(anchors.drop("g").join(found, "key").select(
        F.lit(0).alias("g"), "key", "id", "label", "v", F.col("p.id").alias("p_id"), F.col("p.score").alias("p_score")),
        "negative_windows")

    def negative(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, labels, v = _ordered(right, width)
        key, own, of, a = (np.asarray(left["key"]), np.asarray(left["id"]), np.asarray(left["label"]), matrix(left["v"], width))
        p_id, p_score = left["p_id"].to_pylist(), left["p_score"].to_pylist()
        # bounds of every window, empty ones with their ends swapped
        lows, highs = np.ones((len(a), positives), np.int64), np.zeros((len(a), positives), np.int64)
        for i, scores in enumerate(p_score):
            for j, p in enumerate(scores):
                lows[i, j], highs[i, j] = -(-low * p // 100), high * p // 100
        heaps = Heaps(count)
        for r, c in _tiles(len(a), len(v)):
            s = strassen(a[r], np.ascontiguousarray(v[c].T))
            other = (labels[c] != of[r, None]) & (ids[c] != own[r, None])
            for j in range(positives):
                at, col = best(s, other & (s >= lows[r, j, None]) & (s <= highs[r, j, None]), count)
                heaps.push((at + r.start) * positives + j, s[at, col], ids[c][col])
        i, j = heaps.key // positives, heaps.key % positives
        pick = lambda of: pa.array([of[x][y] for x, y in zip(i.tolist(), j.tolist(), strict=True)], pa.int64())
        return pa.table({"key": pa.array(key[i]), "anchor_id": pa.array(own[i]), "place": pa.array(j), "positive_id": pick(p_id),
                         "positive_score": pick(p_score), "id": pa.array(heaps.id), "score": pa.array(heaps.score)})

    left, right = _met(asked, rows.select(F.lit(0).alias("g"), "id", "label", "v"), cores)
    found = (left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        negative, "key long, anchor_id long, place long, positive_id long, positive_score long, id long, score long"))
    return _merged(found, ["key", "place"], count).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
