"""Exact top-k inner products: Voronoi kNN join.

The largest inner product is the nearest neighbour after each data vector gets one
more coordinate, sqrt(M^2 - |v|^2) (M: the largest norm; 0 for queries), so the metric
bounds of a Voronoi join apply:

1. Pivots (a bounded sample, farthest first) split data and queries into cells; cells
   with near pivots form a few groups of queries.
2. Summaries of the cells (the largest query distance, the smallest data distances of
   ``k + 1`` different ids) give each query cell an upper bound of the distance of its (k+1)-th
   id, of which one may be the query's own, and the triangle inequality gives a lower bound for
   each data row. Only summaries reach the driver.
3. A data row goes only to the groups in which some cell's lower bound is within its
   upper bound. Groups are cut into blocks of queries and rows of a bounded size, so a
   hot cell (a third of all vectors equal, say) is many small tasks.
4. Each block pair is solved exactly; the blocks' best are merged per query.

Scores are exact: products are float64 where every sum stays below 2^53, else Python
integers. Ties go to the smaller id. A vector that is null, or has a null or
non-finite component, takes no part; shorter vectors count as padded with zeros; a row
is never its own candidate (rows with the query's id are the query itself); an id
given twice is one query per distinct vector. A null id takes no part. Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, stored

PIVOTS = 64
GROUPS = 8
SAMPLE = 1024
BLOCK_ROWS = 1024
BLOCK_QUERIES = 1024
EXACT = 2.0**53


def usable(vec: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return vec.isNotNull() & ~F.coalesce(F.exists(vec, bad), F.lit(False))


def quantised(vec: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, x as double."""
    return F.transform(vec, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def _matrix(column: pa.Array | pd.Series, width: int = 0) -> np.ndarray:
    """Rows of integers as an int64 matrix, short ones padded with zeros."""
    rows = column.to_pylist() if isinstance(column, (pa.Array, pa.ChunkedArray)) else list(column)
    width = max(width, *(len(r) for r in rows)) if rows else width
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _distances(x: np.ndarray, tail: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """(rows, pivots) distances; ``tail`` is the added coordinate, the pivots' is their last."""
    width = max(x.shape[1], pivots.shape[1] - 1)
    a = np.zeros((len(x), width + 1))
    a[:, : x.shape[1]], a[:, -1] = x, tail
    b = np.zeros((len(pivots), width + 1))
    b[:, : pivots.shape[1] - 1], b[:, -1] = pivots[:, :-1], pivots[:, -1]
    sq = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(sq, 0))


def _choose_pivots(rows: list[list[int]], top: float, n: int) -> np.ndarray:
    """Farthest-first pivots of the sample, with their added coordinate."""
    x = _matrix(pd.Series(rows)).astype(np.float64)
    tail = np.sqrt(np.maximum(top - (x * x).sum(1), 0))
    full = np.concatenate([x, tail[:, None]], axis=1)
    far, picked = np.full(len(full), np.inf), [0]
    while len(picked) < min(n, len(full)):
        far = np.minimum(far, ((full - full[picked[-1]]) ** 2).sum(1))
        if far.max() <= 0:
            break
        picked.append(int(far.argmax()))
    return full[picked]


def _top(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> list[list[int]]:
    """Per query the positions of its k best columns; ids ascend, so ties go to the smaller id."""
    out = []
    for row, q in zip(scores, own, strict=True):
        order = np.argsort(-row, kind="stable")[: k + int((ids == q).sum())]
        out.append([int(j) for j in order if ids[j] != q][:k])
    return out


def _products(q: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Integer inner products, negatable for sorting."""
    width = max(q.shape[1], d.shape[1])
    q, d = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, d))
    most = float(np.abs(q).max(initial=0)) * float(np.abs(d).max(initial=0)) * width
    if most < EXACT:
        return (q.astype(np.float64) @ d.T.astype(np.float64)).astype(np.int64)
    return q.astype(object) @ d.T.astype(object)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = 256, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` best other rows of every row where ``is_query`` holds."""
    spark = vectors.sparkSession
    prepare(spark)
    vec = F.col(f"`{vec_col}`")
    rows = (vectors.filter(usable(vec) & F.col(f"`{id_col}`").isNotNull())
            .select(F.col(f"`{id_col}`").alias("id"), quantised(vec, scale).alias("v"),
                    F.coalesce(is_query, F.lit(False)).alias("q")))
    rows = stored(rows, "knn_rows")
    as_double = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    total, top = rows.agg(F.count("*"), F.max(as_double)).first()
    drawn = rows.orderBy(F.xxhash64("v"), "id").limit(SAMPLE if total else 0).select("v").collect()
    points = _choose_pivots([r["v"] for r in drawn] or [[0]], top or 0.0, pivots)
    between = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    group = between[:, :GROUPS].argmin(1)
    top = top or 0.0

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1))
            real = x.astype(np.float64)
            d = _distances(x, np.sqrt(np.maximum(top - (real * real).sum(1), 0)), points)
            e = _distances(x, np.zeros(len(x)), points)
            cells, of_query = d.argmin(1), e.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(cells, pa.int32()), pa.array(d[np.arange(len(x)), cells], pa.float64()),
                 pa.array(of_query, pa.int32()), pa.array(e[np.arange(len(x)), of_query], pa.float64())],
                ["id", "v", "q", "cell", "dist", "q_cell", "q_dist"])

    placed = stored(rows.mapInArrow(nearest, "id long, v array<long>, q boolean, cell int, dist double, "
                                             "q_cell int, q_dist double"), "knn_cells")

    def smallest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = pd.DataFrame({"cell": pd.Series(dtype="int32"), "id": pd.Series(dtype="int64"), "dist": pd.Series(dtype="float64")})
        for f in frames:
            best = (pd.concat([best, f]).sort_values("dist").drop_duplicates(["cell", "id"]).groupby("cell").head(k + 1))
        yield best

    nearest_ids = (placed.select("cell", "id", "dist").mapInPandas(smallest, "cell int, id long, dist double")
                   .groupBy("cell", "id").agg(F.min("dist").alias("dist")))
    summary = (nearest_ids.groupBy("cell")
               .agg(F.slice(F.sort_array(F.collect_list(F.struct("dist", "id"))), 1, k + 1).alias("d")).collect())
    asked = {r["q_cell"]: r for r in placed.filter("q").groupBy("q_cell")
             .agg(F.max("q_dist").alias("far"), F.count("*").alias("n")).collect()}
    slack = 1e-6 * (1.0 + float(np.sqrt(top)))  # more than the rounding of any distance
    limit = {}
    for i, r in asked.items():
        nearest_of: dict[int, float] = {}
        for s in summary:
            for d, ident in s["d"]:
                nearest_of[ident] = min(r["far"] + between[i, s["cell"]] + d, nearest_of.get(ident, np.inf))
        upper = sorted(nearest_of.values())
        limit[i] = upper[k] + slack if len(upper) > k else np.inf
    n_groups = int(group.max()) + 1
    q_blocks = [max(1, -(-sum(r["n"] for i, r in asked.items() if group[i] == g) // BLOCK_QUERIES))
                for g in range(n_groups)]
    d_blocks = max(1, -(-(total or 0) // BLOCK_ROWS))

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row once for every group (and block of its queries) that may need it."""
        for b in batches:
            cell, dist = (np.asarray(b.column(c)) for c in (2, 3))
            need = np.zeros((len(cell), n_groups), bool)
            for i, r in asked.items():
                gap = between[i, cell]
                low = np.maximum(gap - r["far"] - dist, dist - gap - r["far"])
                need[:, group[i]] |= low <= limit[i]
            at, g = np.nonzero(need)
            times = np.array(q_blocks)[g]
            at, g = np.repeat(at, times), np.repeat(g, times)
            block = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
            rows = pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["id", "v"]).take(pa.array(at))
            yield pa.RecordBatch.from_arrays([pa.array(g, pa.int32()), pa.array(block, pa.int32()), *rows.columns],
                                             ["g", "qb", "id", "v"])

    spread = lambda n: F.pmod(F.xxhash64("id", "v"), n).cast("int")
    data = (placed.select("id", "v", "cell", "dist")
            .mapInArrow(replicate, "g int, qb int, id long, v array<long>")
            .withColumn("db", spread(F.lit(d_blocks))))
    blocks = F.lit(1)
    groups = F.lit(0)
    for i, g in enumerate(group):
        groups = F.when(F.col("q_cell") == i, F.lit(int(g))).otherwise(groups)
        blocks = F.when(F.col("q_cell") == i, F.lit(int(q_blocks[g]))).otherwise(blocks)
    asks = (placed.filter("q").select("id", "v", groups.alias("g"), spread(blocks).alias("qb")).distinct()
            .withColumn("db", F.explode(F.sequence(F.lit(0), F.lit(d_blocks - 1)))))

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        """The best rows of one block of data for one block of queries."""
        ids, order = np.unique(np.asarray(left["id"]), return_index=True) if left.num_rows else ([], [])
        out: list[tuple[int, list[int], int, int]] = []
        if len(ids) and right.num_rows:
            every = np.asarray(left["id"])
            order = np.argsort(every, kind="stable")
            d, q = _matrix(left["v"])[order], _matrix(right["v"])
            scores, own = _products(q, d), np.asarray(right["id"])
            for i, best in enumerate(_top(scores, every[order], own, k)):
                out += [(int(own[i]), right["v"][i].as_py(), int(every[order][j]), int(scores[i, j])) for j in best]
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        return pa.table({n: pa.array(list(c), t) for (n, t), c in zip(
            (("query_id", pa.int64()), ("qv", pa.list_(pa.int64())), ("id", pa.int64()), ("score", pa.int64())),
            columns, strict=True)})

    keys = ("g", "qb", "db")
    best = (data.groupBy(*keys).cogroup(asks.groupBy(*keys))
            .applyInArrow(solve, "query_id long, qv array<long>, id long, score long"))
    best = best.withColumn("qv", F.xxhash64("qv"))
    w = Window.partitionBy("query_id", "qv").orderBy(F.desc("score"), "id")
    return (best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))
