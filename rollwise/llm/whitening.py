"""Whitening of embeddings by shifted CholeskyQR.

Covariances are taken of A, the rows x - mean: its thin factorisation A = Q R, with Q^T Q = I, gives the
eigenvectors of the covariance as the right singular vectors of the small R, without squaring A's condition.

1. One pass sums every dimension and counts rows, exactly (integers).
2. Rounds of CholeskyQR: a pass computes the Gram matrix of Q = A R^-1 (batches centre their rows before any
   multiplication and solve with the triangular R so far; d x d sums are added up by a hash aggregate), the driver
   factors it and multiplies R. The first rounds add a shift to the Gram matrix's diagonal, which
   keeps its Cholesky factorisation from breaking down; once the Gram matrix is well conditioned, plain rounds
   follow until it is the identity.
3. Directions without variance cannot be orthogonalised; they show as zero eigenvalues of the last Gram
   matrix, and what is left of it goes into R. The SVD of R gives components and eigenvalues.
4. The last passes project the rows; the covariance of the result is measured by a pass of its own.

Only sums of d and d x d numbers reach the driver, however many rows there are.

Defined cases: a vector that is null, or has a null or non-finite entry, takes no part; shorter vectors count as
padded with zeros; rows with repeated or null ids are rows of their own; eigenvalues up to ``d * 1e-14`` of
the largest count as zero and have no component, so a table of equal rows gives no rows, and neither
does an empty one. Other columns are ignored. ``deviation`` is exact; where it exceeds a long, it is null. Entries
must be small enough for row count times entry to be a long (else the job raises). A component's sign
makes its largest entry positive; equal eigenvalues leave their components' directions open.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, stored
from .knn import usable

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
#: Eigenvalues of at most ``width * NOTHING`` of the largest count as zero.
NOTHING = 1e-14
#: Rounds go on until the live eigenvalues of the Gram matrix are this close to one.
CLOSE = 1e-8
ROUNDS = 40


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of integers as an int64 matrix, short ones padded with ``OFFSET`` (the integer of zero)."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = np.asarray(column.flatten())
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.full((len(sizes), width), OFFSET, np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _summed(rows: DataFrame, terms: Callable[[pa.RecordBatch], np.ndarray], size: int, kind: str) -> np.ndarray:
    """The sum over all rows of ``terms`` (``size`` numbers a batch): added up in each task, then by key."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64 if kind == "long" else np.float64)
        for b in batches:
            if b.num_rows:
                total += terms(b)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["k", "v"])

    out = np.zeros(size, np.int64 if kind == "long" else np.float64)
    for r in rows.mapInArrow(partial, f"k long, v {kind}").groupBy("k").agg(F.sum("v").alias("v")).collect():
        out[r["k"]] = r["v"]
    return out


def _cholesky(gram: np.ndarray, rows: int) -> np.ndarray:
    """The upper factor of a Gram matrix, shifted unless it is well conditioned."""
    d = len(gram)
    norm = max(float(np.linalg.norm(gram, 2)), np.finfo(float).tiny)
    if np.linalg.eigvalsh(gram)[0] > 1e-3 * norm:
        return np.linalg.cholesky(gram).T
    # the shift that bounds the rounding of the Gram matrix and its factorisation
    shift = 11 * (d * rows + d * (d + 1)) * np.finfo(float).eps / 2 * norm
    shift = min(shift, 1e-2 * norm)
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift *= 10


def _solve(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """a r^-1 for an upper triangular r."""
    return np.linalg.solve(r.T, a.T).T


def factored(rows: DataFrame, width: int, n: int, sums: np.ndarray) -> np.ndarray:
    """B with A^T A = B^T B, where A holds the centred rows; B has as many rows as A has rank."""
    r = np.eye(width)
    pairs = np.triu_indices(width)

    def gram_of(factor: np.ndarray) -> np.ndarray:
        def terms(b: pa.RecordBatch) -> np.ndarray:
            q = _solve((n * matrix(b.column(1), width) - sums) / n, factor)
            return (q.T @ q)[pairs]
        out = np.zeros((width, width))
        out[pairs] = _summed(rows, terms, len(pairs[0]), "double")
        return out + np.triu(out, 1).T

    before = np.inf
    for _ in range(ROUNDS):
        gram = gram_of(r)
        if not gram.any():
            return np.zeros((0, width))
        values, vectors = np.linalg.eigh(gram)
        live = values > 0.5
        parts = np.sqrt(np.maximum(values, 0))[:, None] * (vectors.T @ r)
        if live.any():
            # directions with variance tend to one; what has not got there must be no more than rounding
            away = np.abs(values[live] - 1).max()
            rest = np.linalg.norm(parts[~live]) if not live.all() else 0.0
            settled = away < CLOSE or before / 2 <= away < 0.1  # the second: held up by the shift
            if settled and rest <= np.sqrt(width * NOTHING) * np.linalg.norm(parts[live], 2):
                break
            before = away
        r = _cholesky(gram, n) @ r
    return parts[live]


def components(rows: DataFrame, width: int, n: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, eigenvectors as columns) of the covariance of the stored ``rows``."""
    b = factored(rows, width, n, sums)
    if not len(b):
        return np.zeros(0), np.zeros((width, 0))
    _, s, vt = np.linalg.svd(b, full_matrices=False)
    live = s * s > width * NOTHING * s[0] * s[0]
    s, v = s[live], vt[live].T
    return s * s / n, v * np.sign(v[np.abs(v).argmax(0), np.arange(v.shape[1])])


def whitened(vectors: DataFrame, count: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of every row and its first ``count`` components."""
    prepare(vectors.sparkSession)
    vec = F.col(f"`{vec_col}`")
    quantised = F.transform(vec, lambda x: F.floor(x.cast("double") * F.lit(float(SCALE))) + F.lit(OFFSET).cast("long"))
    rows = stored(vectors.filter(usable(vec)).select(F.col(f"`{id_col}`").alias("id"), quantised.alias("x")), "whiten_rows")
    n, width, most = rows.agg(F.count("*"), F.max(F.size("x")), F.max(F.greatest(
        F.array_max("x"), -F.array_min("x")))).first()
    width = width or 0
    empty = f"id {vectors.schema[id_col].dataType.simpleString()}, component int, n long, deviation long, whitened double, " \
            "explained double, identity_error double"
    if not width:
        return vectors.sparkSession.createDataFrame([], empty)
    if n * max(most, OFFSET) >= 2**62:
        raise OverflowError(f"{n} rows with entries up to {most} cannot be summed exactly")
    sums = _summed(rows, lambda b: matrix(b.column(1), width).sum(0), width, "long")
    values, vectors_ = components(rows, width, n, sums)
    k = min(count, len(values))
    if not k:
        return vectors.sparkSession.createDataFrame([], empty)
    project = vectors_[:, :k] / np.sqrt(values[:k])
    explained = values / values.sum()

    def centred(b: pa.RecordBatch) -> np.ndarray:
        return n * matrix(b.column(1), width) - sums

    def moments(b: pa.RecordBatch) -> np.ndarray:
        w = (centred(b) / n) @ project
        return np.concatenate([w.sum(0), (w.T @ w).ravel()])

    found = _summed(rows, moments, k + k * k, "double") / n
    error = float(np.abs(found[k:].reshape(k, k) - np.outer(found[:k], found[:k]) - np.eye(k)).max())

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = centred(b)
            if not len(y):
                continue
            far = float(np.abs(y).max())
            if far * far * width < 2.0**62:
                deviation = pa.array((y * y).sum(1))
            else:
                exact = [sum(int(e) ** 2 for e in row) for row in y]
                deviation = pa.array([e if e < 2**63 else None for e in exact], pa.int64())
            at = np.repeat(np.arange(len(y)), k)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y))),
                 deviation.take(pa.array(at)), pa.array(((y / n) @ project).ravel()),
                 pa.array(np.tile(explained[:k], len(y)))],
                ["id", "component", "deviation", "whitened", "explained"])

    kind = rows.schema["id"].dataType.simpleString()
    return (rows.mapInArrow(projected, f"id {kind}, component int, deviation long, whitened double, explained double")
            .select("id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained",
                    F.lit(error).alias("identity_error")))
