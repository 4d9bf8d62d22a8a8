"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Spark does the work that grows with the rows: it turns vectors into integer
codes, keeps each distinct code vector once (the fit list, with a map-side
part so that a hot group of copies collapses before the shuffle), sums them
per dimension, and adds up the centred scatter matrix in partial sums of one
``d x d`` matrix per task. Only that matrix, whose size is set by the
dimension and never by the rows, reaches the driver. There it is factored
``C = G G^T`` by a Cholesky decomposition with diagonal pivoting, which also
finds the rank, and the columns of ``G`` are rotated pairwise until they are
orthogonal (one-sided Jacobi). Then ``C W = W W^T W``: each rotated column is
an eigenvector, its squared norm the eigenvalue. Rows are projected and
whitened in Arrow batches; the covariance of the whitened fit list is summed
by Spark as a check.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyfold.llm.common import map_batches, prepare, settle

# Fixed values of the contract: codes are floor(64 * c) + 1,000,000, at most 16 components.
SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
# A pivot whose remaining variance is below this share of the trace ends the factor: the rank is reached.
RANK_TOLERANCE = 1e-12
# Rotations stop when every pair of columns is orthogonal to this relative precision.
JACOBI_TOLERANCE = 1e-15
JACOBI_SWEEPS = 60

_OUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double, eigenvalue double"
)


def codes(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, x)`` for rows whose vector is not null and has only finite entries, x the integer codes.

    Rows whose vector length differs from the most frequent one (ties: the
    longer) are dropped as well, since a covariance needs one dimension.
    """
    finite = F.forall(
        F.col(vector), lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf"))
    )
    valid = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v")).where(
        F.col("v").isNotNull() & finite
    )
    rows = valid.select(
        "vec_id", F.transform("v", lambda c: (F.floor(c.cast("double") * SCALE) + OFFSET).cast("long")).alias("x")
    )
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if sizes is None:
        return rows.where(F.lit(False))
    return rows.where(F.size("x") == sizes["d"])


def _scatter(fit: DataFrame, d: int, mean: np.ndarray) -> np.ndarray:
    """The centred scatter ``sum (x - mean)(x - mean)^T`` of the fit list, summed per task, then over tasks."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            x = batch.column(0)
            if len(x):
                y = np.asarray(x.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, d) - mean
                total += y.T @ y
        yield pa.RecordBatch.from_pydict({"i": np.arange(d, dtype=np.int32), "row": list(total)})

    parts = map_batches(fit.select("x"), partial, "i int, row array<double>")
    summed = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((d, d))
    for r in summed.collect():
        out[r["i"], r["j"]] = r["v"]
    return out


def pivoted_cholesky(c: np.ndarray, tolerance: float = RANK_TOLERANCE) -> np.ndarray:
    """``G`` (d x rank) with ``G G^T = c``: outer-product Cholesky, always on the largest remaining diagonal."""
    d = len(c)
    a = c.astype(np.float64).copy()
    order = np.arange(d)
    low = np.zeros((d, d))
    limit = tolerance * max(float(np.trace(c)), 0.0)
    rank = 0
    for k in range(d):
        j = k + int(np.argmax(np.diag(a)[k:]))
        if a[j, j] <= limit or a[j, j] <= 0:
            break
        for m in (a, low):
            m[[k, j]] = m[[j, k]]
        a[:, [k, j]] = a[:, [j, k]]
        order[[k, j]] = order[[j, k]]
        low[k, k] = np.sqrt(a[k, k])
        low[k + 1 :, k] = a[k + 1 :, k] / low[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(low[k + 1 :, k], low[k + 1 :, k])
        rank = k + 1
    g = np.zeros((d, rank))
    g[order] = low[:, :rank]
    return g


def one_sided_jacobi(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of ``g g^T``, by rotating pairs of ``g``'s columns.

    Each eigenvector's largest entry is made positive, so the sign does not
    depend on the order of rotations.
    """
    w = g.copy()
    k = w.shape[1]
    for _ in range(JACOBI_SWEEPS):
        rotated = False
        for p in range(k - 1):
            for q in range(p + 1, k):
                alpha, beta = w[:, p] @ w[:, p], w[:, q] @ w[:, q]
                gamma = w[:, p] @ w[:, q]
                if abs(gamma) <= JACOBI_TOLERANCE * np.sqrt(alpha * beta) or gamma == 0:
                    continue
                rotated = True
                zeta = (beta - alpha) / (2 * gamma)
                t = np.copysign(1.0, zeta) / (abs(zeta) + np.sqrt(1 + zeta * zeta))
                cos = 1 / np.sqrt(1 + t * t)
                sin = cos * t
                wp = w[:, p].copy()
                w[:, p] = cos * wp - sin * w[:, q]
                w[:, q] = sin * wp + cos * w[:, q]
        if not rotated:
            break
    values = (w * w).sum(axis=0)
    keep = values > 0
    values, w = values[keep], w[:, keep]
    vectors = w / np.sqrt(values)
    top = np.argmax(np.abs(vectors), axis=0)
    vectors *= np.sign(vectors[top, np.arange(vectors.shape[1])])
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def whiten(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error, eigenvalue)``, a row per row and component.

    Rows whose vector is null, holds a null, NaN or infinite entry, or has
    another length than most are dropped. The fit list holds each distinct
    code vector once; n is its size. deviation is ``sum_d (n x - S)^2`` over
    the dimensions, exact. Components are numbered from 1 by falling
    eigenvalue, at most ``components`` and at most the rank; whitened is the
    centred code vector projected on the component over the square root of
    its eigenvalue. identity_error is one value for the table. A null vec_id
    stays null; repeated rows each get their rows. No row is returned when
    the fit list has rank 0 (empty table, one distinct vector, all equal).
    """
    spark = prepare(vectors.sparkSession)
    rows = settle(codes(vectors, vec_id, vector))
    fit = settle(rows.select("x").distinct())
    first = fit.select(F.size("x").alias("d")).first()
    if first is None:
        return spark.createDataFrame([], _OUT)
    d = first["d"]
    sums = fit.select(F.posexplode("x").alias("j", "v")).groupBy("j").agg(F.sum("v").alias("s"), F.count("*").alias("n"))
    found = {r["j"]: (r["s"], r["n"]) for r in sums.collect()}
    n = found[0][1] if found else fit.count()
    s = np.array([int(found[j][0]) for j in range(d)], dtype=object)
    mean = np.array([float(v) for v in s]) / n
    cov = _scatter(fit, d, mean) / n
    values, comps = one_sided_jacobi(pivoted_cholesky(cov)) if d else (np.zeros(0), np.zeros((0, 0)))
    k = min(components, len(values))
    if k == 0:
        return spark.createDataFrame([], _OUT)
    values, comps = values[:k], comps[:, :k]
    trace = float(np.trace(cov))
    explained = values / trace
    scale = comps / np.sqrt(values)

    def whitened_of(x: pa.Array) -> np.ndarray:
        return (np.asarray(x.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, d) - mean) @ scale

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first_moment = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            z = whitened_of(batch.column(0))
            total += z.T @ z
            first_moment += z.sum(axis=0)
        yield pa.RecordBatch.from_pydict({"i": np.arange(k, dtype=np.int32), "row": list(total), "m": first_moment})

    parts = map_batches(fit.select("x"), check, "i int, row array<double>, m double")
    moments = (
        parts.select("i", "m", F.posexplode("row").alias("j", "v")).groupBy("i", "j")
        .agg(F.sum("v").alias("v"), F.sum(F.when(F.col("j") == 0, F.col("m"))).alias("m"))
    )
    second, first_sum = np.zeros((k, k)), np.zeros(k)
    for r in moments.collect():
        second[r["i"], r["j"]] = r["v"]
        if r["j"] == 0:
            first_sum[r["i"]] = r["m"]
    mz = first_sum / n
    identity_error = float(np.abs(second / n - np.outer(mz, mz) - np.eye(k)).max())
    s_long = np.array([int(v) for v in s], dtype=np.int64)
    # (n x - S)^2 summed over d stays below 2^63 while every |n x - S| is below this bound.
    safe = int(np.sqrt((2**63 - 1) / max(d, 1)))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = batch.column(0), batch.column(1)
            m = len(ids)
            if not m:
                continue
            codes_ = np.asarray(x.flatten().to_numpy(zero_copy_only=False), dtype=np.int64).reshape(-1, d)
            spread = n * codes_ - s_long
            if np.abs(spread).max(initial=0) < safe:
                deviation = (spread * spread).sum(axis=1)
            else:
                deviation = np.array([sum(int(v) * int(v) for v in row) for row in spread.astype(object)], dtype=object)
            z = (codes_.astype(np.float64) - mean) @ scale
            yield pa.RecordBatch.from_pydict({
                "vec_id": pa.array([v for v in ids.to_pylist() for _ in range(k)], pa.int64()),
                "component": np.tile(np.arange(1, k + 1, dtype=np.int32), m),
                "n": np.full(m * k, n, dtype=np.int64),
                "deviation": pa.array([int(v) for v in np.repeat(deviation, k)], pa.int64()),
                "whitened": z.reshape(-1),
                "explained": np.tile(explained, m),
                "identity_error": np.full(m * k, identity_error),
                "eigenvalue": np.tile(values, m),
            })

    return map_batches(rows.select("vec_id", "x"), project, _OUT)
