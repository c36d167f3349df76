"""Embedding whitening: QDWH spectral divide and conquer, then a broadcast of the whitening matrix.

Entries c become integers x = floor(256 c).  The fit list is each distinct x
once.  Its covariance is gathered in integers, by partial sums per task of
outer products of x less the integer part of the mean; what is left of the
mean is taken off at the end.  So it is exact, whatever the order of the tasks.

The covariance, dimensions times dimensions, is all that reaches the driver.
There, the polar factor of V - shift * I (by QR-based dynamically weighted Halley
iterations) is the sign of each eigenvalue against the shift; half of it plus
the identity projects on the eigenvectors above the shift.  Bases of that
subspace and of the rest split V into two blocks, and each block is split again
until it is diagonal.  Mean, components and their scales (a few rows of
`dimensions` numbers) go to all tasks with the function.

Defined results: a vector that is null, or holds null, NaN or infinity, is left
out; so is one of another length than the commonest (of those the longest);
repeated vectors count once in the fit, and each row gets its result; repeated and
null vec_id are kept; vectors without entries have no component; a component
whose variance is nothing against the largest (1e-13) has whitened 0 and is left
out of the identity check; eigenvalues that tie keep the order in which
the splitting gives them, alike for all rows; an empty table gives no rows.
Columns beside vec_id and embedding are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hindcast.llm.common import durable

EPS = np.finfo(float).eps
#: Rows whose outer products are summed at once.
BLOCK = 4096
#: A component's variance against the largest, below which it counts as none.
NONE = 1e-13


def polar(a: np.ndarray, most: int = 40) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QDWH; directions of singular value 0 stay arbitrary but orthogonal ones."""
    d = len(a)
    scale = np.linalg.norm(a, 2)
    if scale == 0:
        return np.eye(d)
    x = a / scale
    low = max(EPS, 0.9 / max(1.0, np.linalg.cond(x, 1)) / np.sqrt(d))
    for _ in range(most):
        l2 = min(1.0, low * low)
        g = np.cbrt(4.0 * (1.0 - l2) / (l2 * l2))
        root = np.sqrt(1.0 + g)
        wa = root + 0.5 * np.sqrt(max(0.0, 8.0 - 4.0 * g + 8.0 * (2.0 - l2) / (l2 * root)))
        wb = (wa - 1.0) ** 2 / 4.0
        wc = wa + wb - 1.0
        q, _r = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(d)]))
        new = (wb / wc) * x + ((wa - wb / wc) / np.sqrt(wc)) * (q[:d] @ q[d:].T)
        new = (new + new.T) / 2.0
        low = min(1.0, low * (wa + wb * l2) / (1.0 + wc * l2))
        moved, x = np.linalg.norm(new - x), new
        if moved <= 10 * d * EPS and 1.0 - low <= 10 * EPS:
            break
    return x


def _split(v: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the invariant subspaces of v above and below the shift."""
    d = len(v)
    projector = (polar(v - shift * np.eye(d)) + np.eye(d)) / 2.0
    rank = int(round(float(np.trace(projector))))
    if rank in (0, d):
        return (np.eye(d), np.zeros((d, 0))) if rank else (np.zeros((d, 0)), np.eye(d))
    # The columns of a projector span its subspace: its longest ones first, then once more through the projector.
    first = np.argsort(-np.einsum("ij,ij->j", projector, projector), kind="stable")
    q, _ = np.linalg.qr(np.hstack([projector[:, first[:rank]], np.eye(d)]))
    for _ in range(3):
        up, _ = np.linalg.qr(projector @ q[:, :rank])
        q, _ = np.linalg.qr(np.hstack([up, q[:, rank:d]]))
        q = q[:, :d]
    return q[:, :rank], q[:, rank:]


def spectral(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, eigenvectors as columns) of a symmetric matrix."""
    d, size = len(v), np.linalg.norm(v)
    todo, values, vectors = [(v, np.eye(d))], [], []
    while todo:
        block, basis = todo.pop()
        k = len(block)
        if k == 0:
            continue
        off = np.linalg.norm(block - np.diag(np.diag(block)))
        if k == 1 or off <= EPS * size:
            values.extend(np.diag(block))
            vectors.extend(basis.T)
            continue
        # Shifts to try: the middle of the diagonal, then the place between its ends; both lie inside the spectrum.
        diagonal = np.sort(np.diag(block))
        shifts = [float(np.median(diagonal)), float(diagonal.mean()), float(diagonal[0] + diagonal[-1]) / 2]
        rest = block - np.trace(block) / k * np.eye(k)
        spread = float(np.linalg.norm(rest, 2))
        shifts += [float(np.trace(block)) / k + spread * s for s in (0.5, -0.5, 0.25, -0.25)]
        for shift in shifts:
            above, below = _split(block, shift)
            if above.shape[1] and below.shape[1] and np.linalg.norm(above.T @ block @ below) <= 100 * k * EPS * size:
                break
        else:
            # What no shift parts is one eigenvalue, as far as doubles tell.
            values.extend(np.diag(block))
            vectors.extend(basis.T)
            continue
        for q in (below, above):
            part = q.T @ block @ q
            todo.append(((part + part.T) / 2.0, basis @ q))
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], np.array(vectors)[order].T


class Whitening(NamedTuple):
    """What a fit gives: exact n and sums, and per component its direction, eigenvalue and share."""

    n: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, x) of the vectors that can be used."""
    good = F.col("embedding").isNotNull() & ~F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * 256.0).cast("long"))
    out = vectors.where(good).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
    lengths = out.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("rows"))
    common = lengths.agg(F.max(F.struct("rows", "d")).alias("m")).first()["m"]
    return out.where(F.size("x") == (common["d"] if common else 0))


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _gathered(fit: DataFrame, d: int, k: int, of) -> tuple[np.ndarray, np.ndarray]:
    """Sums over the fit list of the rows of of(x), and of their outer products, k wide: per task, then by place."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                y = of(_matrix(b.slice(at, BLOCK), d))
                part = np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])
                total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch({"place": np.arange(len(total)), "value": total})

    kind = "long" if np.issubdtype(of(np.zeros((1, d), dtype=np.int64)).dtype, np.integer) else "double"
    sums = fit.mapInArrow(partial, f"place long, value {kind}").groupBy("place").agg(F.sum("value").alias("value"))
    out = np.zeros(k + k * k, dtype=np.int64 if kind == "long" else float)
    for r in sums.collect():
        out[r["place"]] = r["value"]
    return out[:k], out[k:].reshape(k, k)


def fit_whitening(rows: DataFrame, components: int = 4) -> Whitening | None:
    """Fits on the distinct x of rows; None where there is nothing to fit."""
    fit = durable(rows.select("x").distinct())
    n = fit.count()
    d = len(fit.first()["x"]) if n else 0
    if d == 0:
        return None
    # Exact column sums, natively; then outer products of x less the whole part of the mean.
    sums = [0] * d
    for r in fit.select(F.posexplode("x").alias("place", "value")).groupBy("place").agg(F.sum("value").alias("s")).collect():
        sums[r["place"]] = r["s"]
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest, products = _gathered(fit, d, d, lambda x: x - whole)
    left = rest.astype(float) / n
    v = products.astype(float) / n - np.outer(left, left)
    values, vectors = spectral((v + v.T) / 2.0)
    k = min(components, d)
    values, axes = values[:k], vectors[:, :k].T
    scale = np.array([1.0 / np.sqrt(e) if e > NONE * max(values[0], 0.0) else 0.0 for e in values])
    mean = whole + left

    def whiten(x: np.ndarray) -> np.ndarray:
        return ((x - mean) @ axes.T) * scale

    once, twice = _gathered(fit, d, k, whiten)
    used = scale > 0
    error = np.abs(twice / n - np.outer(once / n, once / n) - np.eye(k))[np.ix_(used, used)]
    return Whitening(n, sums, axes, values, values / np.trace(v) if np.trace(v) > 0 else np.zeros(k), float(error.max()) if used.any() else 0.0)


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, fitted: Whitening | None) -> DataFrame:
    """A row per row and component: its whitened value, beside the exact deviation from the mean and the fit's figures."""
    if fitted is None:
        return rows.sparkSession.createDataFrame([], OUT)
    n, d, k = fitted.n, len(fitted.sums), len(fitted.values)
    sums = np.array(fitted.sums, dtype=np.int64)
    whole, part = sums // n, (sums % n) / n
    axes, explained, error = fitted.axes, fitted.explained, fitted.identity_error
    scale = np.array([1.0 / np.sqrt(e) if e > NONE * max(fitted.values[0], 0.0) else 0.0 for e in fitted.values])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b, d)
            m = len(x)
            deviation = np.square(n * x - sums).sum(axis=1)
            w = (((x - whole) - part) @ axes.T) * scale
            ids = b.column("vec_id").take(pa.array(np.repeat(np.arange(m), k)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), pa.array(np.repeat(deviation, k)),
                 pa.array(w.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(apply, OUT)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = integers(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return whiten(rows, fit_whitening(rows))
