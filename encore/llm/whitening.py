"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

The fit list X (each distinct quantised vector once, centred) stays in Spark as written blocks of rows; the
driver holds d x k coefficients only. A step makes two distributed products:

  X v     the next left vector u, freed of all earlier left vectors. Left vectors have a row for each
          vector of the list, so they are not stored: each is X w for a coefficient vector w, and a
          pass makes X W beside X v and returns their inner products (full reorthogonalisation).
  X^T u   in the same pass as the norm of u and what rounding left along earlier left vectors (if more
          than that, it is taken off and the pass made again); freed of all earlier right vectors,
          it is the next right vector.

What is left is a small upper bidiagonal matrix B with X V = U B; its singular values s give the
eigenvalues s^2 / n of the covariance and V times its right singular vectors the components. Steps go on
until the first ``components`` triplets have converged or V spans the space. Where a step finds an
invariant subspace (equal eigenvalues, too few distinct vectors), the next starts from a fresh orthogonal vector.

Sums over the list are made by Spark: each task adds up its blocks, positions are then added by key.

Defined results: rows whose vector is null, holds null or non-finite entries, or is shorter than the
longest vector (entries are missing) are dropped, as are vectors without entries; null and repeated ids are kept, each row gives
its own result. Entries c become x = floor(64 c) + 1000000; the list is of distinct x. Components whose
eigenvalue is zero can't be whitened and give no rows, so a list of one vector, or an empty table, gives
none. ``deviation`` must fit a long; a table where it can't raises an error. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

SCALE, SHIFT = 64, 1_000_000
BLOCK_ROWS = 4096
#: Of the largest singular value: below, a vector is taken for zero; converged residuals are below the second.
ZERO, CONVERGED = 1e-10, 1e-15
#: Of a left vector's length: the part along earlier ones that is left to rounding.
ORTHOGONAL = 1e-12

OUTPUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, y) of the rows that remain; y = x - SHIFT, which has the same covariance and deviations."""
    entry = F.col(f"`{embedding}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), entry.alias("e"))
    finite = F.forall("e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.filter(F.col("e").isNotNull()).filter(finite)
    size = rows.agg(F.max(F.size("e"))).first()[0] or 0
    return rows.filter((F.size("e") == size) & (F.size("e") > 0)).select("vec_id", F.transform("e", lambda c: F.floor(c * SCALE).cast("long")).alias("y"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _blocks(batches):
    for batch in batches:
        if len(batch):
            y = _matrix(batch.column("y"))
            blocks = [y[a:a + BLOCK_ROWS].astype("<i8") for a in range(0, len(y), BLOCK_ROWS)]
            yield pa.RecordBatch.from_arrays([pa.array([b.shape[1] for b in blocks], pa.int32()), pa.array([b.tobytes() for b in blocks], pa.binary())],
                                             ["dims", "block"])


class FitList:
    """The distinct vectors in shared scratch, their number n and per-dimension sums S; sums over the centred rows."""

    def __init__(self, rows: DataFrame):
        self.blocks = materialize(rows.select("y").distinct().mapInArrow(_blocks, "dims int, block binary"), "whitening-list")
        head = self._sum(lambda y: np.r_[len(y), y.shape[1] * len(y), y.sum(axis=0)], "long")
        self.n = int(head[0]) if len(head) else 0
        self.S = head[2:].astype(np.int64)
        if self.n:
            top = int(self._sum_max(lambda y: np.abs(y).max(initial=0)))
            if (top * self.n + int(np.abs(self.S).max(initial=0))) ** 2 * max(len(self.S), 1) >= 2**63:
                raise OverflowError(f"the deviations of {self.n} distinct vectors do not fit a long")

    def _partial(self, of: Callable[[np.ndarray], np.ndarray], join: Callable) -> Callable:
        def run(batches):
            total = None
            for batch in batches:
                for dims, block in zip(batch.column("dims").to_pylist(), batch.column("block").to_pylist()):
                    part = np.asarray(of(np.frombuffer(block, "<i8").reshape(-1, dims)))
                    total = part if total is None else join(total, part)
            if total is not None:
                total = np.atleast_1d(total)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["at", "value"])
        return run

    def _sum(self, of: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
        parts = self.blocks.mapInArrow(self._partial(of, np.add), f"at int, value {kind}")
        rows = parts.groupBy("at").agg(F.sum("value").alias("value")).collect()
        return np.array([r.value for r in sorted(rows)])

    def _sum_max(self, of) -> int:
        return self.blocks.mapInArrow(self._partial(of, np.maximum), "at int, value long").agg(F.max("value")).first()[0]

    def sum(self, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over blocks of ``of`` (centred rows); an array of one dimension."""
        n, S = self.n, self.S
        return self._sum(lambda y: of(centred(y, n, S)))


def centred(y: np.ndarray, n: int, S: np.ndarray) -> np.ndarray:
    """y - S/n, rounded once: n y - S is exact in integers."""
    return (n * y - S) / n


def _fresh(rng, V: np.ndarray) -> np.ndarray | None:
    """A unit vector orthogonal to the columns of V; None if they span the space."""
    if V.shape[1] >= V.shape[0]:
        return None
    v = rng.standard_normal(V.shape[0])
    for _ in range(3):
        v -= V @ (V.T @ v)
        v /= np.linalg.norm(v)
    return v


def bidiagonalise(fit: FitList, components: int) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """After each step: (V, B, beta), with X V = U B and X^T U = V B^T + beta v e^T."""
    d, rng = len(fit.S), np.random.default_rng(11)
    norm = float(np.sqrt(fit.sum(lambda x: np.array([(x * x).sum()]))[0]))
    V, W, B = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((0, 0))
    v, beta = _fresh(rng, V), 0.0
    while v is not None:
        k = V.shape[1]
        w = v - W @ fit.sum(lambda x, W=W: (x @ W).T @ (x @ v)) if k else v
        while True:
            made = fit.sum(lambda x, W=W, w=w: np.r_[(u := x @ w) @ u, x.T @ u, (x @ W).T @ u])
            alpha, along = float(np.sqrt(made[0])), made[1 + d:]
            # what of the earlier left vectors is still in it; once more is enough
            if alpha <= ZERO * norm or np.linalg.norm(along) <= ORTHOGONAL * alpha:
                break
            w = w - W @ along
        flat = alpha <= ZERO * norm
        alpha, w, z = (0.0, w * 0, w * 0) if flat else (alpha, w / alpha, made[1:1 + d] / alpha)
        B = np.pad(B, ((0, 1), (0, 1)))
        B[k, k] = alpha
        if k:
            B[k - 1, k] = beta
        V, W = np.c_[V, v], np.c_[W, w]
        r = z - alpha * v
        for _ in range(2):
            r -= V @ (V.T @ r)
        beta = float(np.linalg.norm(r))
        if beta <= ZERO * norm:
            beta, v = 0.0, _fresh(rng, V)
        else:
            v = r / beta
        yield V, B, beta


def principal(fit: FitList, components: int) -> tuple[np.ndarray, np.ndarray]:
    """(components as columns, eigenvalues), by falling eigenvalue; zero eigenvalues are left out."""
    found = np.zeros((len(fit.S), 0)), np.zeros(0)
    for V, B, beta in bidiagonalise(fit, components):
        left, s, right = np.linalg.svd(B)
        found = V @ right.T[:, :components], s[:components]
        # beta is zero also where a fresh start follows: what that finds may be larger
        if V.shape[1] >= 2 * components and 0 < beta and (beta * np.abs(left[-1, :components]) <= CONVERGED * s[0]).all():
            break
    P, s = found
    keep = s > ZERO * s.max(initial=0)
    return P[:, keep], s[keep] ** 2 / max(fit.n, 1)


def identity_error(fit: FitList, P: np.ndarray, e: np.ndarray) -> float:
    """The largest entry of the whitened list's covariance minus the identity."""
    k, n = len(e), fit.n
    scale = P / np.sqrt(e)
    mean = fit.sum(lambda x: (x @ scale).sum(axis=0)) / n

    def products(x):
        z = x @ scale - mean
        return (z.T @ z).ravel()

    return float(np.abs(fit.sum(products).reshape(k, k) / n - np.eye(k)).max())


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = 16) -> DataFrame:
    """For each remaining row and component: OUTPUT."""
    spark = vectors.sparkSession
    rows = quantised(vectors, vec_id, embedding)
    fit = FitList(rows)
    P, e = principal(fit, components) if fit.n else (None, np.zeros(0))
    if not len(e):
        return spark.createDataFrame([], OUTPUT)
    total = float(fit.sum(lambda x: np.array([(x * x).sum()]))[0]) / fit.n
    error, explained = identity_error(fit, P, e), e / total
    n, S, k, scale = fit.n, fit.S, len(e), P / np.sqrt(e)

    def project(batches):
        for batch in batches:
            for a in range(0, len(batch), BLOCK_ROWS):
                part = batch.slice(a, BLOCK_ROWS)
                y = _matrix(part.column("y"))
                m = len(y)
                z = centred(y, n, S) @ scale
                deviation = ((n * y - S) ** 2).sum(axis=1)
                ids = part.column("vec_id").take(pa.array(np.repeat(np.arange(m), k)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)),
                     pa.array(np.repeat(deviation, k)), pa.array(z.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, OUTPUT)
