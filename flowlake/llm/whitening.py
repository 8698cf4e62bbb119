"""Whitening of an embedding table by shifted CholeskyQR.

Entries become whole numbers (``floor(1024 c) + 100000``), so count and sums are exact
and each row is centred by whole-number arithmetic before anything is multiplied.

1. A pass sums each dimension.  Another takes the Gram matrix ``G = Y'Y`` of the
   centred rows ``Y``: each task adds up its rows, and the tasks' matrices are added
   in two steps of Spark tasks.  The driver gets one matrix of dims x dims.
2. Shifted CholeskyQR: ``R1' R1 = G + s I``; the next pass solves ``Q R1 = Y`` row by row
   (forward substitution inside the task) and takes the Gram matrix of ``Q``, which is far
   better conditioned than ``G``.  Passes repeat until ``Q'Q`` is the identity.
   Squaring thus never costs more than the digits of one factor.
3. The factors compose to ``R`` with ``R'R = Y'Y``.  ``R = U diag(s) V'`` gives the
   components (columns of V) and the variances ``s^2 / n``.
4. One pass measures the covariance of the whitened rows, the last one writes them.

Rows are left out whose vector is null, empty, or holds a null or non-finite entry or
one of 2^52 or more (its whole number doesn't fit a long).  Vectors of several lengths
have no common covariance: the commonest length counts (of equally common ones the
longest), other lengths are left out.  Equal rows count as often as they stand there;
null ids are kept.  A component without variance has null ``whitened`` and an
``explained`` of 0, and doesn't count for ``identity_error``.  ``deviation`` is a decimal,
as the sum of squares may outgrow a long.  An empty table, or one without a usable
vector, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
#: Passes of the factorisation at most; two or three settle all but singular data.
MAX_PASSES = 6
#: Tasks that add up the matrices of all tasks, before one task adds up theirs.
TREE_WIDTH = 64
#: |entry| from which its whole number doesn't fit a long.
TOO_LARGE = 2.0 ** 52
_EPS = np.finfo(np.float64).eps


@dataclass(frozen=True)
class Whitening:
    """What the fit leaves: exact count and sums, components and variances."""
    dims: int
    n: int
    sums: list[int]
    top: int                      # largest |x| of the fit list
    components: np.ndarray        # dims x k
    variances: np.ndarray         # k, falling
    trace: float


# --- rows as whole numbers ---------------------------------------------------

def _finite(vector: Column) -> Column:
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= F.lit(TOO_LARGE)))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def usable(df: DataFrame, vector_col: str) -> DataFrame:
    """Rows whose vector can be whitened, lengths aside."""
    return df.filter(_finite(F.col(vector_col)))


def _whole(vectors: pa.Array, dims: int) -> np.ndarray:
    """rows x dims of ``floor(1024 c) + 100000``."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    c = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    return np.floor(SCALE * c).astype(np.int64) + OFFSET


def _deviations(x: np.ndarray, n: int, sums: list[int], top: int) -> np.ndarray:
    """``n x - S``, exact: as longs where they fit, else as Python integers."""
    if n * (top + 1) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: list[int], top: int) -> np.ndarray:
    return (_deviations(x, n, sums, top) / n).astype(np.float64)


def _squares(d: np.ndarray) -> list[int]:
    """Exact row sums of squares."""
    if d.dtype == object or len(d) and float(np.abs(d).max()) ** 2 * d.shape[1] >= 2.0 ** 62:
        return (d.astype(object) ** 2).sum(axis=1).tolist()
    return (d * d).sum(axis=1).tolist()


# --- distributed sums ----------------------------------------------------------

def _sums(vectors: DataFrame, dims: int) -> tuple[int, list[int], int]:
    """Rows, exact sums of each dimension and the largest |x|; each task sends dims rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low, top = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _whole(batch.column(0), dims)
            n += len(x)
            high += (x >> 32).sum(axis=0)     # halves can't overflow within a task
            low += (x & 0xFFFFFFFF).sum(axis=0)
            top = max(top, int(np.abs(x).max()))
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dims, dtype=np.int32)), pa.array([n] * dims, pa.int64()), pa.array(high),
                 pa.array(low), pa.array([top] * dims, pa.int64())], ["i", "n", "high", "low", "top"])

    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = (vectors.mapInArrow(run, "i int, n long, high long, low long, top long")
            .groupBy("i").agg(F.sum("n").alias("n"), wide("high"), wide("low"), F.max("top").alias("top"))
            .collect())
    if not rows:
        return 0, [], 0
    rows.sort(key=lambda r: r["i"])
    return (rows[0]["n"], [(int(r["high"]) << 32) + int(r["low"]) for r in rows], max(r["top"] for r in rows))


def forward_substitution(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Solve ``Q R = rows`` for an upper triangular R, column by column."""
    q = np.array(rows, order="F")
    for j in range(factor.shape[0]):
        if j:
            q[:, j] -= q[:, :j] @ factor[:j, j]
        q[:, j] /= factor[j, j]
    return q


def _gram(vectors: DataFrame, dims: int, width: int, project) -> np.ndarray:
    """Gram matrix (width x width) of ``project(x)`` over all rows, added in two steps."""
    schema = "slot int, block binary"

    def block(slot: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                          ["slot", "block"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                y = project(_whole(batch.column(0), dims))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            context = TaskContext.get()
            yield block(context.partitionId() if context else 0, total)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, slot = None, 0
        for batch in batches:
            for s, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(b, np.float64).reshape(width, width)
                total, slot = (part, s) if total is None else (total + part, slot)
        if total is not None:
            yield block(slot, total)

    parts = vectors.mapInArrow(partial, schema)
    some = parts.repartition(TREE_WIDTH, F.pmod("slot", F.lit(TREE_WIDTH))).mapInArrow(added, schema)
    rows = some.repartition(1).mapInArrow(added, schema).collect()
    if not rows:
        return np.zeros((width, width))
    return np.frombuffer(bytes(rows[0]["block"]), np.float64).reshape(width, width).copy()


# --- the factorisation ---------------------------------------------------------

def shifted_cholesky(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper triangular R with ``R'R = gram + s I``, s the least of shift, 10 shift, ... that works."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, _EPS * float(np.trace(gram)))


def _shift(gram: np.ndarray, n: int) -> float:
    d = len(gram)
    return 11 * (d * (d + 1) + d * n ** 0.5) * _EPS * float(np.linalg.norm(gram, 2))


def triangular_factors(gram_of, n: int, max_passes: int = MAX_PASSES) -> tuple[list[np.ndarray], np.ndarray]:
    """The factors R1, R2, ... and the Gram matrix of the rows solved by all of them.

    ``gram_of(factors)`` is a pass over the rows.  The first factor is shifted; later
    ones only where the matrix isn't positive definite in double precision."""
    factors: list[np.ndarray] = []
    gram = gram_of(factors)
    if not np.trace(gram) > 0:
        return factors, gram
    for k in range(max_passes):
        least = np.linalg.eigvalsh(gram)[0]
        factors.append(shifted_cholesky(gram, _shift(gram, n) if k == 0 or least < 1e-10 else 0.0))
        gram = gram_of(factors)
        if np.abs(gram - np.eye(len(gram))).max() < 1e-12 * len(gram):
            break
    return factors, gram


def principal(factors: list[np.ndarray], gram: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Components (columns), their variances and the total variance.

    What is left of ``Q'Q`` beside the identity (columns without variance) goes into the
    composed factor, so that it reproduces the rows' Gram matrix in any case."""
    g, w = np.linalg.eigh(gram)
    composed = np.sqrt(np.maximum(g, 0))[:, None] * w.T
    for r in reversed(factors):
        composed = composed @ r
    _, s, vt = np.linalg.svd(composed)
    s = np.where(s > 4 * len(s) * _EPS * s[0], s, 0.0)
    components = vt[:k].T.copy()
    lead = components[np.abs(components).argmax(axis=0), np.arange(components.shape[1])]
    components *= np.where(lead < 0, -1.0, 1.0)
    return components, s[:k] ** 2 / n, float((s ** 2).sum() / n)


def _whitened(y: np.ndarray, components: np.ndarray, variances: np.ndarray) -> np.ndarray:
    return (y @ components) / np.sqrt(variances)


# --- the operator ----------------------------------------------------------------

def fit(df: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Fit on every usable row; None without one."""
    good = usable(df, vector_col)
    vec = F.col(vector_col).cast("array<double>")
    lengths = (good.groupBy(F.size(vector_col).alias("d")).count()
               .orderBy(F.desc("count"), F.desc("d")).limit(1).collect())
    if not lengths:
        return None
    dims = lengths[0]["d"]
    vectors = good.filter(F.size(vector_col) == dims).select(vec.alias("v"))
    n, sums, top = _sums(vectors, dims)

    def gram_of(factors: list[np.ndarray]) -> np.ndarray:
        def project(x: np.ndarray) -> np.ndarray:
            q = _centred(x, n, sums, top)
            for r in factors:
                q = forward_substitution(q, r)
            return q
        return _gram(vectors, dims, dims, project)

    factors, gram = triangular_factors(gram_of, n)
    return Whitening(dims, n, sums, top, *principal(factors, gram, n, min(components, dims)))


def identity_error(df: DataFrame, model: Whitening, vector_col: str = "embedding") -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    live = model.variances > 0
    k = int(live.sum())
    if not k:
        return 0.0
    v, e, n, sums, top = model.components[:, live], model.variances[live], model.n, model.sums, model.top

    def project(x: np.ndarray) -> np.ndarray:
        z = _whitened(_centred(x, n, sums, top), v, e)
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)   # the last column gives the means

    rows = usable(df, vector_col).filter(F.size(vector_col) == model.dims)
    gram = _gram(rows.select(F.col(vector_col).cast("array<double>").alias("v")), model.dims, k + 1, project) / n
    return float(np.abs(gram[:k, :k] - np.outer(gram[:k, k], gram[:k, k]) - np.eye(k)).max())


def whiten(df: DataFrame, model: Whitening | None, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector and component: ``id, component, n, deviation,
    whitened, explained, identity_error``."""
    id_type = df.schema[id_col].dataType.simpleString()
    schema = (f"id {id_type}, component int, n long, deviation decimal(38,0), whitened double, "
              "explained double, identity_error double")
    if model is None:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    error = identity_error(df, model, vector_col)
    k = len(model.variances)
    live = model.variances > 0
    explained = model.variances / model.trace if model.trace else np.zeros(k)
    scale = np.where(live, model.variances, 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            x = _whole(batch.column(1), model.dims)
            z = _whitened(_centred(x, model.n, model.sums, model.top), model.components, scale)
            far = _squares(_deviations(x, model.n, model.sums, model.top))
            far = pa.array([Decimal(v) for v in far], pa.decimal128(38, 0))
            each = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, model.n)), far.take(each),
                pa.array(z.ravel(), mask=np.tile(~live, rows)), pa.array(np.tile(explained, rows)),
                pa.array(np.full(rows * k, error))],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    rows = usable(df, vector_col).filter(F.size(vector_col) == model.dims).select(
        F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def whitened_embeddings(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                        components: int = COMPONENTS) -> DataFrame:
    """Fit on all rows of ``df`` and whiten them."""
    return whiten(df, fit(df, vector_col, components), id_col, vector_col)
