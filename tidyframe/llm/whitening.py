"""Embedding whitening by shifted CholeskyQR.

1. Entries become whole numbers, ``floor(64 * c) + 1000000``, whose counts and sums are
   exact, so that rows are centred without cancellation.
2. A Gram pass adds up ``q q'`` over all rows in the tasks and sums the partial matrices by
   entry; the driver sees one d x d matrix.  The Cholesky factor of the first Gram
   matrix, shifted by a multiple of the rounding unit, makes an ill-conditioned table safe
   to factor; each further pass solves the rows through all factors so far and
   factors what is left, until the rows are orthonormal.
3. The composed factor R has the centred table's singular values and right vectors: an SVD
   of this d x d matrix gives the components, from largest variance to least.
4. A last Gram pass over the whitened rows measures how far their covariance is from the
   identity.

Defined results: rows whose vector is null, or holds a null or non-finite entry, go, and
so do vectors of another length than the most frequent one (of equally frequent ones the
longest); entries beyond 2**52 / 64 count as that bound.  Repeated rows, repeated ids and null
ids are rows of their own.  A component without variance (fewer rows than dimensions, constant or
dependent dimensions) is left out, so one row, equal rows and empty tables give no
rows.  ``deviation`` is null where it passes 64 bits.  Extra columns are ignored.  Equal
variances (ties) leave the choice of components free; it is the same for all rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyframe.llm.common import materialize

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
LIMIT = float(1 << 52)       # of scaled entries
BLOCK = 1 << 19              # entries of a block of rows in a task
PASSES = 12                  # each halves the digits that are missing at least; three are usual
UNIT = 2.0 ** -53
_SPLIT = 1 << 31


@dataclass
class Basis:
    """What the passes have found: ``sums`` are exact, ``factors`` upper triangular."""

    n: int
    sums: list[int]
    factors: list[np.ndarray]
    components: np.ndarray | None = None   # rows, by falling variance
    variances: np.ndarray | None = None
    total: float = 0.0


def whole_numbers(df: DataFrame, vector: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """(vec_id, x): the rows that take part, entries as whole numbers."""
    v = F.col("v")
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).filter(
        F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    x = F.transform(v, lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(LIMIT)), F.lit(-LIMIT))) + OFFSET)
    rows = materialize(rows.select("vec_id", x.alias("x")), "whole-vectors")
    usual = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("x") == (usual["d"] if usual else 0))


# ---------------------------------------------------------------- inside tasks


def _blocks(batches):
    """(ids, rows as an int64 matrix) of bounded size."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, lists = batch.column("vec_id"), batch.column("x")
        d = len(lists[0])
        step = max(1, BLOCK // max(d, 1))
        for a in range(0, batch.num_rows, step):
            part = lists.slice(a, step)
            yield ids.slice(a, step), np.asarray(part.flatten()).reshape(len(part), d)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``x - sums / n``, each entry rounded once: the whole part goes first."""
    whole = np.array([s // n for s in sums], np.int64)
    return (x - whole) - np.array([(s % n) / n for s in sums])


def _solve(y: np.ndarray, r: np.ndarray) -> np.ndarray:
    """``y r^-1`` for an upper triangular ``r``, column by column."""
    q = np.empty_like(y)
    for j in range(r.shape[0]):
        q[:, j] = (y[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum of ``(n x - sums)^2`` per row: with whole means m and remainders t it is
    ``n^2 |x - m|^2 - 2 n (x - m) t + |t|^2``."""
    d = len(sums)
    z = x - np.array([s // n for s in sums], np.int64)
    most = int(np.abs(z).max(initial=0)) + 1
    t = [s % n for s in sums]
    if d * most * max(most, n) >= 1 << 63:
        z = z.astype(object)
    square = (z * z).sum(axis=1).astype(object)
    cross = (z * np.array(t, dtype=z.dtype)).sum(axis=1).astype(object)
    found = n * n * square - 2 * n * cross + sum(v * v for v in t)
    return [int(v) if v < 1 << 63 else None for v in found]


def _sums(batches):
    import pyarrow as pa

    n, high, low = 0, 0, 0
    for _, x in _blocks(batches):
        n, high, low = n + len(x), high + (x // _SPLIT).sum(axis=0), low + (x % _SPLIT).sum(axis=0)
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(high)), pa.int32()), pa.array([n] * len(high), pa.int64()),
             pa.array(high, pa.int64()), pa.array(low, pa.int64())], names=["i", "n", "high", "low"])


def _gram(image):
    """Partial Gram matrix of ``image(rows)``, its upper triangle by entry."""

    def run(batches):
        import pyarrow as pa

        total = None
        for _, x in _blocks(batches):
            q = image(x)
            part = q.T @ q
            total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j], pa.float64())],
                names=["i", "j", "v"])

    return run


def _whitened(x: np.ndarray, basis: Basis) -> np.ndarray:
    return _centred(x, basis.n, basis.sums) @ (basis.components.T / np.sqrt(basis.variances))


# ---------------------------------------------------------------- passes


def _gram_matrix(rows: DataFrame, image, d: int) -> np.ndarray:
    """Sum over all rows; d * (d + 1) / 2 numbers reach the driver."""
    parts = rows.mapInArrow(_gram(image), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    g = np.zeros((d, d))
    for i, j, v in parts.collect():
        g[i, j] = g[j, i] = v
    return g


def _root(g: np.ndarray) -> np.ndarray:
    """b with ``b' b = g``; directions that hold rounding noise only vanish."""
    w, u = np.linalg.eigh(g)
    return np.sqrt(np.where(w > 1e-9, w, 0))[:, None] * u.T


def fit(rows: DataFrame, components: int = COMPONENTS) -> Basis | None:
    """The first ``components`` components with variance of ``rows`` (see
    ``whole_numbers``); None for no rows."""
    wide = "decimal(38,0)"
    sums = sorted(rows.mapInArrow(_sums, "i int, n long, high long, low long").groupBy("i").agg(
        F.sum("n"), F.sum(F.col("high").cast(wide)), F.sum(F.col("low").cast(wide))).collect())
    if not sums:
        return None
    n, d = int(sums[0][1]), len(sums)
    basis = Basis(n, [int(high) * _SPLIT + int(low) for _, _, high, low in sums], [])

    def image(x):
        q = _centred(x, basis.n, basis.sums)
        for r in basis.factors:
            q = _solve(q, r)
        return q

    for k in range(PASSES):
        g = _gram_matrix(rows, image, d)
        w = np.linalg.eigvalsh(g)
        if w[-1] <= 0 or k and np.all((np.abs(w - 1) < 1e-11 * d) | (w < 1e-12)):
            break  # orthonormal, but for directions without variance
        shift = 0.0 if k and w[0] > 1e-3 * w[-1] else min(11 * (n * d + d * (d + 1)) * UNIT, 1e-2) * w[-1]
        basis.factors.append(np.linalg.cholesky(g + shift * np.eye(d)).T)
    r = np.eye(d)
    for one in basis.factors:
        r = one @ r
    _, s, v = np.linalg.svd(_root(g) @ r)
    keep = np.flatnonzero(s > 1e-12 * s[0])[:components] if s[0] > 0 else np.empty(0, int)
    v = v[keep]
    at = np.abs(v).argmax(axis=1)
    basis.components = v * np.sign(v[np.arange(len(v)), at])[:, None]
    basis.variances, basis.total = s[keep] ** 2 / n, float((s ** 2).sum() / n)
    return basis


def whiten(df: DataFrame, components: int = COMPONENTS, vector: str = "embedding",
           id_col: str = "vec_id") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row
    for each vector and component."""
    rows = whole_numbers(df, vector, id_col)
    basis = fit(rows, components)
    schema = (f"vec_id {df.schema[id_col].dataType.simpleString()}, component int, n long, deviation long, "
              "whitened double, explained double, identity_error double")
    if basis is None or not len(basis.components):
        return df.sparkSession.createDataFrame([], schema)
    k = len(basis.components)

    def image(x):  # a column of ones: the means come with the products
        return np.column_stack([_whitened(x, basis), np.ones(len(x))])

    g = _gram_matrix(rows, image, k + 1) / basis.n
    error = float(np.abs(g[:k, :k] - np.outer(g[:k, k], g[:k, k]) - np.eye(k)).max())
    explained = basis.variances / basis.total

    def run(batches):
        import pyarrow as pa

        for ids, x in _blocks(batches):
            size = len(x) * k
            dev = pa.array(_deviations(x, basis.n, basis.sums), pa.int64())
            row = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [ids.take(row), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                 pa.array(np.full(size, basis.n), pa.int64()), dev.take(row),
                 pa.array(_whitened(x, basis).ravel(), pa.float64()),
                 pa.array(np.tile(explained, len(x)), pa.float64()),
                 pa.array(np.full(size, error), pa.float64())],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
