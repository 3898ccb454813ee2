"""Whitening of embeddings by their leading principal components.

Entries become integers ``x = floor(scale * c)``, so equal vectors are equal
to the bit and sums are exact. The fit list is every distinct x vector once;
of it only the number n, the sums S and the scatter matrix of ``x - S / n``
are gathered (``d`` and ``d * d`` numbers for vectors of d entries), by tasks
that add up their own rows first. Then, on these d x d numbers:

1. Pivoted Cholesky: the scatter is ``L L^T`` with the pivot always the
   largest remaining diagonal entry, so ``L`` has one column per dimension in
   which the vectors differ (its rank) and its columns fall in size.
2. One-sided Jacobi on ``L``: pairs of columns are rotated until all are
   orthogonal. Then ``L J = U s``: the squared column norms are the scatter's
   eigenvalues (n times the covariance's), the normalised columns its
   eigenvectors. No product with ``L^T`` is formed, so small eigenvalues keep
   their digits.

Every row is then projected by the task that reads it.

Defined cases: rows whose vector is null or holds a null, NaN or infinite
entry are left out, and so are rows whose length is not the most frequent one
(the longer of two equally frequent). Repeated rows count once in the fit and
get a result each; a null id is kept. Dimensions in which the vectors do not
differ give no component: at most ``rank`` components are returned, hence no
rows for an empty table or a single distinct vector. Components of equal
eigenvalue are in no particular order among themselves. Entries that do not
fit in 64 bits after scaling, or sums that do not, fail the job. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelops.session import cut_lineage

SCALE = 256  # fixed value of the query contract
COMPONENTS = 4
MAX_SWEEPS = 60
LONG = 2**63 - 1


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: list[int]  # exact, per dimension
    components: np.ndarray  # d x k, unit columns by falling eigenvalue
    eigenvalues: np.ndarray  # of the covariance
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows of integer vectors (rows x k)."""
        return (x - self.mean) @ self.components / np.sqrt(self.eigenvalues)


def finite(vector: Column) -> Column:
    """The vector has no null, NaN or infinite entry; false for null."""
    good = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    return F.coalesce(F.forall(vector, good), F.lit(False))


def integer_vectors(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, x) of the rows that have a usable vector (vec_id, embedding)."""
    v = F.col("embedding").cast("array<double>")
    rows = table.select("vec_id", v.alias("v")).where(finite(F.col("v")))
    most = (
        rows.groupBy(F.size("v").alias("size")).count()
        .orderBy(F.desc("count"), F.desc("size")).limit(1).first()
    )
    d = most["size"] if most else 0
    return rows.where(F.size("v") == d).select(
        "vec_id", F.transform("v", lambda c: F.floor(c * F.lit(float(scale)))).alias("x")
    )


def _matrix(batch: pa.RecordBatch, column: int) -> np.ndarray:
    x = batch.column(column)
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


def scatter(fit: DataFrame, mean: np.ndarray) -> np.ndarray:
    """Sum over the rows of ``x`` of the outer products of ``x - mean``."""
    d = len(mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            for at in range(0, len(batch), 4096):
                c = _matrix(batch.slice(at, 4096), 0) - mean
                total += c.T @ c
        for i in range(d):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(d, i)), pa.array(np.arange(d)), pa.array(total[i])],
                names=["i", "j", "v"],
            )

    parts = fit.select("x").mapInArrow(run, "i long, j long, v double")
    rows = (
        parts.groupBy("i", "j").agg(F.sum("v").alias("v"))
        .groupBy("i").agg(F.sort_array(F.collect_list(F.struct("j", "v"))).alias("row"))
        .select("i", F.transform("row", lambda r: r["v"]).alias("row"))
    )
    out = np.zeros((d, d))
    for r in rows.collect():  # d rows of d numbers
        out[r["i"]] = r["row"]
    return (out + out.T) / 2


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """``L`` (d x rank, rows in the order of ``a``) with ``a = L L^T``."""
    d = len(a)
    left = a.diagonal().copy()
    stop = d * np.finfo(float).eps * max(left.max(initial=0.0), 0.0)
    done = np.zeros(d, bool)
    columns: list[np.ndarray] = []
    while len(columns) < d:
        p = int(np.argmax(np.where(done, -np.inf, left)))
        if left[p] <= stop:
            break
        c = a[:, p].copy()
        for earlier in columns:
            c -= earlier * earlier[p]
        c[done] = 0.0
        c /= np.sqrt(left[p])
        c[p] = np.sqrt(left[p])
        columns.append(c)
        done[p] = True
        left = left - c * c
    return np.array(columns).T if columns else np.zeros((d, 0))


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(columns of unit length, their norms), by falling norm, after rotating
    the columns of ``factor`` until all are orthogonal.

    A sweep meets every pair once, as a tournament: the pairs of one round
    have no column in common and are rotated together.
    """
    g = factor.copy()
    m = g.shape[1]
    seats = np.arange(m + m % 2)  # seat m is empty if m is odd
    tolerance = np.finfo(float).eps * max(8.0, np.sqrt(len(g)))
    for _ in range(MAX_SWEEPS):
        worst = 0.0
        for _ in range(len(seats) - 1):
            half = len(seats) // 2
            p, q = seats[:half], seats[half:][::-1]
            real = (p < m) & (q < m)
            p, q = p[real], q[real]
            a, b = g[:, p], g[:, q]
            alpha, beta = (a * a).sum(axis=0), (b * b).sum(axis=0)
            gamma = (a * b).sum(axis=0)
            size = np.sqrt(alpha * beta)
            turn = np.abs(gamma) > tolerance * size
            worst = max(worst, float(np.max(np.abs(gamma[turn]) / size[turn], initial=0.0)))
            if turn.any():
                zeta = (beta[turn] - alpha[turn]) / (2 * gamma[turn])
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                c = 1 / np.hypot(1.0, t)
                a, b = a[:, turn], b[:, turn]
                g[:, p[turn]] = c * a - c * t * b
                g[:, q[turn]] = c * t * a + c * b
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
        if worst == 0.0:
            break
    norms = np.sqrt((g * g).sum(axis=0))
    order = np.argsort(-norms, kind="stable")
    return g[:, order] / norms[order], norms[order]


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of the rows of ``x`` (each distinct vector once); None if
    they do not differ. The driver gets d sums and d x d scatter entries."""
    entries = distinct.select(F.posexplode("x").alias("at", "c"))
    found = entries.groupBy("at").agg(F.sum("c").alias("s"), F.count("c").alias("n")).collect()
    if not found:
        return None
    n, sums = found[0]["n"], [r["s"] for r in sorted(found, key=lambda r: r["at"])]
    mean = np.array([s / n for s in sums])
    total = scatter(distinct, mean)
    u, norms = one_sided_jacobi(pivoted_cholesky(total))
    k = min(components, len(norms))
    if k == 0:
        return None
    return Whitening(n, sums, u[:, :k], norms[:k] ** 2 / n, float(np.trace(total)) / n)


def identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    k = len(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = model.project(_matrix(batch, 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(w[:, i]) for i in range(k)], names=[f"w{i}" for i in range(k)]
            )

    w = distinct.select("x").mapInArrow(run, ", ".join(f"w{i} double" for i in range(k)))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    # covar_pop adds up products of centred values.
    row = w.agg(*[F.covar_pop(f"w{i}", f"w{j}") for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(row, pairs, strict=True))


def _deviation(x: np.ndarray, model: Whitening) -> pa.Array:
    """Exact sums of squares of ``n x - S``."""
    largest = model.n * int(np.abs(x).max(initial=0)) + max(map(abs, model.sums))
    if largest * largest * x.shape[1] <= LONG:
        off = model.n * x - np.array(model.sums, np.int64)
        return pa.array((off * off).sum(axis=1)).cast(pa.decimal128(38, 0))
    off = model.n * x.astype(object) - np.array(model.sums, object)
    return pa.array([Decimal(int(v)) for v in (off * off).sum(axis=1)], pa.decimal128(38, 0))


def whiten(table: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """One row per usable row of ``table`` and component (numbered from 1):
    vec_id, component, n, deviation (decimal), whitened, eigenvalue,
    explained, identity_error."""
    rows = integer_vectors(table, scale)
    distinct = cut_lineage(rows.select("x").distinct(), "vectors")
    schema = T.StructType(
        [
            table.schema["vec_id"],
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.DecimalType(38, 0)),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("eigenvalue", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    model = fit(distinct, components)
    if model is None:
        return table.sparkSession.createDataFrame([], schema)
    error = identity_error(distinct, model)
    explained = model.eigenvalues / model.trace
    k = len(explained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, 1)
            rows = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(rows), model.n)),
                    _deviation(x, model).take(pa.array(rows)),
                    pa.array(model.project(x).ravel()),
                    pa.array(np.tile(model.eigenvalues, len(x))),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(rows), error)),
                ],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)
