"""Embedding whitening: principal components of a distributed covariance, to double precision, and rows in their coordinates.

Entries become whole numbers on a fixed grid, so sums and centred products are exact: tasks add products about the rounded mean, Spark adds the
tasks' sums as decimals, and the covariance is one exact fraction an entry, whatever the order of addition. What reaches the driver is a dimension squared, never a row.

Eigenvectors come from single precision and are corrected by the Ogita-Aishima iteration: with R = I - X'X and S = X'AX each step adds X E, where E takes
its entries from S and R alone (four matrix products), and doubles the number of right digits; the last steps run in extended precision. The step divides by
differences of eigenvalues. Where these are no larger than the error still present it only makes the vectors orthogonal, and the vectors of such a cluster are turned within their
span by an eigenproblem of its own, about the cluster's centre.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitymart.llm.common import arrow_schema, batch_of, per_batch, ship, slices, stored

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Grid numbers lie within this; entries beyond it count as it.
LIMIT = 1 << 40
#: Below this a product of two numbers, summed over a batch, is exact in a double.
SAFE = 1 << 21
_LOW = (1 << 32) - 1


def grid(batch: pa.RecordBatch, column: int) -> np.ndarray:
    """Vectors of one length as rows of whole numbers."""
    lists = batch.column(column)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.clip(np.floor(SCALE * flat), -LIMIT, LIMIT).astype(np.int64).reshape(len(lists), -1) + SHIFT


def clean(embeddings: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that can be fitted: no null, no entry that is null or not finite, and of the length that most such rows have (of several
    the greatest)."""
    e = F.col("embedding")
    finite = F.forall(e, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = embeddings.select("vec_id", "embedding").where(e.isNotNull() & finite & (F.size(e) > 0))
    usual = rows.groupBy(F.size(e).alias("d")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), F.col("d").desc()).first()
    return rows.where(F.size(e) == (usual["d"] if usual else 0))


def halves(values: list[int]) -> dict:
    """Whole numbers of up to 95 bits in two columns."""
    return {"high": [v >> 32 for v in values], "low": [v & _LOW for v in values]}


def totals(df: DataFrame, add, size: int) -> list[int]:
    """Exact sums over all rows: ``add(batch)`` gives an array of ``size`` whole numbers for a batch, each task sends its sums once."""
    target = arrow_schema("at int, high long, low long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = [0] * size
        for batch in slices(batches):
            mine = [a + b for a, b in zip(mine, add(batch))]
        yield batch_of({"at": list(range(size)), **halves(mine)}, target)

    ship(df.sparkSession)
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    found = df.mapInArrow(run, "at int, high long, low long").groupBy("at").agg(wide("high"), wide("low")).collect()  # a row an entry
    out = [0] * size
    for r in found:
        out[r["at"]] = (int(r["high"]) << 32) + int(r["low"])
    return out


def products(x: np.ndarray) -> list[int]:
    """Upper triangle of x'x, exact."""
    if len(x) and np.abs(x).max() < SAFE:  # 512 rows of 42 bits
        y = x.astype(np.float64)
        full = (y.T @ y).astype(np.int64)
    else:
        y = x.astype(object)
        full = y.T @ y
    return [int(v) for v in full[np.triu_indices(x.shape[1])]]


def extended(f: Fraction) -> np.longdouble:
    high = float(f)
    return np.longdouble(high) + np.longdouble(float(f - Fraction(high)))


def even(m: np.ndarray) -> np.ndarray:
    """Symmetric to the last bit: a rounding error divided by a small difference would cost orthogonality."""
    return (m + m.T) / 2


def refined(a: np.ndarray, x: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of symmetric ``a`` from nearby ``x``, by Ogita-Aishima steps with sub-solves of clusters, in the precision of ``a``."""
    n, eps = len(a), np.finfo(a.dtype).eps
    one = np.eye(n, dtype=a.dtype)
    size = np.abs(a).sum(axis=1).max()
    value = np.diag(x.T @ a @ x)
    for _ in range(steps):
        r, s = even(one - x.T @ x), even(x.T @ a @ x)
        value = np.diag(s) / (1 - np.diag(r))
        rest = s - np.diag(value)
        error = 2 * (np.abs(rest).sum(axis=1).max() + size * np.abs(r).sum(axis=1).max())
        gap = value[None, :] - value[:, None]
        apart = np.abs(gap) > error
        e = np.where(apart, (s + value[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ e
        order = np.argsort(-value, kind="stable")
        x, value = x[:, order], value[order]
        x = turned(a, x, value, error)
        if error <= 4 * n * eps * size:
            break
    return value, x


def turned(a: np.ndarray, x: np.ndarray, value: np.ndarray, error) -> np.ndarray:
    """``x`` with each cluster (neighbours no further apart than ``error``) turned to the eigenvectors of its own small problem. About the cluster's centre the
    differences are large against the entries, so double precision tells what single precision could not."""
    x = x.copy()
    cuts = [0, *(np.flatnonzero(value[:-1] - value[1:] > error) + 1).tolist(), len(value)]
    for first, end in zip(cuts, cuts[1:]):
        if end - first > 1:
            own = x[:, first:end]
            centre = value[first:end].mean()
            small = even(own.T @ (a @ own - centre * own))
            scale = np.abs(small).max()
            if scale > 0:
                _, q = np.linalg.eigh((small / scale).astype(np.float64))
                own = own @ q[:, ::-1].astype(a.dtype)
            x[:, first:end] = own @ (1.5 * np.eye(end - first, dtype=a.dtype) - 0.5 * (own.T @ own))
    return x


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors of a symmetric matrix in extended precision: single precision, then double, then extended."""
    scale = np.abs(a).max()
    if not scale > 0:
        return np.zeros(len(a), dtype=a.dtype), np.eye(len(a), dtype=a.dtype)
    b = a / scale
    _, x = np.linalg.eigh(b.astype(np.float32))
    x = x[:, ::-1]
    for kind, steps in ((np.float64, 8), (np.longdouble, 6)):
        value, x = refined(b.astype(kind), x.astype(kind), steps)
    order = np.argsort(-value, kind="stable")
    value, x = value[order], x[:, order]
    x = x @ (1.5 * np.eye(len(x), dtype=a.dtype) - 0.5 * (x.T @ x))
    lead = x[np.abs(x).argmax(axis=0), np.arange(len(x))]
    return value * scale, x * np.where(lead < 0, -1, 1)


class Fit:
    """Sums, covariance and leading components of the clean rows."""

    def __init__(self, rows: DataFrame, components: int = COMPONENTS):
        width = rows.select(F.size("embedding")).first()
        self.d = width[0] if width else 0
        self.n, self.sums, self.centre = 0, [], []
        if not self.d:
            return
        d = self.d
        counted = totals(rows, lambda batch: [batch.num_rows, *(int(v) for v in grid(batch, 1).sum(axis=0))], d + 1)
        self.n, self.sums = counted[0], counted[1:]
        self.centre = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        middle = np.array(self.centre, dtype=np.int64)
        found = totals(rows, lambda batch: products(grid(batch, 1) - middle), d * (d + 1) // 2)
        off = [Fraction(s, self.n) - c for s, c in zip(self.sums, self.centre)]
        cov = np.zeros((d, d), dtype=np.longdouble)
        for i, j, g in zip(*np.triu_indices(d), found):
            cov[i, j] = cov[j, i] = extended(Fraction(g, self.n) - off[i] * off[j])
        self.off = np.array([float(o) for o in off])
        value, vectors = eigen(cov)
        trace = np.trace(cov)
        kept = int((value[:components] > d * np.finfo(np.float64).eps * max(value[0], 0)).sum())
        self.values = value[:kept].astype(np.float64)
        self.explained = (value[:kept] / trace).astype(np.float64) if kept else np.zeros(0)
        self.vectors = vectors[:, :kept].astype(np.float64)


def deviations(x: np.ndarray, n: int, sums: list[int], centre: list[int]) -> list[int | None]:
    """The exact sum of (n x - S)^2 of each row; nothing where it is no long."""
    middle, rest = np.array(centre, dtype=np.int64), [n * c - s for c, s in zip(centre, sums)]
    far = np.abs(x - middle).max(initial=0) * n + max(map(abs, rest), default=0)
    if far**2 * x.shape[1] < 1 << 62:
        y = (x - middle) * n + np.array(rest, dtype=np.int64)
        return (y * y).sum(axis=1).tolist()
    y = (x - middle).astype(object) * n + np.array(rest, dtype=object)
    return [int(v) if v < 1 << 63 else None for v in (y * y).sum(axis=1)]


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, Fit]:
    """(vec_id, n, deviation, whitened array<double>) of the clean rows, stored, and the fit.

    Rows with a null vector, or an entry that is null or not finite, or of an unusual length, are left out; null and repeated ids are rows like others;
    extra columns are not read; an empty table gives an empty one. A component whose eigenvalue is zero to double precision has no scale and is left out, so
    equal vectors have none."""
    rows = clean(embeddings)
    fit = Fit(rows, components)
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, n long, deviation long, whitened array<double>"
    if not fit.d or not len(fit.values):
        return rows.sparkSession.createDataFrame([], schema), fit
    weights = fit.vectors / np.sqrt(fit.values)
    shift, n, sums, centre, off = np.array(fit.centre, dtype=np.int64), fit.n, fit.sums, fit.centre, fit.off

    def make(batch):
        x = grid(batch, 1)
        values = ((x - shift).astype(np.float64) - off) @ weights
        return {"vec_id": batch.column(0), "n": [n] * len(x), "deviation": deviations(x, n, sums, centre), "whitened": values.tolist()}

    return stored(per_batch(rows, make, schema), "whitened"), fit


def identity_error(whitened: DataFrame, k: int) -> float:
    """The largest entry, in absolute value, of the covariance of the whitened rows less the identity."""
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    at = lambda i: F.col("whitened")[i]
    found = whitened.agg(*[F.covar_pop(at(i), at(j)).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(c - (i == j)) for (i, j), c in zip(pairs, found))


def components(embeddings: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """A row for each clean row and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error."""
    rows, fit = whiten(embeddings, most)
    k = len(fit.values) if fit.d else 0
    error = identity_error(rows, k) if k else 0.0
    told = F.array(*[F.lit(float(v)) for v in fit.explained]) if k else F.array().cast("array<double>")
    each = rows.select("vec_id", "n", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened", told[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"))
