"""Whitening of embeddings: eigenvectors of a distributed covariance, refined beyond the precision they were found in.

Sums and the covariance are gathered by one matrix for each partition and added up by cell, so that the driver gets as
many numbers as a covariance has. Its eigenvectors are found in float32 and corrected by the iterations of Ogita and
Aishima, matrix multiplications in extended precision that double the right digits each time. Eigenvalues that lie
too close together for these are a cluster: its vectors span the right space, and a small problem of their own within
that space, from which the common part of the eigenvalues is taken, tells them apart.
"""

from __future__ import annotations

import dataclasses
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.vectors import matrix, usable

WIDE = np.longdouble
SCHEMA = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
AT_ONCE = 2048


def refine(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, float]:
    """One step from approximate eigenvectors ``x`` of ``a``, all in WIDE: better ones, and how far ``x`` was from orthogonal and diagonal."""
    rest = np.eye(len(a), dtype=WIDE) - x.T @ x
    turned = x.T @ (a @ x)
    turned = (turned + turned.T) / 2
    values = np.diag(turned) / (1 - np.diag(rest))
    aside = turned - np.diag(np.diag(turned))
    close = 2 * (np.linalg.norm(aside.astype(np.float64)) + np.linalg.norm(a.astype(np.float64)) * np.linalg.norm(rest.astype(np.float64)))
    gaps, middle = values[None, :] - values[:, None], (values[None, :] + values[:, None]) / 2
    apart = np.abs(gaps) > close
    # half of ``rest`` makes the vectors orthogonal; what turns them is antisymmetric, also as rounded
    better = x + x @ (np.where(apart, (aside + middle * rest) / np.where(apart, gaps, 1), 0) + rest / 2)
    order = np.argsort(-values, kind="stable")
    better, values = better[:, order], values[order]
    for own in np.split(np.arange(len(values)), np.flatnonzero(-np.diff(values) > close) + 1):
        if len(own) > 1:
            inner = better[:, own].T @ (a @ better[:, own] - values[own].mean() * better[:, own])
            w = np.linalg.eigh(((inner + inner.T) / 2).astype(np.float64))[1][:, ::-1].astype(WIDE)
            better[:, own] = better[:, own] @ (w @ (3 * np.eye(len(own), dtype=WIDE) - w.T @ w) / 2)  # orthogonal beyond double precision
    return better, float(max(np.abs(rest).max(), np.abs(aside).max()))


def eigen(a: np.ndarray, most: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and its unit eigenvectors as columns, to double precision.

    Each vector's largest entry is positive. A matrix of zeros has the unit vectors.
    """
    scale = np.abs(a).max(initial=0)
    if not scale:
        return np.zeros(len(a)), np.eye(len(a))
    wide = (a / scale).astype(WIDE)
    now = np.linalg.eigh((a / scale).astype(np.float32))[1].astype(WIDE)
    least = np.inf
    for _ in range(most):
        better, error = refine(wide, now)
        if error < least:
            least, x = error, now
        if error < len(a) * 2.0**-62:
            break
        now = better
    x = x / np.sqrt((x * x).sum(0))
    values = ((x * (wide @ x)).sum(0) * WIDE(scale)).astype(np.float64)
    order = np.argsort(-values, kind="stable")
    x = x[:, order].astype(np.float64)
    signs = np.sign(x[np.abs(x).argmax(0), np.arange(len(a))])
    return values[order], x * signs


@dataclasses.dataclass(frozen=True)
class Whitening:
    """What ``fit`` found: the vectors are ``middle`` + ``rest`` / n in the mean, in whole steps of 1/64 and 1,000,000 more."""

    n: int
    middle: list[int]
    rest: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None

    @property
    def scaled(self) -> np.ndarray:
        """Eigenvectors over the roots of their eigenvalues; NaN where there is no variance but rounding."""
        held = self.values > self.trace * len(self.middle) * 2.0**-52
        return self.vectors / np.sqrt(np.where(held, self.values, np.nan))


def steps(vectors: np.ndarray) -> np.ndarray:
    return np.floor(64 * vectors).astype(np.int64) + 1_000_000


def _summed(rows: DataFrame, per_partition, kind: str) -> dict[tuple[int, int], object]:
    """Add up the matrices that ``per_partition`` makes of a partition's vectors, cell by cell."""
    cells = rows.select("vector").mapInArrow(per_partition, f"i int, row array<{kind}>").select("i", F.posexplode("row").alias("j", "v"))
    return {(r["i"], r["j"]): r["v"] for r in cells.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}


def _as_rows(a, kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(a), dtype=np.int32)), pa.array([list(r) for r in a], pa.list_(kind))], names=["i", "row"])


def _totals(batches):
    """The number of vectors and their sums, exactly."""
    total = None
    for batch in batches:
        x = steps(matrix(batch.column("vector")))
        if len(x):
            own = [len(x), *(int(hi) * 2**26 + int(lo) for hi, lo in zip((x >> 26).sum(0), (x & (2**26 - 1)).sum(0), strict=True))]
            total = own if total is None else [a + b for a, b in zip(total, own, strict=True)]
    if total:
        yield _as_rows([[Decimal(t) for t in total]], pa.decimal128(38, 0))


def centred(x: np.ndarray, middle: np.ndarray, rest: np.ndarray, n: int) -> np.ndarray:
    return (x - middle).astype(np.float64) - rest.astype(np.float64) / n


def _products(middle: np.ndarray, rest: np.ndarray, n: int, turn: np.ndarray | None):
    """Sums of products of a partition's centred vectors, projected on the columns of ``turn`` if given."""

    def run(batches):
        total = None
        for batch in batches:
            x = matrix(batch.column("vector"))
            if len(x):
                y = centred(steps(x), middle, rest, n)
                y = y if turn is None else y @ turn
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield _as_rows(total, pa.float64())

    return run


def _square(cells: dict, size: int) -> np.ndarray:
    out = np.zeros((size, size))
    for (i, j), v in cells.items():
        out[i, j] = v
    return (out + out.T) / 2


def fit(rows: DataFrame, components: int = 32) -> Whitening | None:
    """Fit on all of ``rows``, see ``usable``. None without any."""
    cells = _summed(rows, _totals, "decimal(38,0)")
    if not cells:
        return None
    n, *sums = (int(cells[0, j]) for j in range(len(cells)))
    middle, rest = map(list, zip(*(divmod(s, n) for s in sums), strict=True))
    about = np.array(middle, np.int64), np.array(rest, np.int64), n
    covariance = _square(_summed(rows, _products(*about, None), "double"), len(sums)) / n
    values, vectors = eigen(covariance)
    found = Whitening(n, middle, rest, values[:components], vectors[:, :components], float(np.trace(covariance)), None)
    turn = found.scaled[:, ~np.isnan(found.scaled).any(0)]
    if not turn.shape[1]:
        return found
    whitened = _square(_summed(rows, _products(*about, turn), "double"), turn.shape[1]) / n
    return dataclasses.replace(found, identity_error=float(np.abs(whitened - np.eye(len(whitened))).max()))


def deviations(x: np.ndarray, model: Whitening) -> list[Decimal]:
    """The sum over dimensions of (n x - S)^2 of each row, exactly."""
    off = x - np.array(model.middle)
    largest = model.n * (int(np.abs(off).max(initial=0)) + 1)
    if len(model.middle) * largest**2 < 2**63:
        away = model.n * off - np.array(model.rest)
        return [Decimal(int(v)) for v in (away * away).sum(1)]
    away = model.n * off.astype(object) - np.array(model.rest, object)
    return [Decimal(v) for v in (away * away).sum(1)]


def whiten(df: DataFrame, *, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Entries c become whole numbers floor(64 c) + 1,000,000; components are eigenvectors of their covariance over all
    vectors, numbered by falling eigenvalue. ``whitened`` is the centred vector's projection over the root of the
    eigenvalue, ``explained`` the eigenvalue over the trace, ``deviation`` the exact sum of squares of n x - S.

    Vectors that cannot be computed with take no part (see ``usable``); null ids are carried, repeated rows count and come
    out each, other columns are not read. An empty table gives no rows. Components without variance (one vector, equal
    vectors, a constant dimension) have a null ``whitened``, and their ``explained`` is 0, or null without any variance.
    """
    rows = usable(df, id_col=id_col, vector_col=vector_col)
    model = fit(rows, components)
    if model is None:
        return df.sparkSession.createDataFrame([], SCHEMA)
    turn, trace = model.scaled, model.trace
    k = turn.shape[1]
    middle, rest = np.array(model.middle, np.int64), np.array(model.rest, np.int64)
    explained = [float(v) / trace if trace else None for v in np.maximum(model.values, 0)]

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(lo, AT_ONCE)
                x = steps(matrix(part.column("vector")))
                w = centred(x, middle, rest, model.n) @ turn
                each = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(each), model.n, np.int64)),
                        pa.array(deviations(x, model), pa.decimal128(38, 0)).take(pa.array(each)),
                        pa.array(w.ravel(), mask=np.isnan(w.ravel())),
                        pa.array(explained * len(x), pa.float64()),
                        pa.array([model.identity_error] * len(each), pa.float64()),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.select("id", "vector").mapInArrow(run, SCHEMA)
