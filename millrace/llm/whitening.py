"""Embedding whitening with exact covariances and refined eigenvectors.

1. A row counts if its vector is there and all entries are finite; each entry `c` becomes the integer
   `floor(1024 * c) + 100000`. Everything up to the covariance is integer arithmetic: tasks centre their rows on
   the whole part of the mean, multiply (as limbs of 18 bits, whose products are exact in float64), and Spark adds the entries up. The
   rest of the mean is taken off exactly, so the covariance has one rounding and doesn't depend on how rows are dealt.
2. The driver, with a matrix of `d * d` numbers and no rows, takes eigenvectors in float32 and refines them with the matrix
   products of Ogita and Aishima in extended precision. Eigenvalues that lie too close for a quotient are solved again as
   the small problem that their vectors span, then refined with the others.
3. Rows are projected in Arrow batches. The covariance of the whitened rows is measured in a pass of its own.

No row is shuffled: the tasks send `d * (d + 1) / 2` numbers each, which are added before and after one exchange.

Defined results: vectors of another length than the most frequent (of ties the shorter) are left out like NULLs, as are all if that length is 0. Entries
saturate at 2^53 in size. A component without variance has `whitened` 0.0 in every row, and the identity has a 0 there; with no variance at all
`explained` is NULL. A deviation beyond a long is NULL. Vectors of over `MAX_DIMENSIONS` entries are refused. Repeated rows
count each and repeat their result; ids may be NULL; an empty table gives an empty result. Only the id and vector columns are read; there
is no text. Of equal eigenvalues any orthonormal basis is right; the same input gives the same one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 8
MAX_DIMENSIONS = 2048
SCALE, OFFSET = 1024.0, 100_000
_LARGEST = 2.0**53
_LIMB = 18
#: Rows whose limbs are multiplied at once: 2^17 products of 2 * 18 bits stay below 2^53.
_ROWS = 1 << 14
MAX_STEPS = 40


@dataclass(frozen=True)
class Whitening:
    """`n` fitted rows with sums per dimension; `values` and `vectors` (columns) by falling eigenvalue; the trace."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def scales(self) -> np.ndarray:
        """What projections are multiplied by; 0 for components without variance."""
        least = len(self.sums) * np.finfo(np.float64).eps * max(self.values, default=0.0)
        return np.array([1 / np.sqrt(e) if e > least else 0.0 for e in self.values])


def sound_vectors(rows: DataFrame, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """`vec_id, vector` of the rows whose vector is there, all of it finite, and of the most frequent length."""
    plain = rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    kept = plain.where(F.col("vector").isNotNull() & finite)
    length = kept.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    d = length[0]["d"] if length else 0
    if d > MAX_DIMENSIONS:
        raise ValueError(f"at most {MAX_DIMENSIONS} dimensions, not {d}")
    return kept.where((F.size("vector") == d) & (d > 0))


def integers(column: pa.Array) -> np.ndarray:
    """A column of vectors as the integers that are whitened, a row each."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return (np.clip(np.floor(flat * SCALE), -_LARGEST, _LARGEST).astype(np.int64) + OFFSET).reshape(len(column), -1)


def _chunks(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for first in range(0, batch.num_rows, _ROWS):
            yield integers(batch.column(at).slice(first, _ROWS))


def exact_products(x: np.ndarray) -> np.ndarray:
    """`x.T @ x` of an integer matrix in Python's integers, by matrix products of limbs."""
    sign, rest, limbs = np.sign(x).astype(np.float64), np.abs(x), []
    while not limbs or rest.any():
        limbs.append(sign * (rest & ((1 << _LIMB) - 1)))
        rest = rest >> _LIMB
    total = np.zeros((x.shape[1], x.shape[1]), dtype=object)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            total += (a.T @ b).astype(np.int64).astype(object) << (_LIMB * (i + j))
    return total


def _added(rows: DataFrame, made, kind: str) -> dict[int, object]:
    """Numbers that tasks make, as (place, value) pairs, summed by place."""
    made_rows = rows.mapInArrow(made, f"place bigint, value {kind}")
    return {r["place"]: r["value"] for r in made_rows.groupBy("place").agg(F.sum("value").alias("value")).collect()}


_EXACT = pa.schema([("place", pa.int64()), ("value", pa.decimal128(38, 0))])
_REAL = pa.schema([("place", pa.int64()), ("value", pa.float64())])


def _exact_rows(values: list[int]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(range(len(values)), pa.int64()), pa.array(map(Decimal, values), pa.decimal128(38, 0))], schema=_EXACT)


def column_sums(rows: DataFrame) -> tuple[int, tuple[int, ...]]:
    """Number of rows and exact sum of each dimension."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, None
        for x in _chunks(batches, 0):
            # Halves, so that no sum of a chunk leaves 64 bits.
            part = (x >> 32).sum(axis=0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(axis=0).astype(object)
            n, sums = n + len(x), part if sums is None else sums + part
        if n:
            yield _exact_rows([n, *sums])

    found = _added(rows.select("vector"), made, "decimal(38,0)")
    return int(found.get(0, 0)), tuple(int(found[k]) for k in range(1, len(found)))


def covariance(rows: DataFrame, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """Covariance (divisor `n`) in extended precision, rounded once from its exact value."""
    d, middle = len(sums), np.array([s // n for s in sums], dtype=np.int64)
    upper = np.triu_indices(d)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in _chunks(batches, 0):
            part = exact_products(x - middle)
            total = part if total is None else total + part
        if total is not None:
            yield _exact_rows(total[upper].tolist())

    products = _added(rows.select("vector"), made, "decimal(38,0)")
    rest = [s - n * int(m) for s, m in zip(sums, middle)]
    out = np.zeros((d, d), dtype=np.longdouble)
    for k, (i, j) in enumerate(zip(*upper)):
        out[i, j] = out[j, i] = _quotient(n * int(products[k]) - rest[i] * rest[j], n * n)
    return out


def _quotient(a: int, b: int) -> np.longdouble:
    high = a / b
    p, q = high.as_integer_ratio()
    return np.longdouble(high) + np.longdouble((a * q - p * b) / (b * q))


def refined_eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, to more than double precision."""
    d = len(v)
    scale = np.abs(v).max(initial=0)
    if not scale:
        return np.zeros(d), np.eye(d)
    a, one = np.asarray(v, np.longdouble) / scale, np.eye(d, dtype=np.longdouble)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    size = np.sqrt((a * a).sum())
    best = None
    for _ in range(MAX_STEPS):
        # Orthonormal to the last digit first: else the remainder, divided by a small gap, is no small correction.
        for _ in range(2):
            x = x @ (1.5 * one - 0.5 * (x.T @ x))
        r, s = one - x.T @ x, x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        error = np.sqrt((off * off).sum()) + size * np.sqrt((r * r).sum())
        if best is None or error < best[0]:
            best = (error, values, x)
        if error <= np.finfo(np.longdouble).eps * size * d:
            break
        # Eigenvalues nearer than this can't be told apart yet.
        least = 2 * error
        gaps = values[None, :] - values[:, None]
        near = np.abs(gaps) <= least
        x = x + x @ np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, gaps))
        x = _clusters_solved(a, x, values, least)
    _, values, x = best
    order = np.argsort(-values, kind="stable")
    x = (x / np.sqrt((x * x).sum(axis=0)))[:, order]
    signs = np.sign(x[np.abs(x).argmax(axis=0), np.arange(d)])
    return (values[order] * scale).astype(np.float64), (x * signs).astype(np.float64)


def _clusters_solved(a: np.ndarray, x: np.ndarray, values: np.ndarray, least) -> np.ndarray:
    """Turn the vectors of each cluster of eigenvalues into eigenvectors of what `a` is in their span."""
    order = np.argsort(values, kind="stable")
    for cluster in np.split(order, np.flatnonzero(np.diff(values[order]) > least) + 1):
        if len(cluster) > 1:
            span = x[:, cluster]
            small = span.T @ (a @ span - values[cluster].mean() * span)
            size = np.abs(small).max()
            if size:
                x[:, cluster] = span @ np.linalg.eigh(((small + small.T) / (2 * size)).astype(np.float64))[1].astype(np.longdouble)
    return x


def fitted(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of `sound_vectors`; None if there are none."""
    n, sums = column_sums(rows)
    if not n:
        return None
    v = covariance(rows, n, sums)
    values, vectors = refined_eigen(v)
    return Whitening(n, sums, values[:components], vectors[:, :components], float(np.trace(v)))


def _projected(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, list[int | None]]:
    """Whitened rows, and `sum((n * x - S)^2)` of each."""
    n, sums = model.n, np.array(model.sums, dtype=object)
    widest = n * int(np.abs(x).max(initial=0)) + max(map(abs, model.sums))
    y = n * x - sums.astype(np.int64) if widest < 1 << 63 else n * x.astype(object) - sums
    largest = max(int(np.max(y, initial=0)), -int(np.min(y, initial=0)))
    squares = y if largest**2 * len(sums) < 1 << 63 else y.astype(object)
    deviations = [int(t) if t < 1 << 63 else None for t in (squares * squares).sum(axis=1)]
    return (y / n).astype(np.float64) @ model.vectors * model.scales, deviations


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry of the covariance of all whitened rows minus the identity."""
    k = len(model.values)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for x in _chunks(batches, 0):
            w = _projected(x, model)[0]
            total += np.vstack([w.sum(axis=0), w.T @ w])
        yield pa.record_batch([pa.array(range(total.size), pa.int64()), pa.array(total.ravel())], schema=_REAL)

    sums = _added(rows.select("vector"), made, "double")
    total = np.array([sums[p] for p in range((k + 1) * k)]).reshape(k + 1, k) / model.n
    spread = total[1:] - np.outer(total[0], total[0])
    return float(np.abs(spread - np.diag((model.scales > 0).astype(float))).max())


_WHITENED = pa.schema([
    ("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
    ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64()),
])
_WHITENED_SQL = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whitened(embeddings: DataFrame, components: int = COMPONENTS, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """`vec_id, component, n, deviation, whitened, explained, identity_error` of each sound row and component."""
    rows = sound_vectors(embeddings, vector, vec_id)
    model = fitted(rows, components)
    if model is None:
        return rows.sparkSession.createDataFrame([], _WHITENED_SQL)
    error, k = identity_error(rows, model), len(model.values)
    explained = [float(e) / model.trace if model.trace > 0 else None for e in model.values]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, _ROWS):
                part = batch.slice(first, _ROWS)
                w, deviations = _projected(integers(part.column(1)), model)
                m = len(w)
                yield pa.record_batch([
                    part.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n)), pa.array([v for v in deviations for _ in range(k)], pa.int64()),
                    pa.array(w.ravel()), pa.array(explained * m, pa.float64()), pa.array(np.full(m * k, error)),
                ], schema=_WHITENED)

    return rows.mapInArrow(made, _WHITENED_SQL)
