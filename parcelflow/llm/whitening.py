"""Whitened leading components of embeddings by Chebyshev-filtered subspace iteration.

Entries become whole numbers, x = floor(SCALE * c) + SHIFT, so the count n and
the sums S of every dimension are exact.  The covariance V is never formed: a
pass over the packed vectors gives V Q for a block Q of ``width`` columns, as
the sum of X'(X Q) / n over pieces of the centred rows X = (n x - S) / n.

1. A few Lanczos steps give an estimate of the spectrum's lower end.
2. Rounds: a Chebyshev polynomial of degree ``DEGREE`` in V, by its three-term
   recurrence (one pass a degree), damps what lies between that lower end and
   the block's smallest Ritz value; QR; one pass more for Rayleigh-Ritz.
3. Certified: the residual of every wanted pair is at rounding level, or no
   longer falls and is at most ``LOOSE`` of the largest eigenvalue.  A run that
   is not certified after ``ROUNDS`` rounds raises.

A pass sends the tasks Q and brings back matrices of Q's shape, which some
tasks sum first; nothing that grows with the rows reaches the driver.

Vectors that are null, empty or hold null or non-finite entries take no part,
nor do vectors of another length than the most frequent one (the longer of
equally frequent ones).  A row without an id takes part; repeated rows count
and are returned each.  A component without variance (relative 1e-12) is not
returned: equal vectors, or a single one, give an empty result, and so does an
empty table.  ``deviation`` is null where it does not fit 64 bits.  Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

SCALE, SHIFT = 1024, 100_000
#: columns of the block beyond the wanted ones, degree of the filter, Lanczos steps
SPARE, DEGREE, STEPS, ROUNDS = 24, 12, 8, 60
TIGHT, LOOSE, FLAT = 64 * np.finfo(float).eps, 1e-11, 1e-12
#: bytes of a packed piece, tasks that sum the pieces' results
PIECE, SUMS = 4 << 20, 8


def finite(vec: Column) -> Column:
    """True for vectors with entries, all of them finite numbers."""
    return F.coalesce((F.size(vec) > 0) & F.forall(vec, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))), F.lit(False))


_PACKED = "ids array<bigint>, x binary"


def packed(table: DataFrame, dim: int, key: str, vec: str) -> DataFrame:
    """The vectors of length ``dim`` as pieces: ids and the whole numbers, row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = max(1, PIECE // (8 * dim))
        for b in batches:
            for lo in range(0, b.num_rows, rows):
                part = b.slice(lo, rows)
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).astype("<i8")
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("id"))
                yield pa.RecordBatch.from_arrays([ids, pa.array([x.tobytes()], pa.binary())], names=["ids", "x"])

    whole = F.transform(F.col(vec).cast("array<double>"), lambda c: F.floor(c * SCALE) + F.lit(SHIFT))
    rows = table.where(finite(F.col(vec)) & (F.size(vec) == dim)).select(F.col(key).cast("bigint").alias("id"), whole.cast("array<bigint>").alias("x"))
    return rows.mapInArrow(run, _PACKED)


class Centre:
    """n and S; centres packed pieces without rounding before the one division."""

    def __init__(self, n: int, sums: list[int], largest: int):
        self.n, self.sums = n, sums
        reach = n * largest + max(map(abs, sums))
        self.small = reach < 1 << 62
        self.square = len(sums) * reach * reach < 1 << 62

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """n x - S, as int64 where that holds it, else as Python integers."""
        if self.small:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return (self.numerators(x) / self.n).astype(np.float64)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        num = self.numerators(x)
        if not self.square:
            most = np.abs(num).max(1, initial=0).astype(object)
            exact = num if all(len(self.sums) * m * m < 1 << 63 for m in most) else num.astype(object)
            return [int(v) if v < 1 << 63 else None for v in (exact * exact).sum(1)]
        return (num * num).sum(1).tolist()


def _matrix(raw: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(raw, "<i8").reshape(-1, dim)


def _total(pieces: DataFrame, dim: int, of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """The sum over all pieces of ``of``, a float64 array of ``shape`` made from a piece's whole numbers."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for b in batches:
            for raw in b.column(0):
                total += of(_matrix(raw.as_py(), dim))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["m"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for b in batches:
            for raw in b.column(0):
                total += np.frombuffer(raw.as_py()).reshape(shape)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["m"])

    got = pieces.select("x").mapInArrow(each, "m binary").repartition(SUMS).mapInArrow(join, "m binary").collect()
    return sum((np.frombuffer(bytes(r["m"])).reshape(shape) for r in got), np.zeros(shape))


def fitted(pieces: DataFrame, dim: int) -> Centre | None:
    """n and the exact sums of every dimension; None without a vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column(0):
                x = _matrix(raw.as_py(), dim)
                most = np.maximum(x.max(0), -(x.min(0) + 1)) + 0
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), pa.array((x >> 32).sum(0)), pa.array((x & 0xFFFFFFFF).sum(0)), pa.array(np.full(dim, len(x))), pa.array(most)], names=["j", "high", "low", "n", "most"])

    parts = pieces.select("x").mapInArrow(run, "j bigint, high bigint, low bigint, n bigint, most bigint")
    big = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    got = parts.groupBy("j").agg(big("high"), big("low"), F.sum("n").alias("n"), F.max("most").alias("most")).orderBy("j").collect()
    if not got:
        return None
    return Centre(got[0]["n"], [(int(r["high"]) << 32) + int(r["low"]) for r in got], max(r["most"] for r in got) + 1)


def lower_end(apply: Callable[[np.ndarray], np.ndarray], dim: int, rng: np.random.Generator) -> float:
    """An estimate, rather too small, of the least eigenvalue: Lanczos steps from a random vector."""
    basis, alpha, beta = [np.linalg.qr(rng.normal(size=(dim, 1)))[0]], [], []
    for _ in range(min(STEPS, dim)):
        w = apply(basis[-1])
        alpha.append(float((basis[-1] * w).sum()))
        for _ in range(2):
            for q in basis:
                w = w - q * (q * w).sum()
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-12 * abs(alpha[0]):
            break
        basis.append(w / beta[-1])
    values, vectors = np.linalg.eigh(np.diag(alpha) + np.diag(beta[: len(alpha) - 1], 1) + np.diag(beta[: len(alpha) - 1], -1))
    return max(0.0, float(values[0] - 2 * beta[-1] * abs(vectors[-1, 0])))


def filtered(apply: Callable[[np.ndarray], np.ndarray], q: np.ndarray, low: float, cut: float, top: float, degree: int = DEGREE) -> np.ndarray:
    """Chebyshev polynomial of V, small on [low, cut] and scaled to about 1 at ``top``, times ``q``."""
    half, middle = (cut - low) / 2, (cut + low) / 2
    sigma = first = half / (top - middle)
    before, now = q, (apply(q) - middle * q) * (sigma / half)
    for _ in range(degree - 1):
        new = 1 / (2 / first - sigma)
        before, now = now, (apply(now) - middle * now) * (2 * new / half) - before * (sigma * new)
        sigma = new
    return now


def leading(apply: Callable[[np.ndarray], np.ndarray], dim: int, k: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and unit eigenvectors of the symmetric operator ``apply``."""
    rng = np.random.default_rng(seed)
    k = min(k, dim)
    width = min(dim, k + SPARE)
    low = lower_end(apply, dim, rng) if width < dim else 0.0
    q = np.linalg.qr(rng.normal(size=(dim, width)))[0]
    last = np.inf
    for _ in range(ROUNDS):
        vq = apply(q)
        small = q.T @ vq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        q = q / np.linalg.norm(q, axis=0)
        top = max(values[0], 0.0)
        off = float(np.linalg.norm(vq[:, :k] - q[:, :k] * values[:k], axis=0).max())
        if off <= TIGHT * top or (off <= LOOSE * top and off > last / 2) or width == dim:
            return values[:k], q[:, :k]
        last = off
        cut = max(values[-1], low + 1e-6 * top)
        q = np.linalg.qr(filtered(apply, q, min(low, cut * 0.999), cut, values[0]))[0]
    raise ArithmeticError(f"not certified after {ROUNDS} rounds: residual {last}")


_OUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(table: DataFrame, k: int = 8, key: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """One row for every vector that takes part and each of the k leading components (as many as have variance)."""
    spark = table.sparkSession
    lengths = table.where(finite(F.col(vec))).groupBy(F.size(vec).alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if lengths is None:
        return spark.createDataFrame([], _OUT)
    dim = lengths["dim"]
    pieces = written(packed(table, dim, key, vec), "vectors")
    centre = fitted(pieces, dim)
    n = centre.n
    trace = float(_total(pieces, dim, lambda x: np.square(centre.rows(x)).sum(0), (dim,)).sum()) / n

    def apply(q: np.ndarray) -> np.ndarray:
        return _total(pieces, dim, lambda x: (r := centre.rows(x)).T @ (r @ q), q.shape) / n

    values, vectors = leading(apply, dim, k) if trace > 0 else (np.zeros(0), np.zeros((dim, 0)))
    some = values > FLAT * trace
    values, vectors = values[some], vectors[:, some]
    m = len(values)
    if not m:
        return spark.createDataFrame([], _OUT)
    to = vectors / np.sqrt(values)
    mean = _total(pieces, dim, lambda x: (centre.rows(x) @ to).sum(0), (m,)) / n
    spread = _total(pieces, dim, lambda x: (w := centre.rows(x) @ to - mean).T @ w, (m, m)) / n
    error, explained = float(np.abs(spread - np.eye(m)).max()), values / trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, raw in zip(b.column("ids"), b.column("x"), strict=True):
                x = _matrix(raw.as_py(), dim)
                yield pa.RecordBatch.from_arrays([
                    ids.values.take(pa.array(np.repeat(np.arange(len(x)), m))), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * m, n)),
                    pa.array([d for d in centre.deviation(x) for _ in range(m)], pa.int64()), pa.array((centre.rows(x) @ to).ravel()),
                    pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * m, error)),
                ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return pieces.mapInArrow(run, _OUT)
