"""Embedding whitening by Chebyshev-filtered subspace iteration.

Entries become integers x = floor(1024 c) + 100000, so that counts, sums and deviations are exact.
With n vectors x of d entries, sums S and covariance V = (1/n) sum (x - S/n)(x - S/n)^T:

1. One pass gives n and S (integer sums).
2. The leading eigenvectors of V are found without forming V.  A block Q of BLOCK columns is
   multiplied by V in distributed passes: every task centres its rows ((n x - S) / n, the
   numerator in integers) and returns its share of X^T (X Q), a d x BLOCK matrix, which Spark
   adds up entry by entry; the driver holds d x BLOCK numbers, however many rows there are.
3. Each iteration applies a Chebyshev polynomial of V to Q by its three-term recurrence, scaled
   so that nothing overflows.  Its interval is [0, the smallest Ritz value of the block]: there
   the polynomial stays below one, above it grows fastest, which damps the unwanted spectrum.
   QR, the projected matrix and its eigenvectors (Rayleigh-Ritz) follow.
4. It ends when the wanted pairs are certified: every residual |V q - e q| is at most TOLERANCE
   times the largest eigenvalue (an eigenvalue then lies within that of e, and a vector is off
   by at most that over its gap).  A block as wide as the vectors is exact at the first try.
   A spectrum with no gap behind the block may need more iterations, never gives another result;
   after ITERATIONS without a certificate the operator raises an error.

Defined cases: vectors that are null or hold null or non-finite entries are left out; so are
ones with an entry beyond 2^50 (x would not fit in a long), empty ones and ones whose length is not the commonest (of equally common ones the longest);
a null vec_id is kept; repeated rows count each; components whose eigenvalue is at most RANK of
the largest are not returned (all, for one row or equal rows); fewer dimensions than components
give fewer components; an empty table gives no rows; deviation is null where it exceeds a long;
other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.llm.common import small_batches, written

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
BLOCK = 32
DEGREE = 8
ITERATIONS = 60
TOLERANCE = 2e-14
RANK = 1e-12
BATCH_ROWS = 2048
EXACT = 2 ** 53
LARGEST = 2 ** 50


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, x array<long>) of the vectors that take part; written."""
    c = F.transform("embedding", lambda v: v.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), c.alias("c")).where(
        F.expr(f"size(c) > 0 AND NOT exists(c, v -> v IS NULL OR isnan(v) OR abs(v) > {LARGEST}D)"))
    x = F.transform("c", lambda v: F.floor(v * SCALE) + SHIFT)
    rows = written(rows.select("vec_id", x.alias("x")), "whiten-x")
    longest = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == longest["d"]) if longest else rows


def _matrix(column: pa.ListArray, d: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, d)


def totals(x: DataFrame) -> tuple[int, list[int]]:
    """n and the sums of every dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, own = 0, None
        for batch in batches:
            if batch.num_rows:
                m = _matrix(batch.column(0), len(batch.column(0)[0]))
                # A batch's sums fit in 64 bits while its entries stay below 2^50.
                add = m.astype(object) if np.abs(m).max() > EXACT // 8 else m
                add = add.sum(axis=0).astype(object)
                n, own = n + len(m), add if own is None else own + add
        if n:
            sums = [Decimal(int(v)) for v in (n, *own)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(sums)), pa.int32()), pa.array(sums, pa.decimal128(38, 0))], ["at", "v"])
    added = x.select("x").mapInArrow(run, "at int, v decimal(38,0)").groupBy("at").agg(F.sum("v").alias("v"))
    out = [int(r["v"]) for r in added.orderBy("at").collect()]  # d + 1 numbers
    return (out[0], out[1:]) if out else (0, [])


def centred(m: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """(n x - S) as doubles: exact integers, each rounded once."""
    low, high = int(m.min(initial=0)), int(m.max(initial=0))
    if max(abs(low), abs(high)) * n + max(map(abs, sums)) < 2 ** 62:
        return (m * n - np.array(sums, np.int64)).astype(np.float64)
    return (m.astype(object) * n - np.array(sums, object)).astype(np.float64)


class Passes:
    """Distributed products with the covariance of ``x``."""

    def __init__(self, x: DataFrame, n: int, sums: list[int]):
        self.x, self.n, self.sums, self.count = x.select("x"), n, sums, 0

    def total(self, share) -> np.ndarray:
        """The sum over all rows of ``share(centred rows / n)``, entry by entry."""
        n, sums, d = self.n, self.sums, len(self.sums)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = None
            for batch in batches:
                if batch.num_rows:
                    add = share(centred(_matrix(batch.column(0), d), n, sums) / n)
                    own = add if own is None else own + add
            if own is not None:
                flat = own.reshape(-1)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)],
                                                 ["at", "v"])
        self.count += 1
        added = self.x.mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v"))
        rows = added.collect()  # as many numbers as a task's share has
        out = np.zeros(len(rows))
        for r in rows:
            out[r["at"]] = r["v"]
        return out

    def times(self, q: np.ndarray) -> np.ndarray:
        """V Q."""
        return self.total(lambda c: c.T @ (c @ q)).reshape(q.shape) / self.n

    def trace(self) -> float:
        return float(self.total(lambda c: np.array([(c * c).sum()]))[0]) / self.n


def _ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values (falling), vectors and V times the vectors, from an orthonormal block."""
    small = q.T @ vq
    values, turn = np.linalg.eigh((small + small.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], q @ turn, vq @ turn


def chebyshev(times, q: np.ndarray, vq: np.ndarray, degree: int, cut: float, top: float) -> np.ndarray:
    """p(V) Q for the Chebyshev polynomial that is small on [0, cut] and one at ``top``."""
    half = cut / 2
    sigma = first = half / (top - half)
    old, new = q, (vq - half * q) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        old, new = new, 2 * following / half * (times(new) - half * new) - sigma * following * old
        sigma = following
    return new


def eigenpairs(passes: Passes, wanted: int = COMPONENTS, block: int = BLOCK, degree: int = DEGREE,
               seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Certified leading eigenvalues (falling) and unit eigenvectors of the covariance."""
    d = len(passes.sums)
    k = min(d, max(block, wanted))
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, k)))[0]
    for _ in range(ITERATIONS):
        values, q, vq = _ritz(q, passes.times(q))
        own = min(wanted, k)
        residual = np.linalg.norm(vq[:, :own] - q[:, :own] * values[:own], axis=0)
        if (residual <= TOLERANCE * max(values[0], 0)).all():
            return values[:own], q[:, :own] / np.linalg.norm(q[:, :own], axis=0)
        # The vectors are unit ones of a rank-deficient V too: a cut of nought damps nothing.
        cut = max(values[-1], 1e-9 * values[0])
        q = np.linalg.qr(chebyshev(passes.times, q, vq, degree, cut, values[0]))[0]
    raise ArithmeticError(f"no certificate after {ITERATIONS} iterations; widen the block ({k})")


class Whitening:
    """A fitted whitening: ``components`` (d x k, unit columns) and falling ``eigenvalues``."""

    def __init__(self, spark: SparkSession, x: DataFrame, wanted: int = COMPONENTS, block: int = BLOCK,
                 degree: int = DEGREE):
        small_batches(spark, BATCH_ROWS)
        self.n, self.sums = totals(x)
        passes = Passes(x, self.n, self.sums)
        self.trace = passes.trace() if self.n else 0.0
        if self.trace <= 0:
            self.eigenvalues, self.components = np.zeros(0), np.zeros((len(self.sums), 0))
        else:
            values, vectors = eigenpairs(passes, wanted, block, degree)
            good = values > RANK * values[0]
            self.eigenvalues, self.components = values[good], vectors[:, good]
        self.passes = passes
        self.identity_error = self._identity_error() if len(self.eigenvalues) else 0.0

    def project(self, c: np.ndarray) -> np.ndarray:
        """Centred rows -> whitened rows."""
        return (c @ self.components) / np.sqrt(self.eigenvalues)

    def _identity_error(self) -> float:
        w, e, k = self.components, np.sqrt(self.eigenvalues), len(self.eigenvalues)

        def share(c: np.ndarray) -> np.ndarray:
            own = (c @ w) / e
            return np.concatenate([own.T @ own, own.sum(axis=0)[None, :]])
        both = self.passes.total(share).reshape(k + 1, k) / self.n
        cov = both[:k] - np.outer(both[k], both[k])
        return float(np.abs(cov - np.eye(k)).max())

    def transform(self, x: DataFrame) -> DataFrame:
        """(vec_id, deviation, whitened array<double>) of every row."""
        n, sums, w, e = self.n, self.sums, self.components, np.sqrt(self.eigenvalues)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                m = _matrix(batch.column(1), len(sums))
                c = centred(m, n, sums)
                if len(sums) * float(np.abs(c).max()) ** 2 < 2 ** 62 and np.abs(c).max() < EXACT:
                    own = (c.astype(np.int64) ** 2).sum(axis=1).tolist()
                else:
                    own = ((m.astype(object) * n - np.array(sums, object)) ** 2).sum(axis=1).tolist()
                own = [v if v < 2 ** 63 else None for v in own]
                white = ((c / n) @ w) / e
                ends = np.arange(len(m) + 1, dtype=np.int32) * white.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(own, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(white.reshape(-1)))],
                    ["vec_id", "deviation", "whitened"])
        return x.select("vec_id", "x").mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def contract(vectors: DataFrame) -> DataFrame:
    x = integers(vectors)
    fit = Whitening(vectors.sparkSession, x)
    rows = fit.transform(x).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*[F.lit(float(e / fit.trace)) for e in fit.eigenvalues]).cast("array<double>")
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(fit.n).cast("long").alias("n"),
                       "deviation", "whitened", F.get(shares, F.col("at")).alias("explained"),
                       F.lit(fit.identity_error).alias("identity_error"))
