"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

Entries become integers, so sums over rows are exact. Each distinct vector counts once: sums and
the centred scatter of these are added up in the tasks and then by Spark, entry by entry, so
what reaches the driver is the number of dimensions and its square, whatever the number of
rows. On the driver the covariance is factored by Cholesky with the largest pivot first,
which stops where what is left is rounding, so it finds the rank. One-sided Jacobi rotates
the columns of that triangular factor until they are orthogonal: their squared norms are the
eigenvalues, the normalised columns the components. The covariance itself is never rotated, so
small eigenvalues keep their digits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraclake.llm.frames import stored

#: How an entry becomes an integer.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: A pivot below this share of the largest variance is rounding.
RANK = 1e-13
#: Columns count as orthogonal below this cosine.
ORTHOGONAL, SWEEPS = 1e-15, 60


def whole(vector: str, scale: int) -> Column:
    """floor(scale * entry) of each entry, or null for vectors with entries that are null or not finite."""
    entry = F.transform(vector, lambda c: c.cast("double"))
    sound = F.col(vector).isNotNull() & F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(sound, F.transform(entry, lambda c: F.floor(c * scale)))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a list column of one width."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def added(rows: DataFrame, column: str, width: int, one: Callable[[np.ndarray], np.ndarray], size: int, kind: type) -> np.ndarray:
    """The sum over all rows of ``one``, which gives an array of ``size`` entries for some of them."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, kind)
        for batch in batches:
            total += one(matrix(batch.column(0), width)).reshape(-1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["at", "value"])

    parts = rows.select(column).mapInArrow(task, f"at int, value {'bigint' if kind is np.int64 else 'double'}")
    got = parts.groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(size, kind)
    out[got["at"].to_numpy()] = got["value"].to_numpy()
    return out


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """L with L L' = v, one column for each rank; rows in the order of ``v``."""
    left, n = v.astype(float).copy(), len(v)
    columns = []
    limit = RANK * max(0.0, float(left.diagonal().max(initial=0)))
    for _ in range(n):
        p = int(np.argmax(left.diagonal()))
        if left[p, p] <= limit:
            break
        column = left[:, p] / np.sqrt(left[p, p])
        left -= np.outer(column, column)
        left[p, :] = left[:, p] = 0.0
        columns.append(column)
    return np.array(columns).T.reshape(n, len(columns))


def rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of n columns in rounds of disjoint pairs, as a round-robin tournament deals them."""
    players = list(range(n + n % 2))
    out = []
    for _ in range(len(players) - 1):
        half = len(players) // 2
        pairs = [(a, b) for a, b in zip(players[:half], reversed(players[half:])) if max(a, b) < n]
        out.append((np.array([a for a, _ in pairs], int), np.array([b for _, b in pairs], int)))
        players.insert(1, players.pop())
    return out


def jacobi(factor: np.ndarray) -> np.ndarray:
    """The columns of ``factor`` rotated by pairs until they are orthogonal, the longest first."""
    g = factor.copy()
    for _ in range(SWEEPS):
        worst = 0.0
        for i, j in rounds(g.shape[1]):
            a, b = g[:, i], g[:, j]
            alpha, beta, gamma = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            cosine = np.abs(gamma) / np.maximum(np.sqrt(alpha * beta), 1e-300)
            worst = max(worst, float(cosine.max(initial=0)))
            turn = cosine > ORTHOGONAL
            zeta = (beta - alpha) / np.where(turn, 2 * gamma, 1.0)
            t = np.where(turn, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta)), 0.0)
            c = 1 / np.sqrt(1 + t * t)
            g[:, i], g[:, j] = c * a - c * t * b, c * t * a + c * b
        if worst <= ORTHOGONAL * max(1, len(g)):
            break
    return g[:, np.argsort(-(g * g).sum(0), kind="stable")]


@dataclass
class Whitening:
    """Of ``n`` distinct vectors with sums ``sums``: eigenvalues and, as columns, the components."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x less the mean; the whole part first, so that nothing is lost to the size of the entries."""
        base, rest = self.sums // max(1, self.n), self.sums % max(1, self.n)
        return (x - base).astype(float) - rest / max(1, self.n)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """The sum over dimensions of (n x - sums)^2, exactly; OverflowError if it does not fit into a long."""
        far = self.n * float(np.abs(self.centred(x)).max(initial=0)) + 1
        if far * far * x.shape[1] < 2.0**62:
            rest = (x - self.sums // self.n) * self.n - self.sums % self.n
            return (rest * rest).sum(1)
        return np.array([sum((self.n * int(a) - int(s)) ** 2 for a, s in zip(row, self.sums)) for row in x], dtype=np.int64)


def integers(rows: DataFrame, vector: str, scale: int, shift: int) -> tuple[DataFrame, int]:
    """``rows`` with a usable vector, in an integer column ``x`` before the others, and its width.

    Vectors of another length than most (of equally frequent lengths the longer) take no part,
    nor do empty ones.
    """
    sound = rows.withColumn("x", whole(vector, scale)).where("x is not null and size(x) > 0")
    sound = stored(sound.withColumn("x", F.transform("x", lambda c: c + shift)).drop(vector), "integers")
    widths = sound.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n")).agg(F.max(F.struct("n", "width")).alias("most")).select("most.width").first()
    width = widths.width or 0
    return sound.where(F.size("x") == width), width


def fitted(distinct: DataFrame, width: int) -> Whitening:
    """The whitening of the vectors ``x``, none of which may repeat.

    The driver gets width * width sums; it holds a few matrices of that size.
    """
    n = distinct.count()
    sums = added(distinct, "x", width, lambda m: m.sum(0), width, np.int64)
    plain = Whitening(n, sums, np.ones(width), np.eye(width), 0.0)
    scatter = added(distinct, "x", width, lambda m: (c := plain.centred(m)).T @ c, width * width, np.float64).reshape(width, width)
    v = (scatter + scatter.T) / (2 * max(1, n))
    turned = jacobi(pivoted_cholesky(v))
    norms = (turned * turned).sum(0)
    return Whitening(n, sums, norms, turned / np.sqrt(norms), float(np.trace(v)))


def whitened(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS,
             scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) for each row with a
    usable vector and each of the first components.

    Rows whose vector is null, empty, or holds null or non-finite entries take no part, nor
    do those of another length than most. There are at most as many components as the
    distinct vectors have dimensions they vary in; without such, there are no rows. Repeated
    rows are fitted once and each appear in the result. Tied eigenvalues give some orthonormal
    components of their space. ``key`` may be null or repeat.
    """
    written, width = integers(rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("vector")), "vector", scale, shift)
    distinct = stored(written.groupBy("x").agg(F.lit(1)).select("x"), "distinct-vectors")
    model = fitted(distinct, width)
    k = min(components, len(model.values))
    model = Whitening(model.n, model.sums, model.values[:k], model.components[:, :k], model.trace)

    def moments(m: np.ndarray) -> np.ndarray:
        z = model.whitened(m)
        return np.append((z.T @ z).reshape(-1), z.sum(0))

    sums = added(distinct, "x", width, moments, k * k + k, np.float64) / max(1, model.n)
    error = float(np.abs(sums[:k * k].reshape(k, k) - np.outer(sums[k * k:], sums[k * k:]) - np.eye(k)).max(initial=0))
    explained = [float(e) / model.trace for e in model.values]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), width)
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * k, pa.array(model.whitened(x).reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(model.deviation(x)), lists], names=["key", "deviation", "z"])

    kind = written.schema["key"].dataType.simpleString()
    found = written.select("key", "x").mapInArrow(project, f"key {kind}, deviation bigint, z array<double>") if k else None
    if found is None:
        found = written.limit(0).select("key", F.lit(0).cast("long").alias("deviation"), F.array(F.lit(0.0)).alias("z"))
    long = found.select("key", "deviation", F.posexplode("z").alias("at", "whitened"))
    shares = F.array(*[F.lit(e) for e in explained or [0.0]])
    return long.select(F.col("key").alias(key), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                       shares[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"))
