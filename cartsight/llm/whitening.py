"""Whitening of embeddings by their leading principal components.

Entries become whole numbers x = floor(scale * c) + shift. Per dimension the sums S, and then the products of centred
entries, are added up in map tasks and combined by dimension (pairs). Entries are centred at the whole number r next to the
mean before they are multiplied, and the rest D = S - n*r is taken out exactly, so sums are whole numbers, do not depend on
the order of rows, and the covariance is rounded once.

The covariance, whose size is that of the dimensions squared and does not grow with rows, is solved on the driver:
Householder reflections to tridiagonal form, Sturm counts and bisection for the leading eigenvalues, inverse iteration
for the eigenvectors, those of a cluster made orthogonal to one another. Components are broadcast and applied in map tasks.

The rows are read five times (length, sums, products, check, result) and never shuffled or stored.

Cases: a vector that is null, or has a null, a NaN or an infinite entry, or one beyond 2**40 when scaled, has no result.
Vectors of another length than most have none either (equally many: the longer). Directions without variance (1e4 roundings of
the largest, at most) are no components: equal vectors, a single one and vectors of no entry give rows without components.
Null and repeated ids are kept as they are. A deviation that does not fit a long is null. Empty input gives no rows.
Input columns named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cartsight.llm.registry import query, table
from cartsight.llm.rows import packed, unpacked, without

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
LARGEST = float(1 << 40)
EXACT = 1 << 53  # whole numbers up to here are exact as doubles
RESULT = ("deviation", "whitened")


# --- eigenvectors of a symmetric matrix -----------------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal, and the unit vectors of the reflections, in order, the k-th on the entries after k."""
    a = matrix.astype(np.float64).copy()
    mirrors = []
    for k in range(len(a) - 2):
        x = a[k + 1 :, k]
        v = x.copy()
        v[0] += np.copysign(np.linalg.norm(x), x[0])
        size = np.linalg.norm(v)
        v = v / size if size else v
        mirrors.append(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        x -= 2 * (v @ x) * v
        a[k, k + 1 :] = x
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each of some numbers: the negative pivots of the shifted matrix."""
    squares = off * off
    least = max(1.0, squares.max(initial=0.0)) * np.finfo(float).tiny
    pivot = diagonal[0] - at
    pivot = np.where(np.abs(pivot) <= least, -least, pivot)
    below = (pivot < 0).astype(int)
    for d, s in zip(diagonal[1:], squares):
        pivot = d - at - s / pivot
        pivot = np.where(np.abs(pivot) <= least, -least, pivot)
        below += pivot < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, many: int) -> np.ndarray:
    """The largest eigenvalues, falling, by bisection of all of them at once."""
    n = len(diagonal)
    reach = np.zeros(n)
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    low = np.full(many, (diagonal - reach).min())
    high = np.full(many, (diagonal + reach).max())
    pad = np.finfo(float).eps * max(np.abs(low).max(), np.abs(high).max())
    low, high = low - pad, high + pad
    place = n - 1 - np.arange(many)  # eigenvalues below the k-th largest
    while True:
        middle = low + (high - low) / 2
        if not ((middle > low) & (middle < high)).any():
            return middle
        under = sturm_counts(diagonal, off, middle) <= place
        low, high = np.where(under, middle, low), np.where(under, high, middle)


def _solver(diagonal: np.ndarray, off: np.ndarray, shift: float, least: float) -> Callable[[np.ndarray], np.ndarray]:
    """Solves the shifted tridiagonal system; elimination with row exchanges, small pivots replaced."""
    n = len(diagonal)
    d, u = (diagonal - shift).tolist(), [*off.tolist(), 0.0]
    low, second = off.tolist(), [0.0] * n
    factor, swapped = [0.0] * n, [False] * n
    for i in range(n - 1):
        if abs(low[i]) > abs(d[i]):
            swapped[i] = True
            d[i], low_i = low[i], d[i]
            u[i], d[i + 1] = d[i + 1], u[i]
            second[i], u[i + 1] = u[i + 1], 0.0
        else:
            low_i = low[i]
        d[i] = d[i] if abs(d[i]) > least else least
        factor[i] = f = low_i / d[i]
        d[i + 1] -= f * u[i]
        u[i + 1] -= f * second[i]
    d[-1] = d[-1] if abs(d[-1]) > least else least

    def solve(right: np.ndarray) -> np.ndarray:
        b = right.tolist()
        for i in range(n - 1):
            if swapped[i]:
                b[i], b[i + 1] = b[i + 1], b[i]
            b[i + 1] -= factor[i] * b[i]
        for i in range(n - 1, -1, -1):
            rest = b[i]
            if i + 1 < n:
                rest -= u[i] * b[i + 1]
            if i + 2 < n:
                rest -= second[i] * b[i + 2]
            b[i] = rest / d[i]
        return np.array(b)

    return solve


def tridiagonal_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of falling eigenvalues, as columns, by inverse iteration inside clusters of near values."""
    norm = max(np.abs(diagonal).max(initial=0.0) + 2 * np.abs(off).max(initial=0.0), np.finfo(float).tiny)
    eps = np.finfo(float).eps
    out: list[np.ndarray] = []
    first, shift = 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * norm:
            first = k
        shift = min(value, shift - 10 * eps * norm) if k > first else value  # equal values get shifts of their own
        solve = _solver(diagonal, off, shift, eps * norm)
        x = np.random.default_rng(k).standard_normal(len(diagonal))
        for _ in range(5):
            for _ in range(2):  # the second time takes what rounding has left
                for other in out[first:]:
                    x = x - (other @ x) * other
            x = solve(x / np.linalg.norm(x))
            x /= np.linalg.norm(x)
        for _ in range(2):
            for other in out[first:]:
                x = x - (other @ x) * other
            x /= np.linalg.norm(x)
        out.append(x)
    return np.array(out).T.reshape(len(diagonal), len(values))


def leading_components(matrix: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix that stand out from rounding, falling, and their unit vectors as columns."""
    n = len(matrix)
    size = np.abs(matrix).max(initial=0.0)
    if not size:
        return np.zeros(0), np.zeros((n, 0))
    diagonal, off, mirrors = tridiagonal(matrix / size)
    values = leading_values(diagonal, off, min(many, n))
    values = values[values > 1e4 * n * np.finfo(float).eps * values[0]]
    vectors = tridiagonal_vectors(diagonal, off, values)
    for k in range(len(mirrors) - 1, -1, -1):
        v = mirrors[k]
        vectors[k + 1 :] -= 2 * np.outer(v, v @ vectors[k + 1 :])
    return values * size, vectors / np.linalg.norm(vectors, axis=0)


# --- passes over the rows -------------------------------------------------------------------------


def usable(df: DataFrame, embedding: str, scale: int) -> DataFrame:
    """Rows whose vector has only finite entries within the largest size."""
    value = F.col(f"`{embedding}`")
    fits = F.forall(value, lambda c: F.coalesce(F.abs(c.cast("double") * scale) < LARGEST, F.lit(False)))
    return df.where(value.isNotNull() & fits)


def _whole(column: pa.Array, dims: int, scale: int, shift: int) -> np.ndarray:
    c = np.asarray(column.flatten()).astype(np.float64).reshape(len(column), dims)
    return np.floor(scale * c).astype(np.int64) + shift


def _products(z: np.ndarray) -> np.ndarray:
    """Exact z'z of whole numbers, as Python integers."""
    largest = int(np.abs(z).max(initial=0))
    rows = EXACT // max(1, largest * largest)
    if not rows:
        z = z.astype(object)
        return z.T @ z
    total = np.zeros((z.shape[1], z.shape[1]), object)
    for i in range(0, len(z), rows):
        part = z[i : i + rows].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


@dataclass(frozen=True)
class Whitening:
    """What the passes have found: rows, sums per dimension, components (columns) and their shares of the variance."""

    dims: int
    scale: int
    shift: int
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray

    @property
    def centre(self) -> np.ndarray:
        """The whole numbers next to the means."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        return [s - self.n * int(r) for s, r in zip(self.sums, self.centre)]

    def whiten(self, z: np.ndarray) -> np.ndarray:
        """Centred whole entries to whitened values."""
        rest = np.array([d / self.n for d in self.rest])
        return ((z - rest) @ self.vectors) / np.sqrt(self.values)

    def deviations(self, z: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n*x - S)^2, exactly; null where it does not fit a long."""
        most = 2 * self.n * (int(np.abs(z).max(initial=0)) + 1)
        kind = np.int64 if most * most * self.dims < 1 << 63 else object
        away = z.astype(kind) * self.n - np.array(self.rest, kind)
        return [v if v < 1 << 63 else None for v in map(int, (away * away).sum(axis=1))]


def _summed(rows: DataFrame, embedding: str, run: Callable, schema: str, keys: Sequence[str]) -> list:
    """Partial sums of map tasks, added up by key; their number depends on the dimensions alone."""
    return rows.select(F.col(f"`{embedding}`").alias("v")).mapInArrow(run, schema).groupBy(*keys).agg(F.sum("s").alias("s")).collect()


def fit(df: DataFrame, embedding: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> Whitening | None:
    """The whitening of the usable rows of the usual length; none if there is no row."""
    rows = usable(df, embedding, scale)
    length = F.size(f"`{embedding}`")
    usual = rows.groupBy(length.alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    if usual is None:
        return None
    dims, n = usual["dims"], usual["n"]
    rows = rows.where(length == dims)
    whole = "decimal(38,0)"

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims, object)
        for batch in batches:
            total += _whole(batch.column(0), dims, scale, shift).sum(axis=0).astype(object)
        made = [pa.array(range(dims), pa.int32()), pa.array([Decimal(t) for t in total.tolist()], pa.decimal128(38, 0))]
        yield pa.RecordBatch.from_arrays(made, names=["i", "s"])

    found = {r["i"]: int(r["s"]) for r in _summed(rows, embedding, sums, f"i int, s {whole}", ["i"])}
    none = Whitening(dims, scale, shift, n, tuple(found[i] for i in range(dims)), np.zeros(0), np.zeros((dims, 0)), np.zeros(0))
    if not dims:
        return none
    centre, rest = none.centre, none.rest
    first, second = np.triu_indices(dims)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims), object)
        for batch in batches:
            total += _products(_whole(batch.column(0), dims, scale, shift) - centre)
        values = [Decimal(t) for t in total[first, second].tolist()]
        made = [pa.array(first, pa.int32()), pa.array(second, pa.int32()), pa.array(values, pa.decimal128(38, 0))]
        yield pa.RecordBatch.from_arrays(made, names=["i", "j", "s"])

    covariance = np.zeros((dims, dims))
    for i, j, s in _summed(rows, embedding, products, f"i int, j int, s {whole}", ["i", "j"]):
        covariance[i, j] = covariance[j, i] = (n * int(s) - rest[i] * rest[j]) / (n * n)  # of integers, rounded once
    values, vectors = leading_components(covariance, components)
    trace = float(np.trace(covariance))
    return Whitening(dims, scale, shift, n, none.sums, values, vectors, values / trace if trace else values)


def identity_error(df: DataFrame, model: Whitening, embedding: str = "embedding") -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity; 0 without components."""
    many = len(model.values)
    if not many:
        return 0.0
    sent = df.sparkSession.sparkContext.broadcast(model)
    first, second = np.triu_indices(many)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        sums, total = np.zeros(many), np.zeros((many, many))
        for batch in batches:
            w = model.whiten(_whole(batch.column(0), model.dims, model.scale, model.shift) - model.centre)
            sums += w.sum(axis=0)
            total += w.T @ w
        i = np.concatenate([first, np.full(many, -1)])
        j = np.concatenate([second, np.arange(many)])
        made = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.concatenate([total[first, second], sums]))]
        yield pa.RecordBatch.from_arrays(made, names=["i", "j", "s"])

    rows = usable(df, embedding, model.scale).where(F.size(f"`{embedding}`") == model.dims)
    found = {(i, j): s / model.n for i, j, s in _summed(rows, embedding, run, "i int, j int, s double", ["i", "j"])}
    return max(abs(found[i, j] - found[-1, i] * found[-1, j] - (i == j)) for i, j in zip(first.tolist(), second.tolist()))


def whiten(df: DataFrame, model: Whitening, embedding: str = "embedding", carry: Sequence[str] | None = None) -> DataFrame:
    """The carried columns (all, if not named) of usable rows with ``deviation`` and ``whitened``, one value per component."""
    names = [c for c in (df.columns if carry is None else carry) if c in without(df, RESULT).columns]
    rows = usable(df, embedding, model.scale).where(F.size(f"`{embedding}`") == model.dims)
    source = rows.select(packed(names), F.col(f"`{embedding}`").alias("_vector"))
    fields = [T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))]
    schema = T.StructType([source.schema[0], *fields])
    arrow = to_arrow_schema(schema)
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            z = _whole(batch.column(1), model.dims, model.scale, model.shift) - model.centre
            w = model.whiten(z)
            offsets = pa.array(np.arange(len(z) + 1) * w.shape[1], pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(w).reshape(-1)))
            made = [batch.column(0), pa.array(model.deviations(z), pa.int64()), lists.cast(arrow.types[2])]
            yield pa.RecordBatch.from_arrays(made, schema=arrow)

    return source.mapInArrow(run, schema).select(*unpacked(names), "deviation", "whitened")


OUTPUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector with its whitened value on each component."""
    vectors = table(spark, sf_dir, "embeddings")
    model = fit(vectors)
    if model is None or not len(model.values):
        return spark.createDataFrame([], OUTPUT)
    explained = F.array(*(F.lit(float(x)) for x in model.explained))
    return (
        whiten(vectors, model, carry=["vec_id"])
        .select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened"))
        .select(
            "vec_id",
            (F.col("_at") + 1).cast("int").alias("component"),
            F.lit(model.n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.element_at(explained, F.col("_at") + 1).alias("explained"),
            F.lit(identity_error(vectors, model)).alias("identity_error"),
        )
    )
