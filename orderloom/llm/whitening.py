"""Whitening of embeddings: pivoted Cholesky of the centred scatter, one-sided Jacobi on its factor.

The entries of a vector become the integers floor(256 c). The fit list holds every distinct integer
vector once; its sums are exact, the scatter is summed in the tasks after centring, and only the
sums (one number a dimension) and the scatter (one number a pair of dimensions) reach the driver.
There the covariance V becomes P^T L L^T P with the largest remaining diagonal entry as next pivot;
columns end where nothing above rounding is left, so a flat direction gives no component. Jacobi
rotations from the right make the columns of the factor orthogonal: L J = U S, so the squared norms
of the columns are the eigenvalues of V and the normalised columns its eigenvectors. V itself is
never rotated or squared, which keeps small eigenvalues accurate. Components are numbered by falling
eigenvalue; the largest entry of each is positive.

A vector that is null or holds a null, NaN or infinity is dropped. The length that most vectors have
(of equally frequent ones the larger) is the dimension; vectors of other lengths and empty ones are
dropped too. An integer beyond a long becomes the nearest long; a deviation beyond a long is null.
A null vec_id is kept, repeated rows repeat their result and weigh no more than one, an empty table
or one distinct vector alone gives no components and no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import map_arrow, pick, written

SCALE = 256
_WIDE = 1 << 62


@dataclass(frozen=True)
class Whitening:
    """Exact count and sums of the fit list; eigenvectors (columns) and eigenvalues of V."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    values: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: the integer part is taken off exactly, the remainder as a fraction."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        if _within(x, _WIDE) and _within(whole, _WIDE):
            return (x - whole).astype(np.float64) - rest
        return x.astype(np.float64) - (whole.astype(np.float64) + rest)

    def whitened(self, x: np.ndarray, count: int) -> np.ndarray:
        return self.centred(x) @ (self.components[:, :count] / np.sqrt(self.values[:count]))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n x - S)^2 of every row, exact; null beyond a long."""
        whole = [s // self.n for s in self.sums]
        rest = [s % self.n for s in self.sums]
        if _within(x, _WIDE) and all(abs(w) < _WIDE for w in whole):
            off = x - np.array(whole, np.int64)
            far = int(max(off.max(initial=0), -off.min(initial=0))) + 1
            if len(whole) * (self.n * far) ** 2 < _WIDE:
                return ((off * self.n - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * v - s) ** 2 for v, s in zip(r, self.sums, strict=True)) for r in x.tolist()]
        return [e if e < 1 << 63 else None for e in exact]


def _within(x: np.ndarray, bound: int) -> bool:
    return -bound < x.min(initial=0) and x.max(initial=0) < bound


def vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and x (integers) of the rows that count, all of one length."""
    rows = pick(embeddings, "vec_id", "embedding")
    real = F.forall("embedding", lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    # NaN is larger than any number in Spark
    rows = rows.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & real)
    lengths = rows.groupBy(F.size("embedding").alias("d")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    rows = rows.where(F.size("embedding") == (most["d"] if most else 0))
    return rows.select("vec_id", F.transform("embedding", lambda c: F.floor(c.cast("double") * scale)).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, None
        for batch in batches:
            x = _matrix(batch.column(0))
            if not len(x):
                continue
            part = x.sum(axis=0) if _within(x, _WIDE // len(x)) else x.astype(object).sum(axis=0)
            n, sums = n + len(x), [int(a) + int(b) for a, b in zip(sums or [0] * len(part), part, strict=True)]
        if n:
            arrays = [pa.array(range(len(sums)), pa.int32()), pa.array([n] * len(sums), pa.int64())]
            arrays.append(pa.array(sums, pa.decimal128(38, 0)))
            yield pa.RecordBatch.from_arrays(arrays, names=["dim", "n", "s"])

    parts = map_arrow(fit, run, T.StructType.fromDDL("dim int, n bigint, s decimal(38,0)"))
    found = parts.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("dim").collect()
    return (found[0]["n"] if found else 0), [int(r["s"]) for r in found]


def _products(fit: DataFrame, rows_of, width: int) -> np.ndarray:
    """The sum over the fit list of r^T r, where rows_of turns integer rows into r."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            r = rows_of(_matrix(batch.column(0)))
            total += r.T @ r
        arrays = [pa.array(range(width), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["i", "v"])

    parts = map_arrow(fit, run, T.StructType.fromDDL("i int, v array<double>"))
    cells = parts.select("i", F.posexplode("v").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((width, width))
    for r in cells.collect():
        out[r["i"], r["j"]] = r["v"]
    return out


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """L with L L^T = v; in the order of the pivots its rows are lower triangular.

    It has a column for every pivot that stands out of the rounding of its own diagonal entry.
    """
    d = len(v)
    whole = np.diag(v).copy()
    left, noise = whole.copy(), 8 * d * np.finfo(float).eps * whole
    factor, open_rows = np.zeros((d, d)), np.ones(d, bool)
    for k in range(d):
        live = open_rows & (left > noise)
        if not live.any():
            return factor[:, :k]
        j = int(np.argmax(np.where(live, left, -np.inf)))
        column = (v[:, j] - factor[:, :k] @ factor[j, :k]) / np.sqrt(left[j])
        column[~open_rows] = 0
        column[j] = np.sqrt(left[j])
        factor[:, k] = column
        left -= column**2
        open_rows[j] = False
    return factor


def _rounds(r: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of r columns in rounds of disjoint ones, as in a tournament."""
    even = r + r % 2
    ring = np.arange(even)
    for _ in range(even - 1):
        one, two = ring[: even // 2], ring[even // 2 :][::-1]
        real = (one < r) & (two < r)
        yield one[real], two[real]
        ring = np.concatenate([ring[:1], ring[-1:], ring[1:-1]])


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Unit left singular vectors (columns) and squared singular values, falling."""
    w = np.ascontiguousarray(factor.T)
    r = len(w)
    small = 4 * np.finfo(float).eps * np.sqrt(max(1, factor.shape[0]))
    for _ in range(sweeps):
        turned = False
        for p, q in _rounds(r):
            a, b = (w[p] ** 2).sum(axis=1), (w[q] ** 2).sum(axis=1)
            g = (w[p] * w[q]).sum(axis=1)
            far = np.abs(g) > small * np.sqrt(a * b)
            if not far.any():
                continue
            turned = True
            p, q, a, b, g = p[far], q[far], a[far], b[far], g[far]
            zeta = (b - a) / (2 * g)
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            c = (1 / np.hypot(1, t))[:, None]
            s = c * t[:, None]
            w[p], w[q] = c * w[p] - s * w[q], s * w[p] + c * w[q]
        if not turned:
            break
    values = (w**2).sum(axis=1)
    order = np.argsort(-values, kind="stable")
    unit = w[order] / np.sqrt(values[order])[:, None]
    if r:
        signs = np.sign(unit[np.arange(r), np.abs(unit).argmax(axis=1)])
        unit = unit * signs[:, None]
    return unit.T, values[order]


def fit(distinct: DataFrame) -> Whitening | None:
    """The whitening of a fit list (x); none where it is empty."""
    n, sums = _sums(distinct)
    if not n:
        return None
    d = len(sums)
    plain = Whitening(n, tuple(sums), np.zeros((d, 0)), np.zeros(0), 0.0)
    v = _products(distinct, plain.centred, d) / n
    v = (v + v.T) / 2
    components, values = one_sided_jacobi(pivoted_cholesky(v))
    return Whitening(n, tuple(sums), components, values, float(np.trace(v)))


def identity_error(distinct: DataFrame, model: Whitening, count: int) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity."""
    k = min(count, len(model.values))

    def rows_of(x: np.ndarray) -> np.ndarray:
        return np.hstack([model.whitened(x, k), np.ones((len(x), 1))])

    products = _products(distinct, rows_of, k + 1) / model.n
    mean = products[k, :k]
    return float(np.abs(products[:k, :k] - np.outer(mean, mean) - np.eye(k)).max(initial=0))


def whiten(embeddings: DataFrame, model: Whitening, count: int) -> DataFrame:
    """vec_id, deviation and whitened (array of up to count numbers) of every row that counts."""
    k = min(count, len(model.values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            arrays = [batch.column(0), pa.array(model.deviations(x), pa.int64())]
            arrays.append(pa.array(list(model.whitened(x, k)), pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "deviation", "whitened"])

    schema = T.StructType.fromDDL("vec_id bigint, deviation bigint, whitened array<double>")
    rows = vectors(embeddings).select(F.col("vec_id").cast("bigint"), "x")
    return map_arrow(rows, run, schema)


OUT = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
    "identity_error double"
)


def components(embeddings: DataFrame, count: int = 4) -> DataFrame:
    """A row for every vector and each of the first `count` components that vary."""
    spark = embeddings.sparkSession
    distinct = written(vectors(embeddings).select("x").distinct(), "fit-list")
    model = fit(distinct)
    if model is None or not len(model.values):
        return spark.createDataFrame([], OUT)
    shares = [float(v / model.trace) for v in model.values[:count]]
    error = identity_error(distinct, model, count)
    wide = whiten(embeddings, model, count)
    rows = wide.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(F.array(*map(F.lit, shares)), F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
