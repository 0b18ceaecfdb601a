"""Whitening of embeddings by their leading principal components.

An entry c counts as the whole number x = floor(1024 c) + 100000, so that counts, sums and deviations are exact. One pass adds up
the vectors of each batch, Spark sums those per dimension; a second pass multiplies vectors that are centred first, each task adds
up one matrix of its own, and Spark sums those per entry. What reaches the driver is a matrix of the vectors' dimension,
however many vectors there are.

There the matrix is made tridiagonal by Householder reflections, its largest eigenvalues are found by bisection on Sturm counts, and their
vectors by inverse iteration, orthogonal to those already found for eigenvalues close by, as such iterations all lean to the
same vector. The few components then travel to all tasks, which project their own rows; nothing is shuffled for that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, DoubleType, StructField, StructType

from ..storage import materialize

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Entries are dropped like infinite ones from this size of floor(1024 c) on.
LIMIT = 1 << 40
#: Eigenvalues closer than this part of the matrix norm are one cluster.
CLUSTER = 1e-3
EXACT = DecimalType(38, 0)


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """Diagonal, off-diagonal and the unit vectors of the reflections that make a symmetric matrix tridiagonal."""
    a, n = a.copy(), len(a)
    mirrors: list[np.ndarray | None] = []
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        size = np.linalg.norm(v)
        if not np.any(v[1:]):
            mirrors.append(None)
            continue
        v[0] += np.copysign(size, v[0])
        v /= np.linalg.norm(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] -= 2 * v * (v @ a[k + 1 :, k])
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def below(diag: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix are smaller than each of ``x``, by signs of the Sturm sequence."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    pivot = lambda q: np.where(np.abs(q) < tiny, -tiny, q)
    q = pivot(diag[0] - x)
    count = (q < 0).astype(np.int64)
    for d, e in zip(diag[1:], off):
        q = pivot(d - x - e * e / q)
        count += q < 0
    return count


def largest(diag: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection of the interval that Gershgorin's circles span."""
    around = np.abs(np.concatenate(([0.0], off))) + np.abs(np.concatenate((off, [0.0])))
    low, high = np.full(k, np.min(diag - around)), np.full(k, np.max(diag + around))
    margin = 4 * np.finfo(float).eps * max(abs(low[0]), abs(high[0])) + np.finfo(float).tiny
    low, high = low - margin, high + margin
    place = len(diag) - np.arange(k)  # the j-th largest has so many that aren't above it
    for _ in range(200):
        middle = (low + high) / 2
        if np.all((middle <= low) | (middle >= high)):
            break
        up = below(diag, off, middle) < place
        low, high = np.where(up, middle, low), np.where(up, high, middle)
    return (low + high) / 2


def _solve(diag: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray) -> np.ndarray:
    """x with (T - shift) x = b, by elimination with row exchanges; a pivot of zero is taken for a tiny one."""
    n, x = len(diag), b.copy()
    least = np.finfo(float).eps * (np.max(np.abs(diag)) + 2 * np.max(np.abs(off), initial=0.0)) or np.finfo(float).tiny
    d, u, v = diag - shift, np.append(off, 0.0), np.zeros(n)  # main diagonal and the two above
    for i in range(n - 1):
        under = off[i]
        if abs(under) > abs(d[i]):
            d[i], u[i], v[i], under, d[i + 1], u[i + 1] = under, d[i + 1], u[i + 1], d[i], u[i], v[i]
            x[i], x[i + 1] = x[i + 1], x[i]
        if abs(d[i]) < least:
            d[i] = least
        factor = under / d[i]
        d[i + 1] -= factor * u[i]
        u[i + 1] -= factor * v[i]
        x[i + 1] -= factor * x[i]
    if abs(d[-1]) < least:
        d[-1] = least
    for i in range(n - 1, -1, -1):
        ahead = (u[i] * x[i + 1] if i + 1 < n else 0.0) + (v[i] * x[i + 2] if i + 2 < n else 0.0)
        x[i] = (x[i] - ahead) / d[i]
        if abs(x[i]) > 1e150:
            x /= abs(x[i])
    return x


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as rows.

    An eigenvector's largest entry is positive. Of equal eigenvalues the vectors are some orthonormal basis.
    """
    diag, off, mirrors = tridiagonal(a)
    values = largest(diag, off, k)
    norm = np.max(np.abs(diag)) + 2 * np.max(np.abs(off), initial=0.0)
    rng, found = np.random.default_rng(0), []
    for j, value in enumerate(values):
        near = [z for z, other in zip(found, values) if abs(other - value) <= CLUSTER * norm]
        z = rng.standard_normal(len(diag))
        for _ in range(6):
            z = _solve(diag, off, value, z / np.linalg.norm(z))
            for _ in range(2):
                for other in near:
                    z -= (other @ z) / (other @ other) * other
        found.append(z / np.linalg.norm(z))
    vectors = np.array(found)
    for at, v in reversed(list(enumerate(mirrors))):
        if v is not None:
            vectors[:, at + 1 :] -= 2 * np.outer(vectors[:, at + 1 :] @ v, v)
    vectors *= np.sign(vectors[np.arange(k), np.argmax(np.abs(vectors), axis=1)])[:, None]
    return np.einsum("ki,ij,kj->k", vectors, a, vectors), vectors


def numbers(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows with ``width`` finite entries, and their whole numbers before the shift."""
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), -1))
    starts = np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
    rows = np.flatnonzero(lengths == width)
    values = np.asarray(pc.fill_null(column.flatten().cast(pa.float64()), np.nan))
    with np.errstate(all="ignore"):
        floors = np.floor(SCALE * values[starts[rows][:, None] + np.arange(width)])
        fine = (np.abs(floors) < LIMIT).all(axis=1)
    return rows[fine], floors[fine].astype(np.int64)


def _sums(vectors: DataFrame, column: str) -> DataFrame:
    """(width, dim, n, total, least, most), at most one row for each batch, width and dimension."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.asarray(pc.fill_null(pc.list_value_length(batch.column(0)), 0))
            for width in np.unique(lengths[lengths > 0]).tolist():
                _, x = numbers(batch.column(0), width)
                if len(x):
                    x = x + SHIFT
                    total = pa.array([Decimal(int(t)) for t in x.sum(axis=0)], pa.decimal128(38, 0))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([width] * width), pa.array(range(width)), pa.array([len(x)] * width), total, pa.array(x.min(axis=0)), pa.array(x.max(axis=0))],
                        ["width", "dim", "n", "total", "least", "most"])

    return vectors.select(column).mapInArrow(each, "width long, dim long, n long, total decimal(38,0), least long, most long")


def _gram(rows: DataFrame, width: int, centred: Callable[[pa.Array], np.ndarray]) -> np.ndarray:
    """The sum over all rows of the products of their centred entries; ``centred`` gives those of a batch's only column."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((width, width))
        for batch in batches:
            x = centred(batch.column(0))
            sums += x.T @ x
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(sums[i, j])], ["i", "j", "v"])

    out = np.zeros((width, width))
    # As many rows as half a matrix of the dimension has entries.
    for r in rows.mapInArrow(each, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


@dataclass(frozen=True)
class Whitening:
    """What a projection needs: the size of the fit list, the sums of its vectors, and its leading components."""

    n: int
    sums: tuple[int, ...]
    spread: int
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def width(self) -> int:
        return len(self.sums)

    def offsets(self, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """x - S // n, which is exact, and the remainders of S, for whole numbers before the shift."""
        return floors + (SHIFT - np.array([s // self.n for s in self.sums], np.int64)), np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, floors: np.ndarray) -> np.ndarray:
        """x - S / n."""
        whole, rest = self.offsets(floors)
        return whole - rest / self.n

    def deviations(self, floors: np.ndarray) -> list[int]:
        """The exact sum over the dimensions of (n x - S)^2, for each row."""
        whole, rest = self.offsets(floors)
        if self.width * self.spread * max(self.spread, self.n) >= 1 << 62:
            whole, rest = whole.astype(object), rest.astype(object)
        squares, mixed = (whole * whole).sum(axis=1), (whole * rest).sum(axis=1)
        rests = sum(int(r) * int(r) for r in rest)
        return [self.n * self.n * int(a) - 2 * self.n * int(b) + rests for a, b in zip(squares, mixed)]


def fit(vectors: DataFrame, column: str = "embedding", k: int = COMPONENTS) -> Whitening | None:
    """Fit on all rows with finite entries; None if there are none.

    Rows of another length than most have (the longer, if two lengths are as frequent) aren't among them. Components whose
    eigenvalue is zero as far as doubles can tell are left out, so fewer than ``k`` may come back.
    """
    sums = materialize(_sums(vectors, column), label="sums")
    most = sums.where("dim = 0").groupBy("width").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    if most is None:
        return None
    width = most["width"]
    own = sums.where(F.col("width") == width).groupBy("dim").agg(F.sum("total").alias("s"), F.min("least").alias("low"), F.max("most").alias("high"))
    rows = sorted(own.collect(), key=lambda r: r["dim"])  # one row per dimension
    n, spread = most["n"], 1 + max(r["high"] - r["low"] for r in rows)
    model = Whitening(n, tuple(int(r["s"]) for r in rows), spread, np.zeros(0), np.zeros((0, width)), 0.0)
    v = _gram(vectors.select(column), width, lambda c: model.centred(numbers(c, width)[1])) / n
    values, components = leading(v, min(k, width))
    real = values > width * np.finfo(float).eps * 8 * np.trace(v)
    return Whitening(n, model.sums, spread, values[real], components[real], float(np.trace(v)))


def transform(vectors: DataFrame, model: Whitening, column: str = "embedding", name: str = "whitening") -> DataFrame:
    """The rows of ``vectors`` that :func:`fit` counts, without ``column`` and with a struct column: ``deviation``, a decimal number, and
    ``whitened``, one double per component. A deviation beyond 38 digits is an error. A column called ``name`` is one, too.
    """
    if name in vectors.columns and name != column:
        raise ValueError(f"the table already has a column {name}")
    kept = [f for f in vectors.schema.fields if f.name != column]
    out = StructType([*kept, StructField(name, StructType([StructField("deviation", EXACT), StructField("whitened", ArrayType(DoubleType()))]))])
    project = (model.vectors / np.sqrt(model.values)[:, None]).T

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, floors = numbers(batch.column(len(kept)), model.width)
            w = model.centred(floors) @ project
            deviation = pa.array([Decimal(d) for d in model.deviations(floors)], pa.decimal128(38, 0))
            bounds = pa.array(np.arange(len(rows) + 1) * project.shape[1], pa.int32())
            both = pa.StructArray.from_arrays([deviation, pa.ListArray.from_arrays(bounds, pa.array(w.ravel()))], ["deviation", "whitened"])
            fewer = batch.take(pa.array(rows))
            schema = pa.schema([*list(batch.schema)[: len(kept)], pa.field(name, both.type)])
            yield pa.RecordBatch.from_arrays([*fewer.columns[: len(kept)], both], schema=schema)

    return vectors.select(*(F.col(f"`{f.name}`") for f in kept), F.col(f"`{column}`")).mapInArrow(each, out)


def identity_error(whitened: DataFrame, column: str, k: int) -> float:
    """The largest absolute entry of the covariance of ``column``, arrays of ``k`` doubles, minus the identity; measured on all rows."""
    means = whitened.agg(F.count("*").alias("n"), *(F.avg(F.col(column)[j]).alias(f"m{j}") for j in range(k))).first()
    if not means["n"] or not k:
        return 0.0
    centre = np.array([means[f"m{j}"] for j in range(k)])
    as_rows = lambda c: np.asarray(c.flatten()).reshape(-1, k) - centre
    return float(np.max(np.abs(_gram(whitened.select(column), k, as_rows) / means["n"] - np.eye(k))))


def report(embeddings: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null, empty, hold null or non-finite entries or have another length than most are left out; repeated rows
    count each. Where all vectors are equal, or there are none, no component has a variance and there are no rows. A
    deviation beyond the range of long, from some 10^9 vectors on, is an error rather than a wrong number.
    """
    rows = embeddings.select("vec_id", "embedding")
    model = fit(rows, k=k)
    shape = "vec_id, cast(pos + 1 as int) AS component, n, cast(w.deviation as long) AS deviation, whitened, explained, identity_error"
    if model is None or not len(model.values):
        none = embeddings.sparkSession.createDataFrame([], "pos int, n long, w struct<deviation: decimal(38,0)>, whitened double, explained double, identity_error double")
        return rows.select("vec_id").limit(0).join(none, F.lit(False), "left").selectExpr(*shape.split(", "))
    done = materialize(transform(rows, model, name="w"), label="whitened")
    error = identity_error(done.select(F.col("w.whitened").alias("whitened")), "whitened", len(model.values))
    shares = F.array(*(F.lit(float(e / model.trace)) for e in model.values))
    long = done.select("vec_id", "w", F.posexplode("w.whitened").alias("pos", "whitened"), F.lit(model.n).cast("long").alias("n"), F.lit(error).alias("identity_error"))
    return long.withColumn("explained", F.get(shares, F.col("pos"))).selectExpr(*shape.split(", "))
