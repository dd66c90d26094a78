"""Embedding whitening by a compensated covariance and the eigenvectors of it.

Vectors are whole numbers, so sums are exact and the mean is known to twice the
digits of a double.  Each task adds the outer products of its centred vectors
as pairs of doubles: error-free transformations give what every product and
every sum loses, and that is added to the low parts.  High and low parts of the
tasks are merged the same way, piece of the triangle by piece.  The eigenvectors
come from LAPACK's reduction to tridiagonal form with divide and conquer, and
are then refined in extended precision against both parts of the covariance.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.llm.common import written
from tickweave.llm.vectors import matrix, padded, usable, whole

COMPONENTS = 4
#: Entries of the triangle that one merge takes, tasks' parts that are merged together first, numbers that a task handles at once.
PIECE, GROUPS, TOGETHER = 1024, 64, 1 << 17

Pair = tuple[np.ndarray, np.ndarray]


def two_sum(a: np.ndarray, b: np.ndarray) -> Pair:
    """a + b and what rounding took from it (Knuth)."""
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


def halves(a: np.ndarray) -> Pair:
    """a as a sum of two numbers of 26 bits (Veltkamp)."""
    c = a * 134217729.0
    high = c - (c - a)
    return high, a - high


def add_pairs(a: Pair, b: Pair) -> Pair:
    """The sum of two pairs, high part first."""
    s, r = two_sum(a[0], b[0])
    low = r + (a[1] + b[1])
    high = s + low
    return high, low - (high - s)


def added(high: np.ndarray, low: np.ndarray) -> Pair:
    """The sum over the first axis of pairs, as a tree."""
    while len(high) > 1:
        half = len(high) // 2
        rest = high[2 * half :], low[2 * half :]
        high, low = add_pairs((high[:half], low[:half]), (high[half : 2 * half], low[half : 2 * half]))
        if len(rest[0]):
            high, low = np.concatenate([high, rest[0]]), np.concatenate([low, rest[1]])
    return high[0], low[0]


def outer(high: np.ndarray, low: np.ndarray) -> Pair:
    """The sum of the outer products of rows given as pairs: the upper triangle, row by row, as a pair."""
    width = high.shape[1]
    i, j = np.triu_indices(width)
    total = np.zeros(len(i)), np.zeros(len(i))
    step = max(1, TOGETHER // len(i))
    for at in range(0, len(high), step):
        h, m = high[at : at + step], low[at : at + step]
        a, b = halves(h)
        p = h[:, i] * h[:, j]
        e = ((a[:, i] * a[:, j] - p) + a[:, i] * b[:, j] + b[:, i] * a[:, j]) + b[:, i] * b[:, j]  # Dekker
        e += h[:, i] * m[:, j] + m[:, i] * h[:, j]
        total = add_pairs(total, added(p, e))
    return total


def centred(x: np.ndarray, mean: Pair) -> Pair:
    """Whole numbers less a mean of two doubles, as pairs."""
    s, r = two_sum(x.astype(np.float64), -mean[0])
    low = r - mean[1]
    high = s + low
    return high, low - (high - s)


def covariance(rows: DataFrame, pairs: Callable[[pa.RecordBatch], Pair], width: int, n: int) -> np.ndarray:
    """The sum over rows of the outer products of what ``pairs`` makes of a batch, over n, in extended precision.

    A task keeps one triangle whatever it reads; pieces of the tasks' triangles
    are merged in two steps, so no group grows with all tasks; the driver gets
    one triangle.
    """
    schema = T.StructType([T.StructField("piece", T.IntegerType()), T.StructField("part", T.IntegerType())] + [T.StructField(c, T.BinaryType()) for c in ("high", "low")])
    size = width * (width + 1) // 2

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = outer(*pairs(batch))
                total = found if total is None else add_pairs(total, found)
        if total is None:
            return
        part = TaskContext.get().partitionId() % GROUPS
        for k, at in enumerate(range(0, size, PIECE)):
            high, low = (x[at : at + PIECE].tobytes() for x in total)
            yield pa.record_batch([pa.array([k], pa.int32()), pa.array([part], pa.int32()), pa.array([high]), pa.array([low])], schema.names)

    def merge(table: pa.Table) -> pa.Table:
        high, low = (np.stack([np.frombuffer(x, np.float64) for x in table.column(c).to_pylist()]) for c in ("high", "low"))
        order = np.lexsort(high[:, :1].T)  # whichever task came first
        h, m = added(high[order], low[order])
        return pa.table([table.column("piece")[:1], table.column("part")[:1], pa.array([h.tobytes()]), pa.array([m.tobytes()])], schema.names)

    merged = rows.mapInArrow(task, schema).groupBy("piece", "part").applyInArrow(merge, schema).groupBy("piece").applyInArrow(merge, schema)
    found = merged.orderBy("piece").collect()
    high, low = (np.frombuffer(b"".join(bytes(r[c]) for r in found), np.float64) for c in ("high", "low"))
    out = np.zeros((width, width), np.longdouble)
    i, j = np.triu_indices(width)
    out[i, j] = out[j, i] = (high.astype(np.longdouble) + low) / n
    return out


def eigen(v: np.ndarray, steps: int = 3) -> Pair:
    """Eigenvalues, falling, and unit eigenvectors as columns, refined (Ogita and Aishima) where eigenvalues lie apart."""
    _, x = np.linalg.eigh(v.astype(np.float64))
    x = x[:, ::-1].astype(np.longdouble)
    norm = np.abs(v).sum(1).max()
    for _ in range(steps):
        r = np.eye(len(v), dtype=np.longdouble) - x.T @ x
        s = x.T @ v @ x
        s = (s + s.T) / 2  # else rounding would turn near eigenvectors out of their right angles
        e = np.diag(s) / (1 - np.diag(r))
        apart = e[None, :] - e[:, None]
        near = np.abs(apart) <= 2 * (np.abs(s - np.diag(e)).max() + norm * np.abs(r).max())
        x = x + x @ np.where(near, r / 2, (s + e[None, :] * r) / np.where(near, 1, apart))
    x = x / np.sqrt((x * x).sum(0))
    e = ((v @ x) * x).sum(0)
    order = np.argsort(-e, kind="stable")
    x = x[:, order]
    return e[order], x * np.where(x[np.abs(x).argmax(0), np.arange(len(v))] < 0, -1, 1)


@dataclass(frozen=True)
class Whitening:
    """n and exact sums of the distinct vectors, eigenvalues and eigenvectors of their covariance."""

    n: int
    sums: list[int]
    largest: int
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def width(self) -> int:
        return len(self.sums)

    @property
    def known(self) -> np.ndarray:
        """Which of the components have variance, beyond what rounding makes of none."""
        return self.values > max(self.trace, 0) * 2.0**-48 if self.trace > 0 else np.zeros(len(self.values), bool)

    def differences(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: 64-bit integers, or Python's where these would not do."""
        if self.n * self.largest + max(map(abs, self.sums)) < 2**63:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Rows projected on the components with variance, over the root of their eigenvalues."""
        k = self.known
        return (self.differences(x).astype(np.float64) / self.n) @ self.vectors[:, k] / np.sqrt(self.values[k])

    def deviations(self, x: np.ndarray) -> list[int]:
        d = self.differences(x)
        if d.dtype == object or self.width * (self.n * self.largest + max(map(abs, self.sums))) ** 2 >= 2**63:
            d = d.astype(object)
        return (d * d).sum(1).tolist()


def totals(rows: DataFrame, width: int) -> tuple[int, list[int], int]:
    """The number of rows (x), their exact sums and their largest absolute entry; one row of numbers for each task."""
    schema = "n long, largest long, high array<long>, low array<long>"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, largest, high, low = 0, 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
        for batch in batches:
            x = matrix(batch.column("x"), width)
            n += len(x)
            largest = max(largest, int(np.abs(x).max(initial=0)))
            high += (x >> 26).sum(0)
            low += (x & (2**26 - 1)).sum(0)
        if n:
            yield pa.record_batch([pa.array([n]), pa.array([largest]), pa.array([high]), pa.array([low])], ["n", "largest", "high", "low"])

    parts = rows.select("x").mapInArrow(task, schema)
    each = parts.select("n", "largest", F.posexplode(F.arrays_zip("high", "low")).alias("at", "s"))
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    found = each.groupBy("at").agg(F.sum("n").alias("n"), F.max("largest").alias("largest"), total("s.high").alias("high"), total("s.low").alias("low")).orderBy("at").collect()
    return found[0].n, [int(r.high) * 2**26 + int(r.low) for r in found], found[0].largest


def fit(distinct: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    """Sums, covariance and eigenvectors of rows (x) of one length; the driver gets one triangle of width squared over two pairs."""
    n, sums, largest = totals(distinct, width)
    mean = np.array([s / n for s in sums])
    rest = np.array([float(Fraction(s, n) - Fraction(m)) for s, m in zip(sums, mean.tolist(), strict=True)])
    v = covariance(distinct.select("x"), lambda b: centred(matrix(b.column("x"), width), (mean, rest)), width, n)
    values, vectors = eigen(v)
    k = min(components, width)
    return Whitening(n, sums, largest, values[:k].astype(np.float64), vectors[:, :k].astype(np.float64), float(np.trace(v)))


def identity_error(distinct: DataFrame, model: Whitening) -> float | None:
    """The largest absolute entry of the whitened rows' covariance less the identity; their mean is 0 as that of n x - S is."""
    k = int(model.known.sum())
    if not k:
        return None

    def pairs(batch: pa.RecordBatch) -> Pair:
        w = model.whiten(matrix(batch.column("x"), model.width))
        return w, np.zeros_like(w)

    return float(np.abs(covariance(distinct.select("x"), pairs, k, model.n) - np.eye(k)).max())


FIELDS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("deviation", T.DecimalType(38, 0)),
        T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()),
        T.StructField("identity_error", T.DoubleType()),
    ]
)


def whiten(df: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Each usable row's whitened components, numbered from 1 by falling eigenvalue; see FIELDS.

    Rows whose vector is null or holds null or non-finite entries are dropped;
    entries become whole numbers x.  Model and covariance are those of the
    distinct x, so copies count once; every row, copies and rows without an id
    too, is returned.  Vectors shorter than the longest count as if they ended
    in zeros.  A component without variance has no whitened value, and takes no
    part in identity_error; no usable rows, or only empty vectors, give no rows.
    """
    spark = df.sparkSession
    rows = usable(df).select("vec_id", whole().alias("x"))
    low, width = rows.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if not width:
        return spark.createDataFrame([], FIELDS)
    if low < width:
        rows = rows.withColumn("x", padded("x", width))
    distinct = written(rows.select("x").distinct(), "vectors")
    model = fit(distinct, width, components)
    error = identity_error(distinct, model)
    explained = model.values / model.trace if model.trace > 0 else [None] * len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, known = len(model.values), model.known
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, 2048):
                batch = whole_batch.slice(at, 2048)
                x, size = matrix(batch.column("x"), width), batch.num_rows
                w = np.full((size, c), np.nan)
                w[:, known] = model.whiten(x)
                deviation = pa.array(model.deviations(x), pa.decimal128(38, 0))
                each = pa.array(np.repeat(np.arange(size), c))
                yield pa.record_batch(
                    [
                        batch.column("vec_id").take(each), pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), size)), pa.array(np.full(size * c, model.n)),
                        deviation.take(each), pa.array(w.ravel(), mask=np.tile(~known, size)), pa.array(list(explained) * size, pa.float64()), pa.array([error] * (size * c), pa.float64()),
                    ],
                    FIELDS.names,
                )

    return rows.mapInArrow(run, FIELDS)
