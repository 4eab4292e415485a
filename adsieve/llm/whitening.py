"""Embedding whitening by a covariance in two passes.

The first pass sums integer components exactly: each task splits them in halves of 32 bits, whose sums
stay far below 64 bits, and the tasks' sums meet as integers of any size. They give the mean as a whole
number and a remainder. The second pass subtracts it before multiplying and sums the outer products of
each batch by one GEMM; ``treeAggregate`` merges the tasks' matrices. LAPACK's symmetric solver gives
the components, which are broadcast for the projection; a last pass over the projected vectors measures
how far their covariance is from the identity. What a task holds is a batch and a matrix of dimension
times dimension, whatever the number of vectors.

Defined results: rows whose vector is null or empty, or holds null or non-finite entries, give no row; nor do
vectors of another length than the most frequent one (the longer of two). Repeated rows, and rows with a null id,
count and give rows each by itself. An integer component beyond 2 ** 61 in size is taken as that. ``deviation`` is
null where it needs more than 63 bits. Components without spread (eigenvalue at most ``dimension * eps`` of the
largest, such as for one vector, or equal ones) have a null ``whitened`` and take no part in ``identity_error``,
which is null if no component has spread; ``explained`` is null if the trace is zero. Equal eigenvalues come in any
order. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
FAR = 1 << 61
HALF = 32


def complete(vector: Column) -> Column:
    """Whether a vector is neither null nor empty, and all its entries are finite."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def whole_numbers(vectors: np.ndarray, scale: float, shift: int) -> np.ndarray:
    """floor(scale * c) + shift as 64-bit integers."""
    return np.clip(np.floor(scale * vectors), -float(FAR), float(FAR)).astype(np.int64) + shift


def _matrices(batches: Iterator[pa.RecordBatch], scale: float, shift: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of at most 4,096 vectors, and their integer components row by row."""
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            entries = part.column("x").flatten().to_numpy(zero_copy_only=False)
            yield part, whole_numbers(entries.reshape(part.num_rows, -1), scale, shift)


class Centre:
    """The mean of ``n`` integer vectors with the exact sums ``sums``: a whole number and a remainder below ``n``."""

    def __init__(self, n: int, sums: list[int]) -> None:
        self.n = n
        self.whole, self.rest = np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums over dimensions of (n * x - sum) ** 2, exactly; None where that takes more than 63 bits."""
        apart = x - self.whole
        if len(x) and x.shape[1] * (self.n * (int(np.abs(apart).max()) + 1)) ** 2 < 1 << 63:
            return ((self.n * apart - self.rest) ** 2).sum(axis=1).tolist()
        exact = ((self.n * apart.astype(object) - self.rest.astype(object)) ** 2).sum(axis=1)
        return [int(d) if d < 1 << 63 else None for d in exact]


def _sums(scale: float, shift: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, 0, 0
        for _, x in _matrices(batches, scale, shift):
            n, high, low = n + len(x), high + (x >> HALF).sum(axis=0), low + (x & ((1 << HALF) - 1)).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_pydict({"n": [n], "high": [high.tolist()], "low": [low.tolist()]})

    return run


def _products(centre, scale: float, shift: int, projection=None):
    """One row a task: the sum of its vectors' outer products, centred and, if given, projected, and of the vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, total = 0, 0
        for _, x in _matrices(batches, scale, shift):
            y = centre.value.centred(x)
            y = y if projection is None else y @ projection.value
            products, total = products + y.T @ y, total + y.sum(axis=0)
        if not isinstance(products, int):
            yield pa.RecordBatch.from_pydict({"products": [products.tobytes()], "total": [total.tobytes()]})

    return run


def _covariance(rows: DataFrame, task, n: int, size: int) -> np.ndarray:
    """The tasks' sums merged as a tree, so the driver reads a few matrices however many tasks there are."""
    parts = rows.mapInArrow(task, "products binary, total binary").rdd
    nothing = (np.zeros((size, size)), np.zeros(size))

    def add(have, row):
        return have[0] + np.frombuffer(row["products"]).reshape(size, size), have[1] + np.frombuffer(row["total"])

    products, total = parts.treeAggregate(nothing, add, lambda a, b: (a[0] + b[0], a[1] + b[1]))
    return products / n - np.outer(total / n, total / n)  # the rest of centring, which rounding has left


def components(covariance: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues that fall, their unit vectors in columns (largest entry positive), and which of them have spread."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1][:count], vectors[:, ::-1][:, :count]
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.where(vectors[largest, np.arange(vectors.shape[1])] < 0, -1, 1)
    return values, vectors, values > len(covariance) * np.finfo(float).eps * max(values[0], 0)


def _project(centre, projection, spread: np.ndarray, explained: list, error: float | None, scale: float, shift: int):
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _matrices(batches, scale, shift):
            c, (m, k) = centre.value, (len(x), len(spread))
            whitened = np.full((m, k), np.nan)
            whitened[:, spread] = c.centred(x) @ projection.value
            each = np.repeat(np.arange(m), k)
            columns = [
                part.column("vec_id").take(pa.array(each)), np.tile(np.arange(1, k + 1, dtype=np.int32), m), np.full(m * k, c.n), pa.array(c.deviations(x), pa.int64()).take(pa.array(each)),
                pa.array(whitened.ravel(), mask=np.tile(~spread, m)), pa.array(explained * m, pa.float64()), pa.array([error] * (m * k), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], schema=schema)

    return run


def whiten(vectors: DataFrame, count: int = 32, scale: float = 64.0, shift: int = 1_000_000, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """WHITENED: a row for each complete vector and each of the first ``count`` principal components."""
    spark = vectors.sparkSession
    context = spark.sparkContext
    x = F.col(f"`{vector_column}`")
    whole = vectors.where(complete(x)).select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), x.cast("array<double>").alias("x"))
    usual = whole.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if usual is None:
        return spark.createDataFrame([], WHITENED)
    size = usual["size"]
    rows = whole.where(F.size("x") == size)
    parts = rows.mapInArrow(_sums(scale, shift), "n long, high array<long>, low array<long>").rdd
    exact = parts.map(lambda r: (r["n"], [(h << HALF) + l for h, l in zip(r["high"], r["low"])]))
    n, sums = exact.treeReduce(lambda a, b: (a[0] + b[0], [s + t for s, t in zip(a[1], b[1])]))
    centre = context.broadcast(Centre(n, sums))
    covariance = _covariance(rows, _products(centre, scale, shift), n, size)
    values, axes, spread = components(covariance, count)
    projection = context.broadcast(axes[:, spread] / np.sqrt(values[spread]))
    error = None
    if spread.any():
        measured = _covariance(rows, _products(centre, scale, shift, projection), n, int(spread.sum()))
        error = float(np.abs(measured - np.eye(len(measured))).max())
    trace = float(np.trace(covariance))
    explained = [float(v) / trace if trace > 0 else None for v in np.maximum(values, 0)]
    return rows.mapInArrow(_project(centre, projection, spread, explained, error, scale, shift), WHITENED)
