"""Whitening of embeddings on exact integer cross-products, counted on bit planes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Staged

#: Entries that are this large after scaling, or larger, are held for non-finite.
LIMIT = 2.0**62


def scaled(table: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, x): x is floor(scale * entry) for each entry of a vector, as integers. Vectors that are null or empty, or hold
    null, non-finite or huge entries (LIMIT) are left out, and so are those of another length than the commonest (the
    greatest of equally common ones)."""
    entries = F.transform(F.col(vector_col), lambda c: c.cast("double") * scale)
    fine = F.forall(F.col("_x"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LIMIT))
    rows = table.select(F.col(id_col).alias("vec_id"), entries.alias("_x")).filter(F.col("_x").isNotNull() & (F.size("_x") > 0) & fine)
    size = rows.groupBy(F.size("_x").alias("d")).count().agg(F.max_by("d", F.struct("count", "d")).alias("d"))
    return rows.join(F.broadcast(size), F.size("_x") == F.col("d")).select("vec_id", F.transform("_x", lambda c: F.floor(c)).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def cross_products(vectors: DataFrame, low: list[int], bits: list[int]) -> DataFrame:
    """(i, j, total): exact sums of y_i * y_j over all vectors, i <= j, where y is x less the lowest value of its dimension.

    A batch's rows are scattered to planes: bit a of y_i over the rows, packed in words of 64. The sum of products is that of
    2**(a + b) times the ones in plane (i, a) AND plane (j, b). A task adds its batches up and gives a row a pair."""
    dims = len(low)
    owner = np.repeat(np.arange(dims), bits)
    weight = np.concatenate([np.arange(b) for b in bits]) if sum(bits) else np.zeros(0, np.int64)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], int] = {}
        counts = np.zeros((len(owner), len(owner)), np.int64)
        for batch in it:
            y = (_matrix(batch.column("x")) - np.array(low)).view(np.uint64)
            for lo in range(0, len(y), 1 << 14):
                part = y[lo : lo + (1 << 14)]
                words = (len(part) + 63) // 64
                planes = np.zeros((len(owner), words * 8), np.uint8)
                for p, (i, a) in enumerate(zip(owner, weight)):
                    packed = np.packbits((part[:, i] >> np.uint64(a) & np.uint64(1)).astype(np.uint8))
                    planes[p, : len(packed)] = packed
                planes = planes.view(np.uint64)
                for p in range(len(owner)):
                    counts[p, p:] += np.bitwise_count(planes[p] & planes[p:]).sum(axis=1, dtype=np.int64)
        for p, q in zip(*np.nonzero(counts)):
            i, j = int(owner[p]), int(owner[q])
            ones = int(counts[p, q]) << int(weight[p] + weight[q])
            total[i, j] = total.get((i, j), 0) + (ones if p == q or i != j else 2 * ones)
        if total:
            i, j = zip(*total)
            # Two parts that no sum of long integers over tasks overflows.
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array([v >> 40 * k & (1 << 40) - 1 for v in total.values()], pa.int64()) for k in range(4)]], ["i", "j", "p0", "p1", "p2", "p3"])

    parts = vectors.select("x").mapInArrow(run, "i int, j int, p0 long, p1 long, p2 long, p3 long")
    return parts.groupBy("i", "j").agg(*[F.sum(f"p{k}").alias(f"p{k}") for k in range(4)])


@dataclass(frozen=True)
class Whitening:
    """n distinct vectors with sums S by dimension; the first components by falling eigenvalue, a row each."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates. NaN for a component without variance (up to rounding)."""
        # (n x - S) / n, centred in integers where they fit, so that large means cost no digits.
        deviation = _deviations(x, self.n, self.sums).astype(np.float64) / self.n
        spread = np.where(self.flat, np.nan, np.sqrt(np.maximum(self.eigenvalues, 0)))
        return deviation @ self.components.T / spread

    @property
    def flat(self) -> np.ndarray:
        """Components whose eigenvalue is zero but for rounding."""
        return self.eigenvalues <= self.trace * len(self.sums) * np.finfo(float).eps


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exactly: as long integers where none overflows, else as Python's."""
    most = int(np.abs(x).max(initial=0)) * n + max(map(abs, sums), default=0)
    return x * n - np.array(sums) if most < 2**62 else x.astype(object) * n - np.array(sums, object)


def fit(vectors: DataFrame, components: int = 4) -> Whitening | None:
    """Of a list of distinct integer vectors (x); None for an empty list. Sums cross to the driver: a row a dimension, and
    one a pair of dimensions."""
    by_dim = vectors.select(F.posexplode("x").alias("i", "v")).groupBy("i")
    found = sorted(by_dim.agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("total")).collect())
    if not found:
        return None
    n, low, sums = found[0].n, [r.low for r in found], [int(r.total) for r in found]
    d, bits = len(found), [(r.high - r.low).bit_length() for r in found]
    y = [s - n * lo for s, lo in zip(sums, low)]
    products = np.zeros((d, d), object)
    for r in cross_products(vectors, low, bits).collect():
        products[r.i, r.j] = products[r.j, r.i] = sum(int(r[f"p{k}"]) << 40 * k for k in range(4))
    centred = [[n * int(products[i, j]) - y[i] * y[j] for j in range(d)] for i in range(d)]
    covariance = np.array([[c / (n * n) for c in row] for row in centred])
    values, columns = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    return Whitening(n, sums, columns[:, order].T.copy(), values[order], float(sum(centred[i][i] for i in range(d)) / (n * n)))


def identity_error(vectors: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened list's covariance less the identity, measured on its vectors, over components
    that have variance; None where none has."""
    kept = np.flatnonzero(~model.flat)
    if not len(kept):
        return None

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(kept) + 1, len(kept) + 1))
        for batch in it:
            white = np.column_stack([model.project(_matrix(batch.column("x")))[:, kept], np.ones(batch.num_rows)])
            total += white.T @ white
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], ["i", "j", "total"])

    sums = np.zeros((len(kept) + 1, len(kept) + 1))
    for r in vectors.select("x").mapInArrow(run, "i long, j long, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        sums[r.i, r.j] = r.total
    mean = sums[:-1, -1] / model.n  # zero but for rounding: projections are of centred vectors
    return float(np.abs(sums[:-1, :-1] / model.n - np.outer(mean, mean) - np.eye(len(kept))).max())


def whiten(table: DataFrame, components: int = 4, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each vector that takes part (see `scaled`) and
    component, numbered from 1 by falling variance. The model is fitted on each distinct scaled vector once, so copies, even
    a third of all rows, weigh nothing; every row, repeated ids and null ids too, gets its own results.

    `deviation` is the sum of (n * x - S)**2 over dimensions, null where a long integer can't hold it. `whitened` is null
    for a component without variance, as with one distinct vector, and `explained` then 0 (null where nothing varies);
    `identity_error` is over the others. With fewer dimensions than components there are as many as dimensions. An empty
    table gives no rows. Extra columns are not read."""
    spark = table.sparkSession
    staged = Staged(spark, "whitening")
    schema = f"vec_id {table.schema[id_col].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = staged.write("rows", scaled(table, id_col, vector_col, scale))
    distinct = staged.write("distinct", rows.select("x").distinct())
    model = fit(distinct, components)
    if model is None:
        return spark.createDataFrame([], schema)
    error = identity_error(distinct, model)
    staged.drop("distinct")
    explained = model.eigenvalues / model.trace if model.trace else np.full(len(model.eigenvalues), np.nan)
    explained = np.where(model.flat & (model.trace > 0), 0.0, explained)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.eigenvalues)
        for batch in it:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"))
            from_mean = _deviations(x, model.n, model.sums)
            if from_mean.dtype == object or int(np.abs(from_mean).max()) ** 2 * x.shape[1] >= 2**63:
                exact = (from_mean.astype(object) ** 2).sum(axis=1)
                deviation = pa.array([int(v) if v < 2**63 else None for v in exact], pa.int64())
            else:
                deviation = pa.array((from_mean**2).sum(axis=1))
            of = pa.array(np.repeat(np.arange(len(x)), k))
            white, n = model.project(x).ravel(), len(x) * k
            nan_null = lambda v: pa.array(v, pa.float64(), from_pandas=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(of), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(n, model.n)), deviation.take(of), nan_null(white), nan_null(np.tile(explained, len(x))), pa.array([error] * n, pa.float64())],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema)
