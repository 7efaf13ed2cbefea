"""Embedding whitening by the exact spectrum of the integer scatter.

Entries become integers, and all sums over rows are integers: the number of distinct vectors n, their sums S and the products' sums. From
them comes n * n times the covariance as an integer matrix. Its characteristic polynomial is found modulo primes, one task each, and put together on the
driver (see `spectrum`); both are bounded by the vectors' width, never by the rows. A second pass projects every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal, localcontext

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugeworks.llm import spectrum
from gaugeworks.llm.common import written

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Bits of a limb and rows of a product: their products' sums stay below 2**53, where doubles are exact.
LIMB_BITS, ROWS = 20, 4096
LONG = 2.0**62


def grid(vector: str = "embedding") -> Column:
    """The integer vector of a row: floor(64 * c) + 1000000 of each entry; null where the row takes no part."""
    c = F.col(vector)
    scaled = F.transform(c, lambda v: F.floor(v.cast("double") * SCALE))
    usable = c.isNotNull() & (F.size(c) > 0) & F.forall(c, lambda v: F.coalesce(F.abs(v.cast("double") * SCALE) < LONG, F.lit(False)))  # NaN is largest
    return F.when(usable, F.transform(scaled, lambda v: v.cast("long") + F.lit(OFFSET).cast("long")))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    """Signed integers as sums of limb * 2**(20 * k), each limb an exact double."""
    out = []
    while True:
        low = (y + (1 << LIMB_BITS - 1) & (1 << LIMB_BITS) - 1) - (1 << LIMB_BITS - 1)
        out.append(low.astype(float))
        y = y - low >> LIMB_BITS
        if not y.any():
            return out


def scatter_parts(y: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Exact sums and sums of products of integer rows."""
    d = y.shape[1]
    sums, products = np.zeros(d, object), np.zeros((d, d), object)
    for i in range(0, len(y), ROWS):
        limbs = _limbs(y[i : i + ROWS])
        for a, one in enumerate(limbs):
            sums += one.sum(axis=0).astype(np.int64).astype(object) << LIMB_BITS * a
            for b, two in enumerate(limbs):
                products += (one.T @ two).astype(np.int64).astype(object) << LIMB_BITS * (a + b)
    return sums.tolist(), products.tolist()


def _halves(value: int) -> tuple[int, int]:
    return int(value) >> 60, int(value) & (1 << 60) - 1


def _parts(width: int):  # noqa: ANN202
    """A row per sum and task: its place, and the number in two parts, so that no sum outgrows a decimal."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(width, object), np.zeros((width, width), object)
        for batch in batches:
            y = _matrix(batch.column(0), width) - OFFSET
            s, p = scatter_parts(y)
            n, sums, products = n + len(y), sums + np.array(s, object), products + np.array(p, object)
        upper = np.triu_indices(width)
        values = [n, *sums.tolist(), *products[upper].tolist()]
        halves = [pa.array([Decimal(x) for x in part], pa.decimal128(38, 0)) for part in zip(*(_halves(v) for v in values), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), *halves], names=["place", "high", "low"])

    return run


def _residues(matrix: list[list[int]]):  # noqa: ANN202
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            got = [spectrum.polynomial_modulo(np.array([[x % p for x in row] for row in matrix]), p) for p in frame["p"].tolist()]
            yield pd.DataFrame({"p": frame["p"], "residues": got})

    return run


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:  # noqa: ANN001
    """Integer coefficients, highest first, of a positive semidefinite integer matrix; a task per few primes."""
    primes = spectrum.primes_below(1 << 31, spectrum.coefficient_bits(matrix))
    tasks = spark.createDataFrame([(p,) for p in primes], "p long").repartition(min(len(primes), spark.sparkContext.defaultParallelism))
    got = tasks.mapInPandas(_residues(matrix), "p long, residues array<long>").collect()  # as many rows as primes, d + 1 numbers each
    return spectrum.by_remainders((r.p, list(r.residues)) for r in got)


class Whitening:
    """What a fit leaves: n, sums, components as rows, their eigenvalues and explained shares."""

    def __init__(self, n: int, sums: list[int], values: list[float], vectors: np.ndarray, explained: list[float]) -> None:
        self.n, self.sums, self.values, self.vectors, self.explained = n, sums, values, vectors, explained

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: long integers, or Python's where those might not hold the squares' sum."""
        shifted = [s - OFFSET * self.n for s in self.sums]
        y = x - OFFSET
        bound = max(int(np.abs(y).max(initial=0)), 1) * self.n + max(map(abs, shifted))
        if bound * bound * len(shifted) < 1 << 62:
            return y * self.n - np.array(shifted, np.int64)
        return y.astype(object) * self.n - np.array(shifted, object)

    def project(self, x: np.ndarray) -> tuple[list[int], np.ndarray]:
        """Squared distance of n * x from S, and the whitened coordinates."""
        c = self.centred(x)
        return (c * c).sum(axis=1).tolist(), (c / self.n).astype(float) @ self.vectors.T / np.sqrt(self.values)


def fit(distinct: DataFrame, width: int, count: int = COMPONENTS) -> Whitening | None:
    """Of distinct integer vectors (column x). None where there are none."""
    parts = distinct.select("x").mapInArrow(_parts(width), "place int, high decimal(38,0), low decimal(38,0)")
    sums_of = parts.groupBy("place").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).orderBy("place")
    total = [(int(r.high) << 60) + int(r.low) for r in sums_of.collect()]  # width squared numbers
    if not total or not total[0]:
        return None
    n, sums, upper = total[0], total[1 : width + 1], iter(total[width + 1 :])
    scatter = [[0] * width for _ in range(width)]
    for i in range(width):
        for j in range(i, width):
            scatter[i][j] = scatter[j][i] = n * next(upper) - sums[i] * sums[j]
    trace = sum(scatter[i][i] for i in range(width))
    values, vectors = spectrum.components(scatter, characteristic_polynomial(distinct.sparkSession, scatter), count)
    with localcontext() as c:
        c.prec = spectrum.DIGITS
        explained = [float(v / trace) for v in values]
        values = [float(v / n / n) for v in values]
    return Whitening(n, [s + OFFSET * n for s in sums], values, vectors, explained)


def _moments(model: Whitening, width: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, k = None, len(model.values)
        for batch in batches:
            _, z = model.project(_matrix(batch.column(0), width))
            part = np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(k + k * k), pa.int32()), pa.array(total)], names=["place", "value"])

    return run


def identity_error(distinct: DataFrame, model: Whitening, width: int) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity. Projections are centred before they are multiplied."""
    k = len(model.values)
    got = distinct.select("x").mapInArrow(_moments(model, width), "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    total = np.array([r.value for r in got.orderBy("place").collect()])
    mean, second = total[:k] / model.n, total[k:].reshape(k, k) / model.n
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whiten(rows: DataFrame, keep: str = "vec_id", vector: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """For each usable row and component: the kept column, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, empty, or holds an entry that is null, not finite or too large for a long integer take no part; neither do rows
    whose width is not the most frequent one (of equally frequent ones the larger). The fit takes each distinct integer vector
    once; repeated rows are projected each. Directions without variance are no components, so fewer than `count` may come back, and none where
    all vectors are equal or there are no rows. deviation is exact, as a decimal
    (null beyond 38 digits). Other columns are ignored.
    """
    schema = StructType.fromDDL("component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    gridded = rows.select(F.col(keep).alias("key"), grid(vector).alias("x")).where("x is not null")
    schema = StructType([rows.schema[keep], *schema.fields])
    spark = rows.sparkSession
    widths = gridded.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if widths is None:
        return spark.createDataFrame([], schema)
    width = widths["width"]
    used = gridded.where(F.size("x") == width)
    distinct = written(used.select("x").distinct(), "vectors")
    model = fit(distinct, width, count)
    if model is None or not model.values:
        return spark.createDataFrame([], schema)
    error, k = identity_error(distinct, model, width), len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 2048):
                batch = whole.slice(i, 2048)
                deviations, z = model.project(_matrix(batch.column("x"), width))
                m = len(deviations)
                at = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)),
                        pa.array([Decimal(int(v)) if v < 10**38 else None for v in deviations], pa.decimal128(38, 0)).take(at), pa.array(z.ravel()),
                        pa.array(np.tile(model.explained, m)), pa.array(np.full(m * k, error)),
                    ],
                    names=schema.names,
                )

    return used.mapInArrow(run, schema)
