"""Whitening of embeddings by principal components, with equal vectors worked on once.

Every component c becomes the integer floor(64 c) + 1,000,000. Equal integer vectors are grouped, with map-side combine, so a
vector that a third of all rows hold counts once from there on. Each distinct vector has a weight in the fit: one, or its
number of rows. Sums are exact integers; the covariance is a weighted product of the centred matrix with itself, block by
block in the tasks, and the partial products, one small matrix each, are added entry by entry in a shuffle. Only the
sums and the covariance of d and d x d numbers reach the driver, which takes the eigenvectors. Each distinct vector
is then projected once and joined back to its rows, hot vectors split.

Rows whose vector is NULL or holds NULL or non-finite components are left out, and so are empty vectors, which have no
components; vectors of different lengths are fitted apart. Ids may be NULL or repeat: every row has its own results. Directions
without variance have NULL for ``whitened`` and 0 for ``explained`` and do not count in ``identity_error``, which is NULL
if no direction has any. An empty table gives no rows. Only the named columns are read. A ``deviation`` that does not fit a long is NULL; a
component beyond 2^56 in size, whose integer hardly fits one, fails the job.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import sized_join
from ..sources.scratch import materialize
from .common import read

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
FLAT = 1e-12  # of the total variance: an eigenvalue below it is rounding, not variance
CHUNK = 4_096  # rows of one matrix product


class Model(NamedTuple):
    """The fit for vectors of one length: weight n, floor and remainder of the exact mean, components by falling variance."""

    n: int
    floor: np.ndarray
    rest: np.ndarray  # sum - n * floor, from 0 to n - 1
    axes: np.ndarray  # unit vectors in columns
    values: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floor).astype(float) - (self.rest / self.n).astype(float)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """NaN where a direction has no variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return self.centred(x) @ self.axes / np.where(self.values > 0, np.sqrt(np.maximum(self.values, 0)), np.nan)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The squared distance of n * x from the sum, in integers of any size where 64 bits might not do; None beyond a long."""
        away = x - self.floor
        widest = max(abs(int(away.max(initial=0))), abs(int(away.min(initial=0)))) + 1
        if (widest * self.n) ** 2 * x.shape[1] < 1 << 62:
            return ((self.n * away - self.rest.astype(np.int64)) ** 2).sum(1).tolist()
        exact = [sum((self.n * int(a) - int(r)) ** 2 for a, r in zip(row, self.rest)) for row in away]
        return [e if e < 1 << 63 else None for e in exact]


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows that take part."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    scaled = lambda c: F.floor(c.cast("double") * SCALE)
    # The double nearest the bounds of a long lies beyond the upper one; floor would stop there without an error.
    far = F.exists(v, lambda c: F.abs(c.cast("double") * SCALE) > 2.0**62)
    x = F.when(far, F.raise_error(F.lit("a component does not fit an integer")).cast("array<bigint>")).otherwise(F.transform(v, lambda c: scaled(c) + SHIFT))
    return vectors.filter(v.isNotNull() & (F.size(v) > 0)).filter(~bad).select(F.col(id_col).alias("vec_id"), x.alias("x"))


def _matrices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of every length: the rows it has in the batch, and their vectors as a matrix."""
    lists = batch.column(column)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    values, starts = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes) - sizes
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        for at in range(0, len(rows), CHUNK):
            part = rows[at : at + CHUNK]
            yield int(d), part, values[starts[part][:, None] + np.arange(d)]


def _sums(distinct: DataFrame, weight: str) -> dict[int, tuple[int, list[int]]]:
    """By length of the vectors: their weight and the weighted sum of every component, exactly."""
    one = F.posexplode("x").alias("i", "c")
    rows = distinct.select(F.size("x").alias("dims"), F.col(weight).alias("w"), one)
    term = F.col("w").cast("decimal(38,0)") * F.col("c").cast("decimal(19,0)")
    sums = rows.groupBy("dims", "i").agg(F.sum("w").alias("n"), F.sum(term.cast("decimal(38,0)")).alias("s"))
    out: dict[int, tuple[int, list[int]]] = {}
    for row in sums.orderBy("dims", "i").collect():  # one row per component, however many vectors there are
        out.setdefault(row.dims, (int(row.n), []))[1].append(int(row.s))
    return out


def _products(distinct: DataFrame, weight: str, centred) -> dict[int, np.ndarray]:
    """By length: the weighted sum of outer products of ``centred(dims, x)``; each task adds up its own rows first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            w = batch.column("w").to_numpy().astype(float)
            for d, rows, x in _matrices(batch, "x"):
                y = centred(d, x)
                total[d] = total.get(d, 0) + y.T @ (y * w[rows, None])
        for d, product in total.items():
            k = len(product)
            i, j = np.indices((k, k)).reshape(2, -1)
            columns = [pa.array(np.full(k * k, d), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(product.ravel())]
            yield pa.RecordBatch.from_arrays(columns, names=["dims", "i", "j", "p"])

    parts = distinct.select("x", F.col(weight).alias("w")).mapInArrow(run, "dims int, i int, j int, p double")
    found = parts.groupBy("dims", "i", "j").agg(F.sum("p").alias("p")).collect()
    out: dict[int, np.ndarray] = {}
    for d in {row.dims for row in found}:
        own = [row for row in found if row.dims == d]
        out[d] = np.zeros((1 + max(row.i for row in own),) * 2)
        for row in own:
            out[d][row.i, row.j] = row.p
    return out


def fit(distinct: DataFrame, weight: str, components: int = COMPONENTS) -> dict[int, Model]:
    """A model per length of the vectors in ``x``; ``weight`` names the column of their weights."""
    sums = _sums(distinct, weight)
    means = {d: (n, np.array([s // n for s in total]), np.array([s % n for s in total])) for d, (n, total) in sums.items()}
    bare = {d: Model(*mean, *[np.zeros(0)] * 3) for d, mean in means.items()}
    covariances = _products(distinct, weight, lambda d, x: bare[d].centred(x))
    models = {}
    for d, (n, floor, rest) in means.items():
        v = covariances[d] / n
        values, axes = np.linalg.eigh((v + v.T) / 2)
        values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
        total = float(np.trace(v))
        values = np.where(values > FLAT * total, values, 0.0)
        models[d] = Model(n, floor, rest, axes, values, values / total if total > 0 else values)
    return models


def identity_error(distinct: DataFrame, weight: str, models: dict[int, Model]) -> float | None:
    """The largest entry by which the covariance of the whitened fit list, all of it, differs from the identity."""
    live = {d: m.values > 0 for d, m in models.items()}
    means = _means_of_whitened(distinct, weight, models)
    products = _products(distinct, weight, lambda d, x: models[d].whitened(x)[:, live[d]] - means[d][live[d]])
    errors = [np.abs(p / models[d].n - np.eye(len(p))).max() for d, p in products.items() if len(p)]
    return float(max(errors)) if errors else None


def _means_of_whitened(distinct: DataFrame, weight: str, models: dict[int, Model]) -> dict[int, np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            w = batch.column("w").to_numpy().astype(float)
            for d, rows, x in _matrices(batch, "x"):
                total[d] = total.get(d, 0) + w[rows] @ np.nan_to_num(models[d].whitened(x))
        for d, sums in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * len(sums), pa.int32()), pa.array(range(len(sums)), pa.int32()), pa.array(sums)], names=["dims", "i", "s"])

    parts = distinct.select("x", F.col(weight).alias("w")).mapInArrow(run, "dims int, i int, s double")
    out = {d: np.zeros(len(m.values)) for d, m in models.items()}
    for row in parts.groupBy("dims", "i").agg(F.sum("s").alias("s")).collect():
        out[row.dims][row.i] = row.s / models[row.dims].n
    return out


def project(distinct: DataFrame, models: dict[int, Model]) -> DataFrame:
    """(x, n, deviation, parts): ``parts`` has whitened and explained of every component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = pa.struct([("component", pa.int32()), ("whitened", pa.float64()), ("explained", pa.float64())])
        for batch in batches:
            for d, rows, x in _matrices(batch, "x"):
                model, k = models[d], len(models[d].values)
                y = model.whitened(x).ravel()
                items = pa.StructArray.from_arrays(
                    [pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(y, from_pandas=True), pa.array(np.tile(model.explained, len(x)))],
                    fields=list(part),
                )
                offsets = pa.array(np.arange(0, len(y) + 1, k, dtype=np.int32))
                columns = [batch.column("x").take(pa.array(rows)), pa.array([model.n] * len(x), pa.int64()), pa.array(model.deviations(x), pa.int64()), pa.ListArray.from_arrays(offsets, items)]
                yield pa.RecordBatch.from_arrays(columns, names=["x", "n", "deviation", "parts"])

    return distinct.select("x").mapInArrow(run, "x array<bigint>, n bigint, deviation bigint, parts array<struct<component: int, whitened: double, explained: double>>")


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, weights: str = "one", id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Per row that takes part and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    ``weights`` is "one", so the fit sees every distinct vector once, or "counts", so it sees every row.
    """
    rows = materialize(integer_vectors(vectors, id_col, vector_col), "integer_vectors")
    distinct = rows.groupBy("x").agg(F.count("*").alias("counts")).withColumn("one", F.lit(1).cast("bigint"))
    distinct = materialize(distinct, "distinct_vectors")
    models = fit(distinct, weights, components)
    error = F.lit(identity_error(distinct, weights, models)).cast("double")
    projected = materialize(project(distinct, models), "whitened_vectors").withColumnRenamed("x", "_x")
    found = sized_join(rows, projected, [(F.col("x"), F.col("_x"))], "inner", spread=["vec_id"])
    return found.select("vec_id", "n", "deviation", F.inline("parts")).select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", error.alias("identity_error")
    )


def query(spark, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))
