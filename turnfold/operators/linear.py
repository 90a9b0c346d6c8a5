"""Logistic regression over linear features of short vectors (H1 behind F1, F4).

``pyspark.ml`` keeps the rows that a solver reads as dense blocks in memory and
on disk: 1.6 KB a row for 200 components, whatever the rows they came from.  Here
the solver reads the rows themselves, the values that are not zero only, and the
linear map to the components (scaler and PCA) is applied to sums, not to rows.

The objective is that of ``models.logistic``: mean log loss plus ``regParam / 2``
times the squared norm of the coefficients of the mapped features; the intercept
is free.  It is convex, and Newton steps need about ten passes.  A pass sums
gradient and curvature of a block of rows at a time; a task sends one matrix of
(width + 1)^2, and these are added up on executors by stripes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path, ship
from .flattrees import sigmoid

BLOCK_ROWS = 4096
STRIPES = 8
HALVINGS = 30


@dataclass
class LinearMap:
    """``(x - mean) * scale`` and then ``components`` (columns)."""
    mean: np.ndarray
    scale: np.ndarray
    components: np.ndarray

    @classmethod
    def of(cls, scaler, pca: PCAModel) -> LinearMap:
        """Of ``transform.fit_exact_scaler`` and ``transform.fit_pca``."""
        centre, scale = scaler.stages
        return cls(centre.mean.toArray(), scale.getScalingVec().toArray(), pca.pc.toArray())


def packed_rows(df: DataFrame, features_col: str, label_col: str) -> DataFrame:
    """``places, numbers, y``: a row's values that are not zero and where they
    stand, in binary, and its label; written to the shared folder once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(lo, BLOCK_ROWS)
                x = np.asarray(part.column(0).flatten(), dtype=float).reshape(part.num_rows, -1)
                row, place = np.nonzero(x)
                ends = np.append(0, np.cumsum(np.bincount(row, minlength=len(x))))
                columns = [pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer((ends * v.itemsize).astype(np.int32)), pa.py_buffer(v)])
                           for v in (place.astype(np.int32), np.ascontiguousarray(x[row, place]))]
                yield pa.RecordBatch.from_arrays([*columns, part.column(1)], ["places", "numbers", "y"])

    ship(df.sparkSession)
    rows = df.select(vector_to_array(features_col), F.col(label_col).cast("double")).mapInArrow(
        run, "places binary, numbers binary, y double")
    path = scratch_path(df.sparkSession, "packed-rows")
    rows.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def unpacked(part: pa.RecordBatch, width: int) -> np.ndarray:
    """The rows of ``packed_rows`` in full, rows x ``width``."""
    x, n = np.zeros((part.num_rows, width)), part.num_rows
    flat = []
    for column, kind in ((part.column(0), np.int32), (part.column(1), np.float64)):
        _, ends, data = column.buffers()
        ends = np.frombuffer(ends, np.int32)[column.offset:column.offset + n + 1]
        count = int(ends[-1] - ends[0]) // kind().itemsize
        flat.append(np.frombuffer(data, kind, count, int(ends[0])) if count else np.zeros(0, kind))
        sizes = np.diff(ends) // kind().itemsize
    x[np.repeat(np.arange(n), sizes), flat[0]] = flat[1]
    return x


def loss_sums(blocks: DataFrame, mean: np.ndarray, scale: np.ndarray, slopes: np.ndarray, shift: float
              ) -> tuple[float, np.ndarray, np.ndarray]:
    """Log loss, its gradient and its curvature by the slopes of the scaled
    features and the shift (last), summed over all rows."""
    size = len(mean) + 1
    shared = blocks.sparkSession.sparkContext.broadcast((mean, scale, np.append(slopes, shift)))
    edges = np.linspace(0, size + 2, STRIPES + 1).astype(int)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, scale, theta = shared.value
        total = np.zeros((size + 2, size))  # curvature, gradient, loss
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(lo, BLOCK_ROWS)
                z = np.ones((part.num_rows, size))
                z[:, :-1] = (unpacked(part, size - 1) - mean) * scale
                y = np.asarray(part.column(2), dtype=float)
                m = z @ theta
                p = sigmoid(np.clip(m, -700.0, 700.0))
                total[:size] += (z * (p * (1.0 - p))[:, None]).T @ z
                total[size] += (p - y) @ z
                total[size + 1, 0] += (np.logaddexp(0.0, m) - y * m).sum()
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(STRIPES), pa.int32()),
             pa.array([total[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary())], ["stripe", "sums"])

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            for sums in batch.column("sums"):
                total = total + np.frombuffer(sums.as_buffer(), float)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                         ["stripe", "sums"])

    schema = "stripe int, sums binary"
    got = blocks.mapInArrow(run, schema).groupBy("stripe").applyInArrow(add, schema).collect()
    whole = np.zeros((size + 2, size))
    for r in got:
        whole[edges[r["stripe"]]:edges[r["stripe"] + 1]] = np.frombuffer(r["sums"], float).reshape(-1, size)
    return float(whole[size + 1, 0]), whole[size], whole[:size]


def newton(evaluate, theta: np.ndarray, max_iter: int, tol: float) -> np.ndarray:
    """Least point of a convex function from ``evaluate(theta)``: value,
    gradient, curvature.  Steps are halved until the value falls; the last one
    promises less than ``tol`` squared of the value."""
    value, slope, curve = evaluate(theta)
    for _ in range(max_iter):
        step = np.linalg.lstsq(curve, slope, rcond=None)[0]
        promise = float(slope @ step)
        if not promise > 2.0 * tol * tol * max(abs(value), 1e-12):
            break
        for _ in range(HALVINGS):
            found = evaluate(theta - step)
            if found[0] <= value - 1e-4 * promise:
                break
            step, promise = step / 2.0, promise / 2.0
        else:
            break
        theta, (value, slope, curve) = theta - step, found
    return theta


@dataclass
class LogisticOnMap:
    """Adds the columns of a fitted ``models.logistic``: probability and
    prediction (raw scores are not kept)."""
    coefficients: np.ndarray
    intercept: float
    features_col: str
    probability_col: str
    prediction_col: str

    def transform(self, df: DataFrame) -> DataFrame:
        ship(df.sparkSession)
        weights, shift = self.coefficients, self.intercept

        def run(arrays: pa.Array) -> pa.Array:
            arrays = arrays.combine_chunks() if isinstance(arrays, pa.ChunkedArray) else arrays
            there = np.asarray(arrays.is_valid())
            x = np.asarray(arrays.drop_null().flatten(), dtype=float).reshape(int(there.sum()), -1)
            out = np.full(len(there), np.nan)
            out[there] = sigmoid(np.clip(x @ weights + shift if len(x) else x.sum(axis=1), -700.0, 700.0))
            return pa.array(out, pa.float64(), mask=~there)

        p = F.arrow_udf(run, "double")(F.when(F.col(self.features_col).isNotNull(), vector_to_array(self.features_col)))
        out = df.withColumn("_p1", p)
        return (out.withColumn(self.probability_col, F.when(F.col("_p1").isNotNull(), array_to_vector(F.array(1.0 - F.col("_p1"), "_p1"))))
                .withColumn(self.prediction_col, (F.col("_p1") > 0.5).cast("double")).drop("_p1"))


def fit_on_map(lr, train: DataFrame, mapped: LinearMap, input_col: str = "features") -> LogisticOnMap:
    """``lr``, a ``models.logistic``, fitted on the mapped features of ``train``
    without making them: ``lr.getFeaturesCol()`` is read at scoring only."""
    rows = train.where(F.col(input_col).isNotNull())
    bad, good, n = rows.agg(F.count_if(F.col(lr.getLabelCol()).isNull()), F.sum(F.col(lr.getLabelCol()).cast("double")),
                            F.count(F.lit(1))).first()
    if bad:
        raise ValueError("labels must not be null")
    if not n:
        raise ValueError("no rows to fit on")
    width = mapped.components.shape[1]
    out = LogisticOnMap(np.zeros(width), 0.0, lr.getFeaturesCol(), lr.getProbabilityCol(), lr.getPredictionCol())
    if good in (0.0, n):  # one label only: Spark's learner answers alike
        out.intercept = np.inf if good else -np.inf
        return out
    blocks, reg = packed_rows(rows, input_col, lr.getLabelCol()), lr.getRegParam()

    def evaluate(theta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        loss, slope, curve = loss_sums(blocks, mapped.mean, mapped.scale, mapped.components @ theta[:-1], theta[-1])
        to = np.zeros((len(slope), width + 1))
        to[:-1, :-1], to[-1, -1] = mapped.components, 1.0
        penalty = np.append(np.full(width, reg), 0.0)
        return (loss / n + 0.5 * float(penalty @ theta**2), to.T @ slope / n + penalty * theta,
                to.T @ curve @ to / n + np.diag(penalty))

    theta = newton(evaluate, np.append(np.zeros(width), np.log(good / (n - good))), lr.getMaxIter(), lr.getTol())
    out.coefficients, out.intercept = theta[:-1], float(theta[-1])
    return out
