"""Whitening of embeddings: integer moments on the cluster, components by contour integration, projected rows.

A vector's entries become integers by a fixed scale and shift. Sums and deviations from the mean are exact: with n
vectors and sums S, the integers n*x - S are the deviations times n. The covariance is added up in products of centred
batches, one matrix per task. What reaches the driver is the square of the dimension, never rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructType

from .contour import largest_components

#: Rows projected together.
TOGETHER = 2048


def _finite(column: pa.Array) -> np.ndarray:
    """Which vectors are there and hold finite entries only."""
    lists = column.fill_null([])
    ends = lists.offsets.to_numpy()
    odd = ~np.isfinite(lists.values.cast(pa.float64()).to_numpy(zero_copy_only=False)[: ends[-1]])
    before = np.concatenate([[0], np.cumsum(odd)])
    return column.is_valid().to_numpy(zero_copy_only=False) & (before[ends[1:]] == before[ends[:-1]])


def _integers(column: pa.Array, dimensions: int, scale: float, shift: int) -> np.ndarray:
    """A row of integers for each vector, all of them finite and of ``dimensions`` entries."""
    entries = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    scaled = np.floor(scale * entries)
    if np.abs(scaled).max(initial=0) >= 2.0**53:
        raise OverflowError("an entry is too large to be counted exactly")
    return scaled.astype(np.int64).reshape(len(column), dimensions) + shift


def _deviations(integers: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n*x - S, exactly."""
    low, high = integers.min(initial=0), integers.max(initial=0)
    if max(abs(int(low)), abs(int(high))) * n >= 2**63 or np.abs(sums).max(initial=0) >= 2**62:
        raise OverflowError("the sum of a dimension does not fit 64 bits")
    return integers * n - sums


def _squares(deviations: np.ndarray) -> np.ndarray:
    """Sum of squares of each row, exactly; an error where it does not fit 64 bits."""
    most = int(np.abs(deviations).max(initial=0))
    if most * most * deviations.shape[1] < 2**63:
        return (deviations * deviations).sum(axis=1)
    exact = [sum(int(x) * int(x) for x in row) for row in deviations]
    if max(exact) >= 2**63:
        raise OverflowError("a deviation does not fit 64 bits")
    return np.array(exact, np.int64)


def _batches(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, TOGETHER):
            part = batch.slice(low, TOGETHER)
            part = part.filter(pa.array(_finite(part.column(at))))
            if part.num_rows:
                yield part


def _summed(rows: DataFrame, width: int, of: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum over all rows of matrices of ``width`` columns: each task adds up its own, then row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in _batches(batches, 0):
            part = of(batch)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["row", "entries"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"row": frame["row"].head(1), "entries": [np.sum(np.stack(frame["entries"]), axis=0)]})

    schema = "row int, entries array<double>"
    found = rows.mapInArrow(run, schema).groupBy("row").applyInPandas(add, schema).collect()
    matrix = np.zeros((len(found), width))
    for r in found:
        matrix[r["row"]] = r["entries"]
    return matrix


def whiten(
    vectors: DataFrame, components: int = 32, column: str = "embedding", key: str = "vec_id", scale: float = 64.0, shift: int = 1_000_000
) -> DataFrame:
    """A row for each vector and component: ``key``, component (from 1, by falling variance), n (vectors), deviation
    (sum of squares of n*x - S), whitened (the centred vector's coordinate over its deviation), explained (the
    component's share of the variance) and identity_error (how far the whitened covariance is from the identity).

    Vectors that are null or hold null, NaN or infinite entries are left out. Components of no variance have no
    coordinate and are left out, so equal vectors, a single vector and an empty table give no rows. Repeated rows count
    each time. Vectors of different lengths are an error, and so are entries too large for exact sums. Columns other
    than ``key`` and ``column`` are not read.
    """
    rows = vectors.select(F.col(f"`{column}`").alias("entries"), F.col(f"`{key}`").alias(key))
    entries = rows.select("entries")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in _batches(batches, 0):
            lengths = np.diff(batch.column(0).offsets.to_numpy())
            if lengths.min() != lengths.max() or (total is not None and len(total) != lengths[0]):
                raise ValueError("the vectors have different lengths")
            part = _integers(batch.column(0), int(lengths[0]), scale, shift).sum(axis=0)
            n, total = n + batch.num_rows, part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.tolist()], pa.list_(pa.int64()))], ["n", "sums"])

    # One row per task, added up in exact integers.
    each = entries.mapInArrow(sums, "n long, sums array<long>").select("n", F.size("sums").alias("d"), F.posexplode("sums").alias("at", "sum"))
    found = each.groupBy("at").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"), F.min("d").alias("least"), F.max("d").alias("most")).orderBy("at").collect()
    if any(r.least != r.most for r in found):
        raise ValueError("the vectors have different lengths")
    n, totals = (found[0].n if found else 0), np.array([r["sum"] for r in found], np.int64)
    d = len(totals)

    def centred(batch: pa.RecordBatch) -> np.ndarray:
        return _deviations(_integers(batch.column(0), d, scale, shift), n, totals) / n

    def product(batch: pa.RecordBatch) -> np.ndarray:
        c = centred(batch)
        return c.T @ c

    covariance = _summed(entries, d, product) / max(n, 1)
    variances, axes = largest_components(covariance, components)
    k, weights = len(variances), axes / np.sqrt(variances)

    def whitened_product(batch: pa.RecordBatch) -> np.ndarray:
        w = centred(batch) @ weights  # their mean is 0: the deviations add up to 0 exactly
        return w.T @ w

    error = np.abs(_summed(entries, k, whitened_product) / n - np.eye(k)).max() if k else 0.0
    shares = variances / np.trace(covariance) if k else variances

    schema = StructType([vectors.select(F.col(f"`{key}`").alias(key)).schema[0]])
    for name, kind in [("component", IntegerType()), ("n", LongType()), ("deviation", LongType()), ("whitened", DoubleType()), ("explained", DoubleType()), ("identity_error", DoubleType())]:
        schema = schema.add(name, kind)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches, 0) if k else ():
            deviations = _deviations(_integers(batch.column(0), d, scale, shift), n, totals)
            m = batch.num_rows
            arrays = [
                batch.column(1).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n, np.int64)),
                pa.array(np.repeat(_squares(deviations), k)),
                pa.array((deviations / n @ weights).ravel()),
                pa.array(np.tile(shares, m)),
                pa.array(np.full(m * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return rows.mapInArrow(project, schema)
