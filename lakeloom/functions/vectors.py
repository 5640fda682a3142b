"""Vector expressions for the metadata search."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def vector_matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(matrix of doubles, which rows are vectors): a null, or one with a null component or another length, is none."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.array([-1 if n is None else n for n in column.value_lengths().to_pylist()], np.int64)
    flat = column.flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    missing = np.concatenate([[0], np.cumsum(flat.is_null().to_numpy(zero_copy_only=False))])
    ends = np.cumsum(np.maximum(sizes, 0))
    starts = ends - np.maximum(sizes, 0)
    fine = (sizes == dim) & (missing[ends] == missing[starts])
    out = np.zeros((len(sizes), dim))
    if dim and fine.any():
        out[fine] = values[starts[fine][:, None] + np.arange(dim)]
    return out, fine


def squared_distances(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances (rows x queries), each summed in element order as ``squared_l2`` does: equal vectors tie."""
    out = np.zeros((len(rows), len(queries)))
    for x, y in zip(rows.T, queries.T, strict=True):
        out += (x[:, None] - y[None, :]) ** 2
    return out


def squared_l2(a, b) -> Column:
    """Squared Euclidean distance of two arrays, summed in element order.

    Native higher-order functions, no UDF; Spark interprets them (they are no part of generated code).
    Elements are widened to double before squaring.
    """
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    sq = F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), 2))
    return F.aggregate(sq, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def mean_vector(df: DataFrame, key: str, vec: str, digits: int = 6) -> DataFrame:
    """Element-wise mean vector per ``key`` (rounded to ``digits``).

    posexplode + groupBy(key, pos) is a partial (map-side combined) aggregation,
    so a key owning a large share of the rows is still summed in parallel; the
    re-assembly groups only ``dim`` values per key.
    """
    e = df.select(key, F.posexplode(vec).alias("pos", "x"))
    m = e.groupBy(key, "pos").agg(F.round(F.avg(F.col("x").cast("double")), digits).alias("x"))
    return m.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias(vec))
