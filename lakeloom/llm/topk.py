"""Exact top-k search by inner product: tiled matrix products, partial selection, merging.

Vectors are quantised to integers, so scores are exact.  Queries go out in blocks of a
bounded size (``block_bytes``), one scan of the candidates per block: nothing that grows
with the data is broadcast and no candidate is shuffled.  Inside a task a candidate tile
is multiplied with the query block; only scores that reach the query's running k-th best
are looked at, and the per-task lists are merged per query by Spark, at most k rows of a
query from each task.

Defined results: vectors that are null, empty, or hold null or non-finite components take
no part; a query meets only vectors of its own length.  Ties go to the smaller id.  A
repeated id is a candidate as often as it occurs, and never its own query's; a
repeated query row has its own list.  Rows with a null id take no part.  A component or score beyond the long range is held at its limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_limits, stored

LIMIT = 2 ** 63 - 1
TILE = 4096
BLOCK_BYTES = 32 << 20
EXACT = float(2 ** 53)


def quantised(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(vec_id, v): v = floor(scale * x) as longs; rows that take no part are left out."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.col(id_col).isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    top = float(2 ** 62)
    return df.where(F.coalesce(fine, F.lit(False))).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(v, lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(top)), F.lit(-top))).cast("long")).alias("v"))


def _matrix(batch: pa.RecordBatch) -> list[tuple[np.ndarray, ...]]:
    """The id columns and the vectors of a batch, one tuple for each vector length."""
    col = batch.column("v")
    off = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1]
    flat = col.values.to_numpy(zero_copy_only=False)
    dims, ids = np.diff(off), [batch.column(c).to_numpy() for c in batch.schema.names if c != "v"]
    return [(*(i[m] for i in ids), flat[off[:-1][m][:, None] + np.arange(d)])
            for d in np.unique(dims) if (m := dims == d).any()]


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products: in floating point while every partial sum fits 53 bits, else in Python integers."""
    if float(np.abs(q).max()) * float(np.abs(c).max()) * q.shape[1] < EXACT:
        return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    wide = q.astype(object) @ c.T.astype(object)
    return np.clip(wide, -LIMIT, LIMIT).astype(np.int64)


class TopLists:
    """The k best (score, smaller id) candidates so far for each query of a block."""

    def __init__(self, numbers: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.numbers, self.ids, self.vectors, self.k = numbers, ids, vectors, k
        self.score = np.full((len(ids), k), -LIMIT - 1, np.int64)
        self.vec = np.full((len(ids), k), LIMIT, np.int64)
        self.none = np.ones((len(ids), k), bool)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        s = _scores(self.vectors, vectors)
        worst = self.score[:, -1:]
        reach = (s > worst) | (s == worst) & (ids[None, :] < self.vec[:, -1:]) | self.none[:, -1:]
        reach &= ids[None, :] != self.ids[:, None]
        for row in np.flatnonzero(reach.any(axis=1)):
            at = np.flatnonzero(reach[row])
            if len(at) > self.k:  # partial selection: all above the k-th score, then the smallest ids at it
                kth = np.partition(s[row, at], len(at) - self.k)[len(at) - self.k]
                above = at[s[row, at] > kth]
                at = np.concatenate([above, at[s[row, at] == kth][:self.k - len(above)]])
            score, vec = np.concatenate([self.score[row], s[row, at]]), np.concatenate([self.vec[row], ids[at]])
            none = np.concatenate([self.none[row], np.zeros(len(at), bool)])
            best = np.lexsort((vec, -score, none))[:self.k]
            self.score[row], self.vec[row], self.none[row] = score[best], vec[best], none[best]

    def batch(self) -> pa.RecordBatch:
        real = ~self.none
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(x, self.k)[real.ravel()]) for x in (self.numbers, self.ids)]
            + [pa.array(self.vec[real]), pa.array(self.score[real])], ["number", "query_id", "vec_id", "score"])


def top_k(queries: DataFrame, candidates: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
          k: int = 5, scale: int = 256, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every query."""
    spark = queries.sparkSession
    arrow_limits(spark)
    asked = stored(quantised(queries, id_col, vec_col, scale).select(
        F.monotonically_increasing_id().alias("number"), F.col("vec_id").alias("query_id"), "v"), "topk-queries")
    size = asked.agg(F.sum(F.size("v") * 8 + 16)).first()[0]
    blocks = max(1, -(-(size or 0) // block_bytes))
    pool = quantised(candidates, id_col, vec_col, scale)
    parts = []
    for block in range(blocks):  # each block is of a bounded size, whatever the number of queries
        mine = asked.where(F.pmod(F.xxhash64("number"), F.lit(blocks)) == block).toArrow().combine_chunks()
        sent = spark.sparkContext.broadcast([x for b in mine.to_batches() for x in _matrix(b)] if mine.num_rows else [])

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            lists = {v.shape[1]: TopLists(n, i, v, k) for n, i, v in sent.value}
            for b in batches:
                for ids, vectors in _matrix(b):
                    if (found := lists.get(vectors.shape[1])) is not None:
                        for t in range(0, len(ids), TILE):
                            found.add(ids[t:t + TILE], vectors[t:t + TILE])
            for found in lists.values():
                yield found.batch()

        parts.append(pool.mapInArrow(search, "number long, query_id long, vec_id long, score long"))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    best = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
