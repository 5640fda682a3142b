"""Exact nearest-neighbour search that reads only some partitions.

Index: a few vectors of the collection are pivots.  Every vector is stored in the cell of its
nearest pivot, with its distance to it; a cell is a partition folder, and its least and
greatest distance to the pivot (its ring) are kept with the pivots.

Search: by the triangle inequality no vector of a cell is nearer to a query than the query's distance
to the cell's ring.  First the cells around the query are read that hold ``k`` vectors in all;
their k-th distance bounds the answer, and then only cells whose ring is not farther are read, and in them
only vectors whose own distance to the pivot allows it.  Both passes are exact, so the result is.

The pivots are fitted on a bounded sample (``PIVOTS`` vectors picked by a hash of their id); every
vector is indexed.  Pivots, rings and a block of queries are all that the driver holds.
Vectors that are null, hold a null or have another length than the pivots have no distance and take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.vectors import squared_distances, vector_matrix
from .search import query_blocks, rank_matches

PIVOTS = 32
#: Bounds are widened by this share, so rounding never hides a result.
SLACK = 1e-9


@dataclass
class PivotIndex:
    spark: SparkSession
    path: str
    pivots: np.ndarray
    inner: np.ndarray      # of each cell's ring
    outer: np.ndarray
    sizes: np.ndarray
    order_id: str

    def read(self, cells: list[int]) -> DataFrame:
        """The vectors of some cells; only their folders are read."""
        return self.spark.read.parquet(self.path).where(F.col("cell").isin(cells))


def build_index(collection: DataFrame, path: str, order_id: str, vec: str = "embedding", pivots: int = PIVOTS) -> PivotIndex:
    """Write the cells of a collection under ``path``; ``order_id`` tells its rows apart."""
    spark = collection.sparkSession
    some = collection.where(F.col(vec).isNotNull() & ~F.exists(vec, lambda x: x.isNull()) & (F.size(vec) > 0)).select(order_id, vec)
    chosen = [r[1] for r in some.orderBy(F.xxhash64(order_id), order_id).limit(pivots).collect()]
    dim = len(chosen[0]) if chosen else 0
    centres = np.array([v for v in chosen if len(v) == dim], float).reshape(-1, dim)
    fields = ", ".join([*(f"`{c}` {t}" for c, t in collection.dtypes), "cell int, to_pivot double"])
    names = [*collection.columns, "cell", "to_pivot"]

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            matrix, fine = vector_matrix(b.column(b.schema.names.index(vec)), dim)
            part = b.filter(pa.array(fine))
            away = squared_distances(matrix[fine], centres)
            cell = away.argmin(axis=1) if len(away) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell.astype(np.int32)), pa.array(np.sqrt(away[np.arange(len(cell)), cell]))], names)

    if len(centres):
        # adaptive execution cuts a large cell into several files
        collection.mapInArrow(assigned, fields).hint("rebalance", "cell").write.partitionBy("cell").parquet(path)
        rings = spark.read.parquet(path).groupBy("cell").agg(F.min("to_pivot"), F.max("to_pivot"), F.count("*")).collect()  # one row per pivot
    else:
        rings = []
    inner, outer, sizes = np.full(len(centres), np.inf), np.full(len(centres), -np.inf), np.zeros(len(centres), np.int64)
    for cell, least, most, n in rings:
        inner[cell], outer[cell], sizes[cell] = least, most, n
    return PivotIndex(spark, path, centres, inner, outer, sizes, order_id)


def _scored(index: PivotIndex, cells: dict[int, list[int]], ids: list, queries: np.ndarray, bounds: np.ndarray | None, vec: str, kept: list[str],
            qid: str, kind, k: int) -> DataFrame:
    """The k nearest rows of each task's part of each cell, for the queries that ask the cell (``cells``: queries by cell)."""
    to_pivots = np.sqrt(squared_distances(queries, index.pivots))
    rows = index.read(sorted(cells)).select("cell", "to_pivot", vec, *kept)
    fields = ", ".join([*(f"`{c}` {t}" for c, t in rows.select(*kept).dtypes), f"`{qid}` {kind.simpleString()}", "distance double"])
    id_kind, dim = to_arrow_type(kind), queries.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            matrix, _ = vector_matrix(b.column(2), dim)
            cell, away = b.column(0).to_numpy(), b.column(1).to_numpy()
            for c in np.unique(cell).tolist():
                mine = np.array(cells[c])
                own = np.flatnonzero(cell == c)
                if bounds is not None:  # a row no query can need is not compared
                    gap = np.abs(away[own][:, None] - to_pivots[mine, c][None, :])
                    own = own[(gap * (1 - SLACK) <= bounds[mine][None, :]).any(axis=1)]
                if not len(own):
                    continue
                found = squared_distances(matrix[own], queries[mine])
                for j, q in enumerate(mine.tolist()):
                    # all rows at least as near as the k-th, so ties are left to the ranking
                    at = np.flatnonzero(found[:, j] <= np.partition(found[:, j], k - 1)[k - 1]) if len(own) > k else np.arange(len(own))
                    part = b.select(kept).take(pa.array(own[at]))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array([ids[q]] * len(at), id_kind), pa.array(found[at, j])], [*kept, qid, "distance"])

    return rows.mapInArrow(run, fields)


def knn_pruned(index: PivotIndex, queries: DataFrame, top_k: int, vec: str = "embedding", qid: str = "query_id", qvec: str = "query_vec",
               read: list | None = None) -> DataFrame:
    """(row without its vector, query, distance, rank): the ``top_k`` nearest rows of each query, by (distance, order id).

    ``read``: gets the cells that each pass over a block of queries reads."""
    spark, kind = index.spark, queries.schema[qid].dataType
    if not len(index.pivots):
        raise ValueError("the index has no vector")
    columns = [c for c in spark.read.parquet(index.path).columns if c not in (vec, "cell", "to_pivot")]
    out = None
    for ids, vectors in query_blocks(queries, qid, qvec):
        held = [i for i, v in enumerate(vectors) if v is not None and None not in v and len(v) == index.pivots.shape[1]]
        ids, asked = [ids[i] for i in held], np.array([vectors[i] for i in held], float).reshape(len(held), -1)
        if not ids:
            continue
        away = np.sqrt(squared_distances(asked, index.pivots))
        least = np.maximum(np.maximum(away - index.outer, index.inner - away), 0.0)  # to the ring; infinite for an empty cell
        near: dict[int, list[int]] = {}
        for q in range(len(ids)):
            have = 0
            for c in np.argsort(np.where(index.sizes > 0, away[q], np.inf), kind="stable").tolist():
                if have >= top_k or not index.sizes[c]:
                    break
                near.setdefault(c, []).append(q)
                have += int(index.sizes[c])
        first = _scored(index, near, ids, asked, None, vec, columns, qid, kind, top_k)
        first = rank_matches(first, index.order_id, top_k, qid).drop("rank").cache()
        worst = {r[0]: (r[1], r[2]) for r in first.groupBy(qid).agg(F.max("distance"), F.count("*")).collect()}  # one row per query of the block
        bounds = np.array([np.sqrt(worst[i][0]) if i in worst and worst[i][1] >= top_k else np.inf for i in ids])
        rest: dict[int, list[int]] = {}
        for q in range(len(ids)):
            for c in np.flatnonzero((index.sizes > 0) & (least[q] * (1 - SLACK) <= bounds[q])).tolist():
                if q not in near.get(c, ()):
                    rest.setdefault(c, []).append(q)
        found = first
        if rest:
            found = found.union(_scored(index, rest, ids, asked, bounds, vec, columns, qid, kind, top_k))
        if read is not None:
            read.append((sorted(near), sorted(rest)))
        out = found if out is None else out.union(found)
    if out is None:
        empty = spark.read.parquet(index.path).select(*columns).limit(0)
        out = empty.withColumn(qid, F.lit(None).cast(kind)).withColumn("distance", F.lit(None).cast("double"))
    return rank_matches(out, index.order_id, top_k, qid)
