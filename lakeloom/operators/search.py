"""Metadata search over a vector collection.

Exact nearest-neighbour search: a call asks a list of queries (a user's questions, one
vector per label), which the caller holds; it passes through the driver in blocks of
``QUERY_BLOCK`` and meets the collection partition by partition, without a join.  A block's distances
to an Arrow batch are a few array operations.

All ranks (``top_k=None``) come from the distributed row index - the
full result of one query is never gathered into one task; ``top_k`` uses
``row_number() <= k``, which Spark runs as a partial group limit before the
shuffle.  The largest-gap cut needs no ranks: rows are range-sorted by (query, distance), each
partition finds the largest step between its own neighbours, and the steps between partitions come
from one first and one last row of each.  Only what the cut keeps is ranked.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.vectors import squared_distances, vector_matrix
from ..session import broadcast_if_small
from .rowindex import with_row_index

#: Queries that a task holds at once, and cells (rows x queries) of distances.
QUERY_BLOCK, CELLS = 1024, 1 << 20


def query_blocks(queries: DataFrame, qid: str = "query_id", qvec: str = "query_vec", block: int = QUERY_BLOCK) -> Iterator[tuple[list, list]]:
    """(ids, vectors) of the queries, a block at a time."""
    ids, vectors = [], []
    for r in queries.select(qid, qvec).toLocalIterator():
        ids.append(r[0])
        vectors.append(r[1])
        if len(ids) == block:
            yield ids, vectors
            ids, vectors = [], []
    if ids:
        yield ids, vectors


def knn_distances(collection: DataFrame, queries: DataFrame, vec: str = "embedding",
                  qid: str = "query_id", qvec: str = "query_vec") -> DataFrame:
    """(collection row without its vector, query, distance) for a list of queries.

    A null vector, one with a null component or of another length than the query has a null distance."""
    kept = [c for c in collection.columns if c != vec]
    kind = queries.schema[qid].dataType
    rows = collection.select(vec, *kept)
    fields = ", ".join([*(f"`{c}` {t}" for c, t in rows.select(*kept).dtypes), f"`{qid}` {kind.simpleString()}", "distance double"])

    def scored(ids: list, vectors: list) -> DataFrame:
        whole = [v is not None and None not in v for v in vectors]
        by_dim = {d: [i for i, v in enumerate(vectors) if whole[i] and len(v) == d] for d in {len(v) for v, ok in zip(vectors, whole) if ok}}
        sent = {d: np.array([vectors[i] for i in mine], float) for d, mine in by_dim.items()}
        id_kind = to_arrow_type(kind)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            step = max(1, CELLS // len(ids))
            for batch in batches:
                for at in range(0, batch.num_rows, step):
                    b = batch.slice(at, step)
                    out, known = np.zeros((b.num_rows, len(ids))), np.zeros((b.num_rows, len(ids)), bool)
                    for dim, mine in by_dim.items():
                        matrix, fine = vector_matrix(b.column(0), dim)
                        cells = np.ix_(np.flatnonzero(fine), mine)
                        out[cells], known[cells] = squared_distances(matrix[fine], sent[dim]), True
                    row = pa.array(np.repeat(np.arange(b.num_rows), len(ids)))
                    yield pa.RecordBatch.from_arrays(
                        [*(b.column(c).take(row) for c in range(1, b.num_columns)), pa.array(ids * b.num_rows, id_kind),
                         pa.array(out.ravel(), pa.float64(), mask=~known.ravel())], [*kept, qid, "distance"])

        return rows.mapInArrow(run, fields)

    blocks = [scored(*block) for block in query_blocks(queries, qid, qvec)]
    return reduce(DataFrame.union, blocks) if blocks else collection.sparkSession.createDataFrame([], fields)


def rank_matches(scored: DataFrame, order_id: str, top_k: int | None = None, qid: str = "query_id") -> DataFrame:
    """Rank per query by (distance, ``order_id``) (O5, O6): all results by the
    distributed index, or the first ``top_k`` by a partial group limit."""
    if top_k is None:
        return with_row_index(scored, ["distance", order_id], name="rank", group_by=[qid])
    w = Window.partitionBy(qid).orderBy(F.col("distance"), F.col(order_id))
    return scored.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= top_k)


_PIECE = ["part", "n", "first", "last", "last_id", "gap", "at", "gap_distance", "gap_id"]


def _pieces(scored: DataFrame, order_id: str, qid: str) -> DataFrame:
    """One row per query and range partition: its number of rows, first and last row, and its largest inner step with
    the place and the row before it."""
    ordered = scored.select(qid, "distance", order_id)
    parts = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = dict(ordered.dtypes)
    fields = (f"`{qid}` {kinds[qid]}, part int, n long, first double, last double, last_id {kinds[order_id]}, gap double, at long, "
              f"gap_distance double, gap_id {kinds[order_id]}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now, mine, types = TaskContext.get().partitionId(), None, None, None

        def closed() -> pa.RecordBatch:
            values = [now, part, *(mine[c] for c in _PIECE[1:])]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], [qid, *_PIECE])

        for b in batches:
            types = [b.schema.field(0).type, pa.int32(), pa.int64(), pa.float64(), pa.float64(), b.schema.field(2).type, pa.float64(), pa.int64(),
                     pa.float64(), b.schema.field(2).type]
            query, ids = b.column(0), b.column(2)
            distance = b.column(1).to_numpy(zero_copy_only=False)  # a null is NaN
            runs = query.dictionary_encode("encode").indices.to_numpy()
            starts = [0, *(np.flatnonzero(np.diff(runs)) + 1).tolist()]
            for a, z in zip(starts, [*starts[1:], len(runs)], strict=True):
                name = query[a].as_py()
                if mine is None or name != now:
                    if mine is not None:
                        yield closed()
                    now, mine = name, {"n": 0, "first": _value(distance[a]), "last": None, "last_id": None, "gap": None, "at": None,
                                       "gap_distance": None, "gap_id": None}
                own = distance[a:z]
                before = np.concatenate([[np.nan if mine["last"] is None else mine["last"]], own[:-1]])
                steps = np.where(np.isnan(own - before), -1.0, own - before)  # none before the first row, or beside a null
                best = int(steps.argmax())
                if steps[best] >= 0 and (mine["gap"] is None or steps[best] > mine["gap"]):
                    mine |= {"gap": float(steps[best]), "at": mine["n"] + best, "gap_distance": float(before[best]),
                             "gap_id": mine["last_id"] if best == 0 else ids[a + best - 1].as_py()}
                mine |= {"n": mine["n"] + z - a, "last": _value(own[-1]), "last_id": ids[z - 1].as_py()}
        if mine is not None:
            yield closed()

    return ordered.repartitionByRange(parts, qid, "distance", order_id).sortWithinPartitions(qid, "distance", order_id).mapInArrow(run, fields)


def _value(x: float) -> float | None:
    return None if np.isnan(x) else float(x)


def _cuts(scored: DataFrame, order_id: str, qid: str) -> DataFrame:
    """(query, split_rank, max_gap, and the row before the largest step); queries without a step are absent."""
    w = Window.partitionBy(qid).orderBy("part")  # over one row per partition
    found = _pieces(scored, order_id, qid).withColumns({
        "base": F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "next": F.lead("first").over(w)})

    def step(gap, at, distance, order) -> F.Column:
        return F.struct(gap.alias("gap"), (-(F.col("base") + at)).alias("neg_rank"), distance.alias("cut_distance"), order.alias("cut_id"))

    inner = step(F.col("gap"), F.col("at"), F.col("gap_distance"), F.col("gap_id"))
    across = step(F.col("next") - F.col("last"), F.col("n"), F.col("last"), F.col("last_id"))
    best = found.select(qid, F.explode(F.array(inner, across)).alias("s")).where("s.gap IS NOT NULL").groupBy(qid).agg(F.max("s").alias("s"))
    return best.select(qid, (-F.col("s.neg_rank")).alias("split_rank"), F.col("s.gap").alias("max_gap"), "s.cut_distance", "s.cut_id")


def gap_split(scored: DataFrame, order_id: str, qid: str = "query_id") -> DataFrame:
    """Per query the rank before the largest distance gap (W2, A12): gaps are
    next minus current distance; the first largest gap wins.  Queries with
    fewer than two results get no split (they are kept whole)."""
    return _cuts(scored, order_id, qid).select(qid, "split_rank", "max_gap")


def gap_cut(scored: DataFrame, order_id: str, qid: str = "query_id", ranked: bool = True) -> DataFrame:
    """Keep the strong cluster (V4): the rows of each query up to its largest gap, with their ``rank`` if it is asked for."""
    cuts = _cuts(scored, order_id, qid).select(F.col(qid).alias("_sq"), "cut_distance", "cut_id")
    # one small row per query of the caller's list
    j = scored.join(broadcast_if_small(cuts), F.col(qid).eqNullSafe(F.col("_sq")), "left")
    within = (F.col("distance") < F.col("cut_distance")) | (F.col("distance") == F.col("cut_distance")) & (F.col(order_id) <= F.col("cut_id"))
    kept = j.where(F.col("cut_distance").isNull() | F.col("distance").isNull() | within).select(*scored.columns)
    return rank_matches(kept, order_id, qid=qid) if ranked else kept


def rank_tables(matches: DataFrame, qid: str = "query_id", table: str = "source_tablename") -> DataFrame:
    """Rank the matched tables of each query by their best (lowest) distance
    (V5, A10, A11, O7): one partial aggregation per (query, table), then the
    distributed index per query - no query's tables gather in one task."""
    g = matches.groupBy(qid, table).agg(F.min("distance").alias("best_distance"),
                                        F.count(F.lit(1)).alias("n_matches"))
    return with_row_index(g, ["best_distance", table], name="table_rank", group_by=[qid])


def table_matches(matches: DataFrame, order_id: str, qid: str = "query_id",
                  table: str = "source_tablename") -> DataFrame:
    """The columns listed under each matched table, by score (A10): rows with a
    per-(query, table) position instead of a collected list, so a table with
    very many matches is still spread over tasks."""
    return with_row_index(matches, ["distance", order_id], name="column_rank", group_by=[qid, table])


def matched_rows(catalog: DataFrame, matches: DataFrame, qid: str = "query_id",
                 table: str = "source_tablename", sets: int = 16) -> DataFrame:
    """Catalog rows of the tables a query matched.

    The queries of a table are gathered into sets first (``sets`` of them at most, by a hash of the query), so the catalog is joined
    to one row per table and set, not to one per query; the sets are expanded last."""
    pairs = matches.select(F.col(table).alias("_t"), F.col(qid)).distinct()
    asked = pairs.groupBy("_t", F.pmod(F.xxhash64(qid), F.lit(sets)).alias("_set")).agg(F.collect_set(qid).alias("_asked"))
    met = catalog.join(asked, F.col(table) == F.col("_t"), "inner")
    return met.select(*catalog.columns, F.explode("_asked").alias(qid))
