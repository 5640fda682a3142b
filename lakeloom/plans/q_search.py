"""Queries of the metadata search.

Collection = the embeddings table (table = label); queries = one mean vector
per label, computed from the whole collection.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import pivots as pv
from ..operators import search as se
from ..session import ensure_checkpoint_dir
from ..sources.tables import Tables
from .registry import register

_FIX = ["vector_collection", "label_queries"]

_SCORED = """
WITH s AS (
  SELECT q.query_id, c.vec_id, c.id, c.source_tablename, c.source_columnname,
         list_reduce(list_transform(range(1, len(c.embedding) + 1),
                                    lambda i: (CAST(c.embedding[i] AS DOUBLE) - q.query_vec[i]) ** 2),
                     lambda a, b: a + b) AS distance
  FROM vector_collection c, label_queries q),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM s),
g AS (SELECT query_id, rank, lead(distance) OVER (PARTITION BY query_id ORDER BY rank) - distance AS gap FROM r),
split AS (SELECT query_id, arg_max(rank, (gap, -rank)) AS split_rank, max(gap) AS max_gap
          FROM g WHERE gap IS NOT NULL GROUP BY query_id),
kept AS (SELECT r.* FROM r LEFT JOIN split USING (query_id)
         WHERE split.split_rank IS NULL OR r.rank <= split.split_rank),
tables AS (SELECT query_id, source_tablename, min(distance) AS best_distance,
                  CAST(count(*) AS BIGINT) AS n_matches FROM kept GROUP BY query_id, source_tablename)
"""


def _scored(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return se.knn_distances(fx.vector_collection(t), fx.label_queries(t))


def _ranked(spark, sf_dir, top_k=None):
    return se.rank_matches(_scored(spark, sf_dir), "vec_id", top_k=top_k)


def _out(df):
    return df.select("query_id", "vec_id", "id", "source_tablename", "source_columnname",
                     F.col("distance").cast("float").alias("distance"), "rank")


_OUT_SQL = ("SELECT query_id, vec_id, id, source_tablename, source_columnname, "
            "CAST(distance AS FLOAT) AS distance, rank FROM ")


@register("knn_all", _SCORED + _OUT_SQL + "r", fixtures=_FIX)
def knn_all(spark, sf_dir):
    """Every collection row ranked by squared-L2 distance per query; k = all."""
    return _out(_ranked(spark, sf_dir))


@register("knn_topk", _SCORED + _OUT_SQL + "r WHERE rank <= 10", fixtures=_FIX)
def knn_topk(spark, sf_dir):
    """Ten nearest rows per query (O6): a partial group limit before the shuffle."""
    return _out(_ranked(spark, sf_dir, top_k=10))


@register("knn_pivots", _SCORED + _OUT_SQL + "r WHERE rank <= 10", fixtures=_FIX)
def knn_pivots(spark, sf_dir):
    """Ten nearest rows per query from a pivot index of the collection, which reads only cells that can hold a result."""
    t = Tables(spark, sf_dir)
    path = ensure_checkpoint_dir(spark).rstrip("/") + f"/lakeloom-pivots-{uuid.uuid4().hex}"
    index = pv.build_index(fx.vector_collection(t), path, "vec_id")
    return _out(pv.knn_pruned(index, fx.label_queries(t), 10))


@register("gap_split", _SCORED + "SELECT query_id, split_rank, CAST(max_gap AS FLOAT) AS max_gap FROM split",
          fixtures=_FIX)
def gap_split(spark, sf_dir):
    """Rank before the largest distance gap of each query."""
    s = se.gap_split(_scored(spark, sf_dir), "vec_id")
    return s.select("query_id", "split_rank", F.col("max_gap").cast("float").alias("max_gap"))


@register("gap_cut", _SCORED + _OUT_SQL + "kept", fixtures=_FIX)
def gap_cut(spark, sf_dir):
    """The strong cluster of each query: ranks up to the largest gap (V4)."""
    return _out(se.gap_cut(_scored(spark, sf_dir), "vec_id"))


def _kept(spark, sf_dir):
    return se.gap_cut(_scored(spark, sf_dir), "vec_id", ranked=False)


@register("rank_tables", _SCORED + """
SELECT query_id, source_tablename, CAST(best_distance AS FLOAT) AS best_distance, n_matches,
       row_number() OVER (PARTITION BY query_id ORDER BY best_distance, source_tablename) AS table_rank
FROM tables""", fixtures=_FIX)
def rank_tables(spark, sf_dir):
    """Matched tables per query ranked by best distance."""
    r = se.rank_tables(_kept(spark, sf_dir))
    return r.select("query_id", "source_tablename", F.col("best_distance").cast("float").alias("best_distance"),
                    "n_matches", "table_rank")


@register("table_matches", _SCORED + """
SELECT query_id, source_tablename, source_columnname, vec_id, CAST(distance AS FLOAT) AS distance,
       row_number() OVER (PARTITION BY query_id, source_tablename ORDER BY distance, vec_id) AS column_rank
FROM kept""", fixtures=_FIX)
def table_matches(spark, sf_dir):
    """Columns listed under each matched table, by score (A10)."""
    m = se.table_matches(_kept(spark, sf_dir), "vec_id")
    return m.select("query_id", "source_tablename", "source_columnname", "vec_id",
                    F.col("distance").cast("float").alias("distance"), "column_rank")


@register("matched_tables", _SCORED + """
SELECT t.query_id, c.id, c.vec_id, c.source_tablename, c.source_columnname
FROM vector_collection c JOIN tables t ON c.source_tablename = t.source_tablename""", fixtures=_FIX)
def matched_tables(spark, sf_dir):
    """Catalog rows of the tables each query matched."""
    t = Tables(spark, sf_dir)
    rows = se.matched_rows(fx.vector_collection(t), _kept(spark, sf_dir))
    return rows.select("query_id", "id", "vec_id", "source_tablename", "source_columnname")


def text_search_inputs(spark, sf_dir):
    """(collection with embeddings, embedded text queries) of the
    text metadata search: the part catalog as documents, one query per type."""
    from ..operators import chunks as ch
    t = Tables(spark, sf_dir)
    docs = ch.document_collection(fx.document_input(t), ["p_partkey"], "source_tablename",
                                  "source_columnname", "datatype", "description")
    model = ch.fit_text_embedding(docs, "document", dim=256)
    coll = ch.apply_text_embedding(model, docs).withColumn(
        "doc_no", F.expr("cast(substring(id, 5) as bigint)"))
    qtext = t.part.select(F.col("p_type").alias("document")).distinct()
    queries = ch.apply_text_embedding(model, qtext).select(
        F.col("document").alias("query_id"), F.col("embedding").alias("query_vec"))
    return coll, queries


@register("metadata_search")
def metadata_search(spark, sf_dir):
    """The notebook flow end to end on the part catalog: documents (V1) ->
    embeddings (V2) -> one text query per part type, embedded by the same
    fitted model -> nearest documents, all ranks (V3) -> largest-gap cut (V4)
    -> tables ranked by best distance (V5).  No SQL form (the embedding);
    tests check the search against a plain re-computation on the same vectors."""
    coll, queries = text_search_inputs(spark, sf_dir)
    scored = se.knn_distances(coll, queries)
    kept = se.gap_cut(scored, "doc_no", ranked=False)
    tabs = se.rank_tables(kept)
    return tabs.select(F.col("query_id").alias("query_text"), "table_rank", "source_tablename",
                       F.col("best_distance").cast("float").alias("best_distance"), "n_matches")
