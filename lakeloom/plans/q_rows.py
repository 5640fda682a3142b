"""Queries of the row-numbering jobs and sources."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions.exprs import document_text
from ..operators import chunks as ch
from ..session import ensure_checkpoint_dir
from ..sources.tables import Tables, file_inventory as _inventory
from .registry import register

CHUNK = 1000
_EV = "event_id, ts, user_id, event_type, value, props"


@register("chunk_sort", f"""
WITH i AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS idx FROM events)
SELECT CAST(floor(idx / {CHUNK}) * {CHUNK} AS BIGINT) AS chunk_start,
       row_number() OVER (PARTITION BY floor(idx / {CHUNK}) ORDER BY value ASC NULLS FIRST, event_id) AS chunk_pos,
       {_EV}
FROM i""")
def chunk_sort(spark, sf_dir):
    """Rows cut into chunks of 1,000 in event order, each sorted by value, written
    as one Parquet folder per chunk and read back (X1, K1, W4, O4)."""
    ev = Tables(spark, sf_dir).events
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lakeloom-chunks-{uuid.uuid4().hex}"
    ch.write_chunks(ch.chunk_rows(ev, ["event_id"], ["value", "event_id"], CHUNK), path)
    c = spark.read.parquet(path).withColumn("chunk_start", F.col("chunk_start").cast("long"))
    return c.select("chunk_start", "chunk_pos", *[x.strip() for x in _EV.split(",")])


_DOC_SQL = ("'Table: ' || coalesce(source_tablename, 'None') || ' | Column: ' || coalesce(source_columnname, 'None')"
            " || ' | Type: ' || coalesce(datatype, 'None')"
            " || CASE WHEN description IS NOT NULL THEN ' | Description: ' || description ELSE '' END")


@register("doc_text", f"SELECT p_partkey, {_DOC_SQL} AS document FROM document_input", fixtures=["document_input"])
def doc_text(spark, sf_dir):
    """``Table: .. | Column: .. | Type: .. [| Description: ..]`` per catalog row."""
    d = fx.document_input(Tables(spark, sf_dir))
    return d.select("p_partkey", document_text("source_tablename", "source_columnname", "datatype",
                                               "description").alias("document"))


@register("doc_collection", f"""
SELECT 'row_' || CAST(row_number() OVER (ORDER BY p_partkey) - 1 AS VARCHAR) AS id, {_DOC_SQL} AS document,
       source_tablename, source_columnname, datatype
FROM document_input""", fixtures=["document_input"])
def doc_collection(spark, sf_dir):
    """Collection rows with ``row_<i>`` ids, documents and metadata."""
    d = fx.document_input(Tables(spark, sf_dir))
    return ch.document_collection(d, ["p_partkey"], "source_tablename", "source_columnname", "datatype",
                                  "description")


@register("union_by_name", """
SELECT * FROM document_input
UNION ALL BY NAME
SELECT id, source_tablename, source_columnname FROM vector_collection""",
          fixtures=["document_input", "vector_collection"])
def union_by_name(spark, sf_dir):
    """Bag union by column name, missing columns NULL."""
    t = Tables(spark, sf_dir)
    a = fx.document_input(t)
    b = fx.vector_collection(t).select("id", "source_tablename", "source_columnname")
    return a.unionByName(b, allowMissingColumns=True)


@register("doc_embed")
def doc_embed(spark, sf_dir):
    """Embedding of every whole document text (V2): no SQL form; see tests."""
    docs = Tables(spark, sf_dir).documents.select("doc_id", "text")
    return ch.embed_documents(docs, dim=64).select("doc_id", "embedding")


@register("file_inventory")
def file_inventory(spark, sf_dir):
    """Storage listing of the input tables (S10): path, size, time; no SQL form."""
    return _inventory(spark, sf_dir, "*.parquet").select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "size")
