"""Chunked sorted Parquet output (X1, K1, W4, O4) and document ids."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import document_text
from ..session import ensure_parallelism
from .rowindex import with_row_index


def chunk_rows(df: DataFrame, row_order: list, sort_by: list, chunk_size: int) -> DataFrame:
    """Number rows in ``row_order`` (distributed index), cut them into chunks of
    ``chunk_size`` named by their first row, and order each chunk by
    ``sort_by`` (``chunk_pos``).  A chunk holds at most ``chunk_size`` rows, so
    the per-chunk window is bounded by that parameter."""
    idx = with_row_index(df, row_order, name="_row", start=0)
    c = idx.withColumn("chunk_start", (F.floor(F.col("_row") / chunk_size) * chunk_size).cast("long"))
    w = Window.partitionBy("chunk_start").orderBy(*[F.col(s) if isinstance(s, str) else s for s in sort_by])
    return c.withColumn("chunk_pos", F.row_number().over(w).cast("long")).drop("_row")


def write_chunks(chunked: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One snappy Parquet directory per chunk (``chunk_start=<first row>``),
    rows sorted inside it; no global sort and no single writer task."""
    (chunked.repartition("chunk_start")
     .sortWithinPartitions("chunk_start", "chunk_pos")
     .write.mode(mode).option("compression", "snappy")
     .partitionBy("chunk_start").parquet(path))


def document_collection(rows: DataFrame, order_by: list, table: str, column: str, dtype: str,
                        description: str | None = None) -> DataFrame:
    """Collection rows (K8, W5, V1): ``row_<i>`` ids in frame order (0-based,
    distributed index), the document text, and the metadata columns."""
    idx = with_row_index(rows, order_by, name="_i", start=0)
    return idx.select(F.concat(F.lit("row_"), F.col("_i").cast("string")).alias("id"),
                      document_text(table, column, dtype, description).alias("document"),
                      F.col(table).alias("source_tablename"), F.col(column).alias("source_columnname"),
                      F.col(dtype).alias("datatype"))


def fit_text_embedding(docs: DataFrame, text: str = "text", dim: int = 64):
    """Fit the offline embedding (tokens -> hashed counts -> IDF -> L2 norm) on
    ``docs``; the returned model embeds documents and query texts alike."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer

    pipe = Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_tok", pattern="\\W+", toLowercase=True),
        HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=dim),
        IDF(inputCol="_tf", outputCol="_idf"),
        Normalizer(inputCol="_idf", outputCol="_vec", p=2.0),
    ])
    return pipe.fit(ensure_parallelism(docs))


def apply_text_embedding(model, df: DataFrame, out: str = "embedding") -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    return model.transform(df).withColumn(out, vector_to_array("_vec", "float32")).drop(
        "_tok", "_tf", "_idf", "_vec")


def embedding_udf(model_fn, dim: int):
    """Plug a model in (V2): ``model_fn(list[str]) -> array-like (n, dim)`` runs
    on Arrow batches inside the tasks (load the model once per worker inside
    ``model_fn``); the result is an ``ARRAY<FLOAT>`` column."""
    @F.pandas_udf("array<float>")
    def _embed(texts: pd.Series) -> pd.Series:
        vecs = np.asarray(model_fn(texts.fillna("").tolist()), dtype=np.float32).reshape(len(texts), dim)
        return pd.Series(list(vecs))
    return _embed


def embed_documents(docs: DataFrame, text: str = "text", dim: int = 64) -> DataFrame:
    """Offline document embedding (V2) over whole texts: fit, then embed."""
    docs = ensure_parallelism(docs)
    return apply_text_embedding(fit_text_embedding(docs, text, dim), docs)
