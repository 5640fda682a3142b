"""Fuzzy column matching (M1, O8, F19) and the legacy mapped upsert plan.

The score is the public ratio of Python's ``difflib.SequenceMatcher``
(2 * matches / total length); a source column's match is its best-scoring
target column at or above the cut-off, ties going to the greatest name - the
behaviour of ``difflib.get_close_matches(word, names, n=1, cutoff)``.

Distributed form: a source column with an identically named target column
scores 1.0, the unique maximum, so those are settled by an equi-join.  Every other
name gets its letter histogram once, before pairing.  Pairs come from an index of the target columns by
(table, length): a source column is joined to the lengths that can still reach the
cut-off, 2 * shorter / total, and to no other.  Within an Arrow batch the histograms drop the pairs
that share too few letters, and the ratios of the rest are computed together
(``functions.names``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import letters, may_reach, ratios
from ..session import parallelism
from .ddl import insert_columns, update_columns


def with_letters(df: DataFrame, name: str, out: str) -> DataFrame:
    """``df`` with the letter histogram of a column of names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(letters(b.column(name).to_pylist()), pa.binary())], [*b.schema.names, out])

    kinds = ", ".join(f"{c} {t}" for c, t in df.dtypes)
    return df.mapInArrow(run, f"{kinds}, {out} binary")


def name_ratios(pairs: DataFrame, candidate: str, word: str, cutoff: float) -> DataFrame:
    """``pairs`` (with ``a_letters`` of the candidate and ``b_letters`` of the word) that reach the cut-off, with ``ratio``."""
    kept = [c for c in pairs.columns if c not in ("a_letters", "b_letters")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, w, a_letters, w_letters = (b.column(c).to_pylist() for c in (candidate, word, "a_letters", "b_letters"))
            lengths = np.array([len(x) + len(y) for x, y in zip(a, w, strict=True)], np.int64)
            at = np.flatnonzero(may_reach(a_letters, w_letters, lengths, cutoff))
            found = ratios([a[i] for i in at], [w[i] for i in at])
            at, found = at[found >= cutoff], found[found >= cutoff]
            part = b.select(kept).take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found)], [*kept, "ratio"])

    kinds = ", ".join(f"{c} {t}" for c, t in pairs.select(*kept).dtypes)
    return pairs.mapInArrow(run, f"{kinds}, ratio double")


def fuzzy_column_match(source: DataFrame, target: DataFrame, pairs: DataFrame,
                       cutoff: float = 0.6) -> DataFrame:
    """Best target column for every source column of each (source_table,
    target_table) pair.  ``source``/``target``: (table_name, column_name).  Null names match nothing."""
    s = source.select(F.col("table_name").alias("source_table"), F.col("column_name").alias("source_column")).where("source_column IS NOT NULL")
    s = s.join(pairs, "source_table")
    t = target.select(F.col("table_name").alias("target_table"), F.col("column_name").alias("target_column")).where("target_column IS NOT NULL")
    exact = s.join(t, (s["target_table"] == t["target_table"]) & (s["source_column"] == t["target_column"])) \
        .select(s["source_table"], s["target_table"], "source_column", "target_column",
                F.lit(1.0).alias("ratio"))
    rest = s.join(exact.select("source_table", "target_table", "source_column"),
                  ["source_table", "target_table", "source_column"], "left_anti")
    rest, index = with_letters(rest, "source_column", "b_letters"), with_letters(t, "target_column", "a_letters")
    on = ["target_table"]
    if cutoff > 0:
        size, most = F.length("source_column"), (2 - cutoff) / cutoff
        # a length that cannot reach the cut-off meets nobody; the tiny slack keeps those exactly at it
        least, top = F.ceil(size / F.lit(most) - F.lit(1e-9)), F.floor(size * F.lit(most) + F.lit(1e-9))
        rest = rest.where(least <= top).withColumn("name_length", F.explode(F.sequence(least.cast("int"), top.cast("int"))))
        index, on = index.withColumn("name_length", F.length("target_column")), [*on, "name_length"]
    cand = rest.join(index, on).drop("name_length")
    # the scoring is the costly step: an explicit round-robin repartition
    # keeps it on every core (adaptive execution would merge small hash
    # partitions into one task; a repartition by number is left as asked)
    scored = name_ratios(cand.repartition(parallelism(cand.sparkSession)), "target_column", "source_column", cutoff)
    best = scored.groupBy("source_table", "target_table", "source_column").agg(
        F.max(F.struct("ratio", "target_column")).alias("_b"))
    fuzzy = best.select("source_table", "target_table", "source_column",
                        F.col("_b.target_column").alias("target_column"), F.col("_b.ratio").alias("ratio"))
    return exact.unionByName(fuzzy)


def mapped_columns(source: DataFrame, target: DataFrame, source_keys: list[str], cutoff: float = 0.6) -> dict:
    """Column plan of the legacy mapped upsert (M2) from the two schemas: the keys
    are the source's key columns with their best match in the target (M1), updated
    are the columns of both (T2), inserted those the legacy INSERT fills (P17)
    that the source has.  One table's column names, so the lists are short."""
    spark = source.sparkSession
    pair = spark.createDataFrame([("s", "t")], "source_table string, target_table string")
    src = spark.createDataFrame([("s", c) for c in source.columns], "table_name string, column_name string")
    tgt = spark.createDataFrame([("t", c, i) for i, c in enumerate(target.columns)],
                                "table_name string, column_name string, position int")
    best = {r["source_column"]: r["target_column"] for r in fuzzy_column_match(
        src.where(F.col("column_name").isin(source_keys)), tgt, pair, cutoff).collect()}
    silver = tgt.withColumnRenamed("table_name", "silverdwh_tablename")
    pairs = pair.select(F.col("target_table").alias("silverdwh_tablename"), "source_table")
    names = [[r["column_name"] for r in df.orderBy("position").collect()]
             for df in (update_columns(silver, src, pairs), insert_columns(update_columns(silver, src, pairs)))]
    return {"keys": [(k, best[k]) for k in source_keys if k in best],
            "update_columns": names[0], "insert_columns": names[1]}
