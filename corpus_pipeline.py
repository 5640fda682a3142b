"""The training-corpus pipeline: five stages, each a Parquet table that the next one reads.

Every stage takes (spark, docs, sf_dir) and works on all documents that its predecessor
kept.  All but the last return the columns of ``docs``; the last returns the token ids.

Rows are told apart by their place in the input's files (``placed``), not by ``doc_id``, so null and
repeated ids are handled like others, and every read of a stage's input, on any number of cores,
finds the same rows.  The columns that a stage adds get names that the input does not have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import bpe, exact_dedup, language_id, mixing, simhash
from lakeloom.llm.common import crc_mod, free, placed, stored, table
from lakeloom.llm.queries import bpe_ranks

#: Language ID rejects texts without a letter and those whose best language is less likely than this.
MIN_LANGUAGE_SCORE = 0.3


def _own(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a recognised language; learns from ``lang`` where crc32(doc_id) mod 5 is not 0.

    Null and empty texts and those without a letter go.  Rows are judged alone: equal texts share their fate, repeated
    rows stay repeated.  No labelled document: nothing is recognised.  An empty table gives an empty one."""
    net = language_id.fit(docs.where(crc_mod(F.col("doc_id"), 5) != 0))
    renamed = {c: free(docs, f"pipeline_{c}") for c in docs.columns if c.lower() in ("lang_pred", "lang_score")}
    marked = language_id.predict(docs.withColumnsRenamed(renamed), net)
    kept = marked.where((F.col("lang_pred") != language_id.UND) & (F.col("lang_score") >= MIN_LANGUAGE_SCORE))
    return kept.select(*[F.col(f"`{renamed.get(c, c)}`").alias(c) for c in docs.columns])


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal texts (white space aside): the longest, then the smallest id, null last.

    All null, empty and blank texts are one group; of equal rows one stays.  An empty table gives an empty one."""
    row = free(docs, "pipeline_row")
    rows = placed(docs, row)
    kept = exact_dedup.exact_groups(rows, member_col=row).where("kept").select(row)
    return rows.join(kept, row, "left_semi").select(*_own(docs))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component of fingerprints at 2 or fewer differing bits: the smallest id, null last.

    Null and word-less texts have fingerprint zero; of equal rows one stays.  An empty table gives an empty one."""
    row = free(docs, "pipeline_row")
    rows = placed(docs, row)
    return rows.join(simhash.representatives(rows, row, shingle=3, max_bits=2), row, "left_semi").select(*_own(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, in training order.

    A null source is a source of its own.  Null texts and those without words are never taken.  Rows with equal ids
    come in the order of size, then of their place.  An empty table gives an empty one."""
    row = free(docs, "pipeline_row")
    rows, order = placed(docs, row), ["position", "place", "before", "copy"]
    names = {c: free(docs, f"pipeline_{c}") for c in order}
    taken = mixing.taken_copies(mixing.mix(rows, row_col=row)).select(
        F.col("row").alias(row), *[F.col(c).alias(n) for c, n in names.items()])
    return rows.join(taken, row).orderBy(*names.values(), row).select(*_own(docs))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256): ids as little-endian unsigned 32-bit integers.

    One row per row; null and empty texts have no ids.  An empty table gives an empty one."""
    return bpe.encode(docs, bpe_ranks(), decoded=True).select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", language_stage),
    ("exact dedup", exact_stage),
    ("SimHash near-dedup", near_stage),
    ("mixing to target weights", mixing_stage),
    ("byte-level BPE", encoding_stage),
]

#: SQL can express neither the network nor the merges; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
