"""Importance resampling of documents towards a target distribution, over hashed word n-grams.

Words: A-Z lower-cased, runs of 0-9, a-z and non-ASCII characters.  Features: runs of 1 to ``most`` consecutive words
joined by a blank, hashed into ``buckets`` by the CRC-32 of their UTF-8 bytes.  A bucket's gain is the logarithm of its
share in the target over its share in the documents; a document's weight is its features' mean gain, its score adds
Gumbel noise that depends on its id alone, and the documents of highest score are drawn.

Segment deduplication: separator newlines cut texts into lines.  The lines of all documents are counted (combined in
each task before the shuffle, so a very common line costs one row a task); each distinct line is cut into words and
hashed once, and its features count as often as the line occurs.  Features that cross a line's end are counted apart,
per text.  Weighing works alike within an Arrow batch: a batch's distinct lines are summed once and added up by document.
Only sums per bucket (``buckets`` numbers) reach the driver and the tasks.

The draw is a rank over all eligible documents, by the distributed row index over narrow rows.

Defined results: null and word-less texts have no features and weight 0.  A null id draws its noise as the empty text
and comes last among ties; repeated rows score alike and take ranks of their own.  Other columns are not read.  Empty
tables give empty results; an empty target gives finite gains.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.rowindex import with_row_index

from .common import LOWER_BYTES, arrow_limits, stored, text_list

BUCKETS, MOST = 10_000, 1
#: A worker forgets the buckets of words it has met beyond this number, to bound its memory; no result depends on it.
MEMO = 500_000
#: Letters and digits stay (A-Z lower-cased), bytes of non-ASCII characters too; a newline stays, all else parts words.
_CUT = bytes(c if chr(c).isalnum() or c >= 0x80 or c == 10 else 32 for c in LOWER_BYTES)


class Hasher(dict):
    """Feature -> bucket, remembered."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        self[feature] = bucket = zlib.crc32(feature) % self.buckets
        return bucket


def lines_of(text: bytes) -> list[list[bytes]]:
    """The words of each line of a text."""
    return [line.split() for line in text.translate(_CUT).split(b"\n")]


def features(words: list[bytes], most: int) -> list[bytes]:
    """All runs of 1 to ``most`` consecutive words."""
    out = list(words)
    for n in range(2, most + 1):
        out += [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]
    return out


def crossing(lines: list[list[bytes]], most: int) -> list[bytes]:
    """The features that have words of more than one line."""
    if most < 2:
        return []
    words = [w for line in lines for w in line]
    number = [i for i, line in enumerate(lines) for _ in line]
    return [b" ".join(words[i:i + n]) for n in range(2, most + 1) for i in range(len(words) - n + 1) if number[i] != number[i + n - 1]]


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS, most: int = MOST) -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    spark = docs.sparkSession
    arrow_limits(spark)
    texts = docs.select(F.col(text_col).alias("text")).where("text IS NOT NULL")
    lines = texts.select(F.explode(F.split("text", "\n")).alias("text")).groupBy("text").agg(F.count("*").alias("n"))

    def totals(found) -> Iterator[pa.RecordBatch]:
        """found: batches of (features, how often each counts)."""
        sums, hasher = np.zeros(buckets, np.int64), Hasher(buckets)
        for spelt, times in found:
            at = np.fromiter(map(hasher.__getitem__, spelt), np.int64, len(spelt))
            sums += np.bincount(at, times, buckets).astype(np.int64) if times is not None else np.bincount(at, minlength=buckets)
        full = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(sums[full])], ["bucket", "n"])

    def by_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for b in batches:
                each = [features(text.translate(_CUT).split(), most) for text in text_list(b.column("text"))]
                times = np.repeat(b.column("n").to_numpy(), [len(f) for f in each])
                yield [x for f in each for x in f], times
        return totals(found())

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return totals(([x for t in text_list(b.column("text")) for x in crossing(lines_of(t), most)], None) for b in batches)

    sums = lines.mapInArrow(by_line, "bucket long, n long")
    if most > 1:
        sums = sums.union(texts.mapInArrow(between, "bucket long, n long"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in sums.groupBy("bucket").agg(F.sum("n")).collect():  # ``buckets`` rows at most
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored 1000-fold log ratio of smoothed shares, per bucket."""
    n, s, t = len(source), source.astype(np.float64), target.astype(np.float64)
    return np.floor(1000.0 * np.log((t + 1.0) * (s.sum() + n) / ((s + 1.0) * (t.sum() + n)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", most: int = MOST) -> DataFrame:
    """(id, n_words, n_features, weight), one row per document."""
    arrow_limits(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(len(gain))

        def added(spelt: list[bytes], sizes: list[int]) -> np.ndarray:
            """Sums of gains of consecutive groups of features."""
            at = np.fromiter(map(hasher.__getitem__, spelt), np.int64, len(spelt))
            upto = np.concatenate([[0], np.cumsum(gain[at])])
            ends = np.cumsum([0, *sizes])
            return upto[ends[1:]] - upto[ends[:-1]]

        for b in batches:
            number: dict[bytes, int] = {}
            texts = [t.translate(_CUT).split(b"\n") for t in text_list(b.column("text"))]
            at = [number.setdefault(line, len(number)) for t in texts for line in t]
            words = [line.split() for line in number]
            each = [features(w, most) for w in words]
            line_gain = added([x for f in each for x in f], list(map(len, each)))
            line_words, line_features = (np.array(list(map(len, x)), np.int64) for x in (words, each))
            ends = np.cumsum([0, *map(len, texts)])
            n_words, n_features, total = (np.diff(np.concatenate([[0], np.cumsum(x[at])])[ends]) for x in (line_words, line_features, line_gain))
            if most > 1:
                cross = [crossing([words[i] for i in at[a:z]], most) for a, z in zip(ends[:-1], ends[1:])]
                n_features = n_features + np.array(list(map(len, cross)), np.int64)
                total = total + added([x for f in cross for x in f], list(map(len, cross)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n_words), pa.array(n_features),
                                              pa.array(total // np.maximum(n_features, 1))], ["doc_id", "n_words", "n_features", "weight"])

    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n_words long, n_features long, weight long")
    return out.withColumnRenamed("doc_id", id_col)


def draw(weighed: DataFrame, percent: int, id_col: str = "doc_id", seed: int = 2024, min_words: int = 20) -> DataFrame:
    """``weighed`` with ``score`` and ``rank``: 1, 2, ... for the ``percent`` of highest score among the documents of at
    least ``min_words`` words, else null."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    noise = -F.log(-F.log((h.cast("double") + F.lit(0.5)) / F.lit(4294967296.0)))
    score = F.col("weight") + F.floor(F.lit(1000.0) * noise).cast("long")
    rows = stored(weighed.withColumns({"score": score, "spread": F.rand(seed)}), "weighed")
    able = rows.where(F.col("n_words") >= min_words)
    drawn = able.count() * percent // 100
    by = [F.desc("score"), F.asc_nulls_last(id_col), "n_features", "weight", "spread"]  # the last only parts equal rows
    ranked = with_row_index(able, by, name="rank")
    rank = F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")
    short = rows.where(F.col("n_words") < min_words)
    columns = [c for c in rows.columns if c != "spread"]
    return ranked.select(*columns, rank).union(short.select(*columns, F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", buckets: int = BUCKETS, most: int = MOST, seed: int = 2024, min_words: int = 20) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every document; the target is the texts of ``target``."""
    gain = gains(bucket_counts(docs, text_col, buckets, most), bucket_counts(target, target_text_col, buckets, most))
    return draw(weigh(docs, gain, id_col, text_col, most), percent, id_col, seed, min_words)
