"""Small helpers shared by the training-data operators.

Texts reach Python as Arrow batches; ``text_buffer`` exposes a batch's texts as one
byte array with offsets, so per-character work is vectorised over the whole batch.
"""

from __future__ import annotations

import sys
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.session import ensure_checkpoint_dir

#: Task functions of this subpackage travel with the task, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: The word contract of these operators: maximal runs of anything but ASCII white space.
#: ``bytes.split()`` with no argument splits on exactly these six bytes.
SPACE = " \t\n\x0b\x0c\r"
ARROW_ROWS, ARROW_BYTES = 2000, "8m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_limits(spark: SparkSession, rows: int = ARROW_ROWS, size: str = ARROW_BYTES) -> None:
    """Bound an Arrow batch by rows and bytes, so a worker never holds many long texts at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/lakeloom-llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and reread it.  This cuts the lineage:
    later stages read committed files, whichever executors are lost."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def text_list(column: pa.Array) -> list[bytes]:
    """The texts of a string column as UTF-8; a null counts as empty."""
    return pc.fill_null(column, "").cast(pa.binary()).to_pylist()


def crc_mod(doc_id, modulus: int):
    """crc32(doc_id as text) mod ``modulus``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def crc_mod_ids(ids: list, modulus: int) -> np.ndarray:
    """``crc_mod`` inside a task."""
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % modulus for i in ids], np.int64)


def ascii_lower(column):
    """A-Z to a-z and nothing else."""
    return F.translate(column, UPPER, LOWER)


def free(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``name_``, ``name__``, ... that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def placed(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the column ``name``: 16 bytes that name a row by its place, the same in every read.

    The place is the row's index in its Parquet file, which depends neither on how files are split nor on the
    cores of a run.  A table that is not read from Parquet files is stored first, numbered, and only that is read."""
    try:
        at = df.metadataColumn("_metadata")
        place = F.concat_ws("#", at["file_path"], at["row_index"].cast("string"))
        return df.withColumn(name, F.unhex(F.md5(place.cast("binary"))))
    except AnalysisException:
        return stored(df.withColumn(name, F.unhex(F.md5(F.monotonically_increasing_id().cast("string").cast("binary")))), "placed")


def salted_lookup(rows: DataFrame, table: DataFrame, key: list[str], spread: list[str], how: str = "left", salts: int = 64) -> DataFrame:
    """``rows`` joined to ``table`` (one row per key, no null keys) on ``key``, however many rows share a key.

    Rows are salted by a hash of ``spread``; a key's row is copied to the salts that its rows have, ``salts`` at most.
    ``rows`` is read twice, so its columns must be the same in both reads."""
    rows = rows.withColumn("lookup_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)))
    asked = rows.select(*key, "lookup_salt").distinct().join(table, key)
    return rows.join(asked, [*key, "lookup_salt"], how).drop("lookup_salt")


def running(df: DataFrame, group: str, order: str, totals: dict[str, tuple[str, Column]]) -> DataFrame:
    """``df`` with running totals (column: ("sum" or "xor", of what)) within ``group`` in ``order``, the own row included.

    Rows are range-partitioned by (group, order) and stored, so a large group lies in many tasks; totals of a group's
    earlier partitions, one small row each, are added to the running totals inside a partition."""
    fold = {"sum": F.sum, "xor": F.bit_xor}
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(df.withColumns({f"of_{c}": of for c, (_, of) in totals.items()}).repartitionByRange(parts, group, order)
                  .withColumn("running_part", F.spark_partition_id()), "running")
    by_part = rows.groupBy("running_part", group).agg(*[fold[how](f"of_{c}").alias(f"all_{c}") for c, (how, _) in totals.items()])
    earlier = Window.partitionBy(group).orderBy("running_part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select("running_part", group, *[
        F.coalesce(fold[how](f"all_{c}").over(earlier), F.lit(0)).alias(f"before_{c}") for c, (how, _) in totals.items()])
    within = Window.partitionBy("running_part", group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.withColumns({c: fold[how](f"of_{c}").over(within) for c, (how, _) in totals.items()}).join(before, ["running_part", group])
    add = {"sum": lambda a, b: a + b, "xor": lambda a, b: a.bitwiseXOR(b)}
    return out.select(*df.columns, *[add[how](F.col(c), F.col(f"before_{c}")).alias(c) for c, (how, _) in totals.items()])
