"""Distributed row numbering (W3 surrogate keys, W4 chunk numbers, W5 row ids,
per-query ranks of the vector search, batch numbering per source).

``row_number() OVER (ORDER BY k)`` without PARTITION BY pulls every row into one
task, and ``PARTITION BY g`` does the same for a hot group.  Here the rows are
range-partitioned on ``(group, order)`` (a hot group is split over many
partitions), sorted inside each partition, and numbered locally with
``monotonically_increasing_id``; a small table of per-(partition, group) counts
gives each slice its offset.  Its size is bounded by partitions + groups.

The numbered data is written once into the shared checkpoint folder before the
counts are taken, so the partition ids the offsets refer to cannot change
between the two reads, and the lineage is cut (a lost executor re-reads the
written rows instead of re-running the shuffle).
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def with_row_index(df: DataFrame, order_by: list, name: str = "rn",
                   group_by: list[str] | None = None, num_partitions: int | None = None,
                   start: int = 1) -> DataFrame:
    """Add ``name`` = 1-based position of each row in ``order_by`` order, restarting
    per ``group_by`` group (like ``row_number()``), computed without a single-task
    window.  Give ``order_by`` a unique tiebreaker for a deterministic numbering.

    The offset table joins as adaptive execution sees fit, by its bytes.
    """
    spark = df.sparkSession
    group_by = list(group_by or [])
    keys = [_col(c) for c in group_by] + [_col(c) for c in order_by]
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = (df.repartitionByRange(n, *keys)
         .sortWithinPartitions(*keys)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_pos", F.monotonically_increasing_id()))
    # cut the lineage with a table written once into the shared checkpoint
    # folder (one job; DataFrame.checkpoint would count, then write again)
    root = ensure_checkpoint_dir(spark)
    if root:
        path = f"{root.rstrip('/')}/lakeloom-rowindex-{uuid.uuid4().hex}"
        s.write.parquet(path)
        s = spark.read.parquet(path)
    else:
        s = s.checkpoint(eager=True)
    stats = s.groupBy("_pid", *group_by).agg(F.min("_pos").alias("_p0"),
                                             F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*group_by).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    stats = stats.select(*[F.col(g).alias(f"_g_{g}") for g in group_by], F.col("_pid").alias("_spid"),
                         (F.col("_p0") - F.coalesce(F.sum("_n").over(w), F.lit(0))).alias("_base"))
    cond = [F.col("_pid") == F.col("_spid")]
    cond += [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group_by]
    out = s.join(stats, reduce(lambda a, b: a & b, cond), "inner")
    out = out.withColumn(name, F.col("_pos") - F.col("_base") + F.lit(start))
    return out.drop("_pid", "_pos", "_spid", "_base", *[f"_g_{g}" for g in group_by])
