"""Hot-key check for the distributed row index: one group holds a third of all
rows.  Prints the largest task of the range-partitioned numbering next to the
group size a ``row_number() OVER (PARTITION BY g ...)`` window would give one
task, and the time of both.  Synthetic rows from ``spark.range`` (a check, not
a registered query).

usage: python tools/skew_check.py [rows] [partitions]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from lakeloom.operators.rowindex import with_row_index  # noqa: E402
from lakeloom.session import build_session  # noqa: E402


def main(n: int, parts: int) -> None:
    spark = build_session(shuffle_partitions=parts)
    df = spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("g"),
        (F.col("id") * 7919 % 100003).alias("v"))
    keys = ["g", "v", "id"]
    sizes = (df.repartitionByRange(parts, *keys).groupBy(F.spark_partition_id().alias("p")).count()
             .agg(F.max("count"), F.min("count")).collect()[0])
    hot = df.where("g = 0").count()
    t0 = time.time()
    got = with_row_index(df, ["v", "id"], name="rn", group_by=["g"])
    s1 = got.agg(F.sum("rn")).collect()[0][0]
    t1 = time.time()
    w = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")))
    s2 = w.agg(F.sum("rn")).collect()[0][0]
    t2 = time.time()
    print(f"rows={n} partitions={parts} hot_group_rows={hot}")
    print(f"range-partitioned index: largest task {sizes[0]} rows, smallest {sizes[1]}; {t1 - t0:.1f}s")
    print(f"window PARTITION BY g: one task gets {hot} rows; {t2 - t1:.1f}s; same result: {s1 == s2}")
    spark.stop()


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000, int(sys.argv[2]) if len(sys.argv) > 2 else 64)
