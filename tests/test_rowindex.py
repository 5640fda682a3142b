"""Distributed row numbering equals row_number(), also with a hot group."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeloom.operators.rowindex import with_row_index


def _data(spark, n=3000):
    # one third of the rows in group 0 (hot key), NULL group for some rows, ties on v
    rows = [(i, (0 if i % 3 == 0 else (None if i % 17 == 0 else i % 11)), i % 7) for i in range(n)]
    return spark.createDataFrame(rows, "id long, g long, v long")


def test_global_index_matches_row_number(spark):
    df = _data(spark)
    got = with_row_index(df, ["v", "id"], name="rn", num_partitions=7)
    exp = df.withColumn("rn", F.row_number().over(Window.orderBy("v", "id")))
    assert sorted(got.select("id", "rn").collect()) == sorted(exp.select("id", "rn").collect())


def test_grouped_index_with_hot_and_null_group(spark):
    df = _data(spark)
    got = with_row_index(df, ["v", "id"], name="rn", group_by=["g"], num_partitions=9)
    exp = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")))
    assert sorted(got.select("id", "rn").collect()) == sorted(exp.select("id", "rn").collect())


def test_start_zero_and_dense(spark):
    df = _data(spark, 500)
    got = [r.rn for r in with_row_index(df, ["id"], name="rn", start=0, num_partitions=4).collect()]
    assert sorted(got) == list(range(500))


def test_hot_group_spans_partitions(spark):
    df = _data(spark)
    s = df.repartitionByRange(9, "g", "v", "id").withColumn("p", F.spark_partition_id())
    parts = s.where(F.col("g") == 0).select("p").distinct().count()
    assert parts > 1  # the hot group is split, not sent to one task
