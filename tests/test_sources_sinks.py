"""Flat-file scan, storage listing, chunked writer, embeddings, schema helpers."""

import os
import tempfile

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from lakeloom.operators import chunks as ch
from lakeloom.operators.ddl import silver_schema, spark_type
from lakeloom.sources.tables import file_inventory, scan_flat
from conftest import SF_SMALL


def test_scan_flat_names_are_text(spark, tables):
    d = tempfile.mkdtemp(prefix="lakeloom-test-")
    tables.nation.select(F.col("n_nationkey").alias("1"), "n_name").write.option("header", True).csv(d + "/n")
    df = scan_flat(spark, d + "/n", schema="`1` int, n_name string")
    assert df.columns == ["1", "n_name"] and df.count() == 25


def test_file_inventory_lists_tables(spark):
    names = {r.path.rsplit("/", 1)[-1] for r in file_inventory(spark, SF_SMALL, "*.parquet").collect()}
    assert {"orders.parquet", "lineitem.parquet"} <= names


def test_write_chunks_sorted_per_chunk(spark, tables):
    d = tempfile.mkdtemp(prefix="lakeloom-test-") + "/chunks"
    c = ch.chunk_rows(tables.events, ["event_id"], ["value", "event_id"], 100)
    ch.write_chunks(c, d)
    parts = sorted(p for p in os.listdir(d) if p.startswith("chunk_start="))
    assert len(parts) == 10
    for p in parts:
        t = pq.read_table(os.path.join(d, p)).to_pandas().sort_values("chunk_pos")
        assert len(t) == 100
        assert list(t["value"]) == sorted(t["value"])


def test_embeddings_are_unit_vectors(spark, tables):
    e = ch.embed_documents(tables.documents.select("doc_id", "text"), dim=32).collect()
    norms = [sum(x * x for x in r.embedding) for r in e if any(r.embedding)]
    assert norms and all(abs(n - 1.0) < 1e-4 for n in norms)


def test_spark_types():
    assert spark_type("numeric").simpleString() == "decimal(18,2)"
    assert spark_type("NUMERIC(19,4)").simpleString() == "decimal(19,4)"
    assert spark_type("timestamp with time zone").simpleString() == "timestamp"
    s = silver_schema("d_orders_x", [{"column_id": 1, "silverdwh_columnname": "a", "datatype": "integer",
                                      "precisions": None, "scale": None, "nullable": False}])
    assert s.names[0] == "orderskey" and s["a"].nullable is False and len(s) == 8


def test_pluggable_embedding_udf(spark, tables):
    import numpy as np

    def model(texts):  # a stand-in model: character-count vectors, L2-normalised
        out = np.zeros((len(texts), 8))
        for i, t in enumerate(texts):
            for ch_ in t:
                out[i, ord(ch_) % 8] += 1
            n = np.linalg.norm(out[i])
            out[i] = out[i] / n if n else out[i]
        return out

    e = tables.documents.select("doc_id", ch.embedding_udf(model, 8)("text").alias("v")).collect()
    assert len(e) == tables.documents.count() and all(len(r.v) == 8 for r in e)


def test_write_sorted_ranges(spark, tables):
    from lakeloom.sinks.snapshot import write_sorted
    d = tempfile.mkdtemp(prefix="lakeloom-test-") + "/gold"
    write_sorted(tables.orders, d, ["o_orderkey"], num_partitions=4)
    files = sorted(f for f in os.listdir(d) if f.endswith(".parquet"))
    ranges = []
    for f in files:
        k = pq.read_table(os.path.join(d, f), columns=["o_orderkey"]).column(0).to_pylist()
        assert k == sorted(k)
        ranges.append((k[0], k[-1]))
    ranges.sort()
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_schema_catalog_from_dataframes(spark, tables):
    from lakeloom.operators.catalog import schema_catalog
    cat = schema_catalog(spark, {"orders": tables.orders, "part": tables.part})
    rows = {(r.table_name, r.column_name): r for r in cat.collect()}
    assert len(rows) == len(tables.orders.columns) + len(tables.part.columns)
    assert rows[("orders", "o_orderkey")].data_type == "bigint"
    assert rows[("orders", "o_orderkey")].ordinal_position == 1
    assert rows[("orders", "o_totalprice")].data_type == "double precision"
    assert rows[("part", "p_name")].data_type == "text"


def test_char_lengths_of_declared_columns(spark):
    from lakeloom.operators.catalog import char_type, schema_catalog
    from pyspark.sql import types as T
    raw = {"__CHAR_VARCHAR_TYPE_STRING": "varchar(20)"}
    fields = [T.StructField("v", T.StringType(), True, raw), T.StructField("c", T.StringType(), True, {"__CHAR_VARCHAR_TYPE_STRING": "char(3)"}),
              T.StructField("w", T.VarcharType(7)), T.StructField("s", T.StringType())]
    assert [char_type(f) for f in fields] == [("varchar", 20), ("char", 3), ("varchar", 7), None]
    df = spark.createDataFrame([], T.StructType([fields[0], fields[1], fields[3]]))
    rows = {r.column_name: (r.data_type, r.character_maximum_length) for r in schema_catalog(spark, {"t": df}).collect()}
    assert rows == {"v": ("varchar", 20), "c": ("char", 3), "s": ("text", None)}


def test_a_column_without_a_type(spark):
    import pytest
    from lakeloom.operators.ddl import silver_ddl
    kind = "silverdwh_tablename string, silverdwh_columnname string, column_id int, datatype string, length int, precisions int, scale int, nullable boolean, keyconstraint string"
    lookup = spark.createDataFrame([("d_a_b", "x", 1, "integer", None, None, None, True, None), ("d_a_b", "y", 2, None, None, None, None, False, None)], kind)
    assert " y " not in silver_ddl(lookup).first().ddl
    assert "x integer, y text NOT NULL," in silver_ddl(lookup, untyped="text").first().ddl
    with pytest.raises(Exception, match="no type: d_a_b.y"):
        silver_ddl(lookup, untyped="refuse").collect()
