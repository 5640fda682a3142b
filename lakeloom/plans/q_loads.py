"""End-to-end query: two waves loading the whole orders table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..fixtures import AS_OF
from ..operators.control import RUN_COLUMNS, RunFilter
from ..session import ensure_checkpoint_dir
from ..sinks import snapshot as snap
from ..sources.tables import Tables
from . import loads as pl
from .registry import register


def _control(spark):
    h = spark.createDataFrame(
        [(1, "S1", "orders", "PostgreSQL", "Fact", 1, 1, "ENV1", "BUILDING", 1, "Started", None),
         (2, "S2", "orders", "PostgreSQL", "Fact", 2, 1, "ENV2", "MACHINERY", 1, "Started", None)],
        "id long, sourceid string, sourcename string, sourcetype string, objecttype string, "
        "sourcecallingseq int, isapplicable int, envsourcecode string, datasourcecode string, "
        "rawstorageflag int, status string, lastupdateddate timestamp_ntz")
    d = spark.createDataFrame(
        [(2, "S1", "orders", "PostgreSQL", "orders", "bronze_to_silver", "stg", "orders", "dwh", "dwh",
          "d_orders_silver", "usp_d_orders_silver", "job_s1", "Full", 1, 1, "Daily", "Completed", None, None),
         (4, "S2", "orders", "PostgreSQL", "orders", "bronze_to_silver", "stg", "orders", "dwh", "dwh",
          "d_orders_silver", "usp_d_orders_silver", "job_s2", "Full", 1, 1, "Daily", "Completed", None, None)],
        "id long, sourceid string, sourcename string, sourcetype string, sourcedescription string, "
        "dataflowflag string, sourceschema string, sourceobject string, targetname string, "
        "targetschemaname string, targetobject string, targetprocedurename string, jobname string, "
        "loadtype string, isreadyforexecution int, isapplicable int, loadfrequency string, "
        "flowstatus string, latestbatchid long, etllastrundate timestamp_ntz")
    g = spark.createDataFrame([], "sourceid string, schemaname string, sourcegroup string, isapplicable int, "
                                  "status string, lastrundatetime timestamp_ntz, "
                                  "loadstartdatetime timestamp_ntz, loadenddatetime timestamp_ntz")
    # the rest of the run record: nothing to say for these sources
    spare = lambda df, side: df.withColumns({c: F.lit(None).cast("int" if c == "intervaldays" else "string")
                                             for s, c in RUN_COLUMNS if s == side and c not in df.columns})
    return spare(h, "h"), spare(d, "d"), g


def _runs(spark):
    """Control rows of five runs over the orders: a load into bronze; a pair of runs of one silver target in one wave, with a
    source whose keys repeat; a later wave that updates the target."""
    h, d, g = _control(spark)
    h1, d1 = h.where("sourceid = 'S1'"), d.where("sourceid = 'S1'")
    runs = [("S0", 1, "raw_to_bronze", "orders", "orders"), ("S1", 1, "bronze_to_silver", "orders", "d_orders_silver"),
            ("S2", 1, "bronze_to_silver", "orders", "d_orders_silver"), ("S3", 1, "bronze_to_silver", "twice", "d_twice_silver"),
            ("S4", 2, "bronze_to_silver", "orders", "d_orders_silver")]
    new = F.explode(F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(("id", "seq", "flow", "object", "target"), r)]) for r in runs]))
    header = h1.withColumn("new", new).withColumns({"sourceid": F.col("new.id"), "sourcecallingseq": F.col("new.seq")})
    detail = d1.withColumn("new", new).withColumns({
        "sourceid": F.col("new.id"), "dataflowflag": F.col("new.flow"), "sourceobject": F.col("new.object"), "targetobject": F.col("new.target"),
        "targetschemaname": F.when(F.col("new.flow") == "raw_to_bronze", "stg").otherwise("dwh")})
    return header.select(*h.columns), detail.select(*d.columns), g


@register("waves_e2e", """
WITH n AS (SELECT count(*) AS n FROM orders)
SELECT 'S0' AS sourceid, 'raw_to_bronze' AS dataflowflag, 1 AS sourcecallingseq, n AS srcrwcnt, n AS tgtinscnt, CAST(0 AS BIGINT) AS tgtupdcnt,
       'Completed' AS flowstatus, CAST(1 AS BIGINT) AS latestbatchid, NULL::VARCHAR AS errordesc FROM n
UNION ALL SELECT 'S1', 'bronze_to_silver', 1, n, n, 0, 'Completed', 1, NULL FROM n
UNION ALL SELECT 'S2', 'bronze_to_silver', 1, n, 0, n, 'Completed', 1, NULL FROM n
UNION ALL SELECT 'S3', 'bronze_to_silver', 1, 2 * n, 0, 0, 'Failed', 1,
  'ValueError: ' || n || ' business keys occur more than once (' || n || ' surplus rows)' FROM n
UNION ALL SELECT 'S4', 'bronze_to_silver', 2, n, 0, n, 'Completed', 1, NULL FROM n""")
def waves_e2e(spark, sf_dir):
    """The flows from end to end on the whole orders table (C2-C7): the raw flow loads bronze; the first silver wave has two runs of one
    target, which insert and then update every order, and a source with repeated keys, which fails alone; the second wave updates again.
    The result is the latest audit state with the logged errors.  The control rows are the runs (parameters)."""
    root = ensure_checkpoint_dir(spark).rstrip("/") + f"/lakeloom-e2e-{uuid.uuid4().hex}"
    h, d, g = _runs(spark)
    pl.init_store(spark, root, h, d, g, as_of=AS_OF)
    orders = Tables(spark, sf_dir).orders
    options = dict(keys_of=lambda r: ["o_orderkey"], as_of=AS_OF, parallel=4, source_of=lambda r: orders)
    pl.run_waves(spark, root, RunFilter(dataflowflag="raw_to_bronze"), **options)
    snap.overwrite(orders.unionByName(orders), root, pl.bronze_name("stg", "twice"))
    pl.run_waves(spark, root, RunFilter(dataflowflag="bronze_to_silver"), **options)
    seq = h.select(F.col("sourceid").alias("_s"), "sourcecallingseq")
    errors = pl.error_log(spark, root).select(F.col("sourceid").alias("_e"), "errordesc")
    a = pl.audit_log(spark, root)
    return a.join(seq, F.col("sourceid") == F.col("_s")).join(errors, F.col("sourceid") == F.col("_e"), "left").select(
        "sourceid", "dataflowflag", "sourcecallingseq", "srcrwcnt", "tgtinscnt", "tgtupdcnt", "flowstatus", "latestbatchid", "errordesc")


def _scratch(spark, name: str) -> str:
    return ensure_checkpoint_dir(spark).rstrip("/") + f"/lakeloom-{name}-{uuid.uuid4().hex}"


@register("scan_flat", "SELECT * FROM orders")
def scan_flat(spark, sf_dir):
    """Flat-file source (S3): the whole orders table written as a headered CSV
    into the shared checkpoint folder, read back with an explicit schema and
    every column name taken as text."""
    from ..sources.tables import scan_flat as _scan_flat
    orders = Tables(spark, sf_dir).orders
    path = _scratch(spark, "flat")
    orders.write.option("header", True).csv(path)
    return _scan_flat(spark, path, schema=orders.schema)


@register("bronze_reload", "SELECT * FROM orders")
def bronze_reload(spark, sf_dir):
    """Truncate-and-load of a bronze table (K2): two loads of orders, the
    current version holds one copy (the second load replaces the first)."""
    root = _scratch(spark, "bronze")
    orders = Tables(spark, sf_dir).orders
    snap.overwrite(orders, root, pl.bronze_name("stg", "orders"))
    snap.overwrite(orders, root, pl.bronze_name("stg", "orders"))
    return snap.read_table(spark, root, pl.bronze_name("stg", "orders"))
