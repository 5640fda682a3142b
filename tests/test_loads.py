"""End-to-end waves: inserts, then updates, a failing run, state transitions."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from lakeloom.operators.control import RunFilter
from lakeloom.plans import loads as pl
from lakeloom.plans.q_loads import _control
from lakeloom.sinks import snapshot as snap

T = dt.datetime(2024, 6, 1)


def test_waves_load_fail_and_transition(spark, tables):
    root = tempfile.mkdtemp(prefix="lakeloom-e2e-")
    h, d, g = _control(spark)
    # a third source whose bronze object does not exist: its load fails
    h = h.unionByName(h.where("sourceid = 'S2'").withColumn("sourceid", F.lit("S3")).withColumn("id", F.lit(3)))
    d = d.unionByName(d.where("sourceid = 'S2'").withColumn("sourceid", F.lit("S3"))
                      .withColumn("sourceobject", F.lit("missing")).withColumn("targetobject", F.lit("d_x_y")))
    pl.init_store(spark, root, h, d, g, as_of=T)
    snap.overwrite(tables.orders, root, pl.bronze_name("stg", "orders"))
    res = pl.run_waves(spark, root, RunFilter(), keys_of=lambda r: ["o_orderkey"], as_of=T, parallel=2)
    n = tables.orders.count()
    by = {r.sourceid: r for r in res}
    assert (by["S1"].inscnt, by["S1"].updcnt) == (n, 0)
    assert (by["S2"].inscnt, by["S2"].updcnt) == (0, n)
    assert "FileNotFoundError" in by["S3"].error
    silver = pl.read_silver(spark, root, "dwh", "d_orders_silver")
    assert silver.count() == n and silver.select("orderskey").distinct().count() == n
    audit = {r.sourceid: r for r in pl.audit_log(spark, root).collect()}
    assert audit["S1"].flowstatus == "Completed" and audit["S3"].flowstatus == "Failed"
    errs = pl.error_log(spark, root).collect()
    assert [e.sourceid for e in errs] == ["S3"]
    det = {r.sourceid: r for r in snap.read_table(spark, root, "controldetail").collect()}
    assert det["S1"].isreadyforexecution == 0 and det["S1"].flowstatus == "Completed"
    assert det["S3"].flowstatus == "Failed" and det["S3"].isreadyforexecution == 1
    hdr = {r.sourceid: r.status for r in snap.read_table(spark, root, "controlheader").collect()}
    assert hdr == {"S1": "Completed", "S2": "Completed", "S3": "Failed"}
    # a failed run stays ready: only it is due again (and the failed-only filter finds it)
    again = pl.run_waves(spark, root, RunFilter(failed_only=True), keys_of=lambda r: ["o_orderkey"], as_of=T)
    assert [r.sourceid for r in again] == ["S3"]


def test_bucketed_silver_is_not_shuffled_again(spark, tables):
    from lakeloom.operators.upsert import upsert
    root = tempfile.mkdtemp(prefix="lakeloom-bkt-")
    h, d, g = _control(spark)
    pl.init_store(spark, root, h, d, g, as_of=T)
    snap.overwrite(tables.orders, root, pl.bronze_name("stg", "orders"))
    res = pl.run_waves(spark, root, RunFilter(), keys_of=lambda r: ["o_orderkey"], as_of=T, buckets=8)
    n = tables.orders.count()
    assert [(r.inscnt, r.updcnt) for r in res] == [(n, 0), (0, n)]
    silver = pl.read_silver(spark, root, "dwh", "d_orders_silver")
    assert silver.count() == n
    # the next upsert reads silver bucketed: its scan carries the bucket spec and
    # the silver side of the join has no exchange of its own
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        r = upsert(silver, tables.orders, ["o_orderkey"], surrogate="orderskey", as_of=T)
        plan = r.rows.where("_action != 'I'")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SelectedBucketsCount" in plan


def _store(spark, tables, rows):
    """A store whose runs are (sourceid, sequence, flow, source object, target object)."""
    root = tempfile.mkdtemp(prefix="lakeloom-e2e-")
    h, d, g = _control(spark)
    h1, d1 = h.where("sourceid = 'S1'"), d.where("sourceid = 'S1'")
    hs, ds = h1.limit(0), d1.limit(0)
    for i, (s, seq, flow, src, target) in enumerate(rows):
        hs = hs.unionByName(h1.withColumn("sourceid", F.lit(s)).withColumn("id", F.lit(i).cast("long"))
                            .withColumn("sourcecallingseq", F.lit(seq)))
        ds = ds.unionByName(d1.withColumn("sourceid", F.lit(s)).withColumn("dataflowflag", F.lit(flow))
                            .withColumn("sourceobject", F.lit(src)).withColumn("targetobject", F.lit(target))
                            .withColumn("targetschemaname", F.lit("stg" if flow == "raw_to_bronze" else "dwh")))
    pl.init_store(spark, root, hs, ds, g, as_of=T)
    snap.overwrite(tables.orders, root, pl.bronze_name("stg", "orders"))
    return root


def test_one_wave_one_target_runs_in_order_and_bad_sources_fail(spark, tables):
    root = _store(spark, tables, [("A", 1, "bronze_to_silver", "orders", "d_orders_silver"),
                                  ("B", 1, "bronze_to_silver", "orders", "d_orders_silver"),
                                  ("C", 1, "bronze_to_silver", "twice", "d_twice_silver"),
                                  ("D", 1, "silver_to_gold", "orders", "g_orders")])
    snap.overwrite(tables.orders.unionByName(tables.orders), root, pl.bronze_name("stg", "twice"))
    by = {r.sourceid: r for r in pl.run_waves(spark, root, RunFilter(), keys_of=lambda r: ["o_orderkey"], as_of=T)}
    n = tables.orders.count()
    assert sorted((by[s].inscnt, by[s].updcnt) for s in "AB") == [(0, n), (n, 0)]
    assert "more than once" in by["C"].error and by["C"].srccnt == 2 * n
    gold = pl.run_waves(spark, root, RunFilter(dataflowflag="silver_to_gold"), keys_of=lambda r: [], as_of=T)
    assert "no load for flow" in gold[0].error
    # the silver schema came from the lookup, which knows the key
    lookup = snap.read_table(spark, root, "main_lookup").where("silverdwh_tablename = 'd_orders_silver'")
    assert lookup.where("keyconstraint = 'UNIQUE'").first().source_columnname == "o_orderkey"
    silver = pl.read_silver(spark, root, "dwh", "d_orders_silver")
    assert silver.columns[0] == "orderskey" and set(tables.orders.columns) < set(silver.columns)
    # with an order to pick by, the doubled source loads
    wave = pl.run_waves(spark, root, RunFilter(failed_only=True), keys_of=lambda r: ["o_orderkey"], as_of=T,
                        dedupe_by=lambda r: ["o_totalprice"])
    assert [(r.sourceid, r.inscnt, r.error) for r in wave] == [("C", n, None)]
    # logs only grow; a run's last state counts
    log = snap.read_log(spark, root, "audit", pl.AUDIT_SCHEMA)
    assert log.count() > pl.audit_log(spark, root).count() == 5
    assert {(r.sourceid, r.latestbatchid, r.flowstatus) for r in pl.audit_log(spark, root).where("sourceid = 'C'").collect()} == {
        ("C", 1, "Failed"), ("C", 2, "Completed")}


def test_load_into_bronze_replaces_the_table(spark, tables):
    root = _store(spark, tables, [("A", 1, "raw_to_bronze", "orders", "orders_raw")])
    flow = RunFilter(dataflowflag="raw_to_bronze")
    r = pl.run_waves(spark, root, flow, keys_of=lambda r: [], as_of=T, source_of=lambda run: tables.orders)
    assert (r[0].inscnt, r[0].error) == (tables.orders.count(), None)
    assert snap.read_table(spark, root, pl.bronze_name("stg", "orders_raw")).count() == tables.orders.count()
    # a load that fails after the truncate leaves the table empty, and its whole message in the log
    snap.publish(snap.read_table(spark, root, "controldetail").withColumn("isreadyforexecution", F.lit(1)), root, "controldetail")

    def broken(run):
        raise RuntimeError("x" * 5000)

    r = pl.run_waves(spark, root, flow, keys_of=lambda r: [], as_of=T, source_of=broken)
    assert snap.read_table(spark, root, pl.bronze_name("stg", "orders_raw")).count() == 0
    err = pl.error_log(spark, root).first()
    assert err.errordesc == "RuntimeError: " + "x" * 5000 and err.errorline is not None


def test_errors_raised_by_spark_are_logged_whole(spark, tables):
    root = _store(spark, tables, [("A", 1, "raw_to_bronze", "orders", "orders_raw")])
    sources = [(lambda run: tables.orders.select("no_such_column"), "AnalysisException", "no_such_column"),
               (lambda run: tables.orders.select(F.raise_error(F.lit("bad row " + "y" * 3000)).alias("x")), "", "bad row " + "y" * 3000),
               (lambda run: open("/no/such/file"), "FileNotFoundError", "/no/such/file")]
    for source, kind, text in sources:
        snap.publish(snap.read_table(spark, root, "controldetail").withColumn("isreadyforexecution", F.lit(1)), root, "controldetail")
        pl.run_waves(spark, root, RunFilter(dataflowflag="raw_to_bronze"), keys_of=lambda r: [], as_of=T, source_of=source)
        logged = [r.errordesc for r in pl.error_log(spark, root).collect()]
        assert any(e.startswith(kind) and text in e for e in logged), logged


def test_required_and_long_columns_fail(spark, tables):
    import pytest
    df = spark.createDataFrame([(1, "ab"), (2, None)], "k long, t string")
    with pytest.raises(ValueError, match="t \\(1\\)"):
        pl.check_columns(df, ["k", "t"], {})
    with pytest.raises(ValueError, match="too long"):
        pl.check_columns(df, [], {"t": 1})
    pl.check_columns(df, ["k"], {"t": 2})


def test_old_versions_go(spark):
    root = tempfile.mkdtemp(prefix="lakeloom-e2e-")
    for i in range(6):
        snap.publish(spark.range(i), root, "t", retain=3)
    assert snap.published_versions(spark, root, "t") == [4, 5, 6]
    assert snap.read_table(spark, root, "t").count() == 5
