"""One commit per transition, restart of a stopped wave, upkeep of the logs."""

import datetime as dt
import glob
import tempfile

import pytest
from pyspark.sql import functions as F

from lakeloom.operators.control import RunFilter
from lakeloom.plans import loads as pl
from lakeloom.plans.q_loads import _control
from lakeloom.sinks import keyed
from lakeloom.sinks import snapshot as snap
from test_loads import _store

T = dt.datetime(2024, 6, 1)
TABLES = ["controldetail", "controlheader", "sourcegroupingdtl"]


class Killed(BaseException):
    """Ends the driver's work at once; no handler of the library catches it."""


def state(spark, root):
    out = {t: sorted(map(repr, snap.read_table(spark, root, t).collect())) for t in TABLES}
    # the batch token is random
    for name, schema in (("audit", pl.AUDIT_SCHEMA), ("error", pl.ERROR_SCHEMA)):
        log = snap.read_log(spark, root, name, schema).drop(snap.SEQUENCE, "etlbatchid")
        out[name] = sorted(repr(r).replace(root, "root") for r in log.collect())
    return out


def new_store(spark, tables):
    return _store(spark, tables, [("A", 1, "bronze_to_silver", "orders", "d_orders_silver"), ("B", 1, "bronze_to_silver", "orders", "d_orders_silver"),
                                  ("C", 1, "bronze_to_silver", "missing", "d_c")])


@pytest.fixture(scope="module")
def unbroken(spark, tables):
    root = new_store(spark, tables)
    wave(spark, root)
    return state(spark, root), silver(spark, root)


def silver(spark, root):
    return sorted(map(repr, pl.read_silver(spark, root, "dwh", "d_orders_silver").collect()))


def wave(spark, root):
    return pl.run_waves(spark, root, RunFilter(), keys_of=lambda r: ["o_orderkey"], as_of=T, parallel=1)


@pytest.mark.parametrize("kill", ["controlheader", "audit"])
def test_a_transition_that_stops_between_two_writes_changes_nothing(spark, tables, monkeypatch, unbroken, kill):
    root = new_store(spark, tables)
    before = state(spark, root)
    written, run = [], snap.write_run

    def failing_run(rows, path, last):
        written.append(path)
        if kill == "audit":
            raise Killed
        return run(rows, path, last)

    monkeypatch.setattr(snap, "write_run", failing_run)
    if kill == "controlheader":
        monkeypatch.setattr(pl.tr, "_touch_header", lambda header, *a, **b: header.withColumn("status", F.raise_error(F.lit("stop")).cast("string")))
    with pytest.raises((Killed, Exception)):
        wave(spark, root)
    assert written and state(spark, root) == before
    assert not snap.last_commit(spark, root)["note"]
    if kill == "audit":
        monkeypatch.undo()
        wave(spark, root)
        assert state(spark, root) == unbroken[0]


@pytest.mark.parametrize("where", ["after the first load", "before its ledger entry", "before the post-process"])
def test_a_stopped_wave_ends_as_an_unbroken_one(spark, tables, monkeypatch, unbroken, where):
    root, ran = new_store(spark, tables), []
    load, write = pl.load_silver, snap.write_json

    def counted(spark, root, run, *a, **b):
        if where == "after the first load" and ran:
            raise Killed
        ran.append(run["sourceid"])
        return load(spark, root, run, *a, **b)

    def stopping(spark, path, value):
        if where == "before its ledger entry" and "/_ledger/" in path:
            raise Killed
        return write(spark, path, value)

    with monkeypatch.context() as m:
        m.setattr(pl, "load_silver", counted)
        m.setattr(snap, "write_json", stopping)
        if where == "before the post-process":
            m.setattr(pl.tr, "post_process", lambda *a, **b: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            wave(spark, root)
    assert snap.last_commit(spark, root)["note"]["open"] and ran
    again = []
    with monkeypatch.context() as m:
        m.setattr(pl, "load_silver", lambda s, r, run, *a, **b: again.append(run["sourceid"]) or load(s, r, run, *a, **b))
        wave(spark, root)
    # nothing that was published is loaded twice; C fails and leaves nothing but its entry
    assert "A" in ran and not set(again) & set(ran) - ({"C"} if where == "before its ledger entry" else set())
    assert set(ran) | set(again) == {"A", "B", "C"}
    assert (state(spark, root), silver(spark, root)) == unbroken


def test_logs_keep_few_files_and_their_latest_rows(spark, monkeypatch):
    monkeypatch.setattr(snap, "FAN", 4)  # 66 commits are 4 * 4 * 4 and 2 more
    root, schema = tempfile.mkdtemp(prefix="lakeloom-log-"), "sourceid string, dataflowflag string, targetobject string, latestbatchid long, state string"
    kind = spark.createDataFrame([], schema).schema
    key, want, n = pl.LOG_KEY, {}, 0
    for w in range(66):
        rows = []
        for s in ("a", "b"):
            for batch in {w // 2, max(0, w - 3)}:
                rows.append((s, "f", "t", batch, f"wave {w}"))
                want[s, batch] = f"wave {w}"
        n += len(rows)
        snap.append(spark.createDataFrame(rows, schema), root, "audit", kind, key)
    runs = snap.last_commit(spark, root)["logs"]["audit"]
    assert sorted(r["level"] for r in runs) == [0, 0, 3]
    assert {(r.sourceid, r.latestbatchid): r.state for r in snap.read_latest(spark, root, "audit", kind, key).collect()} == want
    assert snap.read_log(spark, root, "audit", kind).count() == n  # no row is ever dropped
    assert len(glob.glob(f"{root}/audit/*/*/*.parquet")) < 60  # kept runs and those of the last RETAIN commits
    kept = len(glob.glob(f"{root}/_commits/*"))
    assert kept == snap.RETAIN
    superseded = [r for p in glob.glob(f"{root}/audit/*/islast=false") for r in spark.read.parquet(p).collect()]
    assert superseded


def test_the_error_line_is_the_loads_own(spark, tables):
    root = _store(spark, tables, [("A", 1, "raw_to_bronze", "orders", "orders_raw")])

    def source(run):
        return tables.orders.select("no_such_column")  # the line that the log has to name

    line = source.__code__.co_firstlineno + 1
    r = pl.run_waves(spark, root, RunFilter(dataflowflag="raw_to_bronze"), keys_of=lambda r: [], as_of=T, source_of=source)
    assert r[0].line == line and pl.error_log(spark, root).first().errorline == line


def test_a_control_store_without_logs_reads_empty(spark):
    root = tempfile.mkdtemp(prefix="lakeloom-log-")
    pl.init_store(spark, root, *_control(spark), as_of=T)
    assert pl.audit_log(spark, root).count() == pl.error_log(spark, root).count() == 0
    assert keyed.BUCKETS > 0 and snap.published_versions(spark, root, "controlheader") == [1]
