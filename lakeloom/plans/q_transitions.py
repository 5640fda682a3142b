"""Queries of the run-state transitions.

Chain: one run request per order -> pre-process (batch ids, 'Started') ->
post-process (orders with status 'F' raised an error in their batch) -> error
transition; every table version is a query.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import transitions as tr
from ..sources.tables import Tables
from .fixture_sql import AS_OF_SQL
from .registry import register

_FIX = ["control_header", "control_detail", "source_groups", "run_requests"]
_KEY = "sourceid, dataflowflag, targetobject"


def _j(a: str, b: str) -> str:
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in ("sourceid", "dataflowflag", "targetobject"))


_CHAIN = f"""
WITH runs AS (
  SELECT q.*, CASE WHEN d.sourceid IS NOT NULL THEN CAST(coalesce(d.latestbatchid, 0) + row_number() OVER (
           PARTITION BY q.sourceid, q.dataflowflag, q.targetobject ORDER BY q.loadstarttime, q.runid) AS BIGINT)
         END AS batchid
  FROM run_requests q LEFT JOIN (SELECT * FROM control_detail WHERE isapplicable = 1) d ON {_j('q', 'd')}),
lastb AS (SELECT {_KEY}, max(batchid) AS nb FROM runs WHERE batchid IS NOT NULL GROUP BY {_KEY}),
detail1 AS (
  SELECT d.* REPLACE (
    CASE WHEN l.nb IS NOT NULL AND d.isapplicable = 1 THEN l.nb ELSE d.latestbatchid END AS latestbatchid,
    CASE WHEN l.nb IS NOT NULL AND d.isapplicable = 1 THEN 'Started' ELSE d.flowstatus END AS flowstatus)
  FROM control_detail d LEFT JOIN lastb l ON {_j('d', 'l')}),
header1 AS (
  SELECT h.* REPLACE (
    CASE WHEN r.sourceid IS NOT NULL AND h.isapplicable = 1 THEN 'Started' ELSE h.status END AS status,
    CASE WHEN r.sourceid IS NOT NULL AND h.isapplicable = 1 THEN {AS_OF_SQL} ELSE h.lastupdateddate END
      AS lastupdateddate)
  FROM control_header h LEFT JOIN (SELECT DISTINCT sourceid FROM run_requests) r ON h.sourceid = r.sourceid),
groups1 AS (
  SELECT g.* REPLACE (
    CASE WHEN r.sourceid IS NOT NULL AND g.schemaname = 'dwh' AND g.isapplicable = 1 THEN 'Started'
         ELSE g.status END AS status,
    CASE WHEN r.sourceid IS NOT NULL AND g.schemaname = 'dwh' AND g.isapplicable = 1 THEN {AS_OF_SQL}
         ELSE g.loadstartdatetime END AS loadstartdatetime)
  FROM source_groups g
  LEFT JOIN (SELECT DISTINCT sourceid FROM run_requests WHERE dataflowflag = 'raw_to_bronze') r
    ON g.sourceid = r.sourceid),
audit1 AS (
  SELECT d.sourcename, d.sourcetype, d.sourcedescription, d.sourceobject, q.sourceid, q.dataflowflag,
         CAST(0 AS BIGINT) AS srcrwcnt, CAST(0 AS BIGINT) AS srcdelcnt, CAST(NULL AS BIGINT) AS tgtinscnt,
         CAST(NULL AS BIGINT) AS tgtdelcnt, CAST(NULL AS BIGINT) AS tgtupdcnt, 'Started' AS flowstatus,
         d.targetname, d.targetschemaname, q.targetobject, d.targetprocedurename,
         {AS_OF_SQL} AS createddate, CAST(NULL AS TIMESTAMP) AS updateddate, q.loadstarttime,
         CAST(NULL AS TIMESTAMP) AS loadendtime, q.batchid AS latestbatchid, d.loadtype, q.etlbatchid,
         'Python' AS useragent, 1 AS sourcegroupflag
  FROM runs q JOIN control_detail d ON {_j('q', 'd')} AND d.isapplicable = 1),
events AS (
  SELECT r.sourceid, r.dataflowflag, r.targetobject, r.batchid, -1 AS errorid,
         'RuntimeError: ' || o.o_orderpriority AS errordesc
  FROM orders o JOIN runs r ON r.runid = o.o_orderkey WHERE o.o_orderstatus = 'F'),
errs AS (
  SELECT d.sourcename, d.sourcetype, d.sourcedescription, d.sourceid, d.sourceobject, d.dataflowflag,
         d.targetname, d.targetschemaname, d.targetobject, d.targetprocedurename,
         'stg_to_dwh' AS taskname,
         CASE lower(substr(d.dataflowflag, 1, 3)) WHEN 'raw' THEN 'raw_to_bronze' WHEN 'bro' THEN 'bronze_to_silver'
              ELSE 'dwhtoclick' END || '.operation' AS packagename,
         d.jobname, CAST(e.errorid AS INTEGER) AS errorid, e.errordesc, CAST(NULL AS INTEGER) AS errorline,
         {AS_OF_SQL} AS errordate, CAST(coalesce(e.batchid, d.latestbatchid) AS BIGINT) AS latestbatchid
  FROM control_detail d JOIN events e ON {_j('d', 'e')}
  UNION ALL
  SELECT 'onesource', 'PostgreSQL', 'PostgreSQL', sourceid, sourceid, dataflowflag, 'click', 'click', targetobject, NULL,
         'stg_to_dwh', 'dwhtoclick.operation', NULL, CAST(errorid AS INTEGER), errordesc, NULL, {AS_OF_SQL}, batchid
  FROM events WHERE dataflowflag = 'silver_to_gold'),
oc AS (
  SELECT r.*, CAST(coalesce(e.n, 0) AS BIGINT) AS n_errors, coalesce(e.n, 0) > 0 AS failed
  FROM runs r LEFT JOIN (SELECT {_KEY}, latestbatchid, count(*) AS n FROM errs
                         GROUP BY {_KEY}, latestbatchid) e
    ON {_j('r', 'e')} AND r.batchid = e.latestbatchid),
ranked AS (
  SELECT oc.*,
         CASE WHEN failed THEN 'Failed' WHEN dataflowflag = 'raw_to_bronze' THEN 'Started'
              WHEN dataflowflag = 'bronze_to_silver' THEN 'Completed' END AS gstatus,
         CASE WHEN failed THEN 'Failed' WHEN dataflowflag = 'raw_to_bronze' THEN 'Started'
              WHEN dataflowflag = 'bronze_to_silver' THEN 'Completed'
              WHEN runid IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') THEN 'Failed' END AS hstatus
  FROM oc),
lastrun AS (
  SELECT sourceid, hstatus FROM ranked
  QUALIFY row_number() OVER (PARTITION BY sourceid ORDER BY loadstarttime DESC, batchid DESC NULLS LAST, runid DESC) = 1),
lastgroup AS (
  SELECT sourceid, gstatus FROM ranked WHERE gstatus IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY sourceid ORDER BY loadstarttime DESC, batchid DESC NULLS LAST, runid DESC) = 1),
lastok AS (
  SELECT sourceid, dataflowflag AS lastflow FROM (
    SELECT *, row_number() OVER (PARTITION BY sourceid
                                 ORDER BY loadstarttime DESC, batchid DESC NULLS LAST, runid DESC) AS rn
    FROM ranked WHERE NOT failed AND dataflowflag IN ('raw_to_bronze', 'bronze_to_silver')) x WHERE rn = 1),
srcflags AS (
  SELECT sourceid, max(CASE WHEN sourceid IN (SELECT sourceid FROM events) THEN 1 ELSE 0 END) AS anyfail,
         max(CASE WHEN NOT failed AND dataflowflag = 'bronze_to_silver' THEN 1 ELSE 0 END) AS anybrn,
         max(CASE WHEN failed OR dataflowflag = 'bronze_to_silver' THEN 1 ELSE 0 END) AS anyend
  FROM oc GROUP BY sourceid),
lastkey AS (
  SELECT sourceid, dataflowflag, targetobject, failed AS lastfailed FROM (
    SELECT *, row_number() OVER (PARTITION BY sourceid, dataflowflag, targetobject
                                 ORDER BY loadstarttime DESC, batchid DESC NULLS LAST, runid DESC) AS rn
    FROM oc WHERE batchid IS NOT NULL) x WHERE rn = 1),
anyok AS (
  SELECT sourceid, dataflowflag, targetobject, max(CASE WHEN NOT failed THEN 1 ELSE 0 END) AS anyok
  FROM oc WHERE batchid IS NOT NULL GROUP BY sourceid, dataflowflag, targetobject),
header2 AS (
  SELECT h.* REPLACE (
    CASE WHEN l.sourceid IS NOT NULL AND h.isapplicable = 1 THEN coalesce(l.hstatus, h.status)
         WHEN h.isapplicable <> 1 AND f.anyfail = 1 THEN 'Failed' ELSE h.status END AS status,
    CASE WHEN h.sourceid IN (SELECT sourceid FROM lastgroup) AND h.isapplicable = 1 THEN {AS_OF_SQL}
         ELSE h.lastupdateddate END AS lastupdateddate)
  FROM header1 h LEFT JOIN lastrun l ON h.sourceid = l.sourceid LEFT JOIN srcflags f ON h.sourceid = f.sourceid),
detail2 AS (
  SELECT d.* REPLACE (
    CASE WHEN d.isapplicable = 1 AND k.lastflow = 'raw_to_bronze' AND d.dataflowflag = 'raw_to_bronze' THEN 0
         WHEN d.isapplicable = 1 AND k.lastflow = 'raw_to_bronze' AND d.dataflowflag = 'bronze_to_silver' THEN 1
         WHEN d.isapplicable = 1 AND k.lastflow = 'bronze_to_silver' AND d.dataflowflag = 'bronze_to_silver' THEN 0
         WHEN d.isapplicable = 1 AND k.lastflow = 'bronze_to_silver' AND d.dataflowflag = 'raw_to_bronze' THEN 1
         ELSE d.isreadyforexecution END AS isreadyforexecution,
    CASE WHEN d.isapplicable = 1 AND z.sourceid IS NOT NULL
         THEN CASE WHEN z.lastfailed THEN 'Failed' ELSE 'Completed' END ELSE d.flowstatus END AS flowstatus,
    CASE WHEN d.isapplicable = 1 AND z.sourceid IS NOT NULL AND a.anyok = 1 THEN {AS_OF_SQL}
         ELSE d.etllastrundate END AS etllastrundate)
  FROM detail1 d LEFT JOIN lastok k ON d.sourceid = k.sourceid
  LEFT JOIN lastkey z ON {_j('d', 'z')}
  LEFT JOIN anyok a ON {_j('d', 'a')}),
groups2 AS (
  SELECT g.* REPLACE (
    CASE WHEN l.sourceid IS NOT NULL AND g.schemaname = 'dwh' AND g.isapplicable = 1 THEN l.gstatus
         ELSE g.status END AS status,
    CASE WHEN f.sourceid IS NOT NULL AND g.schemaname = 'dwh' AND g.isapplicable = 1
              AND f.anybrn = 1 THEN {AS_OF_SQL} ELSE g.lastrundatetime END AS lastrundatetime,
    CASE WHEN f.sourceid IS NOT NULL AND g.schemaname = 'dwh' AND g.isapplicable = 1
              AND f.anyend = 1 THEN {AS_OF_SQL} ELSE g.loadenddatetime END AS loadenddatetime)
  FROM groups1 g LEFT JOIN lastgroup l ON g.sourceid = l.sourceid LEFT JOIN srcflags f ON g.sourceid = f.sourceid),
audit2 AS (
  SELECT a.* REPLACE (
    CASE WHEN o.batchid IS NOT NULL THEN o.srccnt ELSE a.srcrwcnt END AS srcrwcnt,
    CASE WHEN o.batchid IS NOT NULL THEN o.inscnt ELSE a.tgtinscnt END AS tgtinscnt,
    CASE WHEN o.batchid IS NOT NULL THEN o.updcnt ELSE a.tgtupdcnt END AS tgtupdcnt,
    CASE WHEN o.batchid IS NOT NULL THEN CASE WHEN o.failed THEN 'Failed' ELSE 'Completed' END
         ELSE a.flowstatus END AS flowstatus,
    CASE WHEN o.batchid IS NOT NULL THEN {AS_OF_SQL} ELSE a.updateddate END AS updateddate,
    CASE WHEN o.batchid IS NOT NULL THEN {AS_OF_SQL} ELSE a.loadendtime END AS loadendtime)
  FROM audit1 a LEFT JOIN oc o ON {_j('a', 'o')} AND a.latestbatchid = o.batchid)
"""


class _Chain:
    def __init__(self, spark, sf_dir):
        t = Tables(spark, sf_dir)
        self.t = t
        self.detail0 = fx.control_detail(t)
        self.header0 = fx.control_header(t)
        self.groups0 = fx.source_groups(t)
        self.requests = fx.run_requests(t)
        self._pre = None

    @property
    def pre(self):
        if self._pre is None:
            self._pre = tr.pre_process(self.requests, self.detail0, self.header0, self.groups0,
                                       as_of=fx.AS_OF)
        return self._pre

    def events(self):
        o = self.t.orders.where(F.col("o_orderstatus") == "F").select(
            F.col("o_orderkey").alias("_runid"), F.lit(-1).alias("errorid"),
            F.concat(F.lit("RuntimeError: "), F.col("o_orderpriority")).alias("errordesc"))
        r = self.pre.runs.select(*tr.RUN_KEY, "batchid", "runid")
        return r.join(fx.grown(o), F.col("runid") == F.col("_runid"), "inner").drop("_runid")

    def errors(self):
        return tr.error_rows(self.events(), self.detail0, as_of=fx.AS_OF)

    def post(self):
        p = self.pre
        raised = self.t.orders.where(F.col("o_orderstatus") == "F").select(
            F.col("o_orderkey").alias("_rk"), F.lit(True).alias("_raised"))
        outcomes = p.runs.join(fx.grown(raised), F.col("runid") == F.col("_rk"), "left").select(
            *p.runs.columns, F.coalesce(F.col("_raised"), F.lit(False)).alias("raised"))
        return tr.post_process(outcomes, self.errors(), p.detail, p.header, p.groups, p.audit_rows,
                               as_of=fx.AS_OF)


def _q(name: str, body: str):
    return register(name, _CHAIN + body, fixtures=_FIX)


@_q("next_batch", "SELECT sourceid, dataflowflag, targetobject, runid, batchid FROM runs")
def next_batch(spark, sf_dir):
    """Batch id per run request: latest + 1, + position among same-key requests."""
    return _Chain(spark, sf_dir).pre.runs.select(*tr.RUN_KEY, "runid", "batchid")


@_q("detail_after_pre", "SELECT * FROM detail1")
def detail_after_pre(spark, sf_dir):
    """Control detail after the pre-process: new batch, 'Started' (C2, K5)."""
    return _Chain(spark, sf_dir).pre.detail


@_q("header_after_pre", "SELECT * FROM header1")
def header_after_pre(spark, sf_dir):
    """Control header after the pre-process."""
    return _Chain(spark, sf_dir).pre.header


@_q("groups_after_pre", "SELECT * FROM groups1")
def groups_after_pre(spark, sf_dir):
    """Source groups after the pre-process: raw_to_bronze runs start their group."""
    return _Chain(spark, sf_dir).pre.groups


@_q("audit_start", "SELECT * FROM audit1")
def audit_start(spark, sf_dir):
    """Audit rows appended by the pre-process, one per run (K3)."""
    return _Chain(spark, sf_dir).pre.audit_rows


@_q("error_rows", "SELECT * FROM errs")
def error_rows(spark, sf_dir):
    """Error rows of the failed runs, copied from their control detail (C4, K4)."""
    return _Chain(spark, sf_dir).errors()


@_q("batch_errors", "SELECT sourceid, dataflowflag, targetobject, runid, batchid, n_errors FROM oc")
def batch_errors(spark, sf_dir):
    """Error count of each finished run's batch, 0 if none (A3)."""
    c = _Chain(spark, sf_dir)
    return tr.batch_errors(c.pre.runs, c.errors()).select(*tr.RUN_KEY, "runid", "batchid", "n_errors")


@_q("detail_after_post", "SELECT * FROM detail2")
def detail_after_post(spark, sf_dir):
    """Control detail after the post-process: ready flags flipped, flow status."""
    return _Chain(spark, sf_dir).post().detail


@_q("header_after_post", "SELECT * FROM header2")
def header_after_post(spark, sf_dir):
    """Control header after the post-process: the last run of each source decides."""
    return _Chain(spark, sf_dir).post().header


@_q("groups_after_post", "SELECT * FROM groups2")
def groups_after_post(spark, sf_dir):
    """Source groups after the post-process."""
    return _Chain(spark, sf_dir).post().groups


@_q("audit_after_post", "SELECT * FROM audit2")
def audit_after_post(spark, sf_dir):
    """Audit rows with counts, status and end time."""
    return _Chain(spark, sf_dir).post().audit


@_q("control_after_post", """
SELECT flowstatus, isreadyforexecution, CAST(count(*) AS BIGINT) AS n
FROM detail2 GROUP BY flowstatus, isreadyforexecution""")
def control_after_post(spark, sf_dir):
    """Summary of the rewritten control-detail snapshot (K5)."""
    d = _Chain(spark, sf_dir).post().detail
    return d.groupBy("flowstatus", "isreadyforexecution").agg(F.count(F.lit(1)).alias("n"))


@_q("header_after_error", """
SELECT h.* REPLACE (CASE WHEN e.sourceid IS NOT NULL THEN 'Failed' ELSE h.status END AS status)
FROM control_header h LEFT JOIN (SELECT DISTINCT sourceid FROM events) e ON h.sourceid = e.sourceid""")
def header_after_error(spark, sf_dir):
    """Header after the error transition: 'Failed', no applicability test (C4)."""
    c = _Chain(spark, sf_dir)
    return tr.error_transition(c.events(), c.detail0, c.header0, None, as_of=fx.AS_OF)[2]


@_q("detail_after_error", """
SELECT d.* REPLACE (CASE WHEN e.sourceid IS NOT NULL THEN 'Failed' ELSE d.flowstatus END AS flowstatus)
FROM detail1 d LEFT JOIN (SELECT DISTINCT sourceid, dataflowflag, targetobject, batchid FROM events) e
  ON d.sourceid = e.sourceid AND d.dataflowflag = e.dataflowflag AND d.targetobject = e.targetobject
 AND d.latestbatchid = e.batchid""")
def detail_after_error(spark, sf_dir):
    """Detail after the error transition: the failed batch's row becomes 'Failed' (C4)."""
    c = _Chain(spark, sf_dir)
    return tr.error_transition(c.events(), c.pre.detail, c.header0, None, as_of=fx.AS_OF)[1]


@_q("audit_after_error", """
SELECT a.* REPLACE (CASE WHEN e.sourceid IS NOT NULL THEN 'Failed' ELSE a.flowstatus END AS flowstatus)
FROM audit1 a LEFT JOIN (SELECT DISTINCT sourceid, dataflowflag, targetobject, batchid FROM events) e
  ON a.sourceid = e.sourceid AND a.dataflowflag = e.dataflowflag AND a.targetobject = e.targetobject
 AND a.latestbatchid = e.batchid""")
def audit_after_error(spark, sf_dir):
    """Audit after the error transition: the failed batch's row becomes 'Failed' (C4)."""
    c = _Chain(spark, sf_dir)
    return tr.error_transition(c.events(), c.pre.detail, c.header0, c.pre.audit_rows, as_of=fx.AS_OF)[3]


@_q("latest_audit", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sourceid, dataflowflag, targetobject
                                           ORDER BY latestbatchid DESC) AS rn FROM audit2) x
WHERE rn = 1""".replace("SELECT * FROM (", "SELECT * EXCLUDE (rn) FROM ("))
def latest_audit(spark, sf_dir):
    """Latest state of each run key from the append-only audit log."""
    return tr.latest_audit(_Chain(spark, sf_dir).post().audit)


@_q("run_durations", """
SELECT sourceid, dataflowflag, targetobject, latestbatchid, flowstatus,
       CAST(epoch_us(loadendtime) - epoch_us(loadstarttime) AS BIGINT) AS elapsed_us
FROM audit2 WHERE loadendtime IS NOT NULL""")
def run_durations(spark, sf_dir):
    """Elapsed time of every finished run from the audit log."""
    return tr.run_durations(_Chain(spark, sf_dir).post().audit)
