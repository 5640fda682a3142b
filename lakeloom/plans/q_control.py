"""Queries of the due-run selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import control as ctl
from ..operators.checks import duplicate_keys
from ..operators.rowindex import with_row_index
from ..sources.tables import Tables
from .registry import register

_RUN_SELECT = """
SELECT h.sourceid, d.sourcename, d.sourcetype, d.sourceobject, h.depsource, d.loadtype, d.sourceschema,
       d.loadfrequency, h.connectionstr, h.objecttype, h.sourcedelimiter, d.sourcequery, h.apiurl, h.apimethod,
       h.apiaccesstoken, h.apiqueryparameters, h.apirequestbody, h.adlscontainername, h.dldirstructure,
       d.etllastrundate, d.targetobject, h.sourcecallingseq, d.dataflowflag, d.latestbatchid, d.targetschemaname,
       d.targetprocedurename, d.intervaldays
FROM control_header h JOIN control_detail d ON h.sourceid = d.sourceid
WHERE d.dataflowflag = '{flow}' AND d.isreadyforexecution = 1 AND d.isapplicable = 1"""
_FIX = ["control_header", "control_detail"]
_FIXG = ["control_header", "control_detail", "source_groups"]


def _runs(spark, sf_dir, with_null=False, **kw):
    t = Tables(spark, sf_dir)
    f = ctl.RunFilter(**kw)
    return ctl.due_runs(fx.control_header(t), fx.control_detail(t),
                        fx.source_groups(t, with_null=with_null), f)


@register("due_runs", _RUN_SELECT.format(flow="bronze_to_silver"), fixtures=_FIX)
def due_runs(spark, sf_dir):
    """All due bronze_to_silver runs, ordered by header id."""
    return _runs(spark, sf_dir)


@register("due_by_freq", _RUN_SELECT.format(flow="bronze_to_silver") + " AND d.loadfrequency = 'Daily'",
          fixtures=_FIX)
def due_by_freq(spark, sf_dir):
    """Load-frequency filter (P4, second branch)."""
    return _runs(spark, sf_dir, load_frequency="Daily")


@register("due_failed", _RUN_SELECT.format(flow="bronze_to_silver")
          + " AND d.loadfrequency = 'Daily' AND d.flowstatus = 'Failed'", fixtures=_FIX)
def due_failed(spark, sf_dir):
    """Failed-only re-run filter."""
    return _runs(spark, sf_dir, load_frequency="Daily", failed_only=True)


@register("due_by_source", _RUN_SELECT.format(flow="bronze_to_silver")
          + " AND d.sourceid IN (SELECT 'S' || CAST(c_custkey AS VARCHAR) FROM customer"
            " WHERE c_mktsegment = 'AUTOMOBILE')", fixtures=_FIX)
def due_by_source(spark, sf_dir):
    """Source-list filter (P4): the list overrides the frequency filter; here the
    list is data (the sources of one market segment), so it is a semi join."""
    t = Tables(spark, sf_dir)
    srcs = t.customer.where(F.col("c_mktsegment") == "AUTOMOBILE").select(
        F.concat(F.lit("S"), F.col("c_custkey").cast("string")))
    return _runs(spark, sf_dir, sources=srcs, load_frequency="Daily")


@register("due_excl_source", _RUN_SELECT.format(flow="raw_to_bronze")
          + " AND d.loadfrequency = 'Daily' AND d.sourceid NOT IN (SELECT 'S' || CAST(c_custkey AS VARCHAR)"
            " FROM customer WHERE c_mktsegment = 'MACHINERY')", fixtures=_FIX)
def due_excl_source(spark, sf_dir):
    """Exclude-source filter (P5) on the raw_to_bronze flow."""
    t = Tables(spark, sf_dir)
    srcs = t.customer.where(F.col("c_mktsegment") == "MACHINERY").select(
        F.concat(F.lit("S"), F.col("c_custkey").cast("string")))
    return _runs(spark, sf_dir, dataflowflag="raw_to_bronze", load_frequency="Daily", exclude_sources=srcs)


@register("due_by_type", _RUN_SELECT.format(flow="bronze_to_silver") + " AND h.objecttype IN ('Fact')",
          fixtures=_FIX)
def due_by_type(spark, sf_dir):
    """Object-type filter."""
    return _runs(spark, sf_dir, object_type=["Fact"])


@register("due_by_seq", _RUN_SELECT.format(flow="bronze_to_silver") + " AND h.sourcecallingseq IN (1, 3)",
          fixtures=_FIX)
def due_by_seq(spark, sf_dir):
    """Calling-sequence filter; the CLI gives text, the column is an integer."""
    return _runs(spark, sf_dir, calling_sequence=ctl.split_list("1|3", "|"))


_IN_GROUP = ("SELECT DISTINCT sourceid FROM source_groups WHERE schemaname = 'dwh'"
             " AND sourcegroup IN ({groups})")


@register("due_by_group", _RUN_SELECT.format(flow="bronze_to_silver") + " AND d.loadfrequency = 'Daily'"
          " AND h.sourceid IN (" + _IN_GROUP.format(groups="'BUILDING'") + ")", fixtures=_FIXG)
def due_by_group(spark, sf_dir):
    """Source-group filter: IN-subquery as a semi join."""
    return _runs(spark, sf_dir, load_frequency="Daily", groups=["BUILDING"])


@register("due_by_groups_src", _RUN_SELECT.format(flow="raw_to_bronze") + " AND d.loadfrequency = 'Daily'"
          " AND h.sourceid IN (" + _IN_GROUP.format(groups="'BUILDING', 'HOUSEHOLD'") + ")", fixtures=_FIXG)
def due_by_groups_src(spark, sf_dir):
    """Group filter with a delimited CLI list on the raw_to_bronze flow."""
    return _runs(spark, sf_dir, dataflowflag="raw_to_bronze", load_frequency="Daily",
                 groups=ctl.split_list("BUILDING,HOUSEHOLD"))


@register("due_excl_group", _RUN_SELECT.format(flow="bronze_to_silver") + " AND d.loadfrequency = 'Daily'"
          " AND h.sourceid NOT IN (" + _IN_GROUP.format(groups="'BUILDING'") + ")", fixtures=_FIXG)
def due_excl_group(spark, sf_dir):
    """Exclude-group filter: NOT IN subquery with SQL NULL semantics."""
    return _runs(spark, sf_dir, load_frequency="Daily", exclude_groups=["BUILDING"])


@register("due_excl_group_null", _RUN_SELECT.format(flow="bronze_to_silver") + " AND d.loadfrequency = 'Daily'"
          " AND h.sourceid NOT IN (SELECT DISTINCT sourceid FROM (SELECT * FROM source_groups UNION ALL"
          " SELECT NULL, 'dwh', 'BUILDING', 1, 'Completed', NULL, NULL, NULL) g"
          " WHERE schemaname = 'dwh' AND sourcegroup IN ('BUILDING'))", fixtures=_FIXG)
def due_excl_group_null(spark, sf_dir):
    """NOT IN over a group list that holds a NULL id: no run qualifies."""
    return _runs(spark, sf_dir, with_null=True, load_frequency="Daily", exclude_groups=["BUILDING"])


@register("due_count", "SELECT CAST(count(*) AS BIGINT) AS n_runs FROM ("
          + _RUN_SELECT.format(flow="bronze_to_silver") + " AND d.loadfrequency = 'Daily') x", fixtures=_FIX)
def due_count(spark, sf_dir):
    """Number of due runs."""
    return _runs(spark, sf_dir, load_frequency="Daily").agg(F.count(F.lit(1)).alias("n_runs"))


@register("list_sources", "SELECT dataflowflag || ' => ' || sourceid AS line FROM ("
          + _RUN_SELECT.format(flow="bronze_to_silver") + ") x", fixtures=_FIX)
def list_sources(spark, sf_dir):
    """``flow => source`` listing of the due runs."""
    return ctl.list_sources(_runs(spark, sf_dir))


@register("run_waves", "SELECT sourcecallingseq, CAST(count(*) AS BIGINT) AS n_runs FROM ("
          + _RUN_SELECT.format(flow="bronze_to_silver") + ") x WHERE sourcecallingseq IS NOT NULL"
          " GROUP BY sourcecallingseq", fixtures=_FIX)
def run_waves(spark, sf_dir):
    """Waves: sorted distinct calling sequences with their runs."""
    return ctl.run_waves(_runs(spark, sf_dir))


@register("run_metadata", """
SELECT x.*, m.jobname, m.envsourcecode, m.datasourcecode, m.latestbatchid AS p_batchid,
       m.targetprocedurename AS p_taskname, m.rawstorageflag
FROM (""" + _RUN_SELECT.format(flow="bronze_to_silver") + """) x
LEFT JOIN (SELECT d.*, h.envsourcecode, h.datasourcecode, h.rawstorageflag
           FROM control_detail d JOIN control_header h ON d.sourceid = h.sourceid) m
  ON x.sourceid = m.sourceid AND x.dataflowflag = m.dataflowflag AND x.targetobject = m.targetobject""",
          fixtures=_FIX)
def run_metadata(spark, sf_dir):
    """Run metadata of every due run: detail JOIN header, 3-key match."""
    t = Tables(spark, sf_dir)
    return ctl.run_metadata(_runs(spark, sf_dir), fx.control_header(t), fx.control_detail(t))


@register("left_join_star", "SELECT * FROM nation LEFT JOIN supplier ON nation.n_nationkey = supplier.s_nationkey")
def left_join_star(spark, sf_dir):
    """``SELECT * FROM tab LEFT JOIN tab2 ON tab.id = tab2.tab_id``."""
    t = Tables(spark, sf_dir)
    return t.nation.join(t.supplier, F.col("n_nationkey") == F.col("s_nationkey"), "left")


@register("dq_control_keys", """
WITH h AS (FROM control_header UNION ALL FROM control_header WHERE objecttype = 'Fact'),
d AS (FROM control_detail UNION ALL FROM control_detail WHERE loadfrequency = 'Weekly')
SELECT 'controlheader' AS table_name, sourceid || '|' || sourcename AS key_value, CAST(count(*) AS BIGINT) AS n
FROM h GROUP BY sourceid, sourcename HAVING count(*) > 1
UNION ALL
SELECT 'controldetail', sourceid || '|' || dataflowflag, CAST(count(*) AS BIGINT)
FROM d GROUP BY sourceid, dataflowflag HAVING count(*) > 1""", fixtures=_FIX)
def dq_control_keys(spark, sf_dir):
    """Unique keys of the control tables: (sourceid, sourcename), (sourceid, dataflowflag) (Q4).
    The facts' headers and the weekly details have been entered twice."""
    t = Tables(spark, sf_dir)
    h, d = fx.control_header(t), fx.control_detail(t)
    h = h.unionByName(h.where("objecttype = 'Fact'"))
    d = d.unionByName(d.where("loadfrequency = 'Weekly'"))
    a = duplicate_keys(h, ["sourceid", "sourcename"]).select(
        F.lit("controlheader").alias("table_name"),
        F.concat_ws("|", "sourceid", "sourcename").alias("key_value"), "n")
    b = duplicate_keys(d, ["sourceid", "dataflowflag"]).select(
        F.lit("controldetail").alias("table_name"),
        F.concat_ws("|", "sourceid", "dataflowflag").alias("key_value"), "n")
    return a.unionByName(b)


@register("due_order", """
SELECT h.sourceid, d.targetobject, row_number() OVER (ORDER BY h.id NULLS LAST, d.targetobject NULLS LAST) AS position
FROM control_header h JOIN control_detail d ON h.sourceid = d.sourceid
WHERE d.dataflowflag = 'bronze_to_silver' AND d.isreadyforexecution = 1 AND d.isapplicable = 1""", fixtures=_FIX)
def due_order(spark, sf_dir):
    """The order in which the due runs come (O1), as a position."""
    runs = _runs(spark, sf_dir).select("sourceid", "targetobject", F.monotonically_increasing_id().alias("_at"))
    return with_row_index(runs, ["_at"], name="position").drop("_at")


@register("split_list", """
SELECT p_partkey, CAST(generate_subscripts(string_split(p_name, ' '), 1) AS BIGINT) AS pos,
       unnest(string_split(p_name, ' ')) AS item
FROM part""")
def split_list(spark, sf_dir):
    """Delimited list values arriving as data, split and exploded (P10)."""
    return ctl.split_list_column(Tables(spark, sf_dir).part, "p_name", " ", ["p_partkey"])

