"""Run-state transitions around a load, for many runs at once.

The loader calls a pre-process, the load, then a post-process (or the error
transition) once per run, each a handful of UPDATE/INSERT statements.  Here each
transition takes a DataFrame of runs and returns the new versions of the control
detail, control header, source groups and audit tables.

Several runs may touch the same row (two runs of one source in one batch).  The
sequential outcome is rebuilt by reducing the runs per row key first - the last
run in (loadstarttime, batchid, runid) order wins - with ``max(struct(...))``,
a partial aggregation, so a source owning many runs is combined map-side
instead of being pulled into one task by a window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import FLOWS, Flows, batch_token, elapsed_micros, flow_module
from .rowindex import with_row_index

RUN_KEY = ["sourceid", "dataflowflag", "targetobject"]

# Task name of a failed load, and the second error row the
# gold flow always adds (source name, source type/description, target names).
TASK_NAME = "stg_to_dwh"
GOLD_ERROR_SOURCE = ("onesource", "PostgreSQL", "PostgreSQL")
GOLD_ERROR_TARGET = ("click", "click")
ORDER = ["loadstarttime", "batchid", "runid"]


def _ts(v) -> Column:
    if isinstance(v, Column):
        return v
    return F.current_timestamp().cast("timestamp_ntz") if v is None else F.lit(v).cast("timestamp_ntz")


# --------------------------------------------------------------------- pre

def assign_batches(requests: DataFrame, detail: DataFrame) -> DataFrame:
    """Batch id of each run request: ``COALESCE(latestbatchid, 0) + 1`` from the
    applicable detail row, plus the request's position among the requests of
    the same run key (W1).  No applicable row -> NULL batch."""
    d = detail.where(F.col("isapplicable") == 1).select(
        *[F.col(k).alias(f"_d_{k}") for k in RUN_KEY], F.col("latestbatchid").alias("_latest"))
    cond = F.lit(True)
    for k in RUN_KEY:
        cond = cond & (F.col(k) == F.col(f"_d_{k}"))
    r = with_row_index(requests, ["loadstarttime", "runid"], name="_k", group_by=RUN_KEY)
    r = r.join(d, cond, "left")
    return r.withColumn("batchid", F.when(F.col("_d_sourceid").isNotNull(),
                                          F.coalesce(F.col("_latest"), F.lit(0)) + F.col("_k"))
                        .cast("long")).drop("_k", "_latest", *[f"_d_{k}" for k in RUN_KEY])


@dataclass
class PreResult:
    runs: DataFrame      # requests with batchid
    detail: DataFrame
    header: DataFrame
    groups: DataFrame
    audit_rows: DataFrame


def pre_process(requests: DataFrame, detail: DataFrame, header: DataFrame, groups: DataFrame,
                as_of=None, useragent: str = "Python", sourcegroupflag: int = 1, flows: Flows = FLOWS) -> PreResult:
    """Pre-process transition (C2) for every request in ``requests``
    (sourceid, dataflowflag, targetobject, loadstarttime, runid[, srccnt, etlbatchid])."""
    now = _ts(as_of)
    runs = assign_batches(requests, detail)
    # detail: last batch of each run key, FlowStatus 'Started'
    last = runs.where(F.col("batchid").isNotNull()).groupBy(*RUN_KEY).agg(
        F.max("batchid").alias("_nb"))
    dj = detail.join(last.select(*[F.col(k).alias(f"_l_{k}") for k in RUN_KEY], "_nb"),
                     [F.col(k) == F.col(f"_l_{k}") for k in RUN_KEY], "left")
    hit = F.col("_nb").isNotNull() & (F.col("isapplicable") == 1)
    new_detail = dj.select(*[
        (F.when(hit, F.col("_nb")).otherwise(F.col(c)).cast(t) if c == "latestbatchid" else
         F.when(hit, F.lit("Started")).otherwise(F.col(c)) if c == "flowstatus" else F.col(c)).alias(c)
        for c, t in detail.dtypes])
    # header: 'Started' for every source with a run
    srcs = requests.select(F.col("sourceid").alias("_r_sourceid")).distinct()
    new_header = _touch_header(header, srcs, F.lit("Started"), now)
    # groups: 'Started' for raw_to_bronze runs when the group flag is set
    if sourcegroupflag == 1:
        gs = requests.where(F.col("dataflowflag") == flows.bronze).select(
            F.col("sourceid").alias("_r_sourceid")).distinct()
        gj = groups.join(gs, F.col("sourceid") == F.col("_r_sourceid"), "left")
        ghit = (F.col("_r_sourceid").isNotNull() & (F.col("schemaname") == "dwh")
                & (F.col("isapplicable") == 1))
        new_groups = gj.select(*[
            (F.when(ghit, F.lit("Started")).otherwise(F.col(c)) if c == "status" else
             F.when(ghit, now).otherwise(F.col(c)) if c == "loadstartdatetime" else F.col(c)).alias(c)
            for c in groups.columns])
    else:
        new_groups = groups
    # audit rows: one per run whose detail row is applicable
    dcols = detail.where(F.col("isapplicable") == 1).select(
        *[F.col(k).alias(f"_d_{k}") for k in RUN_KEY],
        *[F.col(c).alias(f"_d_{c}") for c in ("sourcename", "sourcetype", "sourcedescription",
                                                "sourceobject", "targetname", "targetschemaname",
                                                "targetprocedurename", "loadtype")])
    aj = runs.join(dcols, [F.col(k) == F.col(f"_d_{k}") for k in RUN_KEY], "inner")
    has = set(runs.columns)
    audit_rows = aj.select(
        F.col("_d_sourcename").alias("sourcename"), F.col("_d_sourcetype").alias("sourcetype"),
        F.col("_d_sourcedescription").alias("sourcedescription"),
        F.col("_d_sourceobject").alias("sourceobject"), "sourceid", "dataflowflag",
        (F.col("sourcecount") if "sourcecount" in has else F.lit(0)).cast("long").alias("srcrwcnt"),
        F.lit(0).cast("long").alias("srcdelcnt"), F.lit(None).cast("long").alias("tgtinscnt"),
        F.lit(None).cast("long").alias("tgtdelcnt"), F.lit(None).cast("long").alias("tgtupdcnt"),
        F.lit("Started").alias("flowstatus"), F.col("_d_targetname").alias("targetname"),
        F.col("_d_targetschemaname").alias("targetschemaname"), "targetobject",
        F.col("_d_targetprocedurename").alias("targetprocedurename"),
        now.alias("createddate"), F.lit(None).cast("timestamp_ntz").alias("updateddate"),
        (F.col("loadstarttime").cast("timestamp_ntz") if "loadstarttime" in has else now).alias("loadstarttime"),
        F.lit(None).cast("timestamp_ntz").alias("loadendtime"),
        F.col("batchid").alias("latestbatchid"), F.col("_d_loadtype").alias("loadtype"),
        (F.col("etlbatchid") if "etlbatchid" in has else batch_token()).alias("etlbatchid"),
        F.lit(useragent).alias("useragent"), F.lit(sourcegroupflag).alias("sourcegroupflag"))
    return PreResult(runs, new_detail, new_header, new_groups, audit_rows)


def _touch_header(header: DataFrame, srcs: DataFrame, status: Column, now: Column,
                  applicable_only: bool = True) -> DataFrame:
    hj = header.join(srcs, F.col("sourceid") == F.col("_r_sourceid"), "left")
    hit = F.col("_r_sourceid").isNotNull()
    if applicable_only:
        hit = hit & (F.col("isapplicable") == 1)
    return hj.select(*[
        (F.when(hit, status).otherwise(F.col(c)) if c == "status" else
         F.when(hit, now).otherwise(F.col(c)) if c == "lastupdateddate" else F.col(c)).alias(c)
        for c in header.columns])


# -------------------------------------------------------------------- post

def batch_errors(outcomes: DataFrame, errors: DataFrame) -> DataFrame:
    """Error rows per finished run, 0 when none (A3): counted per run key first,
    then left-joined, so an error-heavy source never fans out."""
    ec = errors.groupBy(F.col("sourceid").alias("_e_s"), F.col("dataflowflag").alias("_e_f"),
                        F.col("targetobject").alias("_e_t"),
                        F.col("latestbatchid").alias("_e_b")).agg(F.count(F.lit(1)).alias("_n"))
    cond = ((F.col("sourceid") == F.col("_e_s")) & (F.col("dataflowflag") == F.col("_e_f"))
            & (F.col("targetobject") == F.col("_e_t")) & (F.col("batchid") == F.col("_e_b")))
    j = outcomes.join(ec, cond, "left")
    return j.select(*outcomes.columns, F.coalesce(F.col("_n"), F.lit(0)).cast("long").alias("n_errors"))


@dataclass
class PostResult:
    outcomes: DataFrame  # with n_errors and failed flag
    detail: DataFrame
    header: DataFrame
    groups: DataFrame
    audit: DataFrame


def post_process(outcomes: DataFrame, errors: DataFrame, detail: DataFrame, header: DataFrame,
                 groups: DataFrame, audit: DataFrame, as_of=None,
                 sourcegroupflag: int = 1, flows: Flows = FLOWS) -> PostResult:
    """Post-process transition (C3) for finished runs ``outcomes``
    (sourceid, dataflowflag, targetobject, batchid, loadstarttime, runid,
    srccnt, inscnt, updcnt[, raised]); a run with an error row of its batch
    takes the failed path.

    The result equals running pre-process, load, (error) and post-process run
    after run in (loadstarttime, batchid, runid) order:
      * header (applicable): status of the source's last run (a completed run of
        another flow than these two leaves what its pre-process set) - a completed
        raw_to_bronze run leaves 'Started', a completed bronze_to_silver run 'Completed', a
        failed run 'Failed'; a header that is not applicable only becomes
        'Failed' when one of its runs raised (the error transition has no
        applicability test);
      * detail (applicable): ready flags from the source's last completed run;
        flow status of the row's last run; etllastrundate when any run of the
        row completed;
      * groups (flag set): status of the source's last run of these two flows or
        last failed one, same mapping;
        lastrundatetime when a bronze_to_silver run completed, loadenddatetime when a
        bronze_to_silver run completed or any run failed;
      * audit: each run's own row gets its counts, status and end time.
    """
    now = _ts(as_of)
    oc = batch_errors(outcomes, errors).withColumn("failed", F.col("n_errors") > 0)
    # ``raised``: the load threw (its error transition ran); without the column,
    # a run raised exactly when it failed
    raised = F.col("raised") if "raised" in outcomes.columns else F.col("failed")
    ok = ~F.col("failed")
    is_src = F.col("dataflowflag") == flows.bronze
    is_brn = F.col("dataflowflag") == flows.silver
    # a completed run of another flow changes neither header nor groups
    status_of = (F.when(F.col("failed"), "Failed").when(is_src, "Started").when(is_brn, "Completed"))
    header_of = status_of.when(raised, "Failed")
    order = [F.col(c) for c in ORDER]
    # one partial aggregation per source and one per run key (max of structs)
    src = oc.groupBy(F.col("sourceid").alias("_p_sourceid")).agg(
        F.max(F.when(status_of.isNotNull(), F.struct(*order, status_of.alias("st")))).alias("_last"),
        # any run's pre-process touches the header, so its last run decides, be it to leave it as that did
        F.max(F.struct(*order, header_of.alias("st"))).alias("_hlast"),
        F.max(F.when(ok & (is_src | is_brn), F.struct(*order, F.col("dataflowflag").alias("flow")))).alias("_ok"),
        F.max(raised.cast("int")).alias("_anyfail"),
        F.max((ok & is_brn).cast("int")).alias("_anybrn"),
        F.max((F.col("failed") | (ok & is_brn)).cast("int")).alias("_anyend"),
    ).select("_p_sourceid", F.col("_last.st").alias("_status"), F.col("_hlast.st").alias("_hstatus"), F.col("_ok.flow").alias("_lastok"),
             "_anyfail", "_anybrn", "_anyend")
    key = oc.where(F.col("batchid").isNotNull()).groupBy(*[F.col(k).alias(f"_o_{k}") for k in RUN_KEY]).agg(
        F.max(F.struct(*order, F.col("failed").alias("f"))).alias("_lk"),
        F.max(ok.cast("int")).alias("_anyok"))
    # header
    hj = header.join(src, F.col("sourceid") == F.col("_p_sourceid"), "left")
    app = F.col("isapplicable") == 1
    has = F.col("_p_sourceid").isNotNull()
    new_header = hj.select(*[
        (F.when(has & app, F.coalesce(F.col("_hstatus"), F.col(c))).when(has & (F.col("_anyfail") == 1), F.lit("Failed"))
         .otherwise(F.col(c)) if c == "status" else
         F.when(has & app & F.col("_status").isNotNull(), now).otherwise(F.col(c)) if c == "lastupdateddate"
         else F.col(c)).alias(c)
        for c in header.columns])
    # detail
    dj = detail.join(src.select("_p_sourceid", "_lastok"), F.col("sourceid") == F.col("_p_sourceid"), "left")
    dj = dj.join(key, [F.col(k) == F.col(f"_o_{k}") for k in RUN_KEY], "left")
    ready = (F.when(app & (F.col("_lastok") == flows.bronze) & is_src, 0)
             .when(app & (F.col("_lastok") == flows.bronze) & is_brn, 1)
             .when(app & (F.col("_lastok") == flows.silver) & is_brn, 0)
             .when(app & (F.col("_lastok") == flows.silver) & is_src, 1)
             .otherwise(F.col("isreadyforexecution")))
    khit = app & F.col("_lk").isNotNull()
    new_detail = dj.select(*[
        (ready.cast(t) if c == "isreadyforexecution" else
         F.when(khit, F.when(F.col("_lk.f"), "Failed").otherwise("Completed")).otherwise(F.col(c))
         if c == "flowstatus" else
         F.when(khit & (F.col("_anyok") == 1), now).otherwise(F.col(c)) if c == "etllastrundate" else
         F.col(c)).alias(c) for c, t in detail.dtypes])
    # groups
    if sourcegroupflag == 1:
        gj = groups.join(src.select("_p_sourceid", "_status", "_anybrn", "_anyend"),
                         F.col("sourceid") == F.col("_p_sourceid"), "left")
        ghit = F.col("_p_sourceid").isNotNull() & (F.col("schemaname") == "dwh") & app
        new_groups = gj.select(*[
            (F.when(ghit, F.coalesce(F.col("_status"), F.col(c))).otherwise(F.col(c)) if c == "status" else
             F.when(ghit & (F.col("_anybrn") == 1), now).otherwise(F.col(c)) if c == "lastrundatetime" else
             F.when(ghit & (F.col("_anyend") == 1), now).otherwise(F.col(c)) if c == "loadenddatetime" else
             F.col(c)).alias(c)
            for c in groups.columns])
    else:
        new_groups = groups
    # audit: counts, status and end time of each run's own row
    ao = oc.select(*[F.col(k).alias(f"_o_{k}") for k in RUN_KEY], F.col("batchid").alias("_o_b"),
                   F.col("failed").alias("_o_failed"), F.col("srccnt").alias("_o_src"),
                   F.col("inscnt").alias("_o_ins"), F.col("updcnt").alias("_o_upd"))
    aj = audit.join(ao, [F.col(k) == F.col(f"_o_{k}") for k in RUN_KEY]
                    + [F.col("latestbatchid") == F.col("_o_b")], "left")
    ahit = F.col("_o_b").isNotNull()
    amap = {"srcrwcnt": F.col("_o_src"), "tgtinscnt": F.col("_o_ins"), "tgtupdcnt": F.col("_o_upd"),
            "flowstatus": F.when(F.col("_o_failed"), "Failed").otherwise("Completed"),
            "updateddate": now, "loadendtime": now}
    atypes = dict(audit.dtypes)
    new_audit = aj.select(*[
        (F.when(ahit, amap[c].cast(atypes[c])).otherwise(F.col(c)) if c in amap else F.col(c)).alias(c)
        for c in audit.columns])
    return PostResult(oc, new_detail, new_header, new_groups, new_audit)


# ------------------------------------------------------------------- error (C4)

def error_rows(events: DataFrame, detail: DataFrame, as_of=None, taskname: str = TASK_NAME,
               module: str = "operation", flows: Flows = FLOWS) -> DataFrame:
    """Error rows appended for failed runs (C4, K4): copied from the run's
    control-detail row when it exists; flow silver_to_gold adds a fixed second row.
    ``events``: sourceid, dataflowflag, targetobject, batchid, errorid, errordesc[, errorline]."""
    now = _ts(as_of)
    ev = events.select(*[F.col(k).alias(f"_e_{k}") for k in RUN_KEY], F.col("batchid").alias("_e_b"),
                       F.col("errorid").alias("_e_id"), F.col("errordesc").alias("_e_desc"),
                       (F.col("errorline") if "errorline" in events.columns else F.lit(None))
                       .cast("int").alias("_e_line"))
    j = detail.join(ev, [F.col(k) == F.col(f"_e_{k}") for k in RUN_KEY], "inner")
    package = F.concat(flow_module(F.col("dataflowflag")), F.lit("."), F.lit(module))
    copied = j.select("sourcename", "sourcetype", "sourcedescription", "sourceid", "sourceobject",
                      "dataflowflag", "targetname", "targetschemaname", "targetobject",
                      "targetprocedurename", F.lit(taskname).alias("taskname"), package.alias("packagename"),
                      "jobname", F.col("_e_id").cast("int").alias("errorid"), F.col("_e_desc").alias("errordesc"),
                      F.col("_e_line").alias("errorline"), now.alias("errordate"),
                      F.coalesce(F.col("_e_b"), F.col("latestbatchid")).cast("long").alias("latestbatchid"))
    gold = events.where(F.col("dataflowflag") == flows.gold).select(
        F.lit(GOLD_ERROR_SOURCE[0]).alias("sourcename"), F.lit(GOLD_ERROR_SOURCE[1]).alias("sourcetype"),
        F.lit(GOLD_ERROR_SOURCE[2]).alias("sourcedescription"), "sourceid", F.col("sourceid").alias("sourceobject"),
        "dataflowflag", F.lit(GOLD_ERROR_TARGET[0]).alias("targetname"),
        F.lit(GOLD_ERROR_TARGET[1]).alias("targetschemaname"),
        "targetobject", F.lit(None).cast("string").alias("targetprocedurename"),
        F.lit(taskname).alias("taskname"),
        F.concat(flow_module(F.col("dataflowflag")), F.lit("."), F.lit(module)).alias("packagename"),
        F.lit(None).cast("string").alias("jobname"), F.col("errorid").cast("int").alias("errorid"),
        "errordesc", F.lit(None).cast("int").alias("errorline"), now.alias("errordate"),
        F.col("batchid").cast("long").alias("latestbatchid"))
    return copied.unionByName(gold)


def error_transition(events: DataFrame, detail: DataFrame, header: DataFrame, audit: DataFrame | None,
                     as_of=None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame | None]:
    """Error transition (C4): (error rows, detail, header, audit).  Detail and
    audit rows of the failed batch become 'Failed'; the header becomes 'Failed'
    with no applicability test."""
    rows = error_rows(events, detail, as_of)
    eb = events.select(*[F.col(k).alias(f"_e_{k}") for k in RUN_KEY],
                       F.col("batchid").alias("_e_b")).distinct()
    cond = [F.col(k) == F.col(f"_e_{k}") for k in RUN_KEY] + [F.col("latestbatchid") == F.col("_e_b")]
    dd = detail.join(eb, cond, "left")
    new_detail = dd.select(*[(F.when(F.col("_e_b").isNotNull(), F.lit("Failed")).otherwise(F.col(c))
                              if c == "flowstatus" else F.col(c)).alias(c) for c in detail.columns])
    srcs = events.select(F.col("sourceid").alias("_r_sourceid")).distinct()
    new_header = header.join(srcs, F.col("sourceid") == F.col("_r_sourceid"), "left").select(
        *[(F.when(F.col("_r_sourceid").isNotNull(), F.lit("Failed")).otherwise(F.col(c))
           if c == "status" else F.col(c)).alias(c) for c in header.columns])
    new_audit = None
    if audit is not None:
        aa = audit.join(eb, [F.col(k) == F.col(f"_e_{k}") for k in RUN_KEY]
                        + [F.col("latestbatchid") == F.col("_e_b")], "left")
        new_audit = aa.select(*[(F.when(F.col("_e_b").isNotNull(), F.lit("Failed")).otherwise(F.col(c))
                                 if c == "flowstatus" else F.col(c)).alias(c) for c in audit.columns])
    return rows, new_detail, new_header, new_audit


def latest_audit(audit: DataFrame) -> DataFrame:
    """Latest state of each run key from an append-only audit log (W6):
    the row with the greatest batch, as a partial max-struct aggregation."""
    other = [c for c in audit.columns if c not in RUN_KEY and c != "latestbatchid"]
    g = audit.groupBy(*RUN_KEY).agg(F.max(F.struct("latestbatchid", *other)).alias("_l"))
    return g.select(*RUN_KEY, *[F.col(f"_l.{c}").alias(c) for c in ["latestbatchid", *other]])


def run_durations(audit: DataFrame) -> DataFrame:
    """Microseconds from load start to load end of every finished run."""
    return audit.where(F.col("loadendtime").isNotNull()).select(
        *RUN_KEY, "latestbatchid", "flowstatus",
        elapsed_micros("loadstarttime", "loadendtime").alias("elapsed_us"))
