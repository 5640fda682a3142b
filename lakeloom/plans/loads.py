"""End-to-end loads (C5 one load, C6 waves, C7 bootstrap) over a snapshot store.

Store layout under ``root`` (versioned snapshots, see ``sinks.snapshot``, but for the logs):
  controlheader, controldetail, sourcegroupingdtl, wave, datatype_mapping, main_lookup, source_lookup,
  bronze/<schema>.<object>, silver/<schema>.<table> (``sinks.keyed``); audit and error are append-only logs.

A wave is the set of due runs with one calling sequence.  Its transitions are
set-based (one pre-process and one post-process for all its runs), and each is one
commit: its control tables and log rows become visible together.  The
loads themselves are independent Spark jobs submitted concurrently from the
driver, but for runs of one target, which follow one another in run order.  A
failed load never stops its wave or the next waves; it leaves an error row with
its whole message and line and takes the failed path of the post-process.

Restart: the commit of the pre-process also opens the wave (its runs are the table ``wave``), that of
the post-process closes it.  Every finished load leaves an entry in the wave's ledger; a load into a
keyed table has one in the very marker that publishes it.  ``run_waves`` first ends a wave that it
finds open: loads with an entry are not run again, and no log row is written twice.

What a run does follows from its flow: a load into bronze empties its table in the
pre-process and replaces it (the caller gives the source's rows); a load into
silver makes the table if it is missing - lookup first, then its schema from the
lookup - checks the source's keys and required columns, and upserts.  A flow
without a load fails.
"""

from __future__ import annotations

import datetime as dt
import re
import threading
import traceback
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.errors.exceptions.captured import CapturedException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import FLOWS, Flows, surrogate_key_name
from ..functions.typemap import type_map
from ..operators import checks
from ..operators import control as ctl
from ..operators import transitions as tr
from ..operators.catalog import schema_catalog
from ..operators.ddl import silver_schema
from ..operators.lookup import lookup_rows, lookup_upsert
from ..operators.upsert import dedupe_source, upsert
from ..sinks import keyed
from ..sinks import snapshot as snap

_LOOKUP = threading.Lock()

AUDIT_SCHEMA = T.StructType([
    T.StructField("sourcename", T.StringType()), T.StructField("sourcetype", T.StringType()),
    T.StructField("sourcedescription", T.StringType()), T.StructField("sourceobject", T.StringType()),
    T.StructField("sourceid", T.StringType()), T.StructField("dataflowflag", T.StringType()),
    T.StructField("srcrwcnt", T.LongType()), T.StructField("srcdelcnt", T.LongType()),
    T.StructField("tgtinscnt", T.LongType()), T.StructField("tgtdelcnt", T.LongType()),
    T.StructField("tgtupdcnt", T.LongType()), T.StructField("flowstatus", T.StringType()),
    T.StructField("targetname", T.StringType()), T.StructField("targetschemaname", T.StringType()),
    T.StructField("targetobject", T.StringType()), T.StructField("targetprocedurename", T.StringType()),
    T.StructField("createddate", T.TimestampNTZType()), T.StructField("updateddate", T.TimestampNTZType()),
    T.StructField("loadstarttime", T.TimestampNTZType()), T.StructField("loadendtime", T.TimestampNTZType()),
    T.StructField("latestbatchid", T.LongType()), T.StructField("loadtype", T.StringType()),
    T.StructField("etlbatchid", T.StringType()), T.StructField("useragent", T.StringType()),
    T.StructField("sourcegroupflag", T.IntegerType()),
])
ERROR_SCHEMA = T.StructType([
    T.StructField(c, T.StringType()) for c in
    ("sourcename", "sourcetype", "sourcedescription", "sourceid", "sourceobject", "dataflowflag",
     "targetname", "targetschemaname", "targetobject", "targetprocedurename", "taskname",
     "packagename", "jobname")] + [
    T.StructField("errorid", T.IntegerType()), T.StructField("errordesc", T.StringType()),
    T.StructField("errorline", T.IntegerType()), T.StructField("errordate", T.TimestampNTZType()),
    T.StructField("latestbatchid", T.LongType())])


#: Key of the logs: an audit row's later states have the same one.
LOG_KEY = [*tr.RUN_KEY, "latestbatchid"]


def bronze_name(schema: str, obj: str) -> str:
    return f"bronze/{schema}.{obj}"


def silver_name(schema: str, table: str) -> str:
    return f"silver/{schema}.{table}"


LOOKUP_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in (
    "sourcename", "sourceid", "source_tablename", "bronzedwh_tablename", "silverdwh_tablename")] + [
    T.StructField("column_id", T.IntegerType())] + [T.StructField(c, T.StringType()) for c in (
        "source_columnname", "bronzedwh_columnname", "silverdwh_columnname", "datatype", "lh_datatype")] + [
    T.StructField(c, T.IntegerType()) for c in ("length", "precisions", "scale")] + [
    T.StructField("keyconstraint", T.StringType()), T.StructField("nullable", T.BooleanType()),
    T.StructField("silver_default_value", T.StringType()), T.StructField("createdatetime", T.TimestampNTZType()),
    T.StructField("document", T.StringType())])
SOURCE_LOOKUP_SCHEMA = T.StructType([T.StructField("source_id", T.IntegerType())] + [
    T.StructField(c, T.StringType()) for c in ("source_type", "source_schema", "source_table")] + [
    T.StructField("column_id", T.IntegerType())] + [
    T.StructField(c, T.StringType()) for c in ("column_name", "source_data_type")] + [
    T.StructField(c, T.IntegerType()) for c in ("length", "precisions", "scale")] + [
    T.StructField("nullable", T.BooleanType()), T.StructField("key_constraint", T.StringType()),
    T.StructField("target_table", T.StringType()), T.StructField("extraction_timestamp", T.TimestampNTZType())])


def init_store(spark: SparkSession, root: str, header: DataFrame, detail: DataFrame,
               groups: DataFrame, as_of=None) -> None:
    """Bootstrap (C7): control tables, empty logs and lookups, and the 68-row type map (inserted once)."""
    snap.Commit(spark, root).table("controlheader", header).table("controldetail", detail).table("sourcegroupingdtl", groups).publish()
    snap.create_empty(spark, root, "main_lookup", LOOKUP_SCHEMA)
    snap.create_empty(spark, root, "source_lookup", SOURCE_LOOKUP_SCHEMA)
    if not snap.table_exists(spark, root, "datatype_mapping"):
        snap.publish(type_map(spark, as_of), root, "datatype_mapping")


def audit_log(spark: SparkSession, root: str) -> DataFrame:
    """Each run's audit row in its latest state."""
    return snap.read_latest(spark, root, "audit", AUDIT_SCHEMA, LOG_KEY)


def error_log(spark: SparkSession, root: str) -> DataFrame:
    return snap.read_log(spark, root, "error", ERROR_SCHEMA).drop(snap.SEQUENCE)


def lookup_of(spark: SparkSession, root: str, bronze: DataFrame, run: dict, keys: list[str], as_of) -> list:
    """Upsert the lookup rows of a run's columns; those of its silver table (one table's columns)."""
    columns = schema_catalog(spark, {run["sourceobject"]: bronze}, run["sourceschema"])
    kind = "table_schema string, table_name string, constraint_name string, "
    named = (run["sourceschema"], run["sourceobject"], f"{run['sourceobject']}_key")
    constraints = spark.createDataFrame([(*named, "UNIQUE")] if keys else [], kind + "constraint_type string")
    usage = spark.createDataFrame([(*named, k) for k in keys], kind + "column_name string")
    rows = lookup_rows(columns, constraints, usage, F.lit(run["sourceid"]), F.lit(run["targetobject"]), as_of)
    lookup = lookup_upsert(snap.read_table(spark, root, "main_lookup"), rows).table
    snap.publish(lookup, root, "main_lookup")
    return snap.read_table(spark, root, "main_lookup").where(
        (F.col("silverdwh_tablename") == run["targetobject"]) & (F.col("sourceid") == run["sourceid"])).collect()


def read_silver(spark: SparkSession, root: str, schema: str, table: str) -> DataFrame:
    df = snap.read_table(spark, root, silver_name(schema, table))
    return df.drop("_action") if "_action" in df.columns else df


@dataclass
class LoadResult:
    sourceid: str
    dataflowflag: str
    targetobject: str
    srccnt: int | None = None
    inscnt: int | None = None
    updcnt: int | None = None
    error: str | None = None
    line: int | None = None


def _failed(res: LoadResult, e: Exception, source: DataFrame | None = None) -> LoadResult:
    """The run fails, its wave goes on (F22): whole message, and the line of the load or of the caller's code that raised."""
    frames = traceback.extract_tb(e.__traceback__)
    own = [f for f in frames if not re.search(r"[/\\](pyspark|py4j)[/\\]", f.filename)]
    # Spark's exceptions have no args; their text may go on with the JVM's stack trace
    res.error = f"{type(e).__name__}: {e._desc if isinstance(e, CapturedException) else e}"
    res.line = (own or frames)[-1].lineno if frames else None
    res.inscnt, res.updcnt = 0, 0
    if res.srccnt is None and source is not None:
        try:  # counted whatever fails (quirk 24)
            res.srccnt = source.count()
        except Exception:  # the source is what failed
            res.srccnt = None
    traceback.print_exc()
    return res


def checked_source(bronze: DataFrame, keys: list, dedupe_by: list | None) -> DataFrame:
    """The source with unique business keys (Q1, Q5): a repeated key fails, or the greatest row by ``dedupe_by`` stays."""
    names = [k if isinstance(k, str) else k[0] for k in keys]
    if not names:
        return bronze
    if dedupe_by:
        nulls = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in names])
        return dedupe_source(bronze.where(~nulls), names, dedupe_by).unionByName(bronze.where(nulls))
    surplus = checks.duplicate_summary(bronze, names).first()
    if surplus["dup_keys"]:
        raise ValueError(f"{surplus['dup_keys']} business keys occur more than once ({surplus['surplus_rows']} surplus rows)")
    return bronze


def check_columns(bronze: DataFrame, required: list[str], limits: dict[str, int]) -> None:
    """Required columns hold no NULL (Q2) and texts are not longer than allowed (Q3)."""
    if required and (bad := checks.not_null_violations(bronze, required).collect()):  # one row per column
        raise ValueError("NULL in required columns: " + ", ".join(f"{r['column_name']} ({r['n_null']})" for r in bad))
    if limits and (bad := checks.length_violations(bronze, limits).where("n_over > 0").collect()):
        raise ValueError("too long: " + ", ".join(f"{r['column_name']} ({r['n_over']})" for r in bad))


def check_profile(found: keyed.Profile, dedupe: bool) -> None:
    """The checks of ``check_columns`` and ``checked_source`` on what one pass over the source has found (Q1-Q3, Q5)."""
    if bad := {c: n for c, n in found.nulls.items() if n}:
        raise ValueError("NULL in required columns: " + ", ".join(f"{c} ({n})" for c, n in bad.items()))
    if bad := {c: n for c, n in found.over.items() if n}:
        raise ValueError("too long: " + ", ".join(f"{c} ({n})" for c, n in bad.items()))
    if found.dup_keys and not dedupe:
        raise ValueError(f"{found.dup_keys} business keys occur more than once ({found.surplus_rows} surplus rows)")


def load_silver(spark: SparkSession, root: str, run: dict, keys: list, meta: dict, as_of,
                buckets: int | None = None, dedupe_by: list | None = None, limits: dict | None = None,
                by: dict | None = None, key_buckets: int = keyed.BUCKETS) -> LoadResult:
    """One load into silver (C5 body): make the table when it is missing - lookup
    upsert (U2), then its schema from the lookup (K7) - check the source, upsert
    the bronze object (U1), publish the new version and return (srccnt, inscnt,
    updcnt) counted from the written version.

    One pass over the source counts it, checks it and probes the table's key filters; one more upserts it.
    ``buckets``: a table that Spark buckets instead, whose versions are whole."""
    res, bronze = LoadResult(run["sourceid"], run["dataflowflag"], run["targetobject"]), None
    try:
        bronze = snap.read_table(spark, root, bronze_name(run["sourceschema"], run["sourceobject"]))
        sname = silver_name(run["targetschemaname"], run["targetobject"])
        skeys = [k if isinstance(k, str) else k[0] for k in keys]
        tkeys = [k if isinstance(k, str) else k[1] for k in keys]
        surrogate = surrogate_key_name(run["targetobject"])
        version = snap.current_version(spark, root, sname)
        if version is None:
            with _LOOKUP:  # loads of one wave share the lookup table
                rows = lookup_of(spark, root, bronze, run, tkeys, as_of)
            schema = silver_schema(run["targetobject"], rows)
            version = (snap.create_empty(spark, root, sname, schema) if buckets or not tkeys
                       else keyed.create(spark, root, sname, schema, tkeys, key_buckets))
        lookup = snap.read_table(spark, root, "main_lookup").where(F.col("silverdwh_tablename") == run["targetobject"])
        required = [r[0] for r in lookup.where("NOT nullable").select("silverdwh_columnname").distinct().collect()]
        required = [c for c in required if c in bronze.columns]
        if (held := snap.manifest(spark, root, sname, version)) is None:
            _load_whole(spark, root, run, keys, meta, as_of, buckets, dedupe_by, limits, res, bronze, required)
            return res
        found = keyed.profile(spark, root, sname, held, bronze, skeys, required, limits)
        res.srccnt = found.rows
        check_profile(found, bool(dedupe_by))
        source = checked_source(bronze, keys, dedupe_by) if dedupe_by else bronze
        done = keyed.upsert(spark, root, sname, source, keys, surrogate=surrogate, meta=meta, as_of=as_of, found=found, unique=True,
                            by=None if by is None else by | {"srccnt": found.rows})
        res.inscnt, res.updcnt = done.inserted, done.updated
    except Exception as e:
        return _failed(res, e, bronze)
    return res


def _load_whole(spark, root, run, keys, meta, as_of, buckets, dedupe_by, limits, res, bronze, required) -> None:
    """The load into a table whose versions are whole."""
    sname = silver_name(run["targetschemaname"], run["targetobject"])
    tkeys = [k if isinstance(k, str) else k[1] for k in keys]
    res.srccnt = bronze.count()
    silver = read_silver(spark, root, run["targetschemaname"], run["targetobject"])
    check_columns(bronze, required, limits or {})
    source = checked_source(bronze, keys, dedupe_by)
    r = upsert(silver, source, keys, surrogate=surrogate_key_name(run["targetobject"]), meta=meta, as_of=as_of)
    # sorted by business key inside each file (row-group statistics prune key
    # lookups); with ``buckets`` also bucketed by it, so the next upsert does
    # not shuffle the silver table
    v = snap.publish(r.rows, root, sname, sort_by=tkeys,
                     bucket=(buckets, tkeys) if buckets and tkeys else None)
    written = snap.read_table(spark, root, sname, v)
    c = written.agg(F.count_if(F.col("_action") == "I").alias("i"),
                    F.count_if(F.col("_action") == "U").alias("u")).collect()[0]
    res.inscnt, res.updcnt = int(c["i"]), int(c["u"])


def load_bronze(spark: SparkSession, root: str, run: dict, source_of) -> LoadResult:
    """One load into bronze (K2): the pre-process empties the table, then the source replaces it."""
    res = LoadResult(run["sourceid"], run["dataflowflag"], run["targetobject"])
    try:
        if source_of is None:
            raise ValueError(f"no source is given for flow {run['dataflowflag']}")
        name = bronze_name(run["targetschemaname"], run["targetobject"])
        snap.truncate(spark, root, name)
        source = source_of(run)
        v = snap.overwrite(source, root, name)
        res.srccnt = res.inscnt = snap.read_table(spark, root, name, v).count()
        res.updcnt = 0
    except Exception as e:
        return _failed(res, e)
    return res


def run_wave(spark: SparkSession, root: str, runs: DataFrame, keys_of, as_of=None,
             parallel: int = 4, buckets: int | None = None, source_of=None, dedupe_by=None,
             limits_of=None, flows: Flows = FLOWS, key_buckets: int = keyed.BUCKETS, asked_by: dict | None = None) -> list[LoadResult]:
    """Pre-process all runs of a wave, load them, then the error and post-process
    transitions - each transition one commit.

    ``keys_of``/``dedupe_by``/``limits_of``: functions of a run giving its business
    keys, the order that picks one of several rows of a key (none: they fail), and
    the length limits of columns; ``source_of``: the rows of a load into bronze; ``key_buckets``: of new
    silver tables, about one per gigabyte that they will have; ``asked_by``: kept with the open wave."""
    as_of = as_of or dt.datetime.now().replace(microsecond=0)
    header = snap.read_table(spark, root, "controlheader")
    detail = snap.read_table(spark, root, "controldetail")
    groups = snap.read_table(spark, root, "sourcegroupingdtl")
    # one row per run: the driver submits a job for each, so it holds their records
    asked = sorted((tuple(r) for r in runs.select(*tr.RUN_KEY).collect()), key=repr)
    req = spark.createDataFrame([(*k, i) for i, k in enumerate(asked)], ", ".join(f"{k} string" for k in tr.RUN_KEY) + ", runid long")
    req = req.withColumn("loadstarttime", F.lit(as_of).cast("timestamp_ntz"))
    pre = tr.pre_process(req, detail, header, groups, as_of=as_of, flows=flows)
    batches = pre.runs.select(*tr.RUN_KEY, "batchid", "runid")
    wave = ctl.run_metadata(runs.join(batches, tr.RUN_KEY), header, detail)
    (snap.Commit(spark, root).table("controldetail", pre.detail).table("controlheader", pre.header)
     .table("sourcegroupingdtl", pre.groups).table("wave", wave).append("audit", pre.audit_rows, AUDIT_SCHEMA, LOG_KEY)
     .publish({"open": True, "wave": uuid.uuid4().hex, "as_of": as_of.isoformat(), "asked_by": asked_by}, merge=False))
    return finish_wave(spark, root, keys_of, parallel, buckets, source_of, dedupe_by, limits_of, flows, key_buckets)


def _ledger(root: str, wave: str) -> str:
    return f"{root.rstrip('/')}/_ledger/{wave}"


def _entry(spark: SparkSession, root: str, wave: str, run: dict) -> LoadResult | None:
    """What a load that has ended left in the ledger, or in the marker of the version it published."""
    held = snap.optional_json(spark, f"{_ledger(root, wave)}/{run['runid']}")
    if held is not None:
        return LoadResult(**held)
    sname = silver_name(run["targetschemaname"], run["targetobject"])
    for v in reversed(snap.published_versions(spark, root, sname)):
        held = snap.manifest(spark, root, sname, v) or {}
        if held.get("by") and (held["by"]["wave"], held["by"]["runid"]) == (wave, run["runid"]):
            return LoadResult(run["sourceid"], run["dataflowflag"], run["targetobject"], held["by"]["srccnt"], held["counts"]["i"], held["counts"]["u"])
    return None


def finish_wave(spark: SparkSession, root: str, keys_of, parallel: int = 4, buckets: int | None = None, source_of=None,
                dedupe_by=None, limits_of=None, flows: Flows = FLOWS, key_buckets: int = keyed.BUCKETS) -> list[LoadResult]:
    """The loads of the open wave that have no entry in its ledger, then its post-process."""
    note = snap.last_commit(spark, root)["note"]
    wave, as_of = note["wave"], dt.datetime.fromisoformat(note["as_of"])
    plan = [r.asDict() for r in snap.read_table(spark, root, "wave").collect()]

    def load(run: dict) -> LoadResult:
        if (ended := _entry(spark, root, wave, run)) is not None:
            return ended
        if run["dataflowflag"] == flows.bronze:
            res = load_bronze(spark, root, run, source_of)
        elif run["dataflowflag"] != flows.silver:
            res = LoadResult(run["sourceid"], run["dataflowflag"], run["targetobject"], inscnt=0, updcnt=0)
            res.error = f"ValueError: no load for flow {run['dataflowflag']}"
        else:
            meta = {"etljobname": run["jobname"], "envsourcecd": run["envsourcecode"], "datasourcecd": run["datasourcecode"]}
            res = load_silver(spark, root, run, keys_of(run), meta, as_of, buckets, dedupe_by(run) if dedupe_by else None,
                              limits_of(run) if limits_of else None, {"wave": wave, "runid": run["runid"]}, key_buckets)
        snap.write_json(spark, f"{_ledger(root, wave)}/{run['runid']}", asdict(res))
        return res

    # runs of one target in order, different targets at the same time
    by_target: dict[tuple, list[dict]] = {}
    for run in sorted(plan, key=lambda r: r["runid"]):
        by_target.setdefault((run["targetschemaname"], run["targetobject"]), []).append(run)
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as ex:
        done = list(ex.map(lambda mine: [(run, load(run)) for run in mine], by_target.values()))
    results = [x for mine in done for x in mine]
    out_schema = ("sourceid string, dataflowflag string, targetobject string, batchid long, runid long, srccnt long, "
                  "inscnt long, updcnt long, errordesc string, errorline int")
    rows = [(x.sourceid, x.dataflowflag, x.targetobject, run["batchid"], run["runid"],
             x.srccnt, x.inscnt, x.updcnt, x.error, x.line) for run, x in results]
    outcomes = (spark.createDataFrame(rows, out_schema)
                .withColumn("loadstarttime", F.lit(as_of).cast("timestamp_ntz"))
                .withColumn("raised", F.col("errordesc").isNotNull()))
    events = outcomes.where(F.col("errordesc").isNotNull()).select(
        *tr.RUN_KEY, "batchid", F.lit(-1).alias("errorid"), "errordesc", "errorline")
    header = snap.read_table(spark, root, "controlheader")
    detail = snap.read_table(spark, root, "controldetail")
    groups = snap.read_table(spark, root, "sourcegroupingdtl")
    # the wave's batch ids are new: its own error rows, and the audit rows of its pre-process, are all that matter here
    errors = tr.error_rows(events, detail, as_of=as_of, flows=flows)
    started = snap.read_log(spark, root, "audit", AUDIT_SCHEMA, run=note["runs"]["audit"]).drop(snap.SEQUENCE)
    post = tr.post_process(outcomes.drop("errordesc", "errorline"), errors, detail, header, groups, started,
                           as_of=as_of, flows=flows)
    (snap.Commit(spark, root).table("controldetail", post.detail).table("controlheader", post.header)
     .table("sourcegroupingdtl", post.groups).append("audit", post.audit, AUDIT_SCHEMA, LOG_KEY)
     .append("error", errors, ERROR_SCHEMA, LOG_KEY).publish({"open": False, "wave": wave, "as_of": note["as_of"]}))
    return [x for _, x in results]


def run_waves(spark: SparkSession, root: str, f: ctl.RunFilter, keys_of, as_of=None,
              parallel: int = 4, **options) -> list[LoadResult]:
    """All due runs, wave by wave in ascending calling sequence.

    A wave that was stopped is ended first; if the same selection had asked for it, the waves after it follow.

    Only the list of distinct sequences reaches the driver (a handful of
    numbers); every wave is re-selected from the control tables as they stand
    after the previous wave.  ``options``: see ``run_wave``."""
    results: list[LoadResult] = []
    stopped = None
    if (note := snap.last_commit(spark, root)["note"] or {}).get("open"):
        results += finish_wave(spark, root, keys_of, parallel, **options)
        if note["asked_by"] and note["asked_by"]["selection"] == repr(f):
            stopped = note["asked_by"]["sequence"]
    header = snap.read_table(spark, root, "controlheader")
    detail = snap.read_table(spark, root, "controldetail")
    groups = snap.read_table(spark, root, "sourcegroupingdtl")
    runs = ctl.due_runs(header, detail, groups, f, order=False)
    seqs = [r["sourcecallingseq"] for r in ctl.run_waves(runs).collect()]
    for s in seqs:
        if stopped is not None and s <= stopped:
            continue
        header = snap.read_table(spark, root, "controlheader")
        detail = snap.read_table(spark, root, "controldetail")
        groups = snap.read_table(spark, root, "sourcegroupingdtl")
        wave = ctl.due_runs(header, detail, groups, f, order=False).where(F.col("sourcecallingseq") == s)
        results += run_wave(spark, root, wave, keys_of, as_of=as_of, parallel=parallel, asked_by={"selection": repr(f), "sequence": s}, **options)
    return results
