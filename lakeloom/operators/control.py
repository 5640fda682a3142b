"""Due-run selection over the control tables.

Everything stays a DataFrame: filters are Column predicates built from a typed
``RunFilter``; list filters take either a Python list (small, literal ``IN``)
or a DataFrame of values (semi/anti join, for lists that grow with the data).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The record projection of a due run, as (side, column) with
# h = control header, d = control detail, in the loader's order.
RUN_COLUMNS = [
    ("h", "sourceid"), ("d", "sourcename"), ("d", "sourcetype"), ("d", "sourceobject"),
    ("h", "depsource"), ("d", "loadtype"), ("d", "sourceschema"), ("d", "loadfrequency"),
    ("h", "connectionstr"), ("h", "objecttype"), ("h", "sourcedelimiter"), ("d", "sourcequery"),
    ("h", "apiurl"), ("h", "apimethod"), ("h", "apiaccesstoken"), ("h", "apiqueryparameters"),
    ("h", "apirequestbody"), ("h", "adlscontainername"), ("h", "dldirstructure"),
    ("d", "etllastrundate"), ("d", "targetobject"), ("h", "sourcecallingseq"), ("d", "dataflowflag"),
    ("d", "latestbatchid"), ("d", "targetschemaname"), ("d", "targetprocedurename"),
    ("d", "intervaldays"),
]


def split_list(value: str | None, delimiter: str = ",") -> list[str] | None:
    """CLI list argument -> list (P10); empty/None -> None (no filter)."""
    if not value:
        return None
    return [v for v in value.split(delimiter)]


def split_list_column(df: DataFrame, column: str, delimiter: str, keep: list[str]) -> DataFrame:
    """A delimited list that arrives as data (P10): one row per item with its
    1-based position, split and exploded by native functions."""
    parts = F.split(F.col(column), re.escape(delimiter), -1)
    return df.select(*keep, F.posexplode(parts).alias("pos", "item")).select(
        *keep, (F.col("pos") + 1).cast("long").alias("pos"), "item")


@dataclass
class RunFilter:
    """The optional filters of the due-run selection."""
    dataflowflag: str = "bronze_to_silver"
    sources: list | DataFrame | None = None
    groups: list | None = None
    exclude_sources: list | DataFrame | None = None
    exclude_groups: list | None = None
    object_type: list | None = None
    calling_sequence: list | None = None
    load_frequency: str | None = None
    failed_only: bool = False
    group_schema: str = "dwh"


def is_in(df: DataFrame, col: str, values) -> DataFrame:
    """``col IN (values)`` — literal list or a DataFrame (semi join, J9)."""
    if isinstance(values, DataFrame):
        v = values.select(F.col(values.columns[0]).alias("_v"))
        return df.join(v, F.col(col) == F.col("_v"), "left_semi")
    return df.where(F.col(col).isin(list(values)))


def not_in(df: DataFrame, col: str, values) -> DataFrame:
    """``col NOT IN (values)`` with SQL's three-valued logic.

    Empty list: every row stays (NULL ``col`` too).  Otherwise a NULL ``col`` is
    dropped, and a NULL among the values drops every row.  Written as a left
    anti join plus two scalar facts about the list, so it scales with a list
    that grows (Spark's own null-aware anti join needs a broadcast list).
    """
    if not isinstance(values, DataFrame):
        vals = list(values)
        if not vals:
            return df
        if any(v is None for v in vals):
            return df.limit(0)
        return df.where(~F.col(col).isin(vals))
    v = values.select(F.col(values.columns[0]).alias("_v"))
    facts = v.agg(F.struct(F.count(F.lit(1)).alias("n"),
                           F.count_if(F.col("_v").isNull()).alias("nulls"))).scalar()
    kept = df.join(v.where(F.col("_v").isNotNull()), F.col(col) == F.col("_v"), "left_anti")
    return kept.where((facts["n"] == 0) | ((facts["nulls"] == 0) & F.col(col).isNotNull()))


def group_members(groups: DataFrame, names, schema: str = "dwh") -> DataFrame:
    """``SELECT DISTINCT sourceid FROM groups WHERE schemaname = .. AND sourcegroup IN ..``."""
    g = groups.where((F.col("schemaname") == schema) & F.col("sourcegroup").isin(list(names)))
    return g.select("sourceid").distinct()


def due_runs(header: DataFrame, detail: DataFrame, groups: DataFrame | None,
             f: RunFilter, order: bool = True) -> DataFrame:
    """Runs due for ``f.dataflowflag``: header JOIN detail on sourceid (J1) with
    the mandatory filter (P3) and every optional one (P4-P8, J9, J10), projected
    to the run record (P1) and ordered by header id (O1)."""
    h = header.select(*[F.col(c).alias(f"h_{c}") for c in header.columns])
    d = detail.where((F.col("dataflowflag") == f.dataflowflag)
                     & (F.col("isreadyforexecution") == 1) & (F.col("isapplicable") == 1))
    if f.sources:
        d = is_in(d, "sourceid", f.sources)
    elif f.load_frequency:
        d = d.where(F.col("loadfrequency") == f.load_frequency)
    if f.exclude_sources is not None and (isinstance(f.exclude_sources, DataFrame) or f.exclude_sources):
        d = not_in(d, "sourceid", f.exclude_sources)
    if f.failed_only:
        d = d.where(F.col("flowstatus") == "Failed")
    if f.object_type:
        h = h.where(F.col("h_objecttype").isin(list(f.object_type)))
    if f.calling_sequence:
        h = h.where(F.col("h_sourcecallingseq").isin([int(x) for x in f.calling_sequence]))
    if f.groups:
        h = is_in(h, "h_sourceid", group_members(groups, f.groups, f.group_schema))
    if f.exclude_groups:
        h = not_in(h, "h_sourceid", group_members(groups, f.exclude_groups, f.group_schema))
    j = h.join(d, F.col("h_sourceid") == F.col("sourceid"), "inner")
    have = {"h": {c.removeprefix("h_") for c in h.columns}, "d": set(d.columns)}
    if absent := [f"{side}.{c}" for side, c in RUN_COLUMNS if c not in have[side]]:
        raise ValueError("the control tables lack columns of the run record: " + ", ".join(absent))
    cols = [F.col(f"h_{c}").alias(c) if side == "h" else F.col(c) for side, c in RUN_COLUMNS]
    if order and "h_id" in h.columns:
        j = j.orderBy(F.col("h_id").asc_nulls_last(), F.col("targetobject").asc_nulls_last())
    return j.select(*cols)


def list_sources(runs: DataFrame) -> DataFrame:
    """``dataflowflag => sourceid`` lines of the due runs."""
    return runs.select(F.concat_ws(" => ", "dataflowflag", "sourceid").alias("line"))


def run_waves(runs: DataFrame) -> DataFrame:
    """Waves in ascending calling sequence with their run counts.

    Runs with a NULL sequence never run (the wave filter ``seq == i`` is never
    true for them), so they form no wave.  Grouping is a partial aggregation."""
    w = (runs.where(F.col("sourcecallingseq").isNotNull())
         .groupBy("sourcecallingseq").agg(F.count(F.lit(1)).alias("n_runs")))
    return w.orderBy("sourcecallingseq")


def run_metadata(runs: DataFrame, header: DataFrame, detail: DataFrame) -> DataFrame:
    """Per run: job name, env/datasource codes, latest batch, procedure, raw flag.

    detail JOIN header on sourceid, matched to the run on (sourceid, flow,
    target); a run with no control row keeps NULL metadata (left join)."""
    meta = detail.join(header.select("sourceid", "envsourcecode", "datasourcecode", "rawstorageflag"),
                       "sourceid", "inner").select(
        F.col("sourceid").alias("_m_sourceid"), F.col("dataflowflag").alias("_m_flow"),
        F.col("targetobject").alias("_m_target"), "jobname", "envsourcecode", "datasourcecode",
        F.col("latestbatchid").alias("p_batchid"), F.col("targetprocedurename").alias("p_taskname"),
        "rawstorageflag")
    cond = ((F.col("sourceid") == F.col("_m_sourceid")) & (F.col("dataflowflag") == F.col("_m_flow"))
            & (F.col("targetobject") == F.col("_m_target")))
    return runs.join(meta, cond, "left").drop("_m_sourceid", "_m_flow", "_m_target")
