"""Column lookup: type mapping (L1), type defaults (L2), lookup upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import neg_one_to_null, yes_no_bool
from ..functions.typemap import type_default
from ..session import broadcast_if_small
from .catalog import key_columns
from .upsert import upsert

LOOKUP_KEYS = ["sourceid", "source_tablename", "source_columnname"]


def lookup_build(source_lookup: DataFrame, type_map: DataFrame, case_insensitive: bool = False) -> DataFrame:
    """source_lookup -> main_lookup rows.

    The type map is DISTINCT-ed (no fan-out), and broadcast if it is as small as the seed of 68 rows is.
    Unmapped types become 'text'; length -1 becomes NULL; rows without a
    column_id are dropped.  As in the original, only the map side is
    lower-cased unless ``case_insensitive``."""
    m = type_map.select("sourcedatatypes", "targetdatatypes", "sourcedatabasetype").dropDuplicates()
    m = m.select(F.lower("sourcedatatypes").alias("_m_type"), F.col("targetdatatypes").alias("_m_target"),
                 F.col("sourcedatabasetype").alias("_m_db"))
    stype = F.lower("source_data_type") if case_insensitive else F.col("source_data_type")
    j = source_lookup.where(F.col("column_id").isNotNull()).join(
        broadcast_if_small(m), (stype == F.col("_m_type")) & (F.col("source_type") == F.col("_m_db")), "left")
    out = j.select("column_id", "column_name", "target_table",
                   F.coalesce(F.col("_m_target"), F.lit("text")).alias("target_data_type"),
                   neg_one_to_null("length").alias("length"), "precisions", "scale", "nullable",
                   "key_constraint", F.lit("BRN").alias("processing_layer"),
                   F.lit(None).cast("string").alias("default_value"))
    return out.orderBy(*[F.col(c).asc_nulls_last() for c in ("column_id", "column_name", "target_table")])


def lookup_rows(columns: DataFrame, table_constraints: DataFrame, key_column_usage: DataFrame,
                sourceid, silver_table, as_of) -> DataFrame:
    """One main_lookup row per catalog column with its key constraints and
    default value (the body of U2), for all tables at once.
    ``sourceid`` / ``silver_table``: Columns giving both per catalog table."""
    keys = key_columns(table_constraints, key_column_usage).select(
        F.col("table_schema").alias("_k_s"), F.col("table_name").alias("_k_t"),
        F.col("column_name").alias("_k_c"), "key_constraint")
    j = columns.join(keys, (F.col("table_schema") == F.col("_k_s")) & (F.col("table_name") == F.col("_k_t"))
                     & (F.col("column_name") == F.col("_k_c")), "left")
    return j.select(
        sourceid.alias("sourceid"), F.col("table_name").alias("source_tablename"),
        F.col("column_name").alias("source_columnname"), silver_table.alias("silverdwh_tablename"),
        F.col("ordinal_position").alias("column_id"),
        F.col("column_name").alias("silverdwh_columnname"), F.col("data_type").alias("datatype"),
        F.col("character_maximum_length").alias("length"), F.col("numeric_precision").alias("precisions"),
        F.col("numeric_scale").alias("scale"), yes_no_bool("is_nullable").alias("nullable"),
        F.col("key_constraint").alias("keyconstraint"),
        type_default("data_type").alias("silver_default_value"),
        (as_of if isinstance(as_of, F.Column) else F.lit(as_of).cast("timestamp_ntz")).alias("createdatetime"))


def lookup_upsert(main_lookup: DataFrame, new_rows: DataFrame):
    """Update the lookup row of every catalog column or insert it.

    Unlike the original (quirk: inserted rows left the source names empty, so
    the next run inserted them again) the source names are filled, so this is
    a real upsert keyed on (sourceid, source table, source column)."""
    upd = ["silverdwh_columnname", "datatype", "length", "precisions", "scale", "nullable",
           "keyconstraint", "silver_default_value", "createdatetime"]
    ins = LOOKUP_KEYS + ["silverdwh_tablename", "column_id"] + upd
    return upsert(main_lookup, new_rows, LOOKUP_KEYS, update_columns=upd, insert_columns=ins)
