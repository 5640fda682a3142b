"""Column catalog and key constraints.

The catalog is a DataFrame shaped like information_schema.columns: one row per
(table_schema, table_name, column_name).  Spark/Parquet keeps no constraints, so
key columns come from a declared constraints DataFrame.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spark type -> information_schema data_type of the catalog.
_SPARK_TO_SQL = [
    (T.ByteType, "smallint"), (T.ShortType, "smallint"), (T.IntegerType, "integer"),
    (T.LongType, "bigint"), (T.FloatType, "real"), (T.DoubleType, "double precision"),
    (T.DecimalType, "numeric"), (T.StringType, "text"), (T.BooleanType, "boolean"),
    (T.DateType, "date"), (T.TimestampNTZType, "timestamp without time zone"),
    (T.TimestampType, "timestamp with time zone"), (T.BinaryType, "bytea"), (T.ArrayType, "ARRAY"),
]


#: Fixed value: the metadata key under which Spark keeps the declared type of a char or varchar column.
_RAW_TYPE = "__CHAR_VARCHAR_TYPE_STRING"


def sql_type_name(dt: T.DataType) -> str:
    for cls, name in _SPARK_TO_SQL:
        if isinstance(dt, cls):
            return name
    return "text"


def char_type(field: T.StructField) -> tuple[str, int] | None:
    """("char" or "varchar", n) of a column declared so: its type, or the type that Spark keeps in a string column's metadata."""
    kind = field.dataType
    if isinstance(kind, (T.CharType, T.VarcharType)):
        return "char" if isinstance(kind, T.CharType) else "varchar", kind.length
    found = re.fullmatch(r"((?:var)?char)\((\d+)\)", str((field.metadata or {}).get(_RAW_TYPE, "")))
    return (found[1], int(found[2])) if found else None


def schema_catalog(spark: SparkSession, tables: dict[str, DataFrame], schema: str = "stg") -> DataFrame:
    """information_schema.columns of DataFrames, read from their schemas.

    Only schemas travel to the driver (never data)."""
    rows = []
    for name, df in tables.items():
        for pos, f in enumerate(df.schema.fields, start=1):
            dt = f.dataType
            prec = dt.precision if isinstance(dt, T.DecimalType) else None
            scale = dt.scale if isinstance(dt, T.DecimalType) else None
            kind, size = char_type(f) or (sql_type_name(dt), None)
            rows.append((schema, name, f.name, pos, kind, size, prec, scale,
                         "YES" if f.nullable else "NO", "NO"))
    return spark.createDataFrame(
        rows, "table_schema string, table_name string, column_name string, ordinal_position int, "
              "data_type string, character_maximum_length int, numeric_precision int, "
              "numeric_scale int, is_nullable string, is_identity string")


def key_columns(table_constraints: DataFrame, key_column_usage: DataFrame,
                kinds: tuple[str, ...] | None = None) -> DataFrame:
    """Constraint types per column, ', '-joined in sorted order.

    ``kinds`` keeps only those constraint types (e.g. PRIMARY KEY / UNIQUE for
    business keys; a foreign key is never one).  Aggregated once for all
    tables, then joined where needed - no correlated subquery per column."""
    tc = table_constraints.select(F.col("constraint_name").alias("_cn"), "constraint_type")
    if kinds:
        tc = tc.where(F.col("constraint_type").isin(*kinds))
    j = key_column_usage.join(tc, F.col("constraint_name") == F.col("_cn"), "inner")
    return j.groupBy("table_schema", "table_name", "column_name").agg(
        F.array_join(F.array_sort(F.collect_list("constraint_type")), ", ").alias("key_constraint"))


def business_keys(table_constraints: DataFrame, key_column_usage: DataFrame) -> DataFrame:
    """Columns under a PRIMARY KEY or UNIQUE constraint (J13; foreign keys excluded)."""
    return key_columns(table_constraints, key_column_usage, ("PRIMARY KEY", "UNIQUE"))


def table_metadata(columns: DataFrame, table_constraints: DataFrame,
                   key_column_usage: DataFrame) -> DataFrame:
    """columns LEFT JOIN key usage LEFT JOIN constraints (J7): one row per
    (column, constraint), max_length = char length else numeric precision."""
    kcu = key_column_usage.select(F.col("table_name").alias("_k_t"), F.col("column_name").alias("_k_c"),
                                  F.col("constraint_name").alias("_k_cn"))
    tc = table_constraints.select(F.col("constraint_name").alias("_t_cn"), "constraint_type",
                                  "constraint_name")
    j = columns.join(kcu, (F.col("table_name") == F.col("_k_t")) & (F.col("column_name") == F.col("_k_c")), "left")
    j = j.join(tc, F.col("_k_cn") == F.col("_t_cn"), "left")
    return j.select("table_schema", "table_name", "column_name", "ordinal_position", "data_type",
                    F.coalesce("character_maximum_length", "numeric_precision").alias("max_length"),
                    F.col("numeric_precision").alias("precisions"), F.col("numeric_scale").alias("scale"),
                    "is_nullable", "constraint_type", "constraint_name")


def identity_columns(columns: DataFrame) -> DataFrame:
    """The identity column of each table (S7): the first one by position."""
    ids = columns.where(F.col("is_identity") == "YES")
    g = ids.groupBy("table_schema", "table_name").agg(
        F.min(F.struct("ordinal_position", "column_name")).alias("_m"))
    return g.select("table_schema", "table_name", F.col("_m.column_name").alias("identity_column"))


def regex_name_filter(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Whole-name regular-expression match ``~ ('^(' || p || ')$')``."""
    return df.where(F.col(column).rlike("^(" + pattern + ")$"))


def missing_targets(runs: DataFrame, existing: DataFrame) -> DataFrame:
    """Due runs whose target table does not exist yet (S6), per (schema, table)."""
    e = existing.select(F.col("table_schema").alias("_e_s"), F.col("table_name").alias("_e_t"))
    return runs.join(e, (F.col("targetschemaname") == F.col("_e_s")) & (F.col("targetobject") == F.col("_e_t")),
                     "left_anti")
