"""Scalar column expressions (F1-F22) shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# The audit columns every silver table carries, with their DDL types.
AUDIT_COLUMNS = [
    ("etlactiveind", "INT"),
    ("etljobname", "VARCHAR(200)"),
    ("envsourcecd", "VARCHAR(50)"),
    ("datasourcecd", "VARCHAR(50)"),
    ("etlcreateddatetime", "TIMESTAMP DEFAULT now()"),
    ("etlupdateddatetime", "TIMESTAMP"),
]
AUDIT_NAMES = [n for n, _ in AUDIT_COLUMNS]

# Flow-name prefix -> load module; anything else goes to the gold load.


@dataclass(frozen=True)
class Flows:
    """The caller's flow codes, by the layer a flow loads."""
    bronze: str = "raw_to_bronze"
    silver: str = "bronze_to_silver"
    gold: str = "silver_to_gold"


FLOWS = Flows()
FLOW_MODULES = {"raw": "raw_to_bronze", "bro": "bronze_to_silver"}
DEFAULT_MODULE = "dwhtoclick"


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def surrogate_key_name(table: str) -> str:
    """Second '_'-part of the silver table name + 'key' ('' when there is none)."""
    parts = table.split("_")
    return (parts[1] if len(parts) > 1 else "") + "key"


def surrogate_key_name_col(table) -> Column:
    """Column form of :func:`surrogate_key_name` (``split_part(t, '_', 2) || 'key'``)."""
    return F.concat(F.split_part(c(table), F.lit("_"), F.lit(2)), F.lit("key"))


def legacy_key_name_col(table) -> Column:
    """Legacy identity name: table name from its third character + 'key'."""
    return F.concat(F.substring(c(table), 3, 1 << 30), F.lit("key"))


def neg_one_to_null(x) -> Column:
    """Length -1 (unbounded) becomes NULL (F16)."""
    return F.when(c(x) == -1, F.lit(None)).otherwise(c(x))


def flow_module(flow) -> Column:
    """Which load runs a flow: first three letters, lower-cased."""
    p = F.lower(F.substring(c(flow), 1, 3))
    expr = F.lit(DEFAULT_MODULE)
    for k, v in FLOW_MODULES.items():
        expr = F.when(p == k, F.lit(v)).otherwise(expr)
    return expr


def yes_no_bool(x) -> Column:
    """information_schema 'YES'/'NO' -> boolean (F8)."""
    return F.when(F.upper(c(x)) == "YES", F.lit(True)).when(F.upper(c(x)) == "NO", F.lit(False))


def document_text(table, column, dtype, description=None) -> Column:
    """``Table: t | Column: c | Type: d [| Description: x]`` (V1); NULL parts print as None."""
    parts = [F.concat(F.lit("Table: "), F.coalesce(c(table).cast("string"), F.lit("None"))),
             F.concat(F.lit("Column: "), F.coalesce(c(column).cast("string"), F.lit("None"))),
             F.concat(F.lit("Type: "), F.coalesce(c(dtype).cast("string"), F.lit("None")))]
    if description is not None:
        parts.append(F.when(c(description).isNotNull(),
                            F.concat(F.lit("Description: "), c(description).cast("string"))))
    return F.concat_ws(" | ", *parts)


def elapsed_micros(start, end) -> Column:
    """Run duration in microseconds from audit start/end times."""
    return (F.unix_micros(c(end).cast("timestamp")) - F.unix_micros(c(start).cast("timestamp"))).cast("long")


def batch_token() -> Column:
    """Random 11-character run token of letters and digits (F18); not deterministic, never hashed."""
    return F.expr("randstr(11)")
