"""Constraint checks that PostgreSQL enforced and Spark does not (Q1-Q5).

Each check is one aggregation (partial, map-side combined) returning the
violations as rows, so the result stays small however large the table is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row (Q1, Q4, Q5).  Like SQL UNIQUE, rows with a
    NULL in the key never collide."""
    nn = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (df.where(nn).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def duplicate_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """(duplicated keys, surplus rows) in one row."""
    d = duplicate_keys(df, keys)
    return d.agg(F.count(F.lit(1)).alias("dup_keys"),
                 F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("surplus_rows"))


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NULLs per column (Q2): one pass, then unpivoted to (column_name, n_null)."""
    cols = cols or df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "n_null")


def not_null_violations(df: DataFrame, not_null_cols: list[str]) -> DataFrame:
    """Declared NOT NULL columns holding NULLs."""
    return null_counts(df, not_null_cols).where(F.col("n_null") > 0)


def length_violations(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """VARCHAR(n) checks (Q3): per column the longest value and rows over n."""
    aggs = []
    for c, n in limits.items():
        ln = F.length(F.col(c))
        aggs += [F.max(ln).cast("long").alias(f"{c}__max"),
                 F.count_if(ln > n).cast("long").alias(f"{c}__over")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(n).alias("max_length"),
                     F.col(f"{c}__max").alias("longest"), F.col(f"{c}__over").alias("n_over"))
            for c, n in limits.items()]
    return wide.select(F.inline(F.array(*rows)))
