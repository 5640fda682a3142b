"""Queries of fuzzy column matching and the legacy mapped upsert."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import matching as mt
from ..operators.upsert import upsert
from ..sources.tables import Tables
from .fixture_sql import AS_OF_SQL
from .registry import register


@register("fuzzy_columns")
def fuzzy_columns(spark, sf_dir):
    """Best fuzzy target column per source column of every table pair.

    No SQL form (the ratio is Python's SequenceMatcher); tests compare it with
    ``difflib.get_close_matches`` by brute force."""
    t = Tables(spark, sf_dir)
    src = fx.column_catalog(t).select("table_name", "column_name")
    pairs = fx.catalog_tables(t).select(F.col("table_name").alias("source_table"),
                                        F.concat(F.lit("d_"), F.col("table_name")).alias("target_table"))
    m = mt.fuzzy_column_match(src, fx.fuzzy_targets(t), pairs)
    return m.select("source_table", "target_table", "source_column", "target_column",
                    F.col("ratio").cast("float").alias("ratio"))


_COLS = "o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_META = "'job_orders' AS etljobname, 'ENV1' AS envsourcecd, 'BUILDING' AS datasourcecd"


@register("upsert_mapped", f"""
WITH tgt AS (SELECT orderskey, o_orderkey AS o_order_key, {_COLS}, etlactiveind, etljobname, envsourcecd,
                    datasourcecd, etlcreateddatetime, etlupdateddatetime FROM silver_before),
upd AS (SELECT t.orderskey, t.o_order_key, s.o_custkey, s.o_orderstatus, s.o_totalprice, s.o_orderdate,
               s.o_orderpriority, 1 AS etlactiveind, {_META}, t.etlcreateddatetime,
               {AS_OF_SQL} AS etlupdateddatetime
        FROM tgt t JOIN orders s ON t.o_order_key = s.o_orderkey),
keep AS (SELECT * FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM orders s WHERE s.o_orderkey = t.o_order_key)),
ins AS (SELECT (SELECT coalesce(max(orderskey), 0) FROM tgt)
                 + row_number() OVER (ORDER BY o_orderkey, {_COLS}) AS orderskey,
               CAST(NULL AS BIGINT) AS o_order_key, CAST(NULL AS BIGINT) AS o_custkey, o_orderstatus,
               o_totalprice, o_orderdate, o_orderpriority, 1 AS etlactiveind, {_META},
               {AS_OF_SQL} AS etlcreateddatetime, {AS_OF_SQL} AS etlupdateddatetime
        FROM orders s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.o_order_key = s.o_orderkey))
SELECT * FROM upd UNION ALL SELECT * FROM keep UNION ALL SELECT * FROM ins""", fixtures=["silver_before"])
def upsert_mapped(spark, sf_dir):
    """Legacy upsert: key matched by name similarity, update by exact names,
    insert of the target columns not ending in 'key' (M2)."""
    t = Tables(spark, sf_dir)
    target = fx.silver_before(t).withColumnRenamed("o_orderkey", "o_order_key")
    source = t.orders
    plan = mt.mapped_columns(source, target, ["o_orderkey"])
    return upsert(target, source, plan["keys"], surrogate="orderskey", meta=fx.ORDERS_META,
                  as_of=fx.as_of_col(), update_columns=plan["update_columns"],
                  insert_columns=plan["insert_columns"], insert_null_test="first").table
