"""Queries of the silver upsert family."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators.rowindex import with_row_index
from ..operators.upsert import upsert
from ..session import ensure_checkpoint_dir
from ..sinks import keyed
from ..sinks import snapshot as snap
from ..sources.tables import Tables
from .fixture_sql import AS_OF_SQL
from .registry import register

_SRC_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_SRC_LIST = ", ".join(_SRC_COLS)
_ORDER_ALL = ", ".join(f"{c} ASC NULLS FIRST" for c in _SRC_COLS)
_META = "'job_orders' AS etljobname, 'ENV1' AS envsourcecd, 'BUILDING' AS datasourcecd"


def orders_upsert(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return upsert(fx.silver_before(t), fx.bronze_orders(t), fx.ORDERS_KEYS,
                  surrogate="orderskey", meta=fx.ORDERS_META, as_of=fx.as_of_col())


_UPSERT_PARTS = f"""
WITH upd AS (
  SELECT t.orderskey, s.o_orderkey, s.o_custkey, s.o_orderstatus, s.o_totalprice, s.o_orderdate,
         s.o_orderpriority, 1 AS etlactiveind, {_META},
         t.etlcreateddatetime, {AS_OF_SQL} AS etlupdateddatetime
  FROM silver_before t JOIN orders s ON t.o_orderkey = s.o_orderkey),
keep AS (
  SELECT t.* FROM silver_before t
  WHERE NOT EXISTS (SELECT 1 FROM orders s WHERE s.o_orderkey = t.o_orderkey)),
ins AS (
  SELECT (SELECT coalesce(max(orderskey), 0) FROM silver_before)
           + row_number() OVER (ORDER BY {_ORDER_ALL}) AS orderskey,
         {_SRC_LIST}, 1 AS etlactiveind, {_META},
         {AS_OF_SQL} AS etlcreateddatetime, {AS_OF_SQL} AS etlupdateddatetime
  FROM orders s
  WHERE NOT EXISTS (SELECT 1 FROM silver_before t WHERE t.o_orderkey = s.o_orderkey))
"""


@register("silver_upsert", _UPSERT_PARTS + "SELECT * FROM upd UNION ALL SELECT * FROM keep UNION ALL SELECT * FROM ins",
          fixtures=["silver_before"])
def silver_upsert(spark, sf_dir):
    """The new silver table after the upsert of all orders."""
    return orders_upsert(spark, sf_dir).table


@register("silver_updates", _UPSERT_PARTS + "SELECT * FROM upd", fixtures=["silver_before"])
def silver_updates(spark, sf_dir):
    """Matched rows as written by the UPDATE ... FROM."""
    return orders_upsert(spark, sf_dir).updates


@register("silver_inserts", _UPSERT_PARTS + "SELECT * FROM ins", fixtures=["silver_before"])
def silver_inserts(spark, sf_dir):
    """Rows of the INSERT ... LEFT JOIN ... IS NULL, i.e. the anti join (J4), with keys."""
    return orders_upsert(spark, sf_dir).inserts


@register("upsert_counts", _UPSERT_PARTS + """
SELECT CAST((SELECT count(1) FROM orders) AS BIGINT) AS srccnt,
       CAST((SELECT count(*) FROM ins) AS BIGINT) AS inscnt,
       CAST((SELECT count(*) FROM upd) AS BIGINT) AS updcnt,
       CAST(NULL AS BIGINT) AS dltcount""", fixtures=["silver_before"])
def upsert_counts(spark, sf_dir):
    """srccnt / inscnt / updcnt of the load (A1, A2)."""
    return orders_upsert(spark, sf_dir).counts()


@register("bucket_upsert", _UPSERT_PARTS + "SELECT * FROM upd UNION ALL SELECT * FROM keep UNION ALL SELECT * FROM ins",
          fixtures=["silver_before"])
def bucket_upsert(spark, sf_dir):
    """The same upsert into a stored table kept in buckets of the key's hash, read back: key filters say which
    buckets hold source keys, only those are read and rewritten, others get their new rows as a part (U1, K6, J3)."""
    t = Tables(spark, sf_dir)
    root = ensure_checkpoint_dir(spark).rstrip("/") + f"/lakeloom-keyed-{uuid.uuid4().hex}"
    keyed.load(fx.silver_before(t), root, "silver/orders", fx.ORDERS_KEYS, "orderskey", buckets=16)
    keyed.upsert(spark, root, "silver/orders", fx.bronze_orders(t), fx.ORDERS_KEYS, surrogate="orderskey", meta=fx.ORDERS_META, as_of=fx.as_of_col())
    return snap.read_table(spark, root, "silver/orders")


_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("surrogate_key", f"""
SELECT row_number() OVER (ORDER BY {", ".join(c + " ASC NULLS FIRST" for c in _LI_COLS)}) AS lineitemkey,
       {", ".join(_LI_COLS)}
FROM lineitem""")
def surrogate_key(spark, sf_dir):
    """Identity key 1, 2, 3, ... over a whole table in key order (W3), distributed."""
    li = Tables(spark, sf_dir).lineitem
    return with_row_index(li, _LI_COLS, name="lineitemkey").select("lineitemkey", *_LI_COLS)


@register("keyless_append", f"""
SELECT * FROM silver_before
UNION ALL
SELECT (SELECT coalesce(max(orderskey), 0) FROM silver_before)
         + row_number() OVER (ORDER BY {_ORDER_ALL}) AS orderskey,
       {_SRC_LIST}, 1 AS etlactiveind, {_META},
       {AS_OF_SQL} AS etlcreateddatetime, {AS_OF_SQL} AS etlupdateddatetime
FROM orders""", fixtures=["silver_before"])
def keyless_append(spark, sf_dir):
    """A table without business key: the source is appended, never cross-joined."""
    t = Tables(spark, sf_dir)
    r = upsert(fx.silver_before(t), fx.bronze_orders(t), [], keyless="append",
               surrogate="orderskey", meta=fx.ORDERS_META, as_of=fx.as_of_col())
    return r.table


@register("scan_bronze", "SELECT * FROM orders")
def scan_bronze(spark, sf_dir):
    """Full scan of the bronze table."""
    return Tables(spark, sf_dir).orders


@register("silver_only_changed", _UPSERT_PARTS.replace(
    "FROM silver_before t JOIN orders s ON t.o_orderkey = s.o_orderkey)",
    "FROM silver_before t JOIN orders s ON t.o_orderkey = s.o_orderkey\n"
    "  WHERE t.o_totalprice IS DISTINCT FROM s.o_totalprice OR t.o_custkey IS DISTINCT FROM s.o_custkey\n"
    "     OR t.o_orderstatus IS DISTINCT FROM s.o_orderstatus OR t.o_orderdate IS DISTINCT FROM s.o_orderdate\n"
    "     OR t.o_orderpriority IS DISTINCT FROM s.o_orderpriority)") + """
SELECT count(*) AS n_updated, round(sum(o_totalprice), 2) AS updated_price FROM upd""",
          fixtures=["silver_before"])
def silver_only_changed(spark, sf_dir):
    """Option ``only_changed``: matched rows whose values are all equal stay untouched."""
    t = Tables(spark, sf_dir)
    r = upsert(fx.silver_before(t), fx.bronze_orders(t), fx.ORDERS_KEYS, surrogate="orderskey",
               meta=fx.ORDERS_META, as_of=fx.as_of_col(), only_changed=True)
    return r.updates.agg(F.count(F.lit(1)).alias("n_updated"),
                         F.round(F.sum("o_totalprice"), 2).alias("updated_price"))
