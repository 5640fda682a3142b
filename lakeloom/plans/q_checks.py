"""Queries of the constraint checks (Q1-Q3, Q5)."""

from __future__ import annotations

from .. import fixtures as fx
from ..operators import checks as ck
from ..sources.tables import Tables
from .registry import register


@register("dq_unique", """
SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def dq_unique(spark, sf_dir):
    """Business keys held by more than one row (Q1)."""
    return ck.duplicate_keys(Tables(spark, sf_dir).lineitem, ["l_orderkey", "l_linenumber"])


@register("dq_source_dups", """
SELECT CAST(count(*) AS BIGINT) AS dup_keys, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows
FROM (SELECT count(*) AS n FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
      GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) d""")
def dq_source_dups(spark, sf_dir):
    """Source duplicates on the key before an upsert: duplicated keys and surplus rows (Q5)."""
    return ck.duplicate_summary(Tables(spark, sf_dir).lineitem, ["l_orderkey", "l_linenumber"])


_SL_COLS = ["source_id", "source_type", "source_schema", "source_table", "column_id", "column_name",
            "source_data_type", "length", "precisions", "scale", "nullable", "key_constraint", "target_table"]


@register("dq_not_null", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_null FROM source_lookup"
    for c in _SL_COLS), fixtures=["source_lookup"])
def dq_not_null(spark, sf_dir):
    """NULLs per column in one pass, unpivoted (Q2)."""
    return ck.null_counts(fx.source_lookup(Tables(spark, sf_dir)), _SL_COLS)


_LIMITS = {"text": 65535, "lang": 2, "source": 8}


@register("dq_length", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {n} AS max_length, CAST(max(length({c})) AS BIGINT) AS longest, "
    f"CAST(count(*) FILTER (WHERE length({c}) > {n}) AS BIGINT) AS n_over FROM documents"
    for c, n in _LIMITS.items()))
def dq_length(spark, sf_dir):
    """VARCHAR(n) checks over whole texts: longest value and rows over n (Q3)."""
    return ck.length_violations(Tables(spark, sf_dir).documents, _LIMITS)
