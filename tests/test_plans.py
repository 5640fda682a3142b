"""Plan properties of every registered query: no cross joins, limits pushed."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

QUERIES = E.queries()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_topk_limits_before_the_shuffle(spark):
    plan = _plan(QUERIES["knn_topk"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(QUERIES["silver_inserts"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


@pytest.mark.parametrize("name", ["run_durations", "audit_after_post", "detail_after_post", "header_after_post", "groups_after_post",
                                  "audit_after_error", "header_after_error", "detail_after_error", "error_rows", "due_runs"])
def test_no_control_table_is_broadcast(spark, name):
    # the tables grow with the data, whatever the bytes of their files; only offsets of the row index may be broadcast
    joins = [line for line in _plan(QUERIES[name](spark, SF_SMALL)).splitlines() if "Join" in line]
    assert joins and [line for line in joins if "Broadcast" in line and "_spid" not in line] == []
