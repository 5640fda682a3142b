"""Upsert semantics and laws: counts, NULL keys, idempotence, surrogate keys."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeloom.operators.upsert import dedupe_source, source_duplicates, upsert

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 6, 1)
T2 = dt.datetime(2024, 7, 1)
META = {"etljobname": "j", "envsourcecd": "e", "datasourcecd": "d"}
TSCHEMA = ("customerkey long, k long, name string, bal double, etlactiveind int, etljobname string, "
           "envsourcecd string, datasourcecd string, etlcreateddatetime timestamp_ntz, "
           "etlupdateddatetime timestamp_ntz")


def _target(spark):
    rows = [(1, 10, "a", 1.0, 1, "o", "o", "o", T0, T0), (2, 20, "b", 2.0, 1, "o", "o", "o", T0, T0),
            (3, None, "n", 3.0, 1, "o", "o", "o", T0, T0)]
    return spark.createDataFrame(rows, TSCHEMA)


def _source(spark):
    return spark.createDataFrame([(10, "a2", 1.5), (30, "c", 3.0), (None, "nk", 9.0)],
                                 "k long, name string, bal double")


def test_upsert_rows_and_counts(spark):
    r = upsert(_target(spark), _source(spark), ["k"], surrogate="customerkey", meta=META, as_of=T1)
    rows = {(x.k, x.name): x for x in r.table.collect()}
    assert rows[(10, "a2")].customerkey == 1 and rows[(10, "a2")].etlcreateddatetime == T0
    assert rows[(10, "a2")].etlupdateddatetime == T1 and rows[(10, "a2")].etljobname == "j"
    assert rows[(20, "b")].etljobname == "o"                      # untouched
    assert rows[(None, "n")].etljobname == "o"                    # NULL key in target: kept
    assert rows[(None, "nk")].etlcreateddatetime == T1            # NULL key in source: inserted
    new_keys = sorted(x.customerkey for x in r.inserts.collect())
    assert new_keys == [4, 5]                                      # continue after max, dense
    c = r.counts().collect()[0]
    assert (c.srccnt, c.inscnt, c.updcnt, c.dltcount) == (3, 2, 1, None)
    assert r.table.count() == 3 + c.inscnt


def test_upsert_idempotent_except_timestamps(spark):
    first = upsert(_target(spark), _source(spark), ["k"], surrogate="customerkey", meta=META, as_of=T1).table
    first = first.cache()
    second = upsert(first, _source(spark), ["k"], surrogate="customerkey", meta=META, as_of=T2)
    c = second.counts().collect()[0]
    assert c.updcnt == 2 and c.inscnt == 1                         # the NULL-key row comes in again
    cols = [x for x in first.columns if x not in ("etlupdateddatetime",)]
    a = sorted(map(tuple, first.where(F.col("k").isNotNull()).select(cols).collect()))
    b = sorted(map(tuple, second.table.where(F.col("k").isNotNull()).select(cols).collect()))
    assert a == b


def test_only_changed(spark):
    first = upsert(_target(spark), _source(spark), ["k"], surrogate="customerkey", meta=META, as_of=T1).table.cache()
    again = upsert(first, _source(spark).where("k is not null"), ["k"], surrogate="customerkey", meta=META,
                   as_of=T2, only_changed=True)
    assert again.counts().collect()[0].updcnt == 0


def test_keyless_refused_and_append(spark):
    with pytest.raises(ValueError):
        upsert(_target(spark), _source(spark), [], surrogate="customerkey", meta=META, as_of=T1)
    r = upsert(_target(spark), _source(spark), [], keyless="append", surrogate="customerkey", meta=META, as_of=T1)
    assert r.table.count() == 6


def test_source_duplicates_and_dedupe(spark):
    src = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "z", 1), (None, "n", 1), (None, "m", 1)],
                                "k long, v string, ver int")
    assert [(r.k, r.n) for r in source_duplicates(src, ["k"]).collect()] == [(1, 2)]
    d = {r.k: r.v for r in dedupe_source(src, ["k"], ["ver"]).collect()}
    assert d[1] == "y" and d[2] == "z"


def test_duplicate_source_keys_update_once_insert_all(spark):
    src = spark.createDataFrame([(10, "x", 1.0), (10, "y", 2.0), (40, "p", 1.0), (40, "q", 2.0)],
                                "k long, name string, bal double")
    r = upsert(_target(spark), src, ["k"], surrogate="customerkey", meta=META, as_of=T1)
    rows = r.table.collect()
    assert len([x for x in rows if x.k == 10]) == 1          # updated once, from one source row
    assert {x.name for x in rows if x.k == 10} == {"y"}       # the greatest row wins
    assert len([x for x in rows if x.k == 40]) == 2          # both unmatched rows inserted
    c = r.counts().collect()[0]
    assert (c.srccnt, c.inscnt, c.updcnt) == (4, 2, 1)


def test_map_columns_with_a_surrogate(spark):
    from lakeloom.operators.upsert import upsert
    t = spark.createDataFrame([], "tkey long, k long, m map<string,string>")
    s = spark.createDataFrame([(1, {"a": "b"}), (2, {"c": "d"}), (2, {"e": "f"})], "k long, m map<string,string>")
    got = upsert(t, s, ["k"], surrogate="tkey").table.collect()
    assert sorted(r.tkey for r in got) == [1, 2, 3] and {tuple(r.m.items()) for r in got} == {(("a", "b"),), (("c", "d"),), (("e", "f"),)}
