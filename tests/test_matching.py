"""Fuzzy column matching equals difflib.get_close_matches, brute force."""

import difflib
from collections import defaultdict

from pyspark.sql import functions as F

from lakeloom import fixtures as fx
from lakeloom.operators import matching as mt


def test_fuzzy_matches_stdlib(tables):
    src = fx.column_catalog(tables).select("table_name", "column_name")
    tgt = fx.fuzzy_targets(tables)
    pairs = fx.catalog_tables(tables).select(F.col("table_name").alias("source_table"),
                                             F.concat(F.lit("d_"), F.col("table_name")).alias("target_table"))
    got = {(r.source_table, r.source_column): r.target_column
           for r in mt.fuzzy_column_match(src, tgt, pairs).collect()}
    by_t = defaultdict(list)
    for r in tgt.collect():
        by_t[r.table_name].append(r.column_name)
    exp = {}
    for r in src.collect():
        m = difflib.get_close_matches(r.column_name, by_t["d_" + r.table_name], n=1, cutoff=0.6)
        if m:
            exp[(r.table_name, r.column_name)] = m[0]
    assert got == exp


def test_mapped_columns(spark):
    source = spark.createDataFrame([], "o_orderkey long, o_custkey long, x long, note string")
    target = spark.createDataFrame([], "orderskey long, o_order_key long, o_custkey long, note string")
    plan = mt.mapped_columns(source, target, ["o_orderkey", "x"])
    assert plan == {"keys": [("o_orderkey", "o_order_key")], "update_columns": ["o_custkey", "note"],
                    "insert_columns": ["note"]}


def test_a_table_of_any_width_is_matched(spark):
    wide = [f"column_{i:05d}" for i in range(1700)]
    src = spark.createDataFrame([("s", c + "x") for c in wide[:3]], "table_name string, column_name string")
    tgt = spark.createDataFrame([("t", c) for c in wide], "table_name string, column_name string")
    pair = spark.createDataFrame([("s", "t")], "source_table string, target_table string")
    got = {r.source_column: r.target_column for r in mt.fuzzy_column_match(src, tgt, pair).collect()}
    assert got == {c + "x": difflib.get_close_matches(c + "x", wide, n=1)[0] for c in wide[:3]}


def test_batched_ratios_equal_the_stdlib():
    import random

    from lakeloom.functions.names import letters, may_reach, ratios
    rng = random.Random(1)
    names = ["".join(rng.choice("abcde_0é") for _ in range(rng.randint(0, 24))) for _ in range(3000)]
    a, b = names, names[::-1]
    a += ["x" * 250 + "y", "ab" * 150, "", "a" * 300]
    b += ["y" * 210 + "x", "ba" * 100, "", "a"]
    want = [difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)]
    assert ratios(a, b).tolist() == want
    lengths = __import__("numpy").array([len(x) + len(y) for x, y in zip(a, b)])
    for cutoff in (0.3, 0.6, 1.0):
        may = may_reach(letters(a), letters(b), lengths, cutoff)
        assert all(may[i] for i, r in enumerate(want) if r >= cutoff) and not may.all()


def test_any_cut_off_and_names_of_any_kind(spark):
    names = ["", "a", "aa", "customer_key", "key_customer", "cust", "ß", "x" * 300, "x" * 290 + "y"]
    src = spark.createDataFrame([("s", c + s) for c in names for s in ("", "1")] + [("s", None)], "table_name string, column_name string")
    tgt = spark.createDataFrame([("t", c + s) for c in names for s in ("2", "_")] + [("t", None)], "table_name string, column_name string")
    pair = spark.createDataFrame([("s", "t")], "source_table string, target_table string")
    targets = [r.column_name for r in tgt.collect() if r.column_name is not None]
    for cutoff in (0.0, 0.25, 0.6, 1.0):
        got = {r.source_column: r.target_column for r in mt.fuzzy_column_match(src, tgt, pair, cutoff).collect()}
        want = {r.column_name: difflib.get_close_matches(r.column_name, targets, n=1, cutoff=cutoff) for r in src.collect() if r.column_name is not None}
        assert got == {k: v[0] for k, v in want.items() if v}, cutoff
