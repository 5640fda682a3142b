"""The queries that SQL can express, over tables with every awkward case, against their SQL."""

import sys

import duckdb
import pytest

from lakeloom.llm import queries as Q
from llm_data import edge_docs, no_docs, write_tables

sys.path.insert(0, "tools")
from oracle_check import rows_of  # noqa: E402

NAN, INF = float("nan"), float("inf")


def compare(spark, name, path):
    df = Q.QUERIES[name](spark, path)
    got = rows_of(df.columns, df.collect())
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations", "benchmark"):
        try:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/{t}.parquet/*.parquet')")
        except duckdb.IOException:
            pass
    r = con.execute(Q.ORACLES[name])
    assert got == rows_of([d[0] for d in r.description], r.fetchall())
    return got[1]


@pytest.mark.parametrize("name", ["op8_exact_dedup", "op9_mixing"])
def test_documents(spark, tmp_path, name):
    assert len(compare(spark, name, write_tables(spark, tmp_path, documents=edge_docs(spark)))) == 16


@pytest.mark.parametrize("name", ["op8_exact_dedup", "op9_mixing"])
def test_no_documents(spark, tmp_path, name):
    assert compare(spark, name, write_tables(spark, tmp_path, documents=no_docs(spark))) == []


def test_urls(spark, tmp_path):
    urls = [None, "", "no scheme casino", "http://A.example.COM/en/x?adult=1", "http://example.com", "http://example.com/en/", "https://www.example.com/en/free-bets",
            "http://x.net/es/1", "http://net/fr/", "http://xnet/fr/", "http://free.org/win", "http://free.org/free/free", "http://freewin.org/", "http://casino", "http://casinos/",
            "http://a.org/p#casino", "HTTP://B.ORG/Spam", "http://é.org/ßspamß", "ftp://x.com.net/es/?a://b", "http://free.org/" + "x" * 100_000 + "/win", "http://com/", "://", "http://?q", "casino"]
    rows = [(i, u, "<p>", "clash", "clash") for i, u in enumerate(urls)] + [(3, urls[3], None, "c", "c"), (None, "http://spam.org/", None, "c", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, verdict string")
    path = write_tables(spark, tmp_path, pages=pages)
    df = Q.op4_url_filter(spark, path)
    got = {r["page_id"]: r for r in df.collect()}
    assert df.count() == len(rows)
    assert got[0]["verdict"] == "allow" and got[0]["host"] == got[2]["host"] == "" and got[2]["verdict"] == "block"
    assert got[3]["rule"] == "example.com/en/" and got[3]["host"] == "a.example.com"
    assert got[6]["rule"] == "www.example.com/en/" and got[6]["verdict"] == "allow"
    assert [got[i]["verdict"] for i in (10, 11, 12, 13, 14)] == ["block", "allow", "allow", "block", "allow"]
    assert got[4]["rule"] is None and got[9]["rule"] is None and got[None]["verdict"] == "block"
    ids = spark.createDataFrame([r for r in rows if r[0] is not None and r != rows[-2]], pages.schema)
    compare(spark, "op4_url_filter", write_tables(spark, tmp_path / "ids", pages=ids))
    assert Q.op4_url_filter(spark, write_tables(spark, tmp_path / "none", pages=pages.limit(0))).collect() == []


def test_vectors(spark, tmp_path):
    vecs = [(0, [0.5, 0.25]), (1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [0.9, -0.1]), (4, None), (5, []), (6, [1.0, None]), (7, [NAN, 1.0]), (8, [INF, 1.0]),
            (50, [0.5, 0.25]), (100, [0.1]), (101, [0.3]), (150, [-0.001, -0.7]), (9, [0.5, 0.25]), (10, [0.5, 0.25]), (11, [0.5, 0.25])]
    df = spark.createDataFrame([(i, v, "c", "c") for i, v in vecs], "vec_id long, embedding array<float>, number string, score string").repartition(3)
    rows = compare(spark, "op6_exact_topk", write_tables(spark, tmp_path, embeddings=df))
    assert len(rows) == 5 + 5 + 1 + 5
    assert Q.op6_exact_topk(spark, write_tables(spark, tmp_path / "none", embeddings=df.limit(0))).collect() == []


def test_vectors_in_blocks_and_beyond_53_bits(spark):
    from lakeloom.llm.topk import top_k
    import numpy as np
    rng = np.random.default_rng(0)
    big = rng.integers(-2 ** 28, 2 ** 28, (60, 4))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(big)], "vec_id long, embedding array<double>")
    got = {}
    for r in top_k(df.where("vec_id % 10 = 0"), df, k=3, scale=1, block_bytes=64).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q in range(0, 60, 10):
        s = sorted(((-int(sum(int(a) * int(b) for a, b in zip(big[q], big[c]))), c) for c in range(60) if c != q))[:3]
        assert sorted(got[q]) == [(i + 1, c, -x) for i, (x, c) in enumerate(s)]
