"""The pipeline, stage by stage, against brute force."""

import contextlib
import hashlib
from collections import Counter

import corpus_pipeline as C
import numpy as np
import public_tokenizers as P
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F

from lakeloom.llm import mixing
from lakeloom.llm import queries as Q
from lakeloom.llm.bpe import load_ranks
from llm_data import DELETE, SF, components, edge_docs, fingerprint, no_docs, words, write_tables


def stage(name):
    return next(f for n, f in C.STAGES if n.startswith(name))


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_stages_are_the_five_in_order():
    assert [n.split()[0] for n, _ in C.STAGES] == ["language", "exact", "SimHash", "mixing", "byte-level"]


def test_language(spark):
    docs = edge_docs(spark)
    kept = stage("language")(spark, docs, SF)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in kept.collect()} == {13, 14, 15, 16}


def test_exact(spark, tmp_path):
    edge_docs(spark).write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    kept = stage("exact")(spark, docs, SF)
    best = {}
    for r in docs.collect():
        key, rank = (r["text"] or "").translate(DELETE), (-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"] or 0)
        if key not in best or rank < best[key][0]:
            best[key] = rank, tuple(r)
    assert kept.columns == docs.columns and rows(kept) == Counter(r for _, r in best.values())


def test_near(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(edge_docs(spark).select("doc_id", "text", "lang", "source", "n_chars"))
    docs.write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    kept, every = stage("SimHash")(spark, docs, SF), docs.collect()
    groups = {}
    for r, root in zip(every, components([fingerprint(r["text"]) for r in every])):
        groups.setdefault(root, []).append(r)
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(
        min((r["doc_id"] for r in g), key=lambda i: (i is None, i)) for g in groups.values())


def test_mixing(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = stage("mixing")(spark, docs, SF)
    assert got.columns == docs.columns
    taken = Counter(r["doc_id"] for r in got.collect())
    want = {r["doc_id"]: r["times"] for r in mixing.mix(docs).collect()}
    assert taken == Counter({i: n for i, n in want.items() if n}) and max(taken.values()) <= 2
    size = {r["doc_id"]: len(words(r["text"])) for r in docs.collect()}
    assert abs(sum(n * size[i] for i, n in taken.items()) / sum(size.values()) - 1.5) < 0.05


def test_positions_follow_the_schedule(spark):
    """Words delivered by time t follow the integral of each source's schedule."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    copies = mixing.taken_copies(mixing.mix(docs)).toPandas()
    for place, own in copies.groupby("place"):
        rates, knots = mixing.SCHEDULES[place % 3], mixing.KNOTS
        t = np.linspace(0, 1, 2001)
        w = np.interp(t, knots, rates)
        demand = np.concatenate([[0], np.cumsum((w[1:] + w[:-1]) / 2 * np.diff(t))])
        demand /= demand[-1]
        own = own.sort_values(["copy", "before"])
        part = ((own.before + own.copy_ if "copy_" in own else own.before + own["copy"] * own.source_size) / own.target).clip(0, 1)
        assert np.allclose(np.interp(own.position, t, demand), part, atol=2e-3)
        assert own.position.is_monotonic_increasing


def test_targets_water_filling(spark):
    df = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 0), ("d", 500), (None, 40)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    sizes, weights = {"a": 10, "b": 1000, "c": 0, "d": 500, None: 40}, {"a": 3, "b": 1, "c": 2, "d": 3, None: 1}
    want, left, free = {}, 1.5 * 1550, set(sizes)
    while True:
        level = left / sum(weights[s] for s in free)
        over = {s for s in free if level * weights[s] > 2 * sizes[s]}
        if not over:
            break
        for s in over:
            want[s] = 2.0 * sizes[s]
            left -= want[s]
        free -= over
    want |= {s: level * weights[s] for s in free}
    assert all(abs(got[s] - want[s]) < 1e-9 * max(1, want[s]) for s in sizes) and abs(sum(got.values()) - 1.5 * 1550) < 1e-6


def test_encoding(spark):
    docs = edge_docs(spark)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    want = Counter()
    for r in docs.collect():
        ids = np.array(enc.encode_ordinary(r["text"] or ""), "<u4").tobytes()
        want[r["doc_id"], len(ids) // 4, ids, hashlib.sha256(ids).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()] += 1
    got = Counter((r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["ids_sha256"], r["decoded_sha256"]) for r in stage("byte-level")(spark, docs, SF).collect())
    assert got == want


def test_run(spark):
    assert C.ORACLE_SQL is None
    assert C.run(spark, SF).count() > 200


def test_empty(spark):
    docs = no_docs(spark)
    for name, f in C.STAGES[:-1]:
        out = f(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == 0, name
    assert C.STAGES[-1][1](spark, docs, SF).count() == 0


def test_op9_runs_the_training_order(spark, tmp_path, monkeypatch):
    """Positions are computed, sorted and stored, and ``taken`` is counted from them."""
    path = write_tables(spark, tmp_path, documents=edge_docs(spark))
    whole = Q.op9_mixing(spark, path).collect()
    order = Q.op9_training_order(spark, path).collect()
    assert all(0 <= r["position"] <= 1 for r in order) and len({r["position"] for r in order}) > 3
    assert sum(r["size"] for r in order) == sum(r["taken"] for r in whole) > 0
    mixed, stored = mixing.ordered(edge_docs(spark))
    files = sorted(f.removeprefix("file:") for f in stored.inputFiles())  # files are numbered in order
    positions = [p for f in files for p in pq.read_table(f).column("position").to_pylist()]
    assert len(positions) == len(order) and positions == sorted(positions)
    rows = mixing.folded(mixed, stored).collect()
    assert len(rows) == len(whole) == 16
    assert all(len(r["positions"]) == r["times"] and r["taken"] == r["size"] * r["times"] for r in rows)
    every = mixing.training_order
    monkeypatch.setattr(mixing, "training_order", lambda mixed: every(mixed).where("copy = 0"))
    once = Q.op9_mixing(spark, path).collect()
    assert sum(r["taken"] for r in once) == sum(r["size"] for r in order if r["copy"] == 0) < sum(r["taken"] for r in whole)


#: names that the stages or their operators use inside, as the caller's columns
TAKEN = ["position", "place", "before", "copy", "lang_pred", "lang_score", "pipeline_row", "pipeline_position", "row", "member", "times", "source_size", "order", "range", "size"]


def awkward(spark, path):
    """Nulls, repeated rows and ids, ties, clashing names; in 12 files."""
    small = spark.read.parquet(f"{SF}/documents.parquet")
    edge = edge_docs(spark).select("doc_id", "text", "lang", "source", "n_chars")
    docs = small.unionByName(edge).unionByName(small.where("doc_id % 3 = 0"))
    docs.select("*", *[F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in TAKEN]) \
        .repartition(12).write.parquet(path)
    return path


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    return awkward(spark, str(tmp_path_factory.mktemp("awkward") / "d"))


@contextlib.contextmanager
def cores(spark, n):
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", n)
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


@pytest.mark.parametrize("name", ["exact", "SimHash", "mixing"])
def test_stages_read_the_same_rows_on_any_number_of_cores(spark, files, name):
    """What a stage decided holds when its input is split otherwise at the second read."""
    with cores(spark, 2):
        want = rows(stage(name)(spark, spark.read.parquet(files), SF))
    with cores(spark, 2):
        out = stage(name)(spark, spark.read.parquet(files), SF)
    with cores(spark, 12):
        assert out.sparkSession.read.parquet(files).rdd.getNumPartitions() > 4
        assert rows(out) == want and sum(want.values()) > 100


def test_stages_keep_columns_of_any_name(spark, files):
    docs = spark.read.parquet(files)
    every = rows(docs)
    for name, f in C.STAGES[:-1]:
        out = f(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        kept = rows(out)
        assert set(kept) <= set(every) and len(kept) > 100, name
        if not name.startswith("mixing"):
            assert all(n <= every[r] for r, n in kept.items()), name
    assert C.STAGES[-1][1](spark, docs, SF).count() == sum(every.values())


def test_exact_and_near_on_awkward_rows(spark, files):
    docs = spark.read.parquet(files)
    every = docs.collect()
    kept = stage("exact")(spark, docs, SF).collect()
    keys = [(r["text"] or "").translate(DELETE) for r in kept]
    assert Counter(keys) == Counter({(r["text"] or "").translate(DELETE) for r in every})
    groups = Counter(components([fingerprint(r["text"]) for r in every]))
    assert stage("SimHash")(spark, docs, SF).count() == len(groups)


def test_mixing_on_awkward_rows_against_brute_force(spark, files):
    """Targets, times and the order of training, recomputed in plain Python."""
    docs = spark.read.parquet(files)
    every = [(r, len(words(r["text"]))) for r in docs.collect()]
    sources = sorted({r["source"] for r, _ in every}, key=lambda s: (s is None, s or ""))
    weight = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(sources)}
    total = {s: sum(n for r, n in every if r["source"] == s) for s in sources}
    target, left, free = {}, 1.5 * sum(total.values()), set(sources)
    while over := {s for s in free if left / sum(weight[x] for x in free) * weight[s] > 2 * total[s]}:
        target |= {s: 2.0 * total[s] for s in over}
        left -= sum(target[s] for s in over)
        free -= over
    target |= {s: left / sum(weight[x] for x in free) * weight[s] for s in free}
    want, starts = Counter(), []
    for place, s in enumerate(sources):
        mine = sorted(((hashlib.md5(str(r["doc_id"] if r["doc_id"] is not None else "").encode()).hexdigest(), n, r) for r, n in every if r["source"] == s),
                      key=lambda x: x[:2])
        whole, before = (int(target[s] // total[s]) if total[s] else 0), 0
        t = np.linspace(0, 1, 4001)
        rate = np.interp(t, mixing.KNOTS, mixing.SCHEDULES[place % 3])
        demand = np.concatenate([[0], np.cumsum((rate[1:] + rate[:-1]) / 2 * np.diff(t))])
        for _, n, r in mine:
            times = 0 if n == 0 else whole + (before + n / 2 <= target[s] - whole * total[s])
            want[tuple(r)] += times
            starts += [(np.interp((before + c * total[s]) / target[s], demand / demand[-1], t), tuple(r)) for c in range(times)]
            before += n
    out = stage("mixing")(spark, docs, SF).collect()
    assert Counter(map(tuple, out)) == +want
    at = {}
    for p, r in starts:
        at.setdefault(r, []).append(p)
    best = [min(at[tuple(r)], key=lambda p, i=i: abs(p - i)) for i, r in zip(np.sort([p for p, _ in starts]), out)]
    assert np.allclose(best, np.sort([p for p, _ in starts]), atol=5e-3)
