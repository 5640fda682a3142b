"""Conversation trie, WARC archives and importance resampling: awkward tables against SQL and brute force."""

import gzip
import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import conversation_trie as T
from lakeloom.llm import queries as Q
from lakeloom.llm import resampling as R
from lakeloom.llm import warc as W
from lakeloom.llm.common import placed, running, salted_lookup, stored
from llm_data import LOW, edge_docs, edge_rows, long_text, no_docs, write_tables
from test_llm_sql import compare

CONVERSATION = "conv_id long, turn long, role string, text string, depth string, digest string, pos string, k0 string"


def conversations():
    rows = [(c, t, "user" if t % 2 else "assistant", f"text {min(c, 7)} {t}") for c in range(40) for t in range(c % 11)]
    rows += [(c, t, "user", "the same first turn") for c in range(100, 130) for t in range(1)]
    rows += [(c, t, "user", f"copy {t}") for c in range(200, 230) for t in range(12)]
    rows += [(-7, 1, "user", "negative"), (-3, 0, "user", "x"), (-3, 1, None, None), (-3, None, "user", "null turn comes first"), (-3, None, None, "two of them")]
    rows += [(50, 3, "user", "twice"), (50, 3, "user", "twice"), (51, 0, "", ""), (52, 0, None, None), (53, 0, "user", long_text(3000)),
             (None, 0, "user", "no conversation"), (None, None, None, None), (54, 0, "us", "er\0a"), (55, 0, "user", "\0a"), (56, 0, "a", "é" * 50)]
    return [(*r, "c", "c", "c", "c") for r in rows]


def test_trie(spark, tmp_path):
    df = spark.createDataFrame(conversations(), CONVERSATION).repartition(3)
    rows = compare(spark, "op11_conversation_trie", write_tables(spark, tmp_path, conversations=df))
    assert len(rows) == 43


def test_trie_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([], CONVERSATION)
    assert compare(spark, "op11_conversation_trie", write_tables(spark, tmp_path / "a", conversations=df)) == []
    df = spark.createDataFrame([(None, 1, "a", "b", "", "", "", "")], CONVERSATION)
    assert compare(spark, "op11_conversation_trie", write_tables(spark, tmp_path / "b", conversations=df)) == []


def test_trie_of_one_huge_conversation_and_many_copies(spark):
    """Two thirds of the turns are one conversation's; a third of the conversations are copies."""
    seqs = {0: [("u", str(i)) for i in range(4000)], 1: [("u", str(i)) for i in range(2000)]}
    seqs |= {c: [("u", "0"), ("a", "b")] for c in range(2, 600)} | {c: [("u", str(c))] for c in range(600, 900)} | {900: []}
    rows = [(c, d + 1, hashlib.sha256(repr(t).encode()).digest(), len(t[1])) for c, s in seqs.items() for d, t in enumerate(s)]
    got = {}
    flat = spark.createDataFrame(rows, "conv_id long, depth long, digest binary, size long").repartition(5)
    for r in T.trie(stored(flat, "rows"), spark.createDataFrame([(c,) for c in seqs], "conv_id long")).collect():
        got[r["depth"], r["conv_id"]] = tuple(r)
    members, last, kids, ends = {}, {}, {}, {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            key = hashlib.sha256(repr(s[:d]).encode()).digest() if d < 50 else (d, c if d > 2000 else 0)
            members.setdefault((d, key), []).append(c)
            if d:
                last[d, key] = len(s[d - 1][1])
                kids.setdefault(before, set()).add((d, key))
            before = d, key
        ends.setdefault(before, []).append(c)
    total = {}
    for node in sorted(members, key=lambda n: -n[0]):
        below = [total[k] for k in kids.get(node, ())]
        total[node] = sum(b[0] for b in below) or 1, sum(b[1] for b in below) + (len(members[node]) - 1) * last.get(node, 0)
    parent = {k: p for p, ks in kids.items() for k in ks}
    want = {}
    for node, convs in members.items():
        sha = hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()
        want[node[0], min(convs)] = (min(convs), node[0], min(members[parent[node]]) if node in parent else None, len(convs),
                                     len(kids.get(node, ())), *total[node], sha)
    assert len(want) == len(members) and got == want


def test_two_prefixes_of_one_key_are_noticed(spark):
    rows = [(c, 1, bytes([c]), 1, 7, 7, 0, 0, 0) for c in (1, 2)]
    steps = spark.createDataFrame(rows, "conv_id long, depth long, digest binary, size long, k0 long, k1 long, parent_depth long, p0 long, p1 long")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(T, "prefixes", lambda rows: steps)
        with pytest.raises(Exception, match="two prefixes have one key"):
            T.trie(None, spark.createDataFrame([(1,), (2,)], "conv_id long")).collect()


def test_running_totals_and_salted_lookup_with_a_hot_group(spark):
    rows = [(g, i) for g, n in ((1, 3000), (2, 5), (3, 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "g long, i long").repartition(4)
    got = {(r["g"], r["i"]): (r["s"], r["x"]) for r in running(df, "g", "i", {"s": ("sum", F.col("i")), "x": ("xor", F.col("i") * 7)}).collect()}
    for g, n in ((1, 3000), (2, 5), (3, 1)):
        x = 0
        for i in range(n):
            x ^= 7 * i
            assert got[g, i] == (i * (i + 1) // 2, x)
    names = spark.createDataFrame([(1, "one"), (3, "three"), (4, "four")], "g long, name string")
    found = Counter((r["g"], r["name"]) for r in salted_lookup(df, names, ["g"], ["i"]).collect())
    assert found == {(1, "one"): 3000, (2, None): 5, (3, "three"): 1}


PAGES = "page_id long, url string, html string, row string, digest string, record_id string, payload_bytes string"


def pages(spark):
    big, copy = "<p>" + "é" * 3000, "<html>" + "copy " * 40
    rows = [(5, "http://a/", copy), (3, "http://b/", copy), (9, None, copy), (4, "http://c/ d\r\nX: y", copy), (1, "u", "x" * 99), (2, "u", "x" * 99),
            (6, "u", "y" * 100), (7, "u", "y" * 100), (8, "é", big), (10, "u", big + "!"), (11, "", ""), (12, None, None), (13, "u", "WARC/1.1\r\n\r\n\r\n" * 20),
            (14, "u", "long " * 500_000), (15, "u", "long " * 500_000)]
    rows += [(i, "u", copy) for i in range(100, 400)]
    return spark.createDataFrame([(*r, "c", "c", "c", "c") for r in rows], PAGES).repartition(3)


def test_warc(spark, tmp_path):
    path = write_tables(spark, tmp_path, pages=pages(spark))
    rows = compare(spark, "op12_warc", path)
    assert len(rows) == 315
    assert compare(spark, "op12_warc", write_tables(spark, tmp_path / "none", pages=pages(spark).limit(0))) == []


def test_warc_repeated_rows_and_null_ids(spark, tmp_path):
    html = "z" * 200
    rows = [(None, "u", html), (None, "u", html), (2, "u", html), (2, "u", html), (None, None, "w" * 200), (None, None, "w" * 200), (None, "v", "short")]
    path = write_tables(spark, tmp_path, pages=spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = Counter(tuple(r) for r in Q.op12_warc(spark, path).drop("payload_digest").collect())
    assert got == {(2, 200, "response", None): 1, (2, 200, "revisit", 2): 1, (None, 200, "revisit", 2): 2, (None, 200, "response", None): 1,
                   (None, 200, "revisit", None): 1, (None, 5, "response", None): 1}


def test_warc_images_are_warc_files(spark, tmp_path):
    path = write_tables(spark, tmp_path, pages=pages(spark))
    df = placed(spark.read.parquet(f"{path}/pages.parquet"), "warc_row")
    archives = W.write_archives(df, W.resolve(W.headers(df)), date="2024-01-01T00:00:00Z", image_bytes=2000).collect()
    assert len(archives) > 3 and sum(a["n_records"] for a in archives) == 315
    assert len({a["archive"] for a in archives}) == len(archives)
    ids, payloads = set(), {}
    for a in archives:
        found = list(W.records(bytes(a["image"])))
        assert found[0][0]["warc-type"] == b"warcinfo" and len(found) == a["n_records"] + 1
        assert gzip.decompress(bytes(a["image"])).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        for head, block in found[1:]:
            assert head["warc-record-id"] not in ids
            ids.add(head["warc-record-id"])
            http, _, payload = block.partition(b"\r\n\r\n")
            if head["warc-type"] == b"response":
                payloads[int(head["page-id"])] = payload
                assert b"Content-Length: %d" % len(payload) in http
            else:
                assert payload == b"" and head["warc-profile"].startswith(b"http://netpreserve.org/")
            if head["page-id"] == b"4":
                assert head["warc-target-uri"] == b"http://c/%20d%0D%0AX:%20y"
    want = {r["page_id"]: (r["html"] or "").encode() for r in pages(spark).collect()}
    assert payloads == {i: want[i] for i in payloads} and {3, 6, 14, 1, 2, 11, 12} <= set(payloads) and not {5, 7, 15, 100} & set(payloads)


def test_warc_damage(spark):
    record = W.page_record(b"1" * 16, 1, "u", "text", hashlib.sha256(b"other").hexdigest(), 4, None, None, "2024-01-01T00:00:00Z")
    with pytest.raises(Exception, match="does not have its digest"):
        W.read_archives(spark.createDataFrame([("a", gzip.compress(record))], "archive string, image binary")).collect()
    with pytest.raises(ValueError):
        list(W.records(gzip.compress(record[:-3])))
    with pytest.raises(ValueError):
        list(W.records(gzip.compress(b"x" + record)))
    lone = spark.createDataFrame([("a", "r1", 1, "u", "revisit", None, "d", "r0")], W.RECORDS)
    with pytest.raises(Exception, match="no response with its digest"):
        W.resolved(lone).collect()


def test_resampling(spark, tmp_path):
    bench = spark.createDataFrame([(1, "the cat sat"), (2, None), (3, "Délta x1\nalpha"), (4, "")], "item_id long, text string")
    path = write_tables(spark, tmp_path, documents=edge_docs(spark), benchmark=bench)
    assert len(compare(spark, "op13_importance_resampling", path)) == 16
    path = write_tables(spark, tmp_path / "a", documents=no_docs(spark), benchmark=bench)
    assert compare(spark, "op13_importance_resampling", path) == []
    path = write_tables(spark, tmp_path / "b", documents=edge_docs(spark), benchmark=bench.limit(0))
    assert len(compare(spark, "op13_importance_resampling", path)) == 16


def test_resampling_ranks_repeated_rows(spark):
    rows = [(i % 7, "same words " * 15) for i in range(700)] + [(None, "same words " * 15)] * 300 + [(1, "few")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = R.resample(docs, docs, percent=55).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 551)) and len(got) == 1050
    drawn = [(-r["score"], r["doc_id"] is None, r["doc_id"] or 0) for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])]
    assert drawn == sorted(drawn)


def brute_features(text, most):
    low, words, word = (text or "").translate(LOW), [], ""
    for ch in low + " ":
        if ord(ch) >= 128 or ch.isalnum():
            word += ch
        elif word:
            words.append(word)
            word = ""
    return [" ".join(words[i:i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("most", [1, 2, 3])
def test_resampling_counts_across_lines(spark, most):
    docs = edge_docs(spark)
    texts = [r[1] for r in edge_rows()] + ["one two\nthree\n\nfour one two\nthree", "a\nb\nc\nd", "\n\n"]
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts[-3:])], "doc_id long, text string")
    docs = docs.select("doc_id", "text").union(extra)
    want = np.zeros(97, np.int64)
    for t in texts:
        for f in brute_features(t, most):
            want[zlib.crc32(f.encode()) % 97] += 1
    source = R.bucket_counts(docs, buckets=97, most=most)
    assert (source == want).all()
    gain = R.gains(source, R.bucket_counts(extra, buckets=97, most=most))
    got = Counter((r["doc_id"], r["n_features"], r["weight"]) for r in R.weigh(docs, gain, most=most).collect())
    ids = [r[0] for r in edge_rows()] + [100, 101, 102]
    feats = [brute_features(t, most) for t in texts]
    assert got == Counter((i, len(f), sum(int(gain[zlib.crc32(x.encode()) % 97]) for x in f) // max(len(f), 1)) for i, f in zip(ids, feats))
