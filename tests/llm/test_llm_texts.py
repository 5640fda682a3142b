"""Operators on texts against brute force and the public tokenizer libraries."""

import hashlib
import math
import os
import random
from collections import Counter
from urllib.parse import urlparse

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import regex
import tiktoken
import zlib

from lakeloom.llm import bpe, context_coder, elias_fano, ngram_lm, pieces, simhash, token_output
from lakeloom.llm import queries as Q
from lakeloom.session import ensure_checkpoint_dir
from llm_data import SF, components, crc, edge_docs, edge_rows, fingerprint, no_docs, words, write_tables

RANKS = bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
TIKTOKEN = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
JSON = P.path("byte_bpe_50k.json")


def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(params=["edge", "sf"])
def docs(spark, request):
    return edge_docs(spark) if request.param == "edge" else small(spark)


def test_pieces_equal_the_pattern():
    rng, pattern = random.Random(1), regex.compile(P.PATTERN)
    parts = ["a", "é", "s", "t", "re", "ve", "ll", "d", "m", "'", "'", " ", " ", "  ", "\n", "\t", "1", "²", "中", "!", "..", "\u0085", "\x1c", "🙂", "_", "\r\n", "'s", "'LL", "\u0301", "Ⅳ", "\u200b", "\u00a0"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(5000)]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    buf = np.frombuffer(b"".join(raw), np.uint8)
    at = pieces.cut(buf, offsets).tolist()
    data, got, k = buf.tobytes(), [], 0
    ends = at[1:] + [len(data)]
    for i in range(len(texts)):
        mine = []
        while k < len(at) and at[k] < offsets[i + 1]:
            mine.append(data[at[k]:ends[k]].decode())
            k += 1
        got.append(mine)
    assert got == [pattern.findall(t) for t in texts]


def test_bpe_equals_tiktoken(spark, docs, tmp_path):
    rows = Counter((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    got = Q.op2_byte_bpe(spark, write_tables(spark, tmp_path, documents=docs)).collect()
    want = Counter()
    for (i, t), n in rows.items():
        ids = TIKTOKEN.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += n
    assert Counter(map(tuple, got)) == want
    assert Q.op2_byte_bpe(spark, write_tables(spark, tmp_path / "none", documents=no_docs(spark))).collect() == []


def test_decode_alone(spark):
    rows = [(1, np.array(TIKTOKEN.encode_ordinary("naïve it's"), "<u4").tobytes()), (2, b""), (3, None), (None, np.array([0], "<u4").tobytes())]
    got = bpe.decode(spark.createDataFrame(rows, "doc_id long, ids binary"), RANKS).collect()
    assert {(r["doc_id"], bytes(r["decoded"])) for r in got} == {(1, "naïve it's".encode()), (2, b""), (3, b""), (None, b"!")}


def test_rank_map_finds_every_pair_and_no_other():
    rows = bpe.pair_rows(RANKS)
    moves, slots = bpe.displaced(rows)

    def look(a, b):
        h = bpe.pair_hash(a, b)
        return int(slots[(h >> 32 ^ int(moves[h & len(moves) - 1])) & len(slots) - 1]) ^ (a * bpe.NO_MERGE + b) * bpe.NO_MERGE

    some = random.Random(2).sample([(a, b) for a in rows for b in rows[a]], 3000)
    assert all(look(a, b) == rows[a][b] for a, b in some)
    rng = random.Random(3)
    others = [(a, b) for a, b in ((rng.randrange(50256), rng.randrange(50256)) for _ in range(3000)) if b not in rows.get(a, {})]
    assert all(look(a, b) >= bpe.NO_MERGE for a, b in others)


def test_sampled_pieces_are_counted_with_or_without_their_bytes(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b", "a b c", None, "a", "d e f g"])], "doc_id long, text string").coalesce(1)
    plain = bpe.top_pieces(docs, "doc_id", "text", frozenset(), spelt=False, held=2)
    assert plain.columns == ["word", "n"]
    got = [(bytes(r["word"]), r["n"]) for r in plain.collect()]
    assert got == [(b"a", 3), (b" b", 2), (b" c", 1), (b" e", 1), (b" f", 1), (b" g", 1), (b"d", 1)]
    full = bpe.top_pieces(docs, "doc_id", "text", frozenset([b"a"])).collect()
    assert [(bytes(r["word"]), bytes(r["bytes"]), r["n"]) for r in full] == [(w, w, n) for w, n in got[1:]]


def test_token_files_equal_the_library(spark, docs, tmp_path):
    tok = token_output.load(JSON)
    rows = docs.select("doc_id", "text").collect()
    got = Q.op10_token_output(spark, write_tables(spark, tmp_path, documents=docs)).collect()
    coded = [(r["doc_id"], np.array(tok.encode(r["text"] or "", add_special_tokens=False).ids + [2])) for r in rows]
    coded.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].astype("<u2").tobytes()))
    want, at = [], 0
    for i, ids in coded:
        want.append((i, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert Q.op10_token_output(spark, write_tables(spark, tmp_path / "none", documents=no_docs(spark))).collect() == []


def test_added_tokens_equal_the_plain_library(spark, tmp_path):
    from tokenizers import Tokenizer
    plain, end = Tokenizer.from_file(JSON), "<|endoftext|>"
    texts = [f"one{end}two", end, f"{end}{end} x", f"a  {end}  b \n", f"don'{end}t <|endoftext| >", f" tail {end}", "no such token", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {r["doc_id"]: r for r in Q.op10_token_output(spark, write_tables(spark, tmp_path, documents=docs)).collect()}
    at = 0
    for i, t in enumerate(texts):
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 2]
        assert (50256 in ids) == (end in (t or ""))
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), t
        at += len(ids)


def test_token_file_round_trip_and_damage():
    rng = np.random.default_rng(1)
    for n, block in ((0, 8), (1, 8), (8, 8), (9, 8), (5000, 64)):
        ids = rng.integers(0, 300, n)
        ids[n // 2:n // 2 + n // 4] = ids[:n // 4]
        counts = np.array([n // 3, 0, n - n // 3])
        data = token_output.image([5, None, 7], counts, ids, block)
        back = token_output.parse(data)
        assert back[0] == [5, None, 7] and np.array_equal(back[1], counts) and np.array_equal(back[2], ids)
    for at in (20, len(data) - 3):
        broken = bytearray(data)
        broken[at] ^= 0x55
        with pytest.raises(ValueError):
            token_output.parse(bytes(broken))


def test_coder_learns():
    ids = np.tile(np.arange(40), 500)
    values, freq = context_coder.frequencies(ids)
    coded = context_coder.encode_blocks(ids, 1000, values, freq)
    assert sum(map(len, coded)) * 8 / len(ids) < 1.5  # order 0 alone needs 5.3 bits
    assert np.array_equal(context_coder.decode_blocks(coded, [1000] * 20, values, freq), ids)


def test_elias_fano(tmp_path):
    rng = np.random.default_rng(0)
    for n, top in ((0, 1), (1, 1000), (1000, 50), (1000, 10 ** 6), (50_000, 10 ** 9)):
        v = np.sort(rng.integers(0, top, n))
        elias_fano.write(tmp_path / "f", elias_fano.encode(v))
        e = elias_fano.EliasFano(elias_fano.open_mapped(tmp_path / "f"))
        assert np.array_equal(e.get(np.arange(n)), v)
        asked = np.concatenate([v[:500], v[:500] + 1, rng.integers(0, top + 9, 500)])
        assert np.array_equal(e.successor(asked), np.searchsorted(v, asked))


def test_language_model(spark, docs, tmp_path):
    rows = docs.select("doc_id", "text").collect()
    got = Q.op3_ngram_lm(spark, write_tables(spark, tmp_path, documents=docs)).collect()
    count, pairs, texts = Counter(), Counter(), 0
    for r in rows:
        if crc(r["doc_id"], 10):
            w = [*words(r["text"]), b""]
            count.update(w)
            pairs.update(zip([None, *w[:-1]], w))
            texts += 1
    total, kinds, prior = sum(count.values()), len(count), ngram_lm.PRIOR
    base = lambda w: (count[w] + 0.1) / (total + 0.1 * (kinds + 1))
    seen = dict(count) | {None: texts}

    def p(u, w):
        return (pairs[u, w] + prior * base(w)) / (seen[u] + prior) if seen.get(u) else base(w)

    want = {}
    for r in rows:
        w = [*words(r["text"]), b""]
        want[r["doc_id"], r["text"]] = (crc(r["doc_id"], 10) == 0, len(w), sum(count[x] > 0 for x in w), total,
                                        sum(math.log10(base(x)) for x in w), sum(math.log10(p(u, x)) for u, x in zip([None, *w[:-1]], w)))
    assert len(got) == len(rows)
    by_id = {}
    for (i, _), x in want.items():
        by_id.setdefault(i, []).append(x)
    for g in got:
        assert any(tuple(g)[1:5] == x[:4] and math.isclose(g["base_score"], x[4], rel_tol=1e-9, abs_tol=1e-9)
                   and abs(g["score"] - x[5]) < 0.015 * x[1] for x in by_id[g["doc_id"]])


def test_language_model_sums_to_one(spark):
    docs = small(spark)
    model = ngram_lm.fit(docs.limit(30))
    lines = model.words()
    every = np.concatenate([f["counts"] for s in range(len(lines.id0) - 1) if (f := lines.file(s)) is not None])
    assert abs(model.base(every).sum() + model.base(np.zeros(1))[0] - 1) < 1e-9
    u = int(np.argmax(every))
    ids = np.arange(model.kinds)
    before, total = lines.mass(np.array([u]))
    found = model.find(model.part(np.full(len(ids), before[0]), np.full(len(ids), total[0]), ids), np.full(len(ids), u), ids)
    p = np.where(np.isnan(found), model.prior * model.base(every) / (total[0] + model.prior), 10 ** np.nan_to_num(found))
    assert abs(p.sum() - 1) < 0.03  # one byte per pair


@pytest.mark.parametrize("held", [50, 120_000])
def test_language_model_over_many_batches(spark, monkeypatch, held):
    monkeypatch.setattr(bpe, "TASK_WORDS", held)
    docs = small(spark)
    model = ngram_lm.fit(docs.limit(30))
    texts = [(r["text"] or "").encode() for r in docs.select("text").limit(60).collect()]
    one = ngram_lm.Batches(model)
    for at in range(0, len(texts), 7):
        for got, want in zip(one.read(texts[at:at + 7]), ngram_lm.Batches(model).read(texts[at:at + 7]), strict=True):
            assert np.array_equal(got, want)


def test_language_model_writes_the_trie_alone(spark):
    """No Spark table beside it: its many small files cost the executors a process each.  Batches of texts are small."""
    folder = urlparse(ensure_checkpoint_dir(spark)).path
    there = set(os.listdir(folder))
    model = ngram_lm.fit(small(spark).limit(30))
    new = {f"{folder}/{n}" for n in set(os.listdir(folder)) - there}
    assert new == {model.folder} and model.kinds > 0
    assert any(n.startswith("words-") for n in os.listdir(model.folder)) and any(n.startswith("pairs-") for n in os.listdir(model.folder))
    rows = spark.range(1500).coalesce(1).mapInArrow(lambda bs: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"]) for b in bs), "n long")
    assert max(r["n"] for r in rows.collect()) <= 500


def test_language_model_without_training(spark):
    none = no_docs(spark)
    got = ngram_lm.score(edge_docs(spark), ngram_lm.fit(none)).collect()
    assert len(got) == 16 and all(r["score"] == r["base_score"] == 0.0 and r["n_known"] == 0 for r in got)
    assert ngram_lm.score(none, ngram_lm.fit(edge_docs(spark))).collect() == []


def test_simhash(spark, docs, tmp_path):
    rows = docs.select("doc_id", "text").collect()
    got = Q.op7_simhash(spark, write_tables(spark, tmp_path, documents=docs)).collect()
    fps = [fingerprint(r["text"]) for r in rows]
    roots = components(fps)
    least = {}
    for r, root in zip(rows, roots):
        ids = [x for x in (least.get(root), r["doc_id"]) if x is not None]
        least[root] = min(ids) if ids else None
    want = Counter((r["doc_id"], f"{f:016x}", least[root]) for r, f, root in zip(rows, fps, roots))
    assert Counter(map(tuple, got)) == want
    assert Q.op7_simhash(spark, write_tables(spark, tmp_path / "none", documents=no_docs(spark))).collect() == []


def test_simhash_links_by_general_pigeonhole(spark):
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 2 ** 63, 40, dtype=np.uint64)
    fps = {int(s) for s in seeds}
    for s in seeds:
        for _ in range(30):
            flips = rng.choice(64, rng.integers(1, 5), replace=False)
            fps.add(int(s) ^ int(np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64))))
    fps = sorted(fps)
    signed = [f - (f >> 63 << 64) for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = {(min(a, b), max(a, b)) for i, a in enumerate(signed) for j, b in enumerate(signed) if i < j and (fps[i] ^ fps[j]).bit_count() <= 2}
    got = {(r["a"], r["b"]) for r in simhash.links(df, 2).collect()}
    assert got == want and len(want) > 100


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_thresholds_meet_the_pigeonhole_sum(bits):
    rng = np.random.default_rng(bits)
    for parts in range(1, bits + 2):
        widths = [64 // parts] * parts
        same = rng.integers(1, 10_000, (50, parts)).astype(float)
        chosen = simhash.allocate(same, 10_000, widths, bits)
        assert (chosen.sum(axis=1) == bits - parts + 1).all() and chosen.min() >= -1


def test_edge_rows_have_every_case():
    rows = edge_rows()
    assert any(r[1] is None for r in rows) and any(r[1] == "" for r in rows) and max(len(r[1] or "") for r in rows) > 100_000
