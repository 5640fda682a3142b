"""Trained operators: held-out accuracy, and every awkward input."""

import math
import random
import time

import numpy as np
import pandas as pd
import pytest

from lakeloom.llm import language_id, toxicity
from lakeloom.llm import queries as Q
from llm_data import SF, crc, edge_docs, no_docs, write_tables

SMALL = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    got = Q.op1_language_id(spark, SMALL).toPandas().merge(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang").toPandas())
    held = got[got.held_out]
    assert len(got) == 1000 and (held.lang_pred == held.lang).mean() > 0.95
    assert got.score.between(0, 1).all() and (got.held_out == got.doc_id.map(lambda d: crc(d, 5) == 0)).all()


def test_language_edges(spark, tmp_path):
    got = Q.op1_language_id(spark, write_tables(spark, tmp_path, documents=edge_docs(spark))).collect()
    assert len(got) == 16
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (13, 14, 15, 16))
    assert all(by[i]["lang_pred"] != "und" for i in (10, 17, 18, 20))
    none = write_tables(spark, tmp_path / "none", documents=no_docs(spark))
    assert Q.op1_language_id(spark, none).collect() == []
    unlabelled = language_id.predict(edge_docs(spark), language_id.fit(no_docs(spark)))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {"und"}


def test_language_reads_whole_texts(spark):
    german, english = "und die der das ist nicht ein zu auf für mit sich ", "the and that with this from have are was not for "
    df = spark.createDataFrame([(i, t * 6, la) for i in range(60) for t, la in ((german, "de"), (english, "en"))], "doc_id long, text string, lang string")
    net = language_id.fit(df)
    asked = spark.createDataFrame([(1, english * 20 + german * 200), (2, german * 20 + english * 200)], "doc_id long, text string")
    assert [r["lang_pred"] for r in language_id.predict(asked, net).orderBy("doc_id").collect()] == ["de", "en"]


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity.fit(docs.where("doc_id % 4 <> 2"), labels)


def test_toxicity_held_out(spark):
    got = Q.op5_toxicity(spark, SMALL).toPandas().merge(spark.read.parquet(f"{SMALL}/labels.parquet").toPandas())
    held = got[got.held_out]
    assert ((held.predicted == 1) & (held.toxic == 0)).sum() <= 1
    assert ((held.predicted == 1) & (held.toxic == 1)).sum() >= 0.6 * (held.toxic == 1).sum()
    assert (got.predicted == (got.score >= 0.3)).all() and got.score.between(0, 1).all()


def test_toxicity_sees_through_disguise(spark, model):
    texts = ["what an idiot you are", "what an 1d10t you are", "what an i d i o t you are", "what an i.d.i.o.t you are", "what an iiiidiiiooot you are",
             "pathet1c", "m0r0n!", "w0rthle$$ " * 2, "what a fine day you have", "call +1 (524) 555-5024 or mail a.b@c.de", "", None]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.score(asked, model).collect()}
    plain = got[8]["score"]
    assert all(got[i]["score"] > 2 * plain for i in range(8)), {i: r["score"] for i, r in got.items()}
    assert all(got[i]["score"] == plain and got[i]["predicted"] == 0 for i in (8, 9, 10, 11))


def test_decoding(model):
    read = lambda t: toxicity.decode(t, model.reader.lm)
    assert read("1d10t") == "idiot" and read("i.d.i.o.t") == "idiot" and read("p4th3t1c") == "pathetic" and read("idi*t") == "idiot"


def test_disguise_at_the_ends_and_addresses(model):
    read = model.reader.token
    for token in ("idio*", "*diot", "!diot", "idio*.", "(idio*)", "\"!diot\"", "1d10t://"):
        assert "idiot" in read(token), (token, read(token))
    assert "pathetic" in read("p.@.t.h.e.t.i.c") and "pathetic" in read("p@t.h.e.t.i.c") and "pathetic" in read("pathet!c")
    assert set(read("jane.roe@mail.example.com")) == {"jane", "roe", "mail", "example", "com"}
    assert set(read("https://www.example.com/1d10t?a=b")) == {"https", "www", "example", "com", "d", "t", "a", "b"}
    assert read("fine") == ("fine",) and "idiot" in read("idiot!") and "idiot" in read("(idiot?)")


def test_spaced_out_words(model):
    lm = toxicity.CharModel({"ass": 30, "boob": 30, "as": 20, "stupid": 30, "idiot": 30, "a": 50, "stand": 20, "man": 20, "dirt": 20, "bob": 20})
    reader = toxicity.Reader(lm, frozenset({"ass", "boob", "stupid", "idiot"}))
    for text, words in (("a s s", {"ass"}), ("b o o b", {"boob"}), ("s, t, u, p, i, d", {"stupid"}), ("so s t u p i d!", {"stupid"}),
                        ("you are a s t u p i d man", {"stupid"}), ("s t u p i d i d i o t", {"stupid", "idiot"})):
        assert words <= reader.features(text), (text, reader.features(text))
    score, plain = model.scorer(), model.scorer()("what a fine day")
    assert all(score(t) > 2 * plain for t in ("you are a p a t h e t i c man", "p, a, t, h, e, t, i, c", "m o r o n i d i o t"))
    assert score("a b c d e f g, 1 2 3 4 5 6 - - -") == plain


def test_search_cuts_no_state():
    """Masked words of several scripts, against a search that keeps every context as it is."""
    kinds = ["abcdefghijklmnopqrstuvwxyz", "αβγδεζηθικλμνξοπρστυφχψω", "абвгдежзийклмнопрстуфхцчшщъыьэюя"]
    rng = random.Random(6)
    lexicon = {"".join(rng.choices(k, k=rng.randint(3, 8))): rng.randint(1, 3) for k in kinds * 1500}
    lm = toxicity.CharModel(lexicon)

    def search(token, cut=None):
        states = {("^^^", ""): (0.0, "")}
        for ch in token:
            nxt = {}
            letters = lm.letters if ch in toxicity.MASKS else [ch]
            cost = toxicity.MASK_COST if ch in toxicity.MASKS else 0.0
            for (context, last), (score, text) in states.items():
                ways = [((context + x)[1:], ch, score - cost + lm.score(context, x), text + x) for x in letters]
                ways += [(context, last, score - toxicity.REPEAT_COST, text)] * (last == ch and context[-1] in letters)
                ways += [(context, last, score - toxicity.DROP_COST, text)] * (ch == "*")
                for c, la, s, t in ways:
                    if (c, la) not in nxt or nxt[c, la][0] < s:
                        nxt[c, la] = s, t
            states = dict(sorted(nxt.items(), key=lambda x: -x[1][0])[:cut])
        return max((s + lm.score(c, "$"), t) for (c, _), (s, t) in states.items())[1]

    words, lost = sorted(w for w in lexicon if len(w) > 4), 0
    for w in rng.sample(words, 20):
        token = w[0] + "##" + w[3:]
        assert toxicity.decode(token, lm) == search(token), token
        lost += search(token, 48) != search(token)
    for w in rng.sample(words, 30):  # masks at the end are read from tables, which change no result
        for token in (w[:-2] + "**", w[:-1] + "*#*", w + "###", w[:2] + "*" + w[3:] + "?#", w + w[-1] + "?"):
            by_tables = toxicity.decode(token, lm)
            with pytest.MonkeyPatch.context() as patch:
                patch.setattr(toxicity, "MASK_RUN", 0)
                assert by_tables == toxicity.decode(token, lm), token
    assert lost  # the tokens are ones that a beam of 48 misreads


def test_toxicity_edges(spark, tmp_path):
    labels = spark.createDataFrame([(10, 1), (10, 0), (11, 0), (None, 1), (12, None), (20, 0)], "doc_id long, toxic int")
    got = Q.op5_toxicity(spark, write_tables(spark, tmp_path, documents=edge_docs(spark), labels=labels)).collect()
    assert len(got) == 16 and all(0 <= r["score"] <= 1 for r in got)
    none = write_tables(spark, tmp_path / "none", documents=no_docs(spark), labels=labels.limit(0))
    assert Q.op5_toxicity(spark, none).collect() == []


def plainly(token, lm):
    """The search that reads masks one by one."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(toxicity, "MASK_RUN", 0)
        return toxicity.decode(token, lm)


def three_scripts(n=150):
    kinds = ["abcdefghijklmnopqrstuvwxyz", "αβγδεζηθικλμνξοπρστυφχψω", "абвгдежзийклмнопрстуфхцчшщъыьэюя"]
    rng = random.Random(6)
    return rng, {"".join(rng.choices(k, k=rng.randint(3, 8))): rng.randint(1, 3) for k in kinds * n}


def test_runs_of_masks_equal_the_plain_search():
    rng, lexicon = three_scripts()
    lm = toxicity.CharModel(lexicon)
    for w in rng.sample(sorted(w for w in lexicon if len(w) > 4), 12):
        for token in (w[:-2] + "**", w[0] + "***" + w[3:], w[0] + "*#?" + w[-2:], w[:2] + "****", w + "***#", "***" + w[2:], w[0] + "###" + w[3:],
                      w[0] + "é**" + w[2:], w[0] + "*.**" + w[2:] + "*", "****", "#*#", w[0] + "****" + w[-1] + "??"):
            assert toxicity.decode(token, lm) == plainly(token, lm), token


@pytest.mark.parametrize("letters", [0, 5000])
def test_long_runs_of_masks_take_no_time(letters):
    rng, lexicon = three_scripts()
    if letters:
        some = [chr(0x4E00 + i) for i in range(letters)]
        lexicon = {"".join(rng.choices(some, k=rng.randint(2, 4))): 1 for _ in range(20_000)}
    lm = toxicity.CharModel(lexicon)
    toxicity.decode("no***", lm)  # the tables of the model
    took = []
    for token in ("no" + "*" * 18, "no" + "*" * 10_000, "no" + "*" * 10_000, "no" + "*" * 10_000):
        began = time.perf_counter()
        assert toxicity.decode(token, lm).startswith("no")
        took.append(time.perf_counter() - began)
    assert min(took[1:]) < 0.1, took
    # the other letters of a longer run change nothing
    assert toxicity.decode("no" + "*" * 10_000, lm) == toxicity.decode("no" + "*" * 200, lm)
    for token in ("no" + "*" * 3000 + "b", "no" + "*#?" * 1000, "*" * 3000 + "ab", "a" + "#" * 500 + "b"):
        began = time.perf_counter()
        assert toxicity.decode(token, lm)
        assert time.perf_counter() - began < 10


def test_caches_of_the_model_are_bounded(monkeypatch):
    rng, lexicon = three_scripts()
    lm = toxicity.CharModel(lexicon)
    monkeypatch.setattr(toxicity, "ROW_CELLS", 100 * len(lm.letters))
    monkeypatch.setattr(toxicity, "SCORES", 5000)
    for w in sorted(lexicon)[:40]:
        toxicity.decode(w[0] + "##" + w[2:] + "#" + w[-1], lm)
        assert len(lm.rows) <= 100 or len(lm.rows) * len(lm.letters) <= toxicity.MASK_CELLS
        assert len(lm.cache) <= 5000 + 1


def test_scores_are_the_regression_on_restored_words(spark, model):
    """The score of whole texts, recomputed word by word."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: (r["score"], r["predicted"]) for r in toxicity.score(docs, model).collect()}
    for r in docs.collect():
        found = toxicity.expand(model.reader.features(r["text"] or ""))
        z = model.bias + sum(model.weights.get(f, 0.0) for f in found)
        score = 1 / (1 + math.exp(-z))
        assert abs(got[r["doc_id"]][0] - score) < 1e-9 and got[r["doc_id"]][1] == int(got[r["doc_id"]][0] >= 0.3)


def test_toxicity_learns_from_every_labelled_document(spark):
    rare = ["zorgle", "quimbot", "framvik", "blurdon", "skelpum", "trovash"]  # of four documents each
    texts = [f"{rare[i // 4]} bad" if i < 24 else f"bad thing {i}" if i < 9000 else f"good thing {i}" for i in range(20_000)]
    rows = spark.createDataFrame(pd.DataFrame({"doc_id": range(20_000), "text": texts, "toxic": [int(i < 9000) for i in range(20_000)]}))
    model = toxicity.fit(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))
    assert set(rare) <= model.reader.words
    assert model.weights["bad"] > 1 and model.bias < 0


def test_language_network_against_a_naive_forward_pass(spark):
    """The probabilities of windows, recomputed filter by filter and place by place."""
    from lakeloom.llm import language_id as L
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    net = L.fit(docs, per_language=60)
    texts = [r["text"] for r in docs.select("text").limit(6).collect()] + ["é", "a b"]
    raw = [t.encode() for t in texts]
    buf, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    start, end, row = L.cut(buf, offsets)
    windows = L.gather(buf, start, end)
    fast = net.probabilities(windows)
    for i in range(0, len(windows), max(1, len(windows) // 8)):
        x, tops = net.emb[windows[i]].astype(float), []
        for f in range(net.filt.shape[1]):
            width = L.WIDTHS[f // L.FILTERS]
            taps = net.filt[:, f].reshape(-1, L.EMBEDDING)
            assert not taps[width:].any()  # a narrow filter sees no further bytes
            responses = [sum(float(x[at + k] @ taps[k]) for k in range(width)) for at in range(L.WINDOW)]
            tops.append(max(0.0, max(responses) + float(net.bias[f])))
        z = np.array(tops) @ net.out + net.out_bias
        p = np.exp(z - z.max())
        assert np.allclose(fast[i], p / p.sum(), atol=1e-4)
