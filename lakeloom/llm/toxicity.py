"""Toxicity scores of deobfuscated text.

Deobfuscation is noisy-channel decoding.  The channel may replace letters by look-alikes
(leetspeak, masks), put separators between letters, space letters out and repeat them.  A
token's lattice has, for each character, the letters it may stand for and, for separators
and repeats, nothing; Viterbi search finds the path with the best sum of channel costs
and character-language-model scores (``CharModel``, three letters of context with
interpolation).  No state is cut: contexts with equal futures are one state, and runs of masks of any length are read
exactly (``mask_runs``).  A
token made of letters alone with no run of three has a single path, itself, so only the
others are searched; masks and look-alikes at either end count, since they may be letters or
punctuation.  Addresses and URLs are not searched.  Runs of three and more single characters between
blanks are read twice: as one token, and as a lattice that may also end a word at each blank.

The restored words are scored by logistic regression on the presence of words and word
beginnings that training documents tell apart; whole texts are read.

Training: all labelled documents.  Spark counts their words and fits the regression (Spark ML) on the features found in
them; only the most frequent words (``LM_WORDS`` at most), the features (``FEATURES``) and their weights reach the driver.

Defined results: null and empty texts get the score of a text without features.  A
document labelled more than once counts with its highest label; null labels are skipped.
Without a label of both classes every score is the share of toxic labels (0 if none).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import Matrices, Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_limits, stored
from .mask_runs import MaskRuns, Trail

LM_WORDS, FEATURES = 30_000, 2000
PREFIXES = (4, 5)
THRESHOLD = 0.3
#: What a character may stand for besides itself.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a",
        "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i", "(": "c", "<": "c"}
MASKS, SEPARATORS = "*#?", ".-_*~^'`,:;/\\ "
LEET_COST, MASK_COST, DROP_COST, REPEAT_COST, KEEP_COST = 1.0, 2.5, 0.7, 0.5, 4.0
#: Words of one letter are few kinds but frequent: a cost instead of the character model's score.
ONE_LETTER, ONE_COST = "aioy", 2.5
#: States times letters of a mask that are held at once, and kept by the model (rows of states, and single scores).
MASK_CELLS, ROW_CELLS, SCORES = 1 << 20, 1 << 22, 1 << 20
#: Masks inside a token are read one by one up to this many, and this many states times letters; else as a run, with equal
#: results.  Only a test sets the longest run that is read as one.
FEW_MASKS, FEW_CELLS, MASK_RUN = 2, 1 << 18, 1 << 62
_WORD = re.compile(r"[^\W\d_]+")
_EDGE = "\"'()[]{}<>.,;:?!*#~-_/\\…«»“”‘’"
#: Edge characters that stand for no letter.
_OUTER = "".join(c for c in _EDGE if c not in LEET and c not in MASKS)
#: Real addresses and URLs: every part of the host, and of an address's name, has several characters, the last one letters.
_ADDRESS = re.compile(r"\w{2,}(?:[.+-]\w{2,})*@(?:\w{2,}(?:-\w+)*\.)+[^\W\d_]{2,}")
_URL = re.compile(r"[a-z][a-z0-9+.-]+://(?:[^\s/?#@]*@)?(?:\w{2,}(?:-\w+)*\.)+[^\W\d_]{2,}(?::\d+)?(?:[/?#]\S*)?")
_RUN = re.compile(r"(.)\1\1")
_SQUEEZE = re.compile(r"(.)\1+")
_THREE = re.compile(rb"\x01{3,}")


class CharModel:
    """Interpolated character trigrams over word types weighted by log counts; ``^`` starts and ``$`` ends a word."""

    def __init__(self, words: dict[str, int]):
        self.grams: list[Counter] = [Counter() for _ in range(4)]
        self.ctx: list[Counter] = [Counter() for _ in range(4)]
        self.kinds: list[Counter] = [Counter() for _ in range(4)]
        for w, n in words.items():
            s, weight = "^^^" + w + "$", 1 + math.log(n)
            for i in range(3, len(s)):
                for order in range(4):
                    gram = s[i - order:i + 1]
                    if gram not in self.grams[order]:
                        self.kinds[order][gram[:-1]] += 1
                    self.grams[order][gram] += weight
                    self.ctx[order][gram[:-1]] += weight
        self.letters = sorted({g for g in self.grams[0] if g != "$"})
        self.known = frozenset(self.letters)
        self.cache: dict[tuple[str, str], float] = {}
        self.masks: MaskRuns | None = None
        # of the contexts that masks were read after
        self.rows: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        self.number: dict[str, int] = {}
        self.names: list[str] = []

    def score(self, context: str, ch: str) -> float:
        """log p(ch | the last three characters), Witten-Bell."""
        got = self.cache.get((context, ch))
        if got is None:
            p = 1.0 / (len(self.letters) + 2)
            for order in range(4):
                c = context[3 - order:]
                total, kinds = self.ctx[order][c], self.kinds[order][c]
                if total:
                    p = (self.grams[order][c + ch] + kinds * p) / (total + kinds)
            if len(self.cache) >= SCORES:
                self.cache.clear()
            got = self.cache[(context, ch)] = math.log(p)
        return got

    def state(self, context: str) -> str:
        """A context with equal scores now and after any letters: letters that never led anywhere are blotted out.

        If no word has a context, its scores are those of its shorter end, and no word has its longer continuations."""
        if self.ctx[3][context]:
            return context
        return f"\0{context[1:]}" if self.ctx[2][context[1:]] else f"\0\0{context[2]}"

    def runs(self) -> MaskRuns:
        if self.masks is None:
            self.masks = MaskRuns(self, MASK_COST, DROP_COST, REPEAT_COST)
        return self.masks

    def any_letter(self, contexts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each context and each of ``letters``: log p of the letter, and the number in ``names`` of the state after it."""
        if (len(self.rows) + len(contexts)) * len(self.letters) > ROW_CELLS:
            self.rows.clear()
        new = [c for c in contexts if c not in self.rows]
        for c in new:
            after = [self.state(c[1:] + x) for x in self.letters]
            for name in after:
                if name not in self.number:
                    self.number[name] = len(self.names)
                    self.names.append(name)
            self.rows[c] = np.array([self.score(c, x) for x in self.letters]), np.array([self.number[a] for a in after], np.int32)
        return np.stack([self.rows[c][0] for c in contexts]), np.stack([self.rows[c][1] for c in contexts])


def _spelt(link: tuple | None) -> str:
    out = []
    while link is not None:
        letter, link = link.spelt() if isinstance(link, Trail) else link[::-1]
        out.append(letter)
    return "".join(reversed(out))


def _read_mask(states: dict, ch: str, lm: CharModel, put) -> None:
    """Read a mask as every letter after every state; the best way into each state is put."""
    entries = list(states.items())
    step = max(1, MASK_CELLS // len(lm.letters))
    for a in range(0, len(entries), step):
        part = entries[a:a + step]
        logs, after = lm.any_letter([context for (context, _), _ in part])
        sums = (logs + np.array([score - MASK_COST for _, (score, _) in part])[:, None]).ravel()
        after = after.ravel()
        best = np.full(len(lm.names), -np.inf)
        np.maximum.at(best, after, sums)
        at = np.flatnonzero(sums == best[after])
        _, first = np.unique(after[at], return_index=True)
        for cell in at[first].tolist():
            row, letter = divmod(cell, len(lm.letters))
            put((lm.names[after[cell]], ch), float(sums[cell]), (part[row][1][1], lm.letters[letter]))


def decode(token: str, lm: CharModel) -> str:
    """The best reading of a lower-cased token.  Punctuation at its ends may also be just that, at the cost of a separator.

    A blank, which only a run of spaced-out letters has, is nothing or the boundary of two words."""
    head, tail = len(token) - len(token.lstrip(_EDGE)), len(token.rstrip(_EDGE))
    # (last three letters, last character read as a letter) -> score, letters as links
    states: dict[tuple[str, str], tuple[float, tuple | None]] = {("^^^", ""): (0.0, None)}
    done = 0
    for i, ch in enumerate(token):
        if i < done:
            continue
        if ch in MASKS and lm.letters and (i == 0 or token[i - 1] not in MASKS):
            stop = len(token) - len(token[i:].lstrip(MASKS))
            if stop - i > MASK_RUN:
                pass
            elif stop == len(token):
                link, letters = lm.runs().ending(states, token[i:], MASKS)
                return _spelt(link) + letters
            elif stop - i > FEW_MASKS or len(states) * len(lm.letters) ** (stop - i) > FEW_CELLS:
                states, done = lm.runs().inside(states, token[i:stop], MASKS, lambda c, i=i: c in SEPARATORS or i < head), stop
                continue
        nxt: dict[tuple[str, str], tuple[float, tuple | None]] = {}

        def put(state, score, link):
            if (old := nxt.get(state)) is None or score > old[0]:
                nxt[state] = score, link

        reads = [(x, LEET_COST) for x in LEET.get(ch, "")]
        if ch.isalpha():
            reads.append((ch, 0.0))
        elif ch not in SEPARATORS and ch not in MASKS:
            reads.append((ch, KEEP_COST))  # stays as it is
        if ch in MASKS and lm.letters:
            _read_mask(states, ch, lm, put)
        for (context, last), (score, link) in states.items():
            if ch == " ":
                put((context, ""), score, link)  # letters on both sides of a blank are no repeat
                if context != "^^^":
                    alone = context[:2] == "^^" and context[2] in ONE_LETTER
                    end = -ONE_COST - lm.score("^^^", context[2]) if alone else lm.score(context, "$")
                    put(("^^^", ""), score + end, (link, " "))
            elif ch in SEPARATORS or i < head or i >= tail:
                put((context, last), score - DROP_COST, link)
            for letter, cost in reads:
                put((lm.state((context + letter)[1:]), ch), score - cost + lm.score(context, letter), (link, letter))
                if letter == context[-1] and last == ch:  # a repeat that says nothing
                    put((context, last), score - REPEAT_COST, link)
            if last == ch and ch in MASKS and context[-1] in lm.known:
                put((context, last), score - REPEAT_COST, link)
        states = nxt
        if not states:
            return token
    ends = [(score + lm.score(context, "$"), link) for (context, _), (score, link) in states.items()]
    best = max(score for score, _ in ends)
    return max(_spelt(link) for score, link in ends if score == best)


def short(token: str) -> bool:
    """Whether a token is at most one character between punctuation, as the letters of a spaced-out word are."""
    return len(token) < 2 or len(token.strip(_EDGE)) < 2


def spaced(tokens: list[str], shorts: set[str], lm: CharModel) -> Iterator[str]:
    """Words read from the runs of three and more short tokens; shorts: those of ``tokens`` that are ``short``."""
    if shorts:
        for run in _THREE.finditer(bytes(map(shorts.__contains__, tokens))):
            letters = tokens[run.start():run.end()]
            if any(c.isalpha() or c in LEET for t in letters for c in t):
                yield from _WORD.findall(decode(" ".join(letters), lm))
                yield from _WORD.findall(decode("".join(letters), lm))


@dataclass
class Reader:
    """Words of a text after deobfuscation. words: known words, whose stretched forms are searched too."""

    lm: CharModel
    words: frozenset[str]
    squeezed: frozenset[str] = frozenset()
    limit: int = 200_000
    cache: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def __post_init__(self):
        self.squeezed = frozenset(_SQUEEZE.sub(r"\1", w) for w in self.words)

    def token(self, token: str) -> tuple[str, ...]:
        core = token.strip(_EDGE)
        if core.isalpha() and not self._stretched(core) and token.strip(_OUTER) == core:
            return (core,)  # as most are; the cache is for those that take longer
        got = self.cache.get(token)
        if got is None:
            if len(self.cache) >= self.limit:
                self.cache.clear()
            got = self.cache[token] = tuple(self._read(token))
        return got

    def _stretched(self, core: str) -> bool:
        """Whether letters are repeated as no known word has them."""
        short = _SQUEEZE.sub(r"\1", core)
        return len(short) < len(core) and (_RUN.search(core) is not None or core not in self.words and short in self.squeezed)

    def _read(self, token: str) -> list[str]:
        core = token.strip(_EDGE)
        plain = _WORD.findall(core)
        if not plain and not any(c in LEET for c in core):
            return []
        odd = len(plain) != 1 or plain[0] != core or self._stretched(core)
        whole = token.strip(_OUTER)  # masks and look-alikes at either end may be letters
        if not odd and whole == core or _URL.fullmatch(core) or _ADDRESS.fullmatch(core):
            return plain
        return [*plain, *{w for t in {core, whole} for w in _WORD.findall(decode(t, self.lm))}]

    def features(self, text: str) -> set[str]:
        tokens = text.lower().split()
        kinds = set(tokens)
        out: set[str] = set()
        for t in kinds:
            for w in self.token(t):
                out.add(w)
        out.update(spaced(tokens, set(filter(short, kinds)), self.lm))
        return out


def expand(words) -> set[str]:
    """Feature names of words: the words, and their beginnings marked by ``^``."""
    words = set(words)
    return {*words, *(f"^{w[:n]}" for w in words for n in PREFIXES if len(w) > n)}


@dataclass
class Model:
    reader: Reader | None
    weights: dict[str, float]
    bias: float
    sent: Broadcast | None = None  # the reader, as tasks get it

    def scorer(self):
        """Scores of a batch of texts; a word's features are looked up once per word."""
        found: dict[str, tuple] = {}
        shorts: set[str] = set()
        weights, reader = self.weights, self.reader
        base = 1 / (1 + math.exp(-self.bias))

        def of_token(token: str) -> tuple:
            out = []
            for w in reader.token(token):
                if w in weights:
                    out.append(w)
                out += [f for n in PREFIXES if len(w) > n and (f := "^" + w[:n]) in weights]
            return tuple(out)

        def score(text: str | None) -> float:
            if not text or reader is None:
                return base
            tokens = text.lower().split()
            kinds, hits = set(tokens), set()
            for t in kinds.difference(found):
                found[t] = of_token(t)
                if short(t):
                    shorts.add(t)
            for got in map(found.__getitem__, kinds):
                if got:
                    hits.update(got)
            hits.update(f for f in expand(spaced(tokens, shorts, reader.lm)) if f in weights)
            if len(found) > reader.limit:
                found.clear()
                shorts.clear()
            return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.bias + sum(weights[f] for f in hits))))) if hits else base

        return score


def _regression(rows: DataFrame, features: list[str], l2: float = 2.0) -> tuple[dict[str, float], float]:
    """(weights, bias) of the logistic regression on (found: array<string>, y, n: weight); weights are kept at 0 or more, since
    each feature marks toxicity."""
    size = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.sum("n").alias("n")).collect()}
    if len(size) < 2 or not features:
        return {}, math.log((size.get(1, 0) + 1) / (size.get(0, 0) + 1))
    words = CountVectorizerModel.from_vocabulary(features, inputCol="found", outputCol="features")
    fitted = LogisticRegression(labelCol="y", weightCol="n", regParam=l2 / sum(size.values()), standardization=False, maxIter=400, tol=1e-9,
                                lowerBoundsOnCoefficients=Matrices.dense(1, len(features), [0.0] * len(features)),
                                lowerBoundsOnIntercepts=Vectors.dense([-math.inf])).fit(words.transform(rows))
    # rounded, since the order in which partitions are added up varies
    return {f: round(float(w), 6) for f, w in zip(features, fitted.coefficients, strict=True)}, round(float(fitted.intercept), 6)


def _sent(spark: SparkSession, reader: Reader) -> Broadcast:
    """A reader for all tasks.  A Python worker unpacks it once, so what one task has read is known to the next one there; it
    is sent as bytes, as task functions are, so that executors need not have this package."""
    return spark.sparkContext.broadcast([cloudpickle.dumps(reader), None])


def _received(sent: Broadcast) -> Reader:
    held = sent.value
    if held[1] is None:
        held[1] = cloudpickle.loads(held[0])
    return held[1]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn from the labelled documents given; ``labels``: (id, label)."""
    spark = docs.sparkSession
    arrow_limits(spark)
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("label_id")).agg(
        F.max(F.col(label_col)).cast("int").alias("y"))
    total = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = total.get(1, 0), total.get(0, 0)
    if not n1 or not n0:
        share = n1 / max(n1 + n0, 1)
        return Model(None, {}, math.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    # texts meet their labels once, for both passes over them; by sorting at any size, so that no table of labels is broadcast
    rows = stored(docs.select(F.col(id_col).alias("label_id"), F.col(text_col).alias("text")).join(known.hint("merge"), "label_id").select("text", "y"),
                  "toxicity-train")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = Counter(), Counter()
        for b in batches:
            for text, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist(), strict=True):
                counts[y].update(expand(set(_WORD.findall((text or "").lower()))))
            if len(counts[0]) + len(counts[1]) > 300_000:
                yield _counts(counts)
                counts = Counter(), Counter()
        yield _counts(counts)

    words = stored(rows.mapInArrow(count, "word string, n0 long, n1 long").groupBy("word").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "toxicity-words")
    odds = F.log((F.col("n1") + 0.5) / F.lit(n1)) - F.log((F.col("n0") + 0.5) / F.lit(n0))
    telling = words.where((F.col("n1") >= 4) & (odds > 1.5)).withColumn("odds", odds).orderBy(
        F.desc(F.col("odds") * F.sqrt("n1")), "word").limit(FEATURES).collect()
    common = words.where(~F.col("word").startswith("^")).orderBy(F.desc(F.col("n0") + F.col("n1")), "word").limit(LM_WORDS).collect()
    features = sorted(r["word"] for r in telling)
    lexicon = {r["word"]: r["n1"] for r in telling if r["word"][0] != "^"}
    lm = CharModel({r["word"]: r["n0"] + r["n1"] for r in common} | {w: n * 3 for w, n in lexicon.items()})
    reader, wanted = Reader(lm, frozenset(lexicon)), frozenset(features)
    sent = _sent(spark, reader)

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _received(sent)
        for b in batches:
            found = [sorted(wanted.intersection(expand(own.features(t or "")))) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string())), b.column("y")], ["found", "y"])

    # documents with the same features and label are one row; all of them count
    seen = stored(rows.mapInArrow(present, "found array<string>, y int").groupBy("found", "y").agg(
        F.count(F.lit(1)).cast("double").alias("n")).sortWithinPartitions("found", "y"), "toxicity-seen")
    if seen.isEmpty():
        return Model(None, {}, math.log(n1 / n0))
    weights, bias = _regression(seen, features)
    return Model(reader, {f: w for f, w in weights.items() if w > 0.05}, bias, sent)


def _counts(counts: tuple[Counter, Counter]) -> pa.RecordBatch:
    words = list(counts[0].keys() | counts[1].keys())
    return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *(pa.array([c[w] for w in words], pa.int64()) for c in counts)],
                                      ["word", "n0", "n1"])


def score(docs: DataFrame, model: Model, text_col: str = "text", columns: tuple[str, ...] = ("doc_id",),
          threshold: float = THRESHOLD) -> DataFrame:
    """(*columns, score, predicted), one row per document; ``columns`` must not be named score or predicted."""
    spark = docs.sparkSession
    arrow_limits(spark)
    sent = model.sent or _sent(spark, model.reader)
    weights, bias = model.weights, model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Model(_received(sent), weights, bias).scorer()
        for b in batches:
            got = [scorer(t) for t in b.column("toxicity_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in columns] + [
                pa.array(got, pa.float64()), pa.array([int(s >= threshold) for s in got], pa.int32())], [*columns, "score", "predicted"])

    slim = docs.select(*columns, F.col(text_col).alias("toxicity_text"))
    fields = ", ".join(f"`{c}` {t}" for c, t in docs.select(*columns).dtypes)
    return slim.mapInArrow(run, f"{fields}, score double, predicted int")
