"""Bigram language model in an Elias-Fano trie of memory-mapped files.

Tokens: the words of a text (A-Z lower-cased, runs of anything but ASCII white space),
then one end token.  ``p0(w) = (c(w) + 0.1) / (N + 0.1 (V + 1))`` is the base model, and

    p(w | u) = (c(u, w) + m p0(w)) / (c(u) + m)

is smoothed towards it (a Dirichlet prior of weight m; it sums to 1 over the words and one
unknown word, and falls back to p0 after an unknown u).  The text's start is a context of its own.

Files, in the shared folder, made by one task each:

* word level, dealt by the leading bits of the words' 64-bit hashes: hashes in order, their
  counts, and counts before.  A word's id is its place in this order; ids are dense.
* pair level, dealt by ranges of (u, w) that hold equally many tokens, so a frequent u is
  split: for each u the pointer to its successors (Elias-Fano), the successors' ids, each
  u's continuing where the last one's ended (so the sequence is monotone, Elias-Fano), and
  one byte per pair for log10 p(w | u), quantised evenly over the file's range.

A look-up reads u's pointer, adds the end of the successors before it to w's id, and asks
for the successor of that sum.  All steps work on the distinct pairs of a batch at once.

Counting passes blocks of sorted arrays, not rows, through the shuffle: a task's equal
words and pairs are added up first.  Everything read from the corpus covers all its rows.

The shared folder must be one that tasks can open as files (``file:``, as a mounted or
local path); another scheme raises an error that says so.  Words whose 64-bit hashes
collide count as one; with 10^8 different words this is to be expected for 0.0003 of them in all.

Defined results: a null text counts as empty and holds the end token only.  Without
training texts N = V = 0 and every probability is 1.  Repeated rows repeat.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import Codes
from .common import LOWER_BYTES, arrow_limits, scratch, text_list
from .elias_fano import EliasFano, encode, open_mapped, write

U = np.uint64
PRIOR, DELTA = 16.0, 0.1
SHARD_CHARS, HELD_WORDS, HELD_PAIRS = 32 << 20, 400_000, 1_000_000
#: Texts of an Arrow batch; a task holds some twenty arrays with a number for each of its tokens.
BATCH_ROWS, BATCH_BYTES = 500, "2m"
END = b""  # no word is empty
_hash = xxhash.xxh64_intdigest


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the checkpoint folder, as a path that tasks open."""
    url = urlparse(scratch(spark, name))
    if url.scheme not in ("", "file"):
        raise RuntimeError(f"memory-mapped files need a mounted spark.checkpoint.dir, not {url.scheme}:")
    os.makedirs(url.path, exist_ok=True)
    return url.path


def publish(path: str, arrays: dict[str, np.ndarray]) -> None:
    """Write a file as a whole: another attempt of the same task writes the same bytes."""
    part = f"{path}.{TaskContext.get().taskAttemptId()}"
    write(part, arrays)
    os.replace(part, path)


def tokens_of(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """(tokens of all texts, number of tokens of each)."""
    out: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        words = t.translate(LOWER_BYTES).split()
        words.append(END)
        counts[i] = len(words)
        out += words
    return out, counts


def _sum_by(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(c, first) if len(k) else c


def _blocks(shards: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """A row for each shard; all arrays are in the order of the keys, and so of the shards."""
    at = np.concatenate([[0], np.flatnonzero(np.diff(shards)) + 1, [len(shards)]]) if len(shards) else np.zeros(1, np.int64)
    spans = list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))
    return pa.RecordBatch.from_arrays([
        pa.array([int(shards[a]) for a, _ in spans], pa.int32()),
        pa.array([np.diff(keys[a:b], prepend=U(0)).tobytes() for a, b in spans], pa.binary()),
        pa.array([counts[a:b].astype("<u8" if counts[a:b].max() >> 32 else "<u4").tobytes() for a, b in spans], pa.binary())],
        ["shard", "keys", "counts"])


def _unpacked(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    k = np.cumsum(np.frombuffer(keys, U), dtype=U)
    return k, np.frombuffer(counts, "<u4" if len(counts) < len(keys) else "<u8").astype(np.int64)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, keys, counts) of every shard in a sorted partition."""
    shard, keys, counts, held = None, [], [], 0
    for b in batches:
        for s, k, c in zip(*(b.column(n).to_pylist() for n in ("shard", "keys", "counts")), strict=True):
            if s != shard and shard is not None:
                yield (shard, *_sum_by(keys, counts))
                keys, counts, held = [], [], 0
            shard = s
            k, c = _unpacked(k, c)
            keys.append(k)
            counts.append(c)
            held += len(k)
            if held > 4 * HELD_PAIRS:  # equal keys of many tasks meet before more are read
                k, c = _sum_by(keys, counts)
                keys, counts, held = [k], [c], 0
    if shard is not None:
        yield (shard, *_sum_by(keys, counts))


class Words:
    """The word level: look-ups of sorted hashes or ids go to each file once."""

    def __init__(self, folder: str, sizes: list[int], mass: list[int], total: int):
        self.folder, self.total, self.files = folder, total, {}
        self.id0, self.mass0 = np.cumsum([0, *sizes]), np.cumsum([0, *mass])
        self.bits = (len(sizes) - 1).bit_length()
        self.size = int(self.id0[-1])

    def file(self, shard: int) -> dict[str, np.ndarray] | None:
        if self.id0[shard] == self.id0[shard + 1]:
            return None
        if shard not in self.files:
            self.files[shard] = open_mapped(f"{self.folder}/words-{shard}")
        return self.files[shard]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts) of hashes; an unknown one has id -1 and count 0."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        order = np.argsort(hashes)
        sort = hashes[order]
        shard = (sort >> U(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(sort), np.int64)
        for s in np.unique(shard):
            if (f := self.file(int(s))) is not None:
                a, b = np.searchsorted(shard, [s, s + 1])
                at = np.minimum(np.searchsorted(f["hashes"], sort[a:b]), len(f["hashes"]) - 1)
                hit = f["hashes"][at] == sort[a:b]
                ids[order[a:b][hit]] = self.id0[s] + at[hit]
                counts[order[a:b][hit]] = f["counts"][at[hit]]
        return ids, counts

    def mass(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of all words before, count) of ascending ids."""
        before, counts = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        asked = np.unique(np.searchsorted(self.id0, ids, side="right") - 1)  # the start's id lies after the last file
        for s in asked[(asked >= 0) & (asked < len(self.id0) - 1)].tolist():
            a, b = np.searchsorted(ids, self.id0[s:s + 2])
            f, at = self.file(s), ids[a:b] - self.id0[s]
            before[a:b], counts[a:b] = self.mass0[s] + f["before"][at], f["counts"][at]
        return before, counts


class Model:
    """What a task needs to know of the trie; its files are opened where it is used."""

    def __init__(self, folder: str, sizes: list[int], mass: list[int], texts: int, prior: float):
        self.folder, self.sizes, self.masses, self.texts, self.prior = folder, sizes, mass, texts, prior
        self.total, self.kinds = sum(mass), sum(sizes)
        self.parts, self.begin = 1, self.kinds  # the text's start is the context after the last word
        self.pairs: dict[int, tuple | None] = {}

    def words(self) -> Words:
        return Words(self.folder, self.sizes, self.masses, self.total)

    def part(self, before: np.ndarray, count: np.ndarray, word: np.ndarray) -> np.ndarray:
        """File of a pair: by the tokens that come before it; ascending with (context, word)."""
        place = (before + count * (word / (self.kinds + 1.0))) / max(self.total + self.texts, 1)
        return np.clip((place * self.parts).astype(np.int64), 0, self.parts - 1)

    def contexts(self, words: Words, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens before, count) of ascending context ids, the text's start among them."""
        before, count = words.mass(ids)
        start = ids == self.begin
        before[start], count[start] = self.total, self.texts
        return before, count

    def base(self, count: np.ndarray) -> np.ndarray:
        return (count + DELTA) / (self.total + DELTA * (self.kinds + 1))

    def pair_file(self, part: int):
        if part not in self.pairs:
            path = f"{self.folder}/pairs-{part}"
            self.pairs[part] = None
            if os.path.exists(path):
                f = open_mapped(path)
                fano = [EliasFano({n: f[f"{which}_{n}"] for n in ("high", "ones", "low", "shape")}) for which in ("pointers", "successors")]
                self.pairs[part] = (int(f["range"][0]), int(f["range"][1]), *fano, f["codes"], f["scale"])
        return self.pairs[part]

    def find(self, part: np.ndarray, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """log10 p(word | context) of ascending pairs of ids, NaN if the pair is not in the trie."""
        out = np.full(len(word), np.nan)
        for p in np.unique(part):
            a, b = np.searchsorted(part, [p, p + 1])
            if (f := self.pair_file(int(p))) is None:
                continue
            first, last, pointers, successors, codes, scale = f
            c = context[a:b]
            inside = np.flatnonzero((c >= first) & (c <= last))
            own, back = np.unique(c[inside] - first, return_inverse=True)
            begin, end = pointers.get(own), pointers.get(own + 1)
            base = np.zeros(len(own), np.int64)
            later = begin > 0
            base[later] = successors.get(begin[later] - 1) + 1
            want = base[back] + word[a:b][inside]
            at = successors.successor(want)
            ok = at < end[back]
            ok[ok] = successors.get(at[ok]) == want[ok]
            out[a + inside[ok]] = scale[0] + scale[1] * codes[at[ok]]
        return out


def _write_pairs(model: Model, words: Words, part: int, keys: np.ndarray, counts: np.ndarray) -> None:
    size = U(model.kinds + 1)
    context, word = (keys // size).astype(np.int64), (keys % size).astype(np.int64)
    first, last = int(context[0]), int(context[-1])
    pointers = np.searchsorted(context, np.arange(first, last + 2))
    # each context's successors go on from where the last context's ended
    ends = np.concatenate([np.flatnonzero(np.diff(context)), [len(context) - 1]])
    steps = np.zeros(len(context), np.int64)
    steps[ends[:-1] + 1] = word[ends[:-1]] + 1
    own = np.unique(context)
    total = model.contexts(words, own)[1][np.searchsorted(own, context)]
    kinds, back = np.unique(word, return_inverse=True)
    base = model.base(words.mass(kinds)[1])[back]
    log = np.log10((counts + model.prior * base) / (total + model.prior))
    low, high = log.min(), log.max()
    step = max((high - low) / 255, 1e-12)
    arrays = {"range": np.array([first, last], np.int64), "scale": np.array([low, step]),
              "codes": np.round((log - low) / step).astype(np.uint8)}
    for name, values in (("pointers", pointers), ("successors", word + np.cumsum(steps))):
        arrays |= {f"{name}_{k}": v for k, v in encode(values).items()}
    publish(f"{model.folder}/pairs-{part}", arrays)


class Batches:
    """Token ids of a batch, looked up once per distinct word of a task; what ``codes`` forgets is looked up again."""

    def __init__(self, model: Model):
        self.model, self.words, self.codes = model, model.words(), Codes({}, 0)
        self.ids = self.counts = np.zeros(0, np.int64)  # by code

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, counts, context ids, tokens of each text)."""
        if self.codes.full():
            self.ids = self.counts = np.zeros(0, np.int64)
        words, sizes = tokens_of(texts)
        coded = np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words))
        if new := self.codes.taken():
            ids, counts = self.words.find(np.array([_hash(w) for w in new], U))
            self.ids, self.counts = np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts])
        token, count = self.ids[coded], self.counts[coded]
        context = np.empty_like(token)
        context[1:] = token[:-1]
        context[np.cumsum(sizes) - sizes] = self.model.begin
        return token, count, context, sizes


def fit(docs: DataFrame, text_col: str = "text", prior: float = PRIOR) -> Model:
    """Count words, then pairs, and write both levels.

    Tasks write the trie's files alone and send a row per file: a Spark table of them would be a file per task, for each of
    which the executor's JVM starts processes (``chmod``) that count its memory once more until they run."""
    spark = docs.sparkSession
    arrow_limits(spark, BATCH_ROWS, BATCH_BYTES)
    slim = docs.select(F.col(text_col).alias("text"))
    texts, chars = slim.agg(F.count(F.lit(1)), F.sum(F.length("text"))).first()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = 1 << (max(least, -(-(chars or 0) // SHARD_CHARS)) - 1).bit_length()
    bits, folder = shards.bit_length() - 1, shared_folder(spark, "trie")
    schema = "shard int, keys binary, counts binary"

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            keys = np.array([_hash(w) for w in found], U)
            keys, counts = _sum_by([keys], [np.fromiter(found.values(), np.int64, len(found))])
            found.clear()
            return _blocks((keys >> U(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64), keys, counts)

        for b in batches:
            found.update(tokens_of(text_list(b.column("text")))[0])
            if len(found) > HELD_WORDS:
                yield out()
        yield out()

    def word_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, keys, counts in _merged(batches):
            publish(f"{folder}/words-{shard}", {"hashes": keys, "counts": counts, "before": np.cumsum(counts) - counts})
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (shard, len(keys), int(counts.sum()))], ["shard", "kinds", "mass"])

    def gathered(df: DataFrame, n: int) -> DataFrame:
        return df.repartitionById(n, F.col("shard")).sortWithinPartitions("shard")

    made = gathered(slim.mapInArrow(count_words, schema), shards).mapInArrow(
        word_files, "shard long, kinds long, mass long").collect()  # one row per file
    sizes, mass = [0] * shards, [0] * shards
    for r in made:
        sizes[r["shard"]], mass[r["shard"]] = r["kinds"], r["mass"]
    model = Model(folder, sizes, mass, texts, prior)
    model.parts = shards

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, size = Batches(model), U(model.kinds + 1)
        keys, counts, held = [], [], 0

        def out() -> pa.RecordBatch:
            k, c = _sum_by(keys, counts)
            keys.clear()
            counts.clear()
            context = (k // size).astype(np.int64)
            own = np.unique(context)
            before, count = model.contexts(reader.words, own)
            at = np.searchsorted(own, context)
            return _blocks(model.part(before[at], count[at], (k % size).astype(np.int64)), k, c)

        for b in batches:
            token, _, context, _ = reader.read(text_list(b.column("text")))
            k, c = np.unique(context.astype(U) * size + token.astype(U), return_counts=True)
            keys.append(k)
            counts.append(c)
            held += len(k)
            if held > HELD_PAIRS:
                yield out()
                held = 0
        if keys:
            yield out()

    def pair_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = model.words()
        for part, keys, counts in _merged(batches):
            _write_pairs(model, words, part, keys, counts)
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (part, len(keys))], ["shard", "pairs"])

    gathered(slim.mapInArrow(count_pairs, schema), shards).mapInArrow(pair_files, "shard long, pairs long").agg(F.sum("pairs")).collect()
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(*columns, n_tokens, n_known, train_tokens, base_score, score), one row per document."""
    arrow_limits(docs.sparkSession, BATCH_ROWS, BATCH_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Batches(model)
        for b in batches:
            token, count, context, sizes = reader.read(text_list(b.column("lm_text")))
            base = model.base(count)
            after = np.where(context == model.begin, model.texts, np.concatenate([[0], count[:-1]]))
            # unseen pairs of known words, and whatever follows an unknown word
            log = np.log10(np.where((context >= 0) & (after > 0), model.prior * base / (after + model.prior), base))
            known = np.flatnonzero((context >= 0) & (token >= 0))
            if len(known):
                size = U(model.kinds + 1)
                keys, back = np.unique(context[known].astype(U) * size + token[known].astype(U), return_inverse=True)
                c, w = (keys // size).astype(np.int64), (keys % size).astype(np.int64)
                own = np.unique(c)
                before, total = model.contexts(reader.words, own)
                at = np.searchsorted(own, c)
                found = model.find(model.part(before[at], total[at], w), c, w)[back]
                log[known] = np.where(np.isnan(found), log[known], found)
            ends = np.cumsum(sizes)
            first = ends - sizes
            n = len(sizes)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in columns] + [
                pa.array(sizes), pa.array(np.add.reduceat((count > 0).astype(np.int64), first) if n else sizes),
                pa.array(np.full(n, model.total)), pa.array(np.add.reduceat(np.log10(base), first) if n else np.zeros(0)),
                pa.array(np.add.reduceat(log, first) if n else np.zeros(0))],
                [*columns, "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    slim = docs.select(*columns, F.col(text_col).alias("lm_text"))
    fields = ", ".join(f"`{c}` {t}" for c, t in docs.select(*columns).dtypes)
    return slim.mapInArrow(run, f"{fields}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
