"""Language identification with a byte convolutional network trained in numpy.

Network: byte embeddings, filters of several widths, ReLU, max pooling over a window,
softmax.  A text is cut into windows of ``WINDOW`` byte positions that follow one another
to its end; each window also sees the next bytes that its last filters need, so no
character sequence is missed.  A text's score is the mean of its windows' probabilities,
weighted by their bytes; the language is the one with the highest.

Training reads one window from each of a bounded, hashed sample of labelled documents:
about ``PER_LANGUAGE`` of each language, picked by the hash of the id, so it is the same
at every run.  That sample is all that reaches the driver.

Defined results: a null text or one without a letter is ``und`` with score 0.  Ties go to
the language that sorts first.  Without labelled documents every text is ``und``.  Only
the id and text columns are read for a prediction, so no other column can leak or clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_limits, text_buffer

WINDOW = 256
WIDTHS, FILTERS, EMBEDDING = (2, 3, 4), 10, 8
PER_LANGUAGE = 1500
#: At least EPOCHS passes over the sample, and at least STEPS steps if it is small.
EPOCHS, STEPS, BATCH, RATE = 6, 500, 64, 4e-3
UND = "und"
PAD = 256
_SPAN = max(WIDTHS)
_GROUP = 256


@dataclass
class Network:
    langs: list[str]
    emb: np.ndarray    # 257 x EMBEDDING; row PAD is zero
    filt: np.ndarray   # _SPAN * EMBEDDING x filters; a narrow filter's last rows are zero
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(columns, responses, their maxima) of windows (n x WINDOW + _SPAN - 1 byte values)."""
        e = self.emb[windows]
        n = len(windows)
        s = e.strides
        cols = np.lib.stride_tricks.as_strided(e, (n, WINDOW, _SPAN * EMBEDDING), (s[0], s[1], s[2]), writeable=False)
        cols = cols.reshape(n * WINDOW, -1)
        resp = (cols @ self.filt).reshape(n, WINDOW, -1)
        return cols, resp, resp.max(axis=1)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        z = np.maximum(self.pooled(windows)[2] + self.bias, 0) @ self.out + self.out_bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def cut(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of a batch: (start, end of its text, row). An empty text has none."""
    sizes = np.diff(offsets)
    number = -(-sizes // WINDOW)
    row = np.repeat(np.arange(len(sizes)), number)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
    return offsets[:-1][row] + nth * WINDOW, offsets[1:][row], row


def gather(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    at = start[:, None] + np.arange(WINDOW + _SPAN - 1)
    inside = at < end[:, None]
    return np.where(inside, buf[np.where(inside, at, 0)], PAD)


def train(windows: np.ndarray, labels: np.ndarray, langs: list[str], seed: int = 1) -> Network:
    """Adam on the cross entropy; classes count alike whatever their number of windows."""
    rng = np.random.default_rng(seed)
    n_filters, k = FILTERS * len(WIDTHS), len(langs)
    shape = np.zeros((_SPAN, EMBEDDING, n_filters), np.float32)
    for i, w in enumerate(WIDTHS):
        shape[:w, :, i * FILTERS:(i + 1) * FILTERS] = 1
    shape = shape.reshape(-1, n_filters)
    emb = rng.normal(0, 0.5, (257, EMBEDDING)).astype(np.float32)
    emb[PAD] = 0
    net = Network(langs, emb, (rng.normal(0, 0.3, shape.shape) * shape).astype(np.float32), np.zeros(n_filters, np.float32),
                  rng.normal(0, 0.2, (n_filters, k)).astype(np.float32), np.zeros(k, np.float32))
    weight = (len(labels) / (k * np.maximum(np.bincount(labels, minlength=k), 1))).astype(np.float32)
    params = ["emb", "filt", "bias", "out", "out_bias"]
    step = 0
    first, second = ({p: np.zeros_like(getattr(net, p)) for p in params} for _ in (0, 1))
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // len(labels)))):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            rows = order[at:at + BATCH]
            x, y = windows[rows], labels[rows]
            cols, resp, top = net.pooled(x)
            hidden = np.maximum(top + net.bias, 0)
            z = hidden @ net.out + net.out_bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            g = z / z.sum(axis=1, keepdims=True)
            g[np.arange(len(y)), y] -= 1
            g *= weight[y][:, None] / len(y)
            gh = (g @ net.out.T) * (hidden > 0)
            # only the position of each maximum passes the gradient on
            where = resp.argmax(axis=1) + np.arange(len(y))[:, None] * WINDOW
            picked = cols[where]                                     # n x filters x columns
            grads = {"out": hidden.T @ g, "out_bias": g.sum(axis=0), "bias": gh.sum(axis=0),
                     "filt": np.einsum("nfc,nf->cf", picked, gh) * shape}
            back = (gh[:, :, None] * net.filt.T[None]).reshape(len(y), n_filters, _SPAN, EMBEDDING)
            ge = np.zeros_like(net.emb)
            for o in range(_SPAN):
                np.add.at(ge, x[np.arange(len(y))[:, None], where % WINDOW + o], back[:, :, o])
            ge[PAD] = 0
            grads["emb"] = ge
            step += 1
            for p in params:
                first[p] = 0.9 * first[p] + 0.1 * grads[p]
                second[p] = 0.999 * second[p] + 0.001 * grads[p] ** 2
                move = RATE * (first[p] / (1 - 0.9 ** step)) / (np.sqrt(second[p] / (1 - 0.999 ** step)) + 1e-8)
                setattr(net, p, (getattr(net, p) - move).astype(np.float32))
    return net


def sample_windows(labelled: DataFrame, text_col: str, lang_col: str, id_col: str, per_language: int) -> tuple[list[bytes], list[str]]:
    """About ``per_language`` windows of each language: documents by a hash of the id, the place in the text by another."""
    n_langs = labelled.groupBy(F.col(lang_col).alias("lang")).count().collect()  # one row per language
    total = {r["lang"]: r["count"] for r in n_langs}
    if not total:
        return [], []
    rate = F.lit(0.0)
    for lang, n in total.items():
        rate = F.when(F.col("lang") == lang, min(1.0, per_language / n)).otherwise(rate)
    size = F.length("text")
    at = F.pmod(F.xxhash64("id", F.lit("place")), F.greatest(size - F.lit(WINDOW), F.lit(1))) + 1
    rows = (labelled.select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
            .withColumn("rate", rate)
            .where(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 60)) < F.col("rate") * (1 << 60))
            .where(F.rlike("text", F.lit(r"\p{L}")))
            .select("lang", "id", F.substring(F.col("text"), at.cast("int"), F.lit(WINDOW)).alias("piece"))).collect()
    rows.sort(key=lambda r: (r["lang"], r["id"] or "", r["piece"]))
    return [r["piece"].encode() for r in rows], [r["lang"] for r in rows]


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = PER_LANGUAGE) -> Network | None:
    """Train on documents with a label; None if there is none."""
    pieces, names = sample_windows(labelled.where(F.col(lang_col).isNotNull()), text_col, lang_col, id_col, per_language)
    if not pieces:
        return None
    langs = sorted(set(names))
    sizes = np.array([min(len(p), WINDOW + _SPAN - 1) for p in pieces])
    buf = np.frombuffer(b"".join(p[:WINDOW + _SPAN - 1] for p in pieces), np.uint8)
    end = np.cumsum(sizes)
    return train(gather(buf, end - sizes, end), np.array([langs.index(n) for n in names]), langs)


def predict(docs: DataFrame, net: Network | None, text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (default: all) plus ``lang_pred`` and ``lang_score``, which replace any of those names."""
    arrow_limits(docs.sparkSession)
    keep = [c for c in (docs.columns if columns is None else columns) if c not in ("lang_pred", "lang_score")]
    has_letter = F.coalesce(F.rlike(F.col(text_col), F.lit(r"\p{L}")), F.lit(False))
    slim = docs.select(*dict.fromkeys([*keep, text_col]), has_letter.alias("lang_pred"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, offsets = text_buffer(b.column(text_col))
            letters = b.column("lang_pred").to_numpy(zero_copy_only=False)
            pred, score = np.full(b.num_rows, UND, object), np.zeros(b.num_rows)
            if net is not None and len(buf):
                sums, (start, end, row) = np.zeros((b.num_rows, len(net.langs))), cut(buf, offsets)
                for at in range(0, len(row), _GROUP):
                    s, e, r = (x[at:at + _GROUP] for x in (start, end, row))
                    np.add.at(sums, r, net.probabilities(gather(buf, s, e)) * np.minimum(e - s, WINDOW)[:, None])
                mean = sums / np.maximum(np.diff(offsets), 1)[:, None]
                best = mean.argmax(axis=1)
                pred = np.where(letters, np.array(net.langs, object)[best], UND)
                score = np.where(letters, np.clip(mean[np.arange(len(best)), best], 0, 1), 0)
            arrays = [b.column(c) for c in keep] + [pa.array(pred, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, "lang_pred", "lang_score"])

    schema = T.StructType(docs.select(*keep).schema.fields + [
        T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())])
    return slim.mapInArrow(run, schema)
