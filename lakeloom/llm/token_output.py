"""Token ids in a compact binary file format, written in id order and read back.

Texts are encoded with the tokenizers library.  Added tokens in a text (``<|endoftext|>``)
are split off first and get their ids, as in the library.  Its pre-tokenizer cuts a text into pieces
that are encoded independently, so each different piece of a task is encoded once
(``pieces.cut`` cuts like the library; the tests compare the two), and pieces frequent in a
bounded sample once for all tasks.  The ids, two bytes each if the vocabulary allows, are dealt to parts by ranges of the
document id, sorted, and written as files.

File format (little-endian), at most ``FILE_IDS`` ids unless one document has more:

    magic, crc32 of the meta part, its length, ids per block, number of blocks
    meta (zlib): document ids, null marks, ids per document, the file's id frequencies
    per block: number of ids, bytes, crc32 of the ids (as unsigned 32-bit integers)
    payloads: range-coded blocks (``context_coder``), each decodable from the meta part alone

The files are the rows of a Parquet table (``part``, ``file``, ``image``) in the shared
folder, so Spark's committer makes them whole on any store: a lost task leaves nothing.

Defined results: a null text has only the end id.  Null document ids come first, equal
ones in the order of their ids' bytes.  An empty table gives no file.  A damaged meta part
or block raises ``ValueError``.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import TASK_WORDS, PieceCodes, Pieces, cut_batch, cut_spans, top_pieces
from .common import arrow_limits, stored
from .context_coder import decode_blocks, encode_blocks, frequencies
from .pieces import cut

END_ID, BLOCK, FILE_IDS, PART_CHARS = 2, 512, 1 << 21, 16 << 20
#: Texts of an Arrow batch, and pieces that the library encodes in one call.
BATCH_ROWS, BATCH_BYTES, ENCODED_AT_ONCE = 250, "1m", 2000
#: Pieces of a text that the library splits.
TEXT_PIECES = 250
#: Between them: no text has this byte, and no byte of a text is written as this character.
BETWEEN, SEPARATOR = b"\xff", "\n"
MAGIC = b"CMRC0001"
#: No text has this byte.
MARK = b"\xff"
_HEAD, _ENTRY = "<8sIIII", "<III"


def image(doc_ids: list, counts: np.ndarray, ids: np.ndarray, block: int = BLOCK) -> bytes:
    """A file's bytes: ``counts[i]`` of ``ids`` belong to document ``doc_ids[i]``."""
    values, freq = frequencies(ids)
    payloads = encode_blocks(ids, block, values, freq)
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    known = np.array([0 if d is None else d for d in doc_ids], "<i8")
    meta = zlib.compress(b"".join([struct.pack("<II", len(doc_ids), len(values)), known.tobytes(), nulls.tobytes(),
                                   counts.astype("<u4").tobytes(), np.diff(values, prepend=0).astype("<u4").tobytes(),
                                   freq.astype("<u4").tobytes()]), 1)
    wide = ids.astype("<u4")
    entries = [struct.pack(_ENTRY, len(part := wide[i * block:(i + 1) * block]), len(p), zlib.crc32(part.tobytes()))
               for i, p in enumerate(payloads)]
    return b"".join([struct.pack(_HEAD, MAGIC, zlib.crc32(meta), len(meta), block, len(payloads)), meta, *entries, *payloads])


def parse(data: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(document ids, their numbers of ids, all ids) of a file's bytes."""
    magic, crc, size, _, n_blocks = struct.unpack_from(_HEAD, data)
    meta = data[struct.calcsize(_HEAD):struct.calcsize(_HEAD) + size]
    if magic != MAGIC or zlib.crc32(meta) != crc:
        raise ValueError("not a token file, or its meta part is damaged")
    meta = zlib.decompress(meta)
    n_docs, n_values = struct.unpack_from("<II", meta)
    at, parts = 8, []
    for kind, n in (("<i8", n_docs), ("u1", n_docs), ("<u4", n_docs), ("<u4", n_values), ("<u4", n_values)):
        parts.append(np.frombuffer(meta, kind, n, at))
        at += parts[-1].nbytes
    known, nulls, counts, values, freq = parts
    at, entries = struct.calcsize(_HEAD) + size, []
    for _ in range(n_blocks):
        entries.append(struct.unpack_from(_ENTRY, data, at))
        at += struct.calcsize(_ENTRY)
    payloads = []
    for _, length, _ in entries:
        payloads.append(data[at:at + length])
        at += length
    ids = decode_blocks(payloads, [e[0] for e in entries], np.cumsum(values, dtype=np.int64), freq.astype(np.int64))
    wide, at = ids.astype("<u4"), 0
    for number, (n, _, crc) in enumerate(entries):
        if zlib.crc32(wide[at:at + n].tobytes()) != crc:
            raise ValueError(f"block {number} is damaged")
        at += n
    return [None if no else int(d) for d, no in zip(known.tolist(), nulls.tolist(), strict=True)], counts.astype(np.int64), ids


def load(tokenizer_path: str):
    """The library's tokenizer; added tokens in a text get their own ids."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path)


def added_tokens(tokenizer) -> dict[str, int]:
    """Contents and ids of the tokens that are looked for in a text before it is cut."""
    added = tokenizer.get_added_tokens_decoder()
    if any(t.lstrip or t.rstrip or t.single_word or t.normalized and tokenizer.normalizer for t in added.values()):
        raise ValueError("an added token that takes blanks along, stands alone or is normalised is not supported")
    return {t.content: i for i, t in added.items()}


def cut_around(column: pa.Array, added: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``cut_spans`` of the texts between added tokens; an added token is a piece of its own, marked by ``MARK``."""
    if not any(pc.any(pc.match_substring(column, a)).as_py() for a in added):
        return cut_spans(column)
    either = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
    split = [either.split(t or "") for t in column.to_pylist()]  # texts and added tokens by turns
    pieces, counts = cut_batch(pa.array([t for parts in split for t in parts[::2]], pa.string()))
    stops, out, sizes, at = np.cumsum(counts).tolist(), [], [], 0
    spans = iter(zip([0, *stops], stops))
    for parts in split:
        for i, part in enumerate(parts):
            if i % 2:
                out.append(MARK + part.encode())
            else:
                a, z = next(spans)
                out += pieces[a:z]
        sizes.append(len(out) - at)
        at = len(out)
    bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, out), np.int64, len(out)))]).astype(np.int64)
    return np.frombuffer(b"".join(out), np.uint8), bounds, np.array(sizes, np.int64)


def token_sizes(tokenizer) -> np.ndarray:
    """Number of bytes of every token of a byte-level vocabulary, whose characters stand for bytes."""
    vocab = tokenizer.get_vocab(with_added_tokens=False)
    sizes = np.zeros(max(tokenizer.get_vocab(with_added_tokens=True).values(), default=-1) + 1, np.int64)
    sizes[list(vocab.values())] = list(map(len, vocab))
    return sizes


def byte_characters() -> np.ndarray:
    """The characters that stand for the bytes in a byte-level vocabulary (UTF-16); BETWEEN becomes SEPARATOR."""
    shown = np.zeros(256, bool)
    for low, high in ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)):  # printed as they are; the others follow from 256 on
        shown[low:high + 1] = True
    out = np.where(shown, np.arange(256), 255 + np.cumsum(~shown)).astype("<u2")
    out[BETWEEN[0]] = ord(SEPARATOR)
    return out


CHARACTERS = byte_characters()


def _alone(tokenizer, words: list[bytes], kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words in turn, number of ids of each), each word a text of its own."""
    part = [e.ids for e in tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]
    sizes = np.fromiter(map(len, part), np.int64, len(part))
    return np.fromiter(chain.from_iterable(part), kind, int(sizes.sum())), sizes


def _together(tokenizer, words: list[bytes], kind: str, token_bytes: np.ndarray, added: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``_alone``, as one text: a word that is cut from it as one piece has the ids whose bytes are its own; others go alone."""
    apart = [w if w[:1] == b" " else b"\n" + w for w in words]  # most words are cut from what is before them
    text = b"".join(apart)
    ends, sizes = np.cumsum(np.fromiter(map(len, apart), np.int64, len(words))), np.fromiter(map(len, words), np.int64, len(words))
    found = np.array(tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids, np.int64)
    upto = np.cumsum(token_bytes[found])
    if any(t.encode() in text for t in added) or not len(found) or upto[-1] != len(text):
        return _alone(tokenizer, words, kind)
    starts = cut(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    at = np.searchsorted(starts, ends - sizes)
    whole = (np.append(starts, -1)[at] == ends - sizes) & (np.append(starts, [len(text)] * 2)[at + 1] == ends) & (sizes > 0)
    first, last = (np.searchsorted(upto, x, side="right") for x in (ends - sizes, ends))
    n, rest = last - first, np.flatnonzero(~whole)
    own, n[rest] = _alone(tokenizer, [words[i] for i in rest.tolist()], kind)
    first[rest] = len(found) + np.cumsum(n[rest]) - n[rest]
    before = np.cumsum(n) - n
    return np.append(found.astype(kind), own)[np.arange(int(n.sum())) + np.repeat(first - before, n)], n


def _separated(tokenizer, words: list[bytes], kind: str, token_bytes: np.ndarray, added: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``_together``, in the vocabulary's characters and split by the library at ``SEPARATOR`` only, since the words are cut already."""
    from tokenizers import pre_tokenizers as pre
    text, own = BETWEEN.join(words), getattr(tokenizer, "pre_tokenizer", None)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    if (not isinstance(own, pre.ByteLevel) or own.add_prefix_space or getattr(tokenizer, "normalizer", None) or any(t.encode() in text for t in added)
            or text.count(BETWEEN) != len(words) - 1):
        return _together(tokenizer, words, kind, token_bytes, added)
    tokenizer.pre_tokenizer = pre.CharDelimiterSplit(SEPARATOR)
    texts = [CHARACTERS[np.frombuffer(BETWEEN.join(words[at:at + TEXT_PIECES]), np.uint8)].tobytes().decode("utf-16-le")
             for at in range(0, len(words), TEXT_PIECES)]
    found = np.concatenate([np.array(e.ids, np.int64) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
    tokenizer.pre_tokenizer = own
    upto = np.concatenate([[0], np.cumsum(token_bytes[found])])
    last = np.searchsorted(upto, ends, side="right") - 1
    if upto[-1] != ends[-1] or (upto[last] != ends).any():  # bytes without a token
        return _together(tokenizer, words, kind, token_bytes, added)
    return found.astype(kind), np.diff(last, prepend=0)


def _encoded(tokenizer, words: list[bytes], kind: str, token_bytes: np.ndarray, added: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words in turn, number of ids of each); the library's results, large objects, are held a few at a time."""
    parts = [_separated(tokenizer, words[at:at + ENCODED_AT_ONCE], kind, token_bytes, added) for at in range(0, len(words), ENCODED_AT_ONCE)]
    return tuple(map(np.concatenate, zip(*parts))) if parts else (np.zeros(0, kind), np.zeros(0, np.int64))


def _encoder(held: list, definition: str) -> tuple:
    """(tokenizer, codes, ids of the codes), taken out of ``held`` (the pieces known to all tasks, and what the worker's last
    task left there) or made anew; a task that ends in the middle leaves nothing."""
    spelling, spelt, ids, sizes, left = held
    held[-1] = None
    if left is not None:
        return left
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_str(definition), PieceCodes(spelling, spelt, np.arange(len(spelt)), len(spelt)), Pieces(ids, sizes)


def boundaries(docs: DataFrame, id_col: str, text_col: str) -> list[int]:
    """Upper document ids of all parts but the last: quantiles, as many as the text's size asks for."""
    size = docs.agg(F.sum(F.length(text_col))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-size // PART_CHARS))
    marks = docs.agg(F.percentile_approx(F.col(id_col).cast("long"), [i / parts for i in range(1, parts)] or [0.5], 20 * parts)).first()[0]
    return sorted(set(marks or []))


def tokenize(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
             end_id: int | None = END_ID, marks: list[int] | None = None) -> DataFrame:
    """(part, doc_id, ids): ids as little-endian integers of the type ``id_kind``, the end id last.

    marks: upper document ids of all parts but the last."""
    spark = docs.sparkSession
    arrow_limits(spark, BATCH_ROWS, BATCH_BYTES)
    tokenizer = load(tokenizer_path)
    added, kind = added_tokens(tokenizer), id_kind(tokenizer_path)
    words = top_pieces(docs, id_col, text_col, frozenset(), spelt=False, held=TASK_WORDS).select("word").toArrow()["word"].to_pylist()
    token_bytes, contents = token_sizes(tokenizer), list(added)
    flat, sizes = _encoded(tokenizer, words, kind, token_bytes, contents)
    words += [MARK + t.encode() for t in added]
    flat, sizes = np.append(flat, np.array(list(added.values()), kind)), np.append(sizes, np.ones(len(added), np.int64))
    # a Python worker unpacks it once, so it may keep there what its next tasks need
    sent = spark.sparkContext.broadcast([b"".join(words), np.array(list(map(len, words)), np.int64), flat, sizes, None])
    definition = tokenizer.to_str()
    upper, added = np.array(marks or [], np.int64), contents
    del tokenizer, words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, codes, known = _encoder(held := sent.value, definition)
        end = np.zeros(0 if end_id is None else 1, kind)
        end[:] = end_id or 0
        for b in batches:
            forget = codes.full()
            buf, bounds, counts = cut_around(b.column("text"), added)
            coded = codes.of(buf, bounds)
            del buf, bounds
            known.add(*_encoded(own, codes.taken(), kind, token_bytes, added), forget)
            ids, upto = known.spelt(coded)
            cuts = np.concatenate([[0], upto])[np.concatenate([[0], np.cumsum(counts)])].astype(np.int64)
            texts = [np.concatenate([ids[a:z], end]).tobytes() for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            doc_ids = b.column("doc_id")
            at = np.searchsorted(upper, np.array([-2 ** 63 if d is None else d for d in doc_ids.to_pylist()], np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), doc_ids, pa.array(texts, pa.binary())], ["part", "doc_id", "ids"])
        held[-1] = own, codes, known

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "part int, doc_id long, ids binary")


def id_kind(tokenizer_path: str) -> str:
    """Type of the ids between tokenizer and file."""
    return "<u2" if load(tokenizer_path).get_vocab_size() <= 1 << 16 else "<u4"


def write_files(tokens: DataFrame, kind: str, parts: int, block: int = BLOCK, file_ids: int = FILE_IDS) -> DataFrame:
    """(part, file, n_ids, image), stored; parts and files follow the order of the document ids."""
    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, size, doc_ids, texts = None, 0, 0, [], []

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(texts), kind).astype(np.int64)
            counts = np.array([len(t) for t in texts], np.int64) // np.dtype(kind).itemsize
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([len(ids)]),
                                               pa.array([image(doc_ids, counts, ids, block)], pa.binary())], ["part", "file", "n_ids", "image"])

        for b in batches:
            for p, d, t in zip(*(b.column(c).to_pylist() for c in ("part", "doc_id", "ids")), strict=True):
                if texts and (p != part or size + len(t) > file_ids * np.dtype(kind).itemsize):
                    yield close()
                    number, size, doc_ids, texts = (number + 1 if p == part else 0), 0, [], []
                part, size = p, size + len(t)
                doc_ids.append(d)
                texts.append(t)
        if texts:
            yield close()

    dealt = tokens.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "doc_id", "ids")
    return stored(dealt.mapInArrow(files, "part int, file int, n_ids long, image binary"), "token-files")


def read_files(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read from the files; ``start``: ids of all documents before it."""
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    # one small row per file of FILE_IDS ids passes through this window
    offsets = files.select("part", "file", "n_ids").withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).drop("n_ids")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                doc_ids, counts, ids = parse(b.column("image")[i].as_py())
                wide, ends = ids.astype("<u4", copy=False), np.cumsum(counts)
                crc = [zlib.crc32(wide[a:z].tobytes()) for a, z in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
                n = len(doc_ids)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, b.column(c)[i].as_py(), np.int32)) for c in ("part", "file")] + [
                    pa.array(doc_ids, pa.int64()), pa.array(ends - counts), pa.array(counts), pa.array(crc, pa.int64())],
                    ["part", "file", "doc_id", "at", "n_tokens", "ids_crc32"])

    rows = files.select("part", "file", "image").mapInArrow(
        read, "part int, file int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return rows.join(offsets, ["part", "file"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_output(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int | None = END_ID) -> DataFrame:
    """Encode, write the files, and read them back."""
    marks = boundaries(docs, id_col, text_col)
    tokens = tokenize(docs, tokenizer_path, id_col, text_col, end_id, marks)
    return read_files(write_files(tokens, id_kind(tokenizer_path), len(marks) + 1)).withColumnRenamed("doc_id", id_col)
