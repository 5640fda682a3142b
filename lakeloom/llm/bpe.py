"""Byte-level BPE encoding and decoding with given ranks.

Encoding cuts texts into the pattern's pieces (``pieces.cut``).  Pieces that are tokens
themselves need no merges.  The merges of all other pieces run in Spark's higher-order
functions: ``fold_merges`` folds over a piece's byte array, at each step merging the
leftmost pair of least rank, with a literal rank map.  A token and the rank of its pair are
one number, so a step rebuilds one array.  The map is a constant array (the value of a scalar
subquery) made as a perfect hash of the pairs (Spark's own maps are searched from end to end),
and every slot names its pair, so one look-up gives a pair's rank.

A distinct piece is folded once per task: a block (the texts of one Arrow batch) brings only
the pieces that the task has not met (it forgets them all when there are over ``TASK_WORDS``,
to bound its memory).  The pieces that are frequent in a bounded sample (``CACHE_DOCS`` texts,
``CACHE_WORDS`` pieces) are folded once and sent to all tasks.  Both only save work and
change no result.  No text and no id is shuffled.

Decoding concatenates the byte strings of the ids.

Defined results: a null text counts as empty and has no ids; repeated rows repeat.  Only
the id and text columns are read.  Ids outside the vocabulary raise an error, and so do
ranks of ``NO_MERGE`` and more.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_limits, text_buffer
from .pieces import cut

CACHE_DOCS, CACHE_WORDS, TASK_WORDS = 20_000, 200_000, 120_000
#: Words of an Arrow batch that a task's counts go out in.
COUNTED_WORDS = 20_000
#: A block of texts: so small that what it becomes in the JVM are no humongous objects.
BLOCK_ROWS, BLOCK_BYTES = 125, "256k"
#: Ids and ranks stay below; a look-up that meets another pair's slot gives at least this.
ID_BITS = 20
NO_MERGE = 1 << ID_BITS
EMPTY = 1 << 61


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file (base64, blank, id on each line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(n) for t, n in (line.split() for line in lines if line.strip())}


def pair_rows(ranks: dict[bytes, int]) -> dict[int, dict[int, int]]:
    """left id -> right id -> id of the merged token, for every pair of tokens that makes one."""
    if ranks and max(ranks.values()) >= NO_MERGE:
        raise ValueError(f"ids of {NO_MERGE} and more don't fit into the rank map")
    rows: dict[int, dict[int, int]] = {}
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                rows.setdefault(left, {})[right] = rank
    return rows


def displaced(rows: dict[int, dict[int, int]], seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(displacements, slots) of a perfect hash of the pairs, by hash and displace; both lengths are powers of two.

    h is the XXH64 of a pair's ids (Spark's ``xxhash64``).  The pair's bucket is the low bits of h, its slot the bits above
    32 xor the bucket's displacement.  A slot holds ``(left * NO_MERGE + right) * NO_MERGE + rank``, or EMPTY."""
    pairs = np.array([(le, ri, rank) for le, row in rows.items() for ri, rank in row.items()] or [(0, 0, 0)], np.int64)
    hashes = np.array([pair_hash(int(le), int(ri)) for le, ri, _ in pairs], np.uint64)
    size = 1 << int(1.15 * len(pairs)).bit_length()
    n_buckets, place = size >> 2, ((hashes >> np.uint64(32)) & np.uint64(size - 1)).astype(np.int64)
    n_buckets = max(n_buckets, 1)
    while len(np.unique((hashes & np.uint64(n_buckets - 1)).astype(np.int64) * size + place)) < len(pairs):
        n_buckets *= 2  # two pairs of one bucket must differ in place
    bucket = (hashes & np.uint64(n_buckets - 1)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    groups = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1)
    free, moves, rng = np.ones(size, bool), np.zeros(n_buckets, np.int64), np.random.default_rng(seed)
    for group in sorted(groups, key=len, reverse=True):  # the largest buckets while most slots are free
        while True:
            tries = rng.integers(0, size, 32)
            fits = np.flatnonzero(free[place[group][None, :] ^ tries[:, None]].all(axis=1))
            if len(fits):
                moves[bucket[group[0]]] = tries[fits[0]]
                free[place[group] ^ tries[fits[0]]] = False
                break
    slots = np.full(size, EMPTY, np.int64)
    if rows:
        slots[place ^ moves[bucket]] = (pairs[:, 0] * NO_MERGE + pairs[:, 1]) * NO_MERGE + pairs[:, 2]
    return moves, slots


def pair_hash(left: int, right: int) -> int:
    """Spark's ``xxhash64(left, right)`` of two longs: the first's hash seeds the second's."""
    return xxhash.xxh64_intdigest(right.to_bytes(8, "little"), seed=xxhash.xxh64_intdigest(left.to_bytes(8, "little"), seed=42))


def _let(value: Column, body, like: Column) -> Column:
    """``body(value)`` with the value computed once; ``like`` is any value of the result's type."""
    return F.aggregate(F.array(value), like, lambda _, x: body(x))


def _joined(*arrays: Column) -> Column:
    return F.flatten(F.array(*arrays))  # much cheaper than concat where expressions are interpreted


RANK_MAP = "rank_map"


@dataclass
class RankMap:
    """The constant arrays of a fold, made once for all its uses: a struct that is the value of a scalar subquery, so it is a
    literal of the running plan but no part of a plan's text.

    firsts: the cell of a byte before another one, at ``256 * byte + next byte``; lasts: of a piece's last byte."""

    value: DataFrame
    sizes: tuple[int, int]

    @classmethod
    def of(cls, spark: SparkSession, ranks: dict[bytes, int]) -> RankMap:
        moves, slots = displaced(pair_rows(ranks))
        ids = [ranks[bytes([b])] for b in range(256)]
        firsts = [ranks.get(bytes([a, b]), NO_MERGE) << ID_BITS | ids[a] for a in range(256) for b in range(256)]
        arrays = {"firsts": firsts, "lasts": [NO_MERGE << ID_BITS | i for i in ids], "moves": moves, "slots": slots}
        row = pa.table({c: pa.array([v], pa.list_(pa.int64())) for c, v in arrays.items()})
        return cls(spark.createDataFrame(row).select(F.struct(*arrays).alias(RANK_MAP)), (len(moves), len(slots)))


def fold_merges(df: DataFrame, words: str, out: str, ranks: RankMap) -> DataFrame:
    """``df`` with the ids (array<array<int>>, column ``out``) of an array of pieces, each the array of its bytes (0 to 255, at
    least one), in the place of ``words``.

    The constants are bound once around the fold, so the plan holds one copy of each."""
    none, held = F.array().cast("array<array<bigint>>"), F.col(RANK_MAP)
    folded = _let(held["firsts"], lambda first: _let(held["lasts"], lambda last: _let(held["moves"], lambda move: _let(
        held["slots"], lambda slot: F.transform(F.col(words), lambda w: _fold(w, first, last, move, slot, *ranks.sizes)), none), none), none), none)
    return df.withColumn(RANK_MAP, ranks.value.scalar()).select(
        *[c for c in df.columns if c != words], folded.cast("array<array<int>>").alias(out))


def _fold(word: Column, firsts: Column, lasts: Column, moves: Column, slots: Column, n_moves: int, n_slots: int) -> Column:
    """A fold over cells ``rank << ID_BITS | id``: a token's id, under the rank of its pair with the next token (NO_MERGE if none).

    Equal ranks are equal pairs, so the least cell's first place is the leftmost pair of least rank, and the rank is the
    merged token's id."""
    ids, top = F.lit(NO_MERGE - 1), F.lit(NO_MERGE << ID_BITS)
    n, none = F.size(word), F.array().cast("array<bigint>")

    def cell(left: Column, right: Column) -> Column:
        """The cell of ``left`` before ``right``."""
        pair = F.shiftleft(F.shiftleft(left, ID_BITS).bitwiseOR(right), ID_BITS)
        rank = _let(F.xxhash64(left, right), lambda h: F.get(slots, F.shiftrightunsigned(h, 32).bitwiseXOR(
            F.get(moves, h.bitwiseAND(F.lit(n_moves - 1)).cast("int"))).bitwiseAND(F.lit(n_slots - 1)).cast("int")).bitwiseXOR(pair),
            F.lit(0).cast("bigint"))
        return F.shiftleft(F.least(rank, F.lit(NO_MERGE).cast("bigint")), ID_BITS).bitwiseOR(left)

    pairs = F.zip_with(F.slice(word, 1, n - 1), F.slice(word, 2, n - 1), lambda a, b: F.get(
        firsts, F.shiftleft(a.cast("int"), 8).bitwiseOR(b.cast("int"))))
    start = _joined(pairs, F.array(F.get(lasts, F.get(word, n - 1).cast("int"))))

    def merged(acc: Column, p: Column, best: Column) -> Column:
        last = F.size(acc)
        left = F.when(p > 1, F.array(cell(F.get(acc, p - 2).bitwiseAND(ids), best))).otherwise(none)
        here = F.when(p + 1 < last, cell(best, F.get(acc, p + 1).bitwiseAND(ids))).otherwise(top.bitwiseOR(best))
        return _joined(F.slice(acc, 1, F.greatest(p - 2, F.lit(0))), left, F.array(here),
                       F.slice(acc, p + 2, F.greatest(last - p - 1, F.lit(0))))

    def step(acc: Column, _: Column) -> Column:
        return _let(F.array_min(acc), lambda least: F.when(least < top, _let(
            F.array_position(acc, least).cast("int"), lambda p: merged(acc, p, F.shiftright(least, ID_BITS)), acc)).otherwise(acc), acc)

    def plain(cells: Column) -> Column:
        return F.transform(cells, lambda c: c.bitwiseAND(ids))

    return F.when(n > 1, F.aggregate(F.sequence(F.lit(2), n), start, step, plain)).otherwise(plain(start))


class Codes(dict):
    """Codes of pieces.  An unknown one gets the next code after ``size`` and is noted; new pieces are remembered from
    batch to batch until there are over TASK_WORDS."""

    def __init__(self, known: dict[bytes, int], size: int):
        super().__init__(known)
        self.size, self.new, self.held = size, [], []

    def __missing__(self, piece: bytes) -> int:
        self.new.append(piece)
        self[piece] = code = self.size + len(self.held) + len(self.new) - 1
        return code

    def full(self) -> bool:
        """Before a batch: whether the new pieces were too many; they are forgotten then."""
        if len(self.held) <= TASK_WORDS:
            return False
        for p in self.held:
            del self[p]
        self.held = []
        return True

    def taken(self) -> list[bytes]:
        """The new pieces since the last call."""
        new, self.new = self.new, []
        self.held += new
        return new


class PieceCodes:
    """``Codes`` of the pieces of whole batches, found by array operations, without an object per piece.

    A piece of up to SHORT bytes is two words: its bytes, with its length in the top byte.  These words lie in a table that
    is searched from a hash of them on, at most half full; longer pieces, few, lie in a dict."""

    SHORT = 15

    def __init__(self, spelling: bytes, spelt: np.ndarray, codes: np.ndarray, size: int):
        """The pieces in ``spelling``, ``spelt`` bytes each, have the ``codes``, all below ``size``."""
        self.known = np.frombuffer(spelling, np.uint8), np.concatenate([[0], np.cumsum(spelt)]).astype(np.int64), codes.astype(np.int32)
        self.size, self.new = size, []
        self._start()

    def _start(self) -> None:
        buf, bounds, codes = self.known
        self.held, self.long, self.used = 0, {}, 0
        self._room((2 * (len(codes) + TASK_WORDS)).bit_length())
        sizes, raw = np.diff(bounds), buf.tobytes()
        for i in np.flatnonzero(sizes > self.SHORT).tolist():
            self.long[raw[bounds[i]:bounds[i + 1]]] = int(codes[i])
        short = np.flatnonzero((sizes > 0) & (sizes <= self.SHORT))
        low, high = self._words(buf, bounds)
        self._put(low[short], high[short], codes[short])

    def _room(self, bits: int) -> None:
        self.bits = bits
        self.low, self.high, self.code = (np.zeros(1 << bits, kind) for kind in (np.uint64, np.uint64, np.int32))

    @staticmethod
    def _words(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The two words of every piece; those of a long piece are no short one's."""
        at, sizes = bounds[:-1], np.minimum(np.diff(bounds), 255)
        padded = np.concatenate([buf, np.zeros(16, np.uint8)])
        every = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))  # the word that starts at each byte
        masks = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
        return (every[at] & masks[np.minimum(sizes, 8)],
                every[at + 8] & masks[np.clip(sizes - 8, 0, 7)] | sizes.astype(np.uint64) << np.uint64(56))

    def _slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        h = (low ^ high * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def _put(self, low: np.ndarray, high: np.ndarray, codes: np.ndarray) -> None:
        """Add pieces that are not in the table."""
        self.used += len(codes)
        if 2 * self.used > len(self.high):
            there = np.flatnonzero(self.high)
            low, high, codes = (np.concatenate([a[there], b]) for a, b in ((self.low, low), (self.high, high), (self.code, codes)))
            self._room((2 * self.used).bit_length())
        slots = self._slots(low, high)
        todo = np.arange(len(codes))
        while len(todo):
            free = self.high[slots] == 0
            mine, own = slots[free], todo[free]
            self.code[mine] = own  # of several for one slot, one gets it
            won = self.code[mine] == own
            at, own = mine[won], own[won]
            self.low[at], self.high[at] = low[own], high[own]
            lost = ~free
            lost[np.flatnonzero(free)[~won]] = True
            self.code[at] = codes[own]
            todo, slots = todo[lost], slots[lost] + 1 & len(self.high) - 1

    def _find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Codes of the pieces that are in the table, -1 of others."""
        slots = self._slots(low, high)
        there = self.high.take(slots)
        hit = (there == high) & (self.low.take(slots) == low)
        out = np.where(hit, self.code.take(slots), np.int32(-1))
        todo = np.flatnonzero(~hit & (there != 0))
        slots = slots[todo]
        while len(todo):
            slots = slots + 1 & len(self.high) - 1
            there = self.high[slots]
            hit = (there == high[todo]) & (self.low[slots] == low[todo])
            out[todo[hit]] = self.code[slots[hit]]
            go = ~hit & (there != 0)
            todo, slots = todo[go], slots[go]
        return out

    def of(self, buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Codes of the pieces ``buf[bounds[i]:bounds[i + 1]]``; a new one gets the next code and is noted."""
        low, high = self._words(buf, bounds)
        out = self._find(low, high)
        rest = np.flatnonzero(out < 0)
        if not len(rest):
            return out
        raw, fresh, firsts, code = buf.tobytes(), {}, [], self.size + self.held + len(self.new)
        for i, a, z in zip(rest.tolist(), bounds[rest].tolist(), bounds[rest + 1].tolist(), strict=True):
            piece = raw[a:z]
            among = fresh if z - a <= self.SHORT else self.long
            if (known := among.get(piece)) is None:
                known = among[piece] = code
                code += 1
                self.new.append(piece)
                if among is fresh:
                    firsts.append(i)
            out[i] = known
        at = np.array(firsts, np.int64)
        self._put(low[at], high[at], out[at])
        return out

    def full(self) -> bool:
        """Before a batch: whether the new pieces were too many; they are forgotten then."""
        if self.held <= TASK_WORDS:
            return False
        self._start()
        return True

    def taken(self) -> list[bytes]:
        """The new pieces since the last call."""
        new, self.new = self.new, []
        self.held += len(new)
        return new


class Pieces:
    """Ids of the pieces by code: those of the known codes, then the new ones as they come."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray):
        self.known = len(ids), len(sizes)
        self.ids, self.sizes, self.starts = ids, sizes, np.cumsum(sizes) - sizes
        self.n_ids, self.n = self.known  # filled so far

    def add(self, ids: np.ndarray, sizes: np.ndarray, forget: bool) -> None:
        if forget:
            self.n_ids, self.n = self.known
        if not len(sizes):
            return
        if self.n_ids + len(ids) > len(self.ids):
            self.ids = np.append(self.ids[:self.n_ids], np.zeros(len(ids) + self.n_ids // 4, self.ids.dtype))
        if self.n + len(sizes) > len(self.sizes):
            more = np.zeros(len(sizes) + self.n // 4, np.int64)
            self.sizes, self.starts = np.append(self.sizes[:self.n], more), np.append(self.starts[:self.n], more)
        self.ids[self.n_ids:self.n_ids + len(ids)] = ids
        self.sizes[self.n:self.n + len(sizes)] = sizes
        self.starts[self.n:self.n + len(sizes)] = self.n_ids + np.cumsum(sizes) - sizes
        self.n_ids, self.n = self.n_ids + len(ids), self.n + len(sizes)

    def spelt(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all pieces in turn, the number of ids up to each)."""
        n = self.sizes[codes]
        upto = np.cumsum(n)
        return self.ids[np.arange(upto[-1] if len(n) else 0) + np.repeat(self.starts[codes] - upto + n, n)], upto


def cut_spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all texts, where the pieces begin and the last one ends, number of pieces of each text)."""
    buf, offsets = text_buffer(column)
    at = cut(buf, offsets)
    return buf, np.append(at, len(buf)) if len(at) else np.zeros(1, np.int64), np.diff(np.searchsorted(at, offsets))


def cut_batch(column: pa.Array) -> tuple[list[bytes], np.ndarray]:
    """(pieces of all texts, number of pieces of each)."""
    buf, bounds, counts = cut_spans(column)
    raw, ends = buf.tobytes(), bounds.tolist()
    return [raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], counts


def _byte_lists(words: list[bytes]) -> pa.Array:
    sizes = np.cumsum([0, *map(len, words)]).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(words), np.uint8).astype(np.int16))
    return pa.ListArray.from_arrays(pa.array(sizes), values)


def top_pieces(docs: DataFrame, id_col: str, text_col: str, tokens: frozenset[bytes], spelt: bool = True, held: int = 0) -> DataFrame:
    """(word, bytes if ``spelt``, n): the CACHE_WORDS most frequent pieces, but ``tokens``, of about CACHE_DOCS texts picked by a hash.

    held: a task's counts go out after the batch in which it has met more pieces than that."""
    share = CACHE_DOCS / max(docs.count(), 1)
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(
        F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share * (1 << 30))

    key = ["word", "bytes"] if spelt else ["word"]

    def counted(found: Counter) -> Iterator[pa.RecordBatch]:
        every = [w for w in found if w not in tokens]
        for at in range(0, len(every), COUNTED_WORDS):
            words = every[at:at + COUNTED_WORDS]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), *([_byte_lists(words)] if spelt else []),
                                              pa.array([found[w] for w in words], pa.int64())], [*key, "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for b in batches:
            found.update(cut_batch(b.column("text"))[0])
            if len(found) > held:
                yield from counted(found)
                found = Counter()
        yield from counted(found)

    return picked.select("text").mapInArrow(count, f"word binary, {'bytes array<smallint>, ' if spelt else ''}n long").groupBy(*key).agg(
        F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(CACHE_WORDS)


def frequent_pieces(docs: DataFrame, id_col: str, text_col: str, ranks: dict[bytes, int],
                    rank_map: RankMap) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The top pieces that are no tokens: their bytes one after another, the number of bytes of each, then the same of
    their ids.  Flat arrays, so that the driver makes no object per piece."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the literals are bound once a row, so the words are folded in blocks; dealt out, since a limit leaves one partition
    top = top_pieces(docs, id_col, text_col, frozenset(ranks)).withColumn(
        "block", F.pmod(F.xxhash64("word"), F.lit(max(parts, CACHE_WORDS // 500)))).repartition(parts, "block")
    blocks = top.groupBy("block").agg(F.collect_list("word").alias("words"), F.collect_list("bytes").alias("bytes"))
    rows = fold_merges(blocks.select("words", "bytes"), "bytes", "ids", rank_map).toArrow()
    words, ids = (rows[c].combine_chunks() for c in ("words", "ids"))
    words, ids = words.flatten(), ids.flatten()
    sizes = [pc.binary_length(words), pc.list_value_length(ids)]
    spelt, n_ids = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in sizes)
    return text_buffer(words)[0].tobytes(), spelt, ids.flatten().to_numpy().astype(np.uint32), n_ids


def encode(docs: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False) -> DataFrame:
    """(id, ids): ids as little-endian unsigned 32-bit integers in a binary.

    decoded: also the column ``decoded``, the ids decoded again as ``decode`` does, in the same task."""
    spark = docs.sparkSession
    arrow_limits(spark, BLOCK_ROWS, BLOCK_BYTES)
    concatenated, rank_map = _concatenation(ranks) if decoded else None, RankMap.of(spark, ranks)
    spelling, spelt, flat, sizes = frequent_pieces(docs, id_col, text_col, ranks, rank_map)
    # codes: the ids of the vocabulary, then the cached pieces; both are of a bounded size
    n_ids = max(ranks.values(), default=-1) + 1
    size = n_ids + len(spelt)
    known: Broadcast = spark.sparkContext.broadcast((
        b"".join(ranks) + spelling, np.concatenate([np.fromiter(map(len, ranks), np.int64, len(ranks)), spelt]),
        np.concatenate([np.fromiter(ranks.values(), np.int64, len(ranks)), np.arange(n_ids, size)])))
    folded_ids: Broadcast = spark.sparkContext.broadcast((
        np.concatenate([np.arange(n_ids, dtype=np.uint32), flat]), np.concatenate([np.ones(n_ids, np.int64), sizes])))
    del spelling, spelt, flat, sizes

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = PieceCodes(*known.value, size)
        for b in batches:
            forget = codes.full()
            buf, bounds, counts = cut_spans(b.column("text"))
            coded = codes.of(buf, bounds)
            del buf, bounds
            yield pa.RecordBatch.from_arrays([
                pa.array([b.column("id").to_pylist()], pa.list_(b.schema.field("id").type)), pa.array([counts.astype(np.int32).tobytes()]),
                pa.array([coded.tobytes()], pa.binary()), pa.array([forget]),
                pa.ListArray.from_arrays(pa.array([0, len(codes.new)], pa.int32()), _byte_lists(codes.taken()))],
                ["id", "counts", "codes", "forget", "words"])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(*folded_ids.value)
        for b in batches:
            for row in range(b.num_rows):  # the blocks of this task, in order
                own = b.column("ids")[row].values  # the folded pieces that are new in this block
                pieces.add(own.flatten().to_numpy().astype(np.uint32), np.diff(own.offsets.to_numpy()) if len(own) else np.zeros(0, np.int64),
                           b.column("forget")[row].as_py())
                ids, upto = pieces.spelt(np.frombuffer(b.column("codes")[row].as_py(), np.int32))
                counts = np.frombuffer(b.column("counts")[row].as_py(), np.int32)
                ends = np.concatenate([[0], upto])[np.cumsum(counts)] if len(counts) else counts
                cuts = np.concatenate([[0], ends]).astype(np.int32) * 4
                texts = pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())])
                more = []
                if concatenated is not None:
                    spans = zip((cuts[:-1] // 4).tolist(), (cuts[1:] // 4).tolist(), strict=True)
                    more = [pa.array([concatenated(ids[a:z]) for a, z in spans], pa.binary())]
                yield pa.RecordBatch.from_arrays([b.column("id")[row].values, texts, *more], [id_col, "ids", "decoded"][:2 + len(more)])

    kind = docs.select(id_col).dtypes[0][1]
    coded = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        blocks, f"id array<{kind}>, counts binary, codes binary, forget boolean, words array<array<smallint>>")
    folded = fold_merges(coded, "words", "ids", rank_map)
    return folded.mapInArrow(assemble, f"`{id_col}` {kind}, ids binary" + ", decoded binary" * decoded)


def _concatenation(ranks: dict[bytes, int]):
    """A function from an array of ids to their bytes, one token's after another's."""
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for t, n in ranks.items():
        tokens[n] = t
    sizes = np.array([len(t) for t in tokens], np.int64)
    starts, every = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(tokens), np.uint8)

    def concatenated(ids: np.ndarray) -> bytes:
        n = sizes[ids]
        upto = np.cumsum(n)
        return every[np.arange(upto[-1] if len(n) else 0) + np.repeat(starts[ids] - upto + n, n)].tobytes()

    return concatenated


def decode(encoded: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id") -> DataFrame:
    """(id, ids, decoded): the bytes of the ids; a null ``ids`` decodes to nothing."""
    concatenated, kind = _concatenation(ranks), encoded.select(id_col).dtypes[0][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [concatenated(np.frombuffer(i or b"", "<u4")) for i in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(id_col), b.column("ids"), pa.array(texts, pa.binary())], [id_col, "ids", "decoded"])

    return encoded.select(id_col, "ids").mapInArrow(run, f"`{id_col}` {kind}, ids binary, decoded binary")
