"""Exact deduplication through an extendible-hash index.

The key of a text is the 64-bit xxHash of its normalised form (all ASCII white space
deleted).  A directory maps the leading bits of keys to buckets.  It starts with one
bucket and doubles while a bucket holds more than ``bucket_bytes`` of text, splitting only
the overfull ones.  Each bucket is a key range with one owner task.  Owners keep their
range in an extendible hash table of their own (``HashIndex``: pages that split, a local
directory that doubles); entries of one key form a chain, in which normalised texts are
compared byte for byte, so equal keys of different texts do no harm.  Entries and index
are tables in the shared folder, and the result is read from them.

Before anything is shuffled, each Arrow batch is reduced to one entry per distinct text,
so a text with any number of copies reaches its owner at most once per batch, and its
members stay behind with the entry (at most a batch's rows); entry numbers join them to
their group, a key without skew.

Defined results: null counts as empty, and all empty texts form one group.  The row with
the most code points (of the original text) stays, then the smallest id, null ids last;
of identical rows exactly one is flagged ``kept``.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, arrow_limits, stored, text_list

BUCKET_BYTES = 16 << 20
PAGE = 64
#: Leading bits by which key ranges are counted; the second count covers only what the first finds overfull.
#: 2^20 counters bound what the driver sees.
COUNT_BITS = (10, 20)
_SPACE_BYTES = SPACE.encode()


class Directory:
    """Extendible-hash directory over key prefixes: ``slots[key >> (64 - depth)]`` is a bucket number.

    The slots of a bucket are one range, so a split halves a range; ``starts`` has the first slot of each bucket and
    ``local`` the number of its leading bits, in the order of the keys."""

    def __init__(self):
        self.depth, self.starts, self.local = 0, [0], [0]

    @property
    def slots(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.local), dtype=np.int32), 1 << (self.depth - np.array(self.local, np.int64)))

    def of(self, key: int) -> int:
        return bisect_right(self.starts, key >> (64 - self.depth)) - 1 if self.depth else 0


def build_directory(loads: dict[int, int], bits: int, capacity: int) -> Directory:
    """Split until no bucket holds more than ``capacity``, or it is a single counter; the directory is as deep as its
    deepest bucket.  loads: by the leading ``bits`` of keys.  Each bucket's load is a difference of two prefix sums."""
    total = np.zeros((1 << bits) + 1, np.int64)
    for prefix, load in loads.items():
        total[prefix + 1] = load
    total = np.cumsum(total)
    found, todo = [], [(0, 0)]  # (prefix, its number of bits), the least prefix on top
    while todo:
        prefix, depth = todo.pop()
        width = bits - depth
        if width and total[(prefix + 1) << width] - total[prefix << width] > capacity:
            todo += [(prefix << 1 | 1, depth + 1), (prefix << 1, depth + 1)]
        else:
            found.append((prefix, depth))
    d = Directory()
    d.depth = max(depth for _, depth in found)
    d.local = [depth for _, depth in found]
    d.starts = [prefix << (d.depth - depth) for prefix, depth in found]
    return d


class HashIndex:
    """An owner's table: a local directory over the low bits of keys to pages of chains."""

    def __init__(self, page: int = PAGE):
        self.page, self.depth, self.slots = page, 0, [(0, {})]

    def chain(self, key: int) -> list:
        """The chain of a key, made if absent."""
        while True:
            local, entries = self.slots[key & ((1 << self.depth) - 1)]
            if key in entries:
                return entries[key]
            if len(entries) < self.page:
                return entries.setdefault(key, [])
            if local == self.depth:
                self.slots += self.slots
                self.depth += 1
            low = (local + 1, {k: c for k, c in entries.items() if not k >> local & 1})
            high = (local + 1, {k: c for k, c in entries.items() if k >> local & 1})
            for i in range(key & ((1 << local) - 1), len(self.slots), 1 << local):
                self.slots[i] = high if i >> local & 1 else low

    def chains(self) -> Iterator[tuple[int, list]]:
        seen: set[int] = set()
        for _, entries in self.slots:
            if id(entries) not in seen:
                seen.add(id(entries))
                yield from entries.items()


def directory_for(entries: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> Directory:
    """The directory whose buckets hold ``bucket_bytes`` at most (less if that keeps the cluster busy), from the
    bytes of all entries by key prefix."""
    few, many = COUNT_BITS
    load = F.sum(F.col("norm_bytes") + 64)

    def counts(df: DataFrame, bits: int) -> dict[int, int]:
        return {r[0]: r[1] for r in df.groupBy(F.shiftrightunsigned("key", 64 - bits).alias("p")).agg(load).collect()}

    loads = counts(entries, few)
    partitions = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket_bytes = min(bucket_bytes, max(1, sum(loads.values()) // (2 * partitions)))
    over = [p for p, n in loads.items() if n > 4 * bucket_bytes]
    if not over:
        return build_directory(loads, few, bucket_bytes)
    fine = {p << (many - few): n for p, n in loads.items() if p not in set(over)}
    fine |= counts(entries.where(F.shiftrightunsigned("key", 64 - few).isin(over)), many)
    return build_directory(fine, many, bucket_bytes)


ENTRY = "entry long, key long, norm binary, norm_bytes long, best_cps long, best_id long, best_at int, members array<{}>"
INDEX = "entry long, bucket int, chain int, text_sha256 string, keep_id long, keep_here boolean, group_size long"


def _signed(key: int) -> int:
    return key - (key >> 63 << 64)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per distinct normalised text of a batch, with its members and the best of them."""
    serial = TaskContext.get().partitionId() << 33
    for b in batches:
        cps = pc.fill_null(pc.utf8_length(b.column("text")), 0).to_pylist()
        found: dict[bytes, list] = {}
        rows = zip(b.column("doc_id").to_pylist(), cps, text_list(b.column("text")), b.column("member").to_pylist(), strict=True)
        for doc_id, n, text, member in rows:
            found.setdefault(text.translate(None, _SPACE_BYTES), []).append((-n, doc_id is None, doc_id, member))
        best = [min(range(len(m)), key=lambda i, m=m: m[i][:3]) if len(m) > 1 else 0 for m in found.values()]
        won = [m[i] for m, i in zip(found.values(), best, strict=True)]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.arange(serial, serial + len(found))),
            pa.array([_signed(xxhash.xxh64_intdigest(t, seed=42)) for t in found], pa.int64()),
            pa.array(list(found), pa.binary()), pa.array([len(t) for t in found], pa.int64()),
            pa.array([-w[0] for w in won], pa.int64()), pa.array([w[2] for w in won], pa.int64()),
            pa.array(best, pa.int32()), pa.array([[m[3] for m in v] for v in found.values()], pa.list_(b.schema.field("member").type)),
        ], [f.split()[0] for f in ENTRY.split(", ")])
        serial += len(found)


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Owner of some buckets: put every entry into its chain, then tell each entry its text's group."""
    index = HashIndex()
    names = ("bucket", "key", "norm", "entry", "best_cps", "best_id", "n")
    for b in batches:
        for bucket, key, norm, *row in zip(*(b.column(c).to_pylist() for c in names), strict=True):
            chain = index.chain(key & (1 << 64) - 1)
            mine = next((c for c in chain if c[1] == norm), None)
            if mine is None:
                chain.append(mine := (bucket, norm, []))
            mine[2].append(row)
    out: list[tuple] = []
    for _, chain in index.chains():
        for number, (bucket, norm, rows) in enumerate(chain):
            best = min(rows, key=lambda r: (-r[1], r[2] is None, r[2], r[0]))
            sha, size = hashlib.sha256(norm).hexdigest(), sum(r[3] for r in rows)
            out += [(r[0], bucket, number, sha, best[2], r[0] == best[0], size) for r in rows]
            if len(out) >= 10_000:
                yield _index_batch(out)
                out = []
    if out:
        yield _index_batch(out)


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.bool_(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      [f.split()[0] for f in INDEX.split(", ")])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES,
                member_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(entries, index), both stored.  ``chain`` numbers the different texts of one key; ``member_col`` (default: the id)
    is what entries list."""
    spark = docs.sparkSession
    arrow_limits(spark)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       (F.col(member_col) if member_col else F.col(id_col).cast("long")).alias("member"))
    entries = stored(slim.mapInArrow(_entries, ENTRY.format(slim.schema["member"].dataType.simpleString())), "dedup-entries")
    directory = directory_for(entries, bucket_bytes)
    slots, shift = directory.slots, np.uint64(64 - directory.depth)

    @F.pandas_udf("int")
    def bucket_of(key: pd.Series) -> pd.Series:
        k = key.to_numpy().astype(np.int64).view(np.uint64)
        return pd.Series(slots[(k >> shift).astype(np.int64)] if len(slots) > 1 else np.zeros(len(k), np.int32))

    sent = entries.select("entry", "key", "norm", "best_cps", "best_id", F.size("members").cast("long").alias("n"),
                          bucket_of("key").alias("bucket"))
    owners = max(len(directory.local), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return entries, stored(sent.repartition(owners, "bucket").mapInArrow(_own, INDEX), "dedup-index")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES,
                 member_col: str | None = None) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256), one row per document; with ``member_col`` it stands in the id's place."""
    entries, index = build_index(docs, id_col, text_col, bucket_bytes, member_col)
    members = entries.select("entry", "best_at", "members").join(index, "entry").select("*", F.posexplode("members").alias("at", "member"))
    return members.select(F.col("member").alias(member_col or id_col), "keep_id", "group_size",
                          (F.col("keep_here") & (F.col("at") == F.col("best_at"))).alias("kept"), "text_sha256")
