"""SimHash near-duplicates by the general pigeonhole principle.

Fingerprint: the words of a text (A-Z lower-cased, runs of anything but ASCII white
space) form shingles of ``shingle`` words joined by a blank; bit i of the fingerprint is 1
when it is set in over half of the shingles' XXH64 hashes (seed 42), repeats included.
Fingerprints link at ``max_bits`` or fewer differing bits; a component is what links reach.

Search over the *distinct* fingerprints, so copies never meet each other:

1. Correlated bits go into the same part (greedy on the bits' correlations over all
   fingerprints), so that the other parts stay selective.
2. Every fingerprint gets a threshold t_i >= -1 for each of the m parts with
   sum t_i = max_bits - m + 1.  If two fingerprints differ in at most max_bits bits, some
   part differs in at most t_i: otherwise the parts alone differ in more.  A dynamic
   programme picks the thresholds with the least probes and estimated candidates; the
   estimate uses the number of fingerprints that share the part's value, so a crowded
   part gets -1 (not probed) and the others more.
3. Every fingerprint probes the values within t_i of its own in part i and candidates are
   verified by their distance inside the join: only true links leave it.

Components come from alternating large and small stars, each round a written table.

Defined results: null and word-less texts have fingerprint zero, which links like any
other; fewer words than a shingle are one shingle.  Rows with a null id have a fingerprint
and a component but never name one; a component of null ids only has a null id.  Repeated
rows repeat in the result.  Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_BYTES, arrow_limits, stored, text_list

BITS = 64
SHINGLE, MAX_BITS = 3, 2
_CHUNK = 1 << 16
_hash = partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.translate(LOWER_BYTES).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return _hash(joined)  # one shingle: each bit is set in all or none
    ends = list(accumulate(map(len, words), lambda at, n: at + n + 1))
    starts = [0, *(e + 1 for e in ends)]
    n, ones = len(words) - shingle + 1, np.zeros(BITS, np.int64)
    for at in range(0, n, _CHUNK):
        spans = zip(starts[at:min(at + _CHUNK, n)], ends[at + shingle - 1:], strict=False)
        hashes = np.fromiter([_hash(joined[a:b]) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 row_col: str | None = None) -> DataFrame:
    """(doc_id, row, fp): fp is the fingerprint as a signed long; row is ``row_col``, null if there is none."""
    arrow_limits(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t, shingle) for t in text_list(b.column("text"))), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row"), pa.array(fps.view(np.int64))], ["doc_id", "row", "fp"])

    row = F.col(row_col) if row_col else F.lit(None).cast("long")
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), row.alias("row"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, f"doc_id long, row {slim.schema['row'].dataType.simpleString()}, fp long")


def _bits_of(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_pairs(fps: DataFrame) -> tuple[np.ndarray, int]:
    """How often bits i and j are both set, over all fingerprints, and their number: 64 x 64 sums from the tasks' sums."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS)), 0
        for b in batches:
            bits = _bits_of(b.column("fp").to_numpy()).astype(np.float32)
            both += bits.T @ bits
            n += len(bits)
        i, j = np.triu_indices(BITS)
        yield pa.RecordBatch.from_arrays([pa.array([*(i * BITS + j), -1]), pa.array([*both[i, j].astype(np.int64), n])], ["pair", "n"])

    both, total = np.zeros((BITS, BITS)), 0
    for pair, n in fps.select("fp").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n")).collect():
        if pair < 0:
            total = n
        else:
            both[pair // BITS, pair % BITS] = both[pair % BITS, pair // BITS] = n
    return both, total


def group_bits(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Parts of nearly equal size, each grown by the free bit that correlates most with those it has."""
    mean = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    corr = np.abs(both / max(n, 1) - np.outer(mean, mean)) / np.outer(spread, spread)
    np.fill_diagonal(corr, 0)
    free, out = list(range(BITS)), []
    for p in range(parts):
        mine = [free.pop(int(np.argmax(corr[np.ix_(free, free)].sum(axis=1))))]
        while len(mine) < (BITS * (p + 1)) // parts - (BITS * p) // parts:
            mine.append(free.pop(int(np.argmax(corr[np.ix_(free, mine)].sum(axis=1)))))
        out.append(sorted(mine))
    return out


def masks_within(bits: list[int], distance: int) -> np.ndarray:
    """Every change of up to ``distance`` of these bits, as signed longs; first the empty change."""
    flips = [reduce(lambda m, b: m | 1 << b, c, 0) for d in range(distance + 1) for c in combinations(bits, d)]
    return np.array(flips, np.uint64).view(np.int64)


def allocate(same: np.ndarray, n: int, widths: list[int], max_bits: int) -> np.ndarray:
    """Thresholds per row and part by dynamic programming.

    same: rows x parts, the number of fingerprints with the row's value in the part.  The cost of threshold t
    is its probes plus the candidates they should find: those of the own value, and n / 2^width for any other."""
    rows, parts = same.shape
    goal = max_bits - parts + 1
    best = {0: (np.zeros(rows), np.zeros((rows, 0), np.int8))}
    for p, width in enumerate(widths):
        nxt: dict[int, tuple] = {}
        for t in range(-1, max_bits + 1):
            probes = len(masks_within(list(range(width)), t)) if t >= 0 else 0
            cost = probes + (same[:, p] + (probes - 1) * n / 2.0 ** width if t >= 0 else 0)
            for used, (before, chosen) in best.items():
                total, pick = before + cost, np.hstack([chosen, np.full((rows, 1), t, np.int8)])
                if (old := nxt.get(used + t)) is not None:
                    less = total < old[0]
                    total, pick = np.where(less, total, old[0]), np.where(less[:, None], pick, old[1])
                nxt[used + t] = total, pick
        best = nxt
    return best[goal][1]


def part_count(n: int, max_bits: int) -> int:
    """The number of parts whose cheapest thresholds cost least if bits were even."""
    def cost(parts: int) -> float:
        widths = [(BITS * (p + 1)) // parts - (BITS * p) // parts for p in range(parts)]
        chosen = allocate(np.array([[n / 2.0 ** w for w in widths]]), n, widths, max_bits)[0]
        probes = [len(masks_within(list(range(w)), int(t))) if t >= 0 else 0 for w, t in zip(widths, chosen, strict=True)]
        return sum(p * (1 + n / 2.0 ** w) for p, w in zip(probes, widths, strict=True))
    return min(range(1, max_bits + 2), key=cost)


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b), a < b: all pairs of different fingerprints at ``max_bits`` or fewer differing bits. fps: distinct."""
    both, n = bit_pairs(fps)
    groups = group_bits(both, n, part_count(n, max_bits))
    widths = [len(g) for g in groups]
    masks = [int(np.array([reduce(lambda m, b: m | 1 << b, g, 0)], np.uint64).view(np.int64)[0]) for g in groups]
    flips = [[masks_within(g, t) for t in range(max_bits + 1)] for g in groups]
    index = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("value"))
                                                 for i, m in enumerate(masks)])).alias("s")).select("fp", "s.part", "s.value")
    shared = index.groupBy("part", "value").agg(F.count("*").alias("same"))
    crowds = index.join(shared, ["part", "value"]).groupBy("fp").agg(
        *[F.max(F.when(F.col("part") == i, F.col("same"))).alias(f"same{i}") for i in range(len(groups))])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy()
            same = np.stack([b.column(f"same{i}").to_numpy() for i in range(len(groups))], axis=1).astype(np.float64)
            chosen = allocate(same, n, widths, max_bits)
            for i, mask in enumerate(masks):
                for t in range(max_bits + 1):
                    mine = fp[chosen[:, i] == t]
                    values = ((mine & mask)[:, None] ^ flips[i][t][None, :]).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(values), i, np.int32)), pa.array(values), pa.array(np.repeat(mine, len(flips[i][t])))],
                        ["part", "value", "a"])

    probes = crowds.mapInArrow(probe, "part int, value long, a long")
    target = index.select("part", "value", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    met = probes.join(target, (probes["part"] == target["part"]) & (probes["value"] == target["value"]) & (F.col("a") < F.col("b")) & near)
    return met.select("a", "b").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(node, root): the smallest node that links reach, for every node of ``pairs`` (a, b)."""
    edges = stored(pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or tuple(mark) == state:
            break
        state = tuple(mark)
        ways = edges.union(edges.select("b", "a"))  # large star: what is above a node joins the least around it
        least = ways.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
        edges = ways.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        least = edges.groupBy("a").agg(F.min("b").alias("least"))  # small star: what is below joins the least below
        down = edges.join(least, "a")
        edges = stored(down.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
                       .union(least.select("a", "least")).distinct(), "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select("b", "b")).groupBy("node").agg(F.min("root").alias("root"))


def rooted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
           max_bits: int = MAX_BITS, row_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(doc_id, row, fp) of every document, and (fp, root, least_id) of every different fingerprint."""
    marked = stored(fingerprints(docs, id_col, text_col, shingle, row_col), "fingerprints")
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct")
    roots = components(links(distinct.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    return marked, distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(id, fingerprint, component_id), one row per document."""
    marked, by_fp = rooted(docs, id_col, text_col, shingle, max_bits)
    named = by_fp.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_fp = by_fp.join(named, "root").select("fp", "component_id")
    return marked.join(by_fp, "fp").select(F.col("doc_id").alias(id_col),
                                           F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, row_col: str, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(row): ``row_col`` of one document of each component, the one of the smallest id (null last), then row."""
    marked, by_fp = rooted(docs, id_col, text_col, shingle, max_bits, row_col)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "row"))
    per_fp = marked.groupBy("fp").agg(first.alias("first"))  # copies are reduced before any join
    return per_fp.join(by_fp, "fp").groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row_col))
