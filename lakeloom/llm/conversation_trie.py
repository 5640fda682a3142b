"""Prefix trie of conversations by collapsing whole sequences.

A turn is known by the SHA-256 of its role and text.  A prefix is known by its depth and the
xor of 128-bit hashes of (depth, turn) over its turns, so the prefixes of a conversation are
running totals and no conversation has to lie in one task.  The key is checked: all rows of
a node must have the same last turn and the same parent, which by induction makes their
prefixes equal; otherwise the job fails.

1. Whole sequences: conversations with equal keys of all their turns collapse into one
   sequence with its weight, least member and the list of those that end there.
2. Leaves: the sequences whose key is no parent of any turn (anti-join with the proper prefixes).
3. Nodes: the prefixes of the different sequences, aggregated with their weights.
4. Subtree sums: every node belongs to the least leaf below it, so a node is counted on one
   leaf's path only; running totals up each path, added up by node, are the sums.

End lists are hashed as streams: tasks of ascending id ranges write them in pieces, and each
node's pieces pass through one running SHA-256, one at a time.  Look-ups by keys that many
rows share (a parent of very many nodes) are salted.

Defined results: rows with a null conversation id belong to no conversation.  Turns come in
the order of ``turn``, null first; equal ones in the order of their SHA-256 (role's SHA-256 in
hex, then text); repeated rows are turns of their own.  Null role or text counts as empty.
Other columns are not read.  No conversation: no node, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.rowindex import with_row_index

from .common import running, salted_lookup, stored

KEY = ["depth", "k0", "k1"]
PARENT = ["parent_depth", "p0", "p1"]
#: Rows of an Arrow batch of end lists.
END_ROWS = 10_000


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, size): the turns of every conversation in order, ``pos`` from 1; stored."""
    role, text = (F.coalesce(F.col(c), F.lit("")).cast("binary") for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.sha2(role, 256).cast("binary"), text), 256))
    slim = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("size"))
    return stored(with_row_index(slim, ["turn", "digest"], name="pos", group_by=["conv_id"]).drop("turn"), "turns")


def rebuilt(own: DataFrame, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """((conv_id, depth, digest, size), (conv_id)): conversation c gets the first h turns of conversation c - c % ``family``
    for its own first h, h = crc32(c as text) mod ``most``.  The second result holds every conversation, turnless ones too."""
    def head(conv: Column) -> Column:
        return F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(most))

    convs = own.groupBy("conv_id").agg(F.max("pos").alias("n"))
    base = convs.select(F.col("conv_id").alias("base_id"), F.col("n").alias("n_base"))
    taken = (convs.withColumn("base_id", F.col("conv_id") - F.col("conv_id") % family).join(base, "base_id", "left")
             .select("conv_id", "base_id", F.least(head(F.col("conv_id")), F.coalesce("n_base", F.lit(0))).alias("n_head")))
    # a base has fewer than ``most`` head turns, and fewer than 2 * ``family`` conversations share it
    heads = own.where(F.col("pos") < most).withColumnRenamed("conv_id", "base_id").join(taken, "base_id").where(F.col("pos") <= F.col("n_head"))
    rest = salted_lookup(own.where(F.col("pos") > head(F.col("conv_id"))), taken.select("conv_id", "n_head"), ["conv_id"], ["pos"], "inner")
    depth = F.col("n_head") + F.col("pos") - head(F.col("conv_id"))
    rows = heads.select("conv_id", F.col("pos").alias("depth"), "digest", "size").union(
        rest.select("conv_id", depth.alias("depth"), "digest", "size"))
    return rows, convs.select("conv_id")


def prefixes(rows: DataFrame) -> DataFrame:
    """``rows`` with the keys of the prefix that ends at each turn (KEY) and of the prefix before it (PARENT); stored."""
    h = F.sha2(F.concat(F.col("digest"), F.col("depth").cast("string").cast("binary")), 256)
    lanes = [F.conv(F.substring(h, 1 + 16 * i, 16), 16, -10).cast("long") for i in (0, 1)]
    out = running(rows.withColumns({"l0": lanes[0], "l1": lanes[1]}), "conv_id", "depth", {
        "k0": ("xor", F.col("l0")), "k1": ("xor", F.col("l1"))})
    return stored(out.select("conv_id", *KEY, "digest", "size", (F.col("depth") - 1).alias("parent_depth"),
                             F.col("k0").bitwiseXOR(F.col("l0")).alias("p0"), F.col("k1").bitwiseXOR(F.col("l1")).alias("p1")), "prefixes")


def ends_hashed(whole: DataFrame) -> DataFrame:
    """(KEY, ends_sha256) of (conv_id, KEY): SHA-256 of each sequence's ids, ascending, comma-joined."""
    spark = whole.sparkSession
    kind = "depth long, k0 long, k1 long, "

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, END_ROWS):
                b, found = batch.slice(at, END_ROWS), {}
                for conv, *key in zip(*(b.column(c).to_pylist() for c in ("conv_id", *KEY)), strict=True):
                    found.setdefault(tuple(key), []).append(conv)
                if found:
                    keys = [pa.array(k, pa.int64()) for k in zip(*found, strict=True)]
                    yield pa.RecordBatch.from_arrays([*keys, pa.array([v[0] for v in found.values()], pa.int64()),
                                                      pa.array([",".join(map(str, v)) for v in found.values()])], [*KEY, "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for b in batches:
            done = []
            for *key, ids in zip(*(b.column(c).to_pylist() for c in (*KEY, "ids")), strict=True):
                if key != at:
                    if at is not None:
                        done.append((*at, state.hexdigest()))
                    at, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield _rows(done)
        if at is not None:
            yield _rows([(*at, state.hexdigest())])

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)], [*KEY, "ends_sha256"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = whole.select("conv_id", *KEY).repartitionByRange(parts, "conv_id").sortWithinPartitions("conv_id").mapInArrow(
        pieces, kind + "first long, ids string")
    return cut.repartition(parts, *KEY).sortWithinPartitions(*KEY, "first").drop("first").mapInArrow(hashed, kind + "ends_sha256 string")


def trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the trie of the sequences ``rows`` (conv_id, depth, digest, size) of all ``convs`` (conv_id)."""
    path = prefixes(rows)
    one = [F.min(c).eqNullSafe(F.max(c)) for c in ("digest", *PARENT)]
    if not path.groupBy(*KEY).agg(reduce(and_, one).alias("one")).where("NOT one").isEmpty():
        raise ValueError("two prefixes have one key")
    last = path.groupBy("conv_id").agg(F.max(F.struct(*KEY)).alias("last"))
    zero = F.lit(0).cast("long")
    whole = stored(convs.join(last, "conv_id", "left").select(
        "conv_id", *[F.coalesce(f"last.{c}", zero).alias(c) for c in KEY]), "whole")

    # whole sequences with weights; those that are proper prefixes of others are no leaves
    sequences = whole.groupBy(*KEY).agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"))
    proper = path.select(*[F.col(p).alias(k) for p, k in zip(PARENT, KEY, strict=True)]).distinct()
    leaves = sequences.join(proper, KEY, "left_anti").withColumn("leaf", F.lit(True))
    others = sequences.join(proper, KEY, "left_semi").withColumn("leaf", F.lit(False))
    sequences = stored(leaves.union(others).select(*KEY, "conv_id", "n", "leaf"), "sequences").drop(*KEY)

    none = F.lit(None)
    roots = sequences.select("conv_id", *[zero.alias(c) for c in KEY], none.cast("binary").alias("digest"), zero.alias("size"),
                             *[none.cast("long").alias(c) for c in PARENT], "n", "leaf")
    steps = stored(salted_lookup(path, sequences, ["conv_id"], ["depth"], "inner").select(*roots.columns).unionByName(roots), "steps")
    nodes = stored(steps.groupBy(*KEY).agg(
        F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min(F.when(F.col("leaf"), F.col("conv_id"))).alias("owner"),
        F.count_if("leaf").alias("n_leaves"), F.max("size").alias("size"), *[F.max(c).alias(c) for c in PARENT]), "nodes")

    # a node counts on the path of its owner; running totals from the leaf up, added up by node
    worth = nodes.select(F.col("owner").alias("conv_id"), "depth", ((F.col("n_convs") - 1) * F.col("size")).alias("worth"))
    up = steps.where("leaf").select("conv_id", *KEY).join(worth, ["conv_id", "depth"], "left")
    up = running(up.withColumn("height", -F.col("depth")), "conv_id", "height", {"below": ("sum", F.coalesce("worth", zero))})
    saved = up.groupBy(*KEY).agg(F.sum("below").alias("saved_tokens"))

    children = nodes.where("depth > 0").groupBy(*PARENT).agg(F.count("*").alias("n_children")).withColumnsRenamed(dict(zip(PARENT, KEY, strict=True)))
    parents = nodes.select(*[F.col(k).alias(p) for k, p in zip(KEY, PARENT, strict=True)], F.col("conv_id").alias("parent_conv_id"))
    named = salted_lookup(nodes, parents, PARENT, ["k0"])
    out = named.join(children, KEY, "left").join(saved, KEY, "left").join(ends_hashed(whole), KEY, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves",
                      "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all rebuilt conversations."""
    return trie(*rebuilt(turns(conversations)))
