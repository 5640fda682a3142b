"""Tables in buckets of their key's hash, of which an upsert writes only those it touches.

A version is a manifest (the JSON content of its marker): for every bucket the parts that hold
its rows, each in the folder of the version that wrote it, ``v=<n>/rows/keybucket=<b>/``.  An
upsert writes a new version with new parts and names the others by reference.

Every version also has a Bloom filter of the keys of each part it wrote: blocks of 2^15 bits,
``v=<n>/filter/`` (one row per block).  An upsert first probes the filters of the source's
buckets.  A bucket without a hit gets its new rows as one more part and none of its data is read.  In a
bucket with hits these are verified against its keys, and one full outer join of its rows with the
source gives the updated, inserted and kept rows of its new, only part.  So is a bucket with ``MAX_PARTS`` parts.

Rows with a NULL in the key never match; they are bucket ``NULLS``, which only grows.
Surrogate keys continue after the greatest one, which the manifest holds, in the order of the
business key, rows with a NULL in it last; only keys are sorted for that.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.rowindex import with_row_index
from ..operators.upsert import orderable, unique_upsert
from . import snapshot as snap

BUCKET, NULLS, ACTION = "keybucket", -1, "_action"
BUCKETS, MAX_PARTS = 16, 8
#: Bits of a filter per key, bits that a key sets, bits of a block.
KEY_BITS, HASHES, BLOCK_BITS = 24, 8, 1 << 15


def _all_set(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])


def bucket_of(keys: list[str], buckets: int) -> Column:
    cols = [F.col(k) for k in keys]
    return F.when(_all_set(cols), F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int")).otherwise(F.lit(NULLS))


def _block(keys: list[str], blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), *keys), blocks).cast("int")


def _positions(keys: list[str]) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), *keys), F.lit(BLOCK_BITS)).cast("int") for i in range(HASHES)]


def _bit(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substr(bits, F.shiftright(position, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, position.bitwiseAND(F.lit(7))) == 1


def _empty(schema: T.StructType, keys: list[str], buckets: int) -> dict:
    return {"schema": schema.json(), "keys": keys, "buckets": buckets, "parts": {}, "max_key": 0, "by": None, "counts": None}


def schema_of(held: dict) -> T.StructType:
    import json
    return T.StructType.fromJson(json.loads(held["schema"]))


def create(spark: SparkSession, root: str, table: str, schema: T.StructType, keys: list[str], buckets: int = BUCKETS) -> int:
    """CREATE TABLE IF NOT EXISTS: an empty first version with the derived schema (K7)."""
    cur = snap.current_version(spark, root, table)
    if cur is None:
        cur = snap.next_version(spark, root, table)
        snap.mark(spark, root, table, cur, _empty(schema, keys, buckets))
    return cur


def _paths(root: str, table: str, held: dict, buckets=None) -> list[str]:
    return [f"{root.rstrip('/')}/{table}/v={v}/rows/{BUCKET}={b}" for b, parts in sorted(held["parts"].items()) for v, _ in parts
            if buckets is None or int(b) in buckets]


def read(spark: SparkSession, root: str, table: str, held: dict, buckets=None) -> DataFrame:
    """The rows of a version, or of some of its buckets; only their folders are listed and read."""
    schema, paths = schema_of(held), _paths(root, table, held, buckets)
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def filters(spark: SparkSession, root: str, table: str, held: dict) -> DataFrame | None:
    """(part_version, keybucket, block, bits) of the versions that hold parts."""
    versions = sorted({v for b, parts in held["parts"].items() if int(b) != NULLS for v, _ in parts})
    out = [spark.read.schema(f"{BUCKET} int, block int, bits binary").parquet(f"{root.rstrip('/')}/{table}/v={v}/filter")
           .select(F.lit(v).alias("part_version"), BUCKET, "block", "bits") for v in versions]
    return reduce(DataFrame.union, out) if out else None


@dataclass
class Profile:
    """What one pass over a source found: sizes, violations, and which keys the filters of the table may have."""

    rows: int
    nulls: dict[str, int]           # of required columns
    over: dict[str, int]            # rows with too long a text, by column
    dup_keys: int
    surplus_rows: int
    buckets: dict[int, int]         # filter hits, by bucket of the source
    hits: DataFrame | None          # keys that the filters may have


def profile(spark: SparkSession, root: str, table: str, held: dict, source: DataFrame, keys: list[str], required=(), limits=None) -> Profile:
    """Count, check and probe a source in one pass: one row per key, then one per bucket."""
    limits, n = dict(limits or {}), held["buckets"]
    named = {f"_null_{c}": F.count_if(F.col(c).isNull()) for c in required} | {
        f"_over_{c}": F.count_if(F.length(c) > most) for c, most in limits.items()}
    by_key = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[a.alias(c) for c, a in named.items()]).withColumn(
        BUCKET, bucket_of(keys, n))
    found, hits = filters(spark, root, table, held), None
    marked = by_key.withColumn("_hit", F.lit(False))
    if found is not None:
        parts = spark.createDataFrame([(int(b), v, blocks) for b, ps in held["parts"].items() if int(b) != NULLS for v, blocks in ps],
                                      f"{BUCKET} int, part_version int, blocks int")
        asked = source.where(_all_set([F.col(k) for k in keys])).select(*keys, bucket_of(keys, n).alias(BUCKET)).join(parts, BUCKET)
        met = asked.withColumn("block", _block(keys, F.col("blocks"))).join(found, [BUCKET, "part_version", "block"])
        hits = met.where(reduce(lambda a, b: a & b, [_bit(F.col("bits"), p) for p in _positions(keys)])).select(*keys).distinct()
        marked = by_key.join(hits.withColumn("_hit", F.lit(True)), keys, "left")
    own = F.col(BUCKET) != NULLS
    rows = marked.groupBy(BUCKET).agg(
        F.sum("_n").alias("n"), F.count_if(own & (F.col("_n") > 1)).alias("dups"), F.sum(F.when(own, F.col("_n") - 1).otherwise(0)).alias("surplus"),
        F.count_if("_hit").alias("hits"), *[F.sum(c).alias(c) for c in named]).collect()  # one row per bucket
    total = {c: sum(r[c] for r in rows) for c in ("n", "dups", "surplus", *named)}
    return Profile(total["n"], {c: total[f"_null_{c}"] for c in required}, {c: total[f"_over_{c}"] for c in limits}, total["dups"],
                   total["surplus"], {r[BUCKET]: r["hits"] for r in rows}, hits if any(r["hits"] for r in rows) else None)


@dataclass
class Written:
    version: int
    inserted: int
    updated: int
    rewritten: list[int]
    appended: list[int]


def upsert(spark: SparkSession, root: str, table: str, source: DataFrame, keys: list, *, surrogate: str | None = None, meta: dict | None = None,
           as_of=None, only_changed: bool = False, by: dict | None = None, found: Profile | None = None, unique: bool = False) -> Written:
    """Upsert ``source`` into the current version and publish the next one; repeated business keys are refused.

    ``keys``: column names, or (source, target) pairs.  ``by``: who writes, kept in the manifest.  ``found``: the
    source's ``profile`` if it was made already.  ``unique``: repeated keys that it found are gone from ``source``."""
    version = snap.current_version(spark, root, table)
    held = snap.manifest(spark, root, table, version)
    pairs = [(k, k) if isinstance(k, str) else tuple(k) for k in keys]
    skeys, tkeys = [s for s, _ in pairs], [t for _, t in pairs]
    if tkeys != held["keys"]:
        raise ValueError(f"{table} is kept by {held['keys']}, not by {tkeys}")
    found = found or profile(spark, root, table, held, source, skeys)
    if found.dup_keys and not unique:
        raise ValueError(f"{found.dup_keys} business keys occur more than once ({found.surplus_rows} surplus rows)")
    n = held["buckets"]
    many = {int(b) for b, parts in held["parts"].items() if len(parts) >= MAX_PARTS}
    rewritten = sorted(b for b, hits in found.buckets.items() if hits or b in many)
    src = source.withColumn(BUCKET, bucket_of(skeys, n))
    own, loose = src.where(F.col(BUCKET) != NULLS).drop(BUCKET), src.where(F.col(BUCKET) == NULLS).drop(BUCKET)
    target = read(spark, root, table, held, {b for b in rewritten if b != NULLS})
    nothing = spark.createDataFrame([], target.schema)
    common = dict(surrogate=surrogate, max_key=held["max_key"], meta=meta, as_of=as_of, only_changed=only_changed)
    if surrogate:
        # new keys, in order: those the filters don't know, and hits that the buckets' keys don't confirm
        new = own.select(*skeys)
        if found.hits is not None:
            old = target.select(*[F.col(t).alias(s) for s, t in pairs])
            new = new.join(found.hits.join(old, skeys, "left_semi"), skeys, "left_anti")
        new = with_row_index(new, skeys, name="_rn")
        own = own.join(new, skeys, "left")
    else:
        own = own.withColumn("_rn", F.lit(0))
    # buckets that are not read have new rows only, so one full outer join serves all buckets
    out = unique_upsert(target, own, pairs, **common)
    if NULLS in found.buckets:
        if surrogate:
            kinds = {f.name: f.dataType for f in loose.schema.fields}
            order = [F.col(c) if orderable(kinds[c]) else F.xxhash64(F.to_json(F.struct(F.col(c))))
                     for c in [*skeys, *(c for c in loose.columns if c not in skeys)]]
            after = new.select(F.count(F.lit(1))).scalar()
            loose = with_row_index(loose, order, name="_nth").withColumn("_rn", F.col("_nth") + after).drop("_nth")
        else:
            loose = loose.withColumn("_rn", F.lit(0))
        out = out.unionByName(unique_upsert(nothing, loose, pairs, **common))
    return _write(spark, root, table, held, out, tkeys, surrogate, rewritten, by)


def _write(spark: SparkSession, root: str, table: str, held: dict, rows: DataFrame, tkeys: list[str], surrogate: str | None,
           rewritten: list[int], by: dict | None) -> Written:
    """Write the rows (with ACTION) as parts of the next version, then their filters, then the manifest."""
    v = snap.next_version(spark, root, table)
    path, schema = f"{root.rstrip('/')}/{table}/v={v}", schema_of(held)
    (rows.withColumn(BUCKET, bucket_of(tkeys, held["buckets"])).repartition(BUCKET).sortWithinPartitions(BUCKET, *tkeys)
     .write.partitionBy(BUCKET).parquet(f"{path}/rows"))
    full = T.StructType([*schema.fields, T.StructField(ACTION, T.StringType()), T.StructField(BUCKET, T.IntegerType())])
    written = spark.read.schema(full).parquet(f"{path}/rows")
    top = F.max(surrogate) if surrogate else F.lit(0)
    stats = written.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(ACTION) == "I").alias("i"),
                                        F.count_if(F.col(ACTION) == "U").alias("u"), top.alias("top")).collect()  # one row per bucket
    blocks = {r[BUCKET]: -(-r["n"] * KEY_BITS // BLOCK_BITS) for r in stats}
    sizes = spark.createDataFrame([(b, k) for b, k in blocks.items() if b != NULLS], f"{BUCKET} int, blocks int")
    spelt = written.select(BUCKET, *tkeys).join(sizes, BUCKET).select(
        BUCKET, _block(tkeys, F.col("blocks")).alias("block"), F.explode(F.array(*_positions(tkeys))).alias("position"))
    spelt.groupBy(BUCKET, "block").agg(F.bitmap_construct_agg(F.col("position").cast("long")).alias("bits")) \
        .write.parquet(f"{path}/filter")

    parts = {b: list(p) for b, p in held["parts"].items()}
    changed = {r[BUCKET] for r in stats if r["i"] or r["u"]}
    appended = []
    for b, k in blocks.items():
        if b in rewritten and b != NULLS:
            if b in changed:  # else its rows are as they were
                parts[str(b)] = [[v, k]]
        else:
            appended.append(b)
            parts.setdefault(str(b), []).append([v, k])
    counts = {c: sum(r[c] for r in stats) for c in ("i", "u")}
    top = max([held["max_key"], *(r["top"] for r in stats if r["top"] is not None)])
    snap.mark(spark, root, table, v, held | {"parts": parts, "max_key": int(top), "by": by, "counts": counts})
    return Written(v, counts["i"], counts["u"], [b for b in rewritten if b in changed], appended)


def load(df: DataFrame, root: str, table: str, keys: list[str], surrogate: str | None = None, buckets: int = BUCKETS) -> int:
    """All rows of ``df`` as the first keyed version of a table (or the next one, replacing it)."""
    spark = df.sparkSession
    return _write(spark, root, table, _empty(df.schema, keys, buckets), df.withColumn(ACTION, F.lit("K")), keys, surrogate, [], None).version
