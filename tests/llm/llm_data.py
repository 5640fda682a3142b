"""Small tables with every awkward case, and brute-force versions of the operators."""

import zlib

import numpy as np
import xxhash
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DELETE = str.maketrans("", "", " \t\n\x0b\x0c\r")
#: names that operators use inside, as extra columns
CLASHES = ["fp", "key", "score", "part", "value", "entry", "id", "member", "row", "range", "order", "rank", "text_sha256"]

DOC_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType())] + [T.StructField(c, T.StringType()) for c in CLASHES])


def long_text(words=30_000, seed=3):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(["alpha", "Beta", "gamma", "délta", "naïve", "it's", "x1", "--"], words))


def edge_rows():
    long = long_text()
    base = [
        (10, "The cat sat on the mat by the door.", "en", "web"),
        (11, "The cat sat on the  mat\nby the door. ", "en", "web"),     # equal without white space, longer
        (12, "The cat sat on the  mat\nby the door. ", "en", "books"),   # tie: smaller id stays
        (13, None, None, None),
        (14, "", "en", None),
        (15, " \t\n\x0b\x0c\r", "de", "web"),
        (16, "12345 !!! 67", "fr", "web"),
        (17, long, "en", "books"),
        (18, long + " tail", "en", "books"),
        (19, "the CAT sat on the mat by the door.", "en", "other"),
        (20, "two words", "en", "other"),
        (21, "don't WE'LL we'll  'sun  x\u00a0y  \u4e2d\u6587 \U0001f642\u200b ½²Ⅳ", "es", "other"),
        (22, "word", None, "other"),
        (None, "a text without an id", "en", "web"),
        (None, "a text without an id", "en", "web"),
        (20, "two words", "en", "other"),
    ]
    return [(i, t, la, s, None if t is None else len(t)) + ("clash",) * len(CLASHES) for i, t, la, s in base]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), DOC_SCHEMA).repartition(3)


def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def words(text):
    return (text or "").translate(LOW).encode().split()


def crc(doc_id, mod):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % mod


def fingerprint(text):
    w = words(text)
    shingles = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps):
    """Root of every position, positions linked at 2 or fewer bits."""
    f, parent = np.array(fps, np.uint64), list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i + 1:] ^ f[i]) <= 2) + i + 1:
            a, b = sorted((find(i), find(int(j))))
            parent[b] = a
    return [find(i) for i in range(len(f))]


def write_tables(spark, path, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)
