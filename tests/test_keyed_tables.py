"""Keyed tables: touched buckets only, key filters, equality with the plain upsert."""

import datetime as dt
import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from lakeloom.operators.upsert import upsert
from lakeloom.sinks import keyed
from lakeloom.sinks import snapshot as snap

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1)
META = {"etljobname": "j", "envsourcecd": "e", "datasourcecd": "d"}
SCHEMA = ("tkey long, k long, name string, bal double, etlactiveind int, etljobname string, envsourcecd string, "
          "datasourcecd string, etlcreateddatetime timestamp_ntz, etlupdateddatetime timestamp_ntz")


def target(spark, keys):
    rows = [(i + 1, k, f"old {k}", 1.0, 1, "o", "o", "o", T0, T0) for i, k in enumerate(keys)]
    return spark.createDataFrame(rows, SCHEMA)


def source(spark, keys, text="new"):
    return spark.createDataFrame([(k, f"{text} {k}", 2.0) for k in keys], "k long, name string, bal double")


def files(root, table="t"):
    return {os.path.relpath(p, root): os.stat(p).st_mtime_ns for p in glob.glob(f"{root}/{table}/v=*/rows/**/*.parquet", recursive=True)}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def probe_tasks(spark, root):
    held = snap.manifest(spark, root, "t", snap.current_version(spark, root, "t"))
    return held


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="lakeloom-keyed-")


def test_equals_the_plain_upsert_over_several_loads(spark, root):
    before = target(spark, range(0, 200, 2))
    keyed.load(before, root, "t", ["k"], "tkey", buckets=8)
    plain = before
    for n, keys in enumerate([range(50, 60), range(1000, 1010), [55, 2000, 0, 198], range(300)]):
        src = source(spark, keys, f"load {n}")
        r = upsert(plain, src, ["k"], surrogate="tkey", meta=META, as_of=T1)
        counts = r.counts().first()
        done = keyed.upsert(spark, root, "t", src, ["k"], surrogate="tkey", meta=META, as_of=T1)
        plain = spark.createDataFrame(r.table.collect(), SCHEMA)
        assert (done.inserted, done.updated) == (counts.inscnt, counts.updcnt)
        assert rows(snap.read_table(spark, root, "t")) == rows(plain)


def test_untouched_buckets_keep_their_files(spark, root):
    keyed.load(target(spark, range(400)), root, "t", ["k"], "tkey", buckets=16)
    old = files(root)
    touched = {r[0] for r in source(spark, [3, 4]).select(keyed.bucket_of(["k"], 16)).collect()}
    done = keyed.upsert(spark, root, "t", source(spark, [3, 4]), ["k"], surrogate="tkey", meta=META, as_of=T1)
    assert set(done.rewritten) == touched and not done.appended and (done.inserted, done.updated) == (0, 2)
    now = files(root)
    assert {p: m for p, m in now.items() if p in old} == old  # carried by reference, not copied
    assert {p.split("keybucket=")[1].split("/")[0] for p in now if p not in old} == {str(b) for b in touched}
    held = snap.manifest(spark, root, "t", done.version)
    assert sum(part[0] == 1 for parts in held["parts"].values() for part in parts) == 16 - len(touched)
    assert snap.read_table(spark, root, "t").count() == 400
    # the version before can still be read
    assert snap.read_table(spark, root, "t", 1).where("name like 'new%'").count() == 0


def test_new_keys_read_no_data_of_the_table(spark, root):
    keyed.load(target(spark, range(1000)), root, "t", ["k"], "tkey", buckets=8)
    for p in glob.glob(f"{root}/t/v=1/rows/**/*.parquet", recursive=True):
        os.chmod(p, 0o644)
        with open(p, "wb") as f:  # whoever reads a row of the table fails
            f.write(b"not parquet")
    for p in glob.glob(f"{root}/t/v=1/rows/**/.*.crc", recursive=True):
        os.remove(p)
    done = keyed.upsert(spark, root, "t", source(spark, range(5000, 5100)), ["k"], surrogate="tkey", meta=META, as_of=T1)
    assert (done.inserted, done.updated, done.rewritten) == (100, 0, []) and len(done.appended) == 8
    held = snap.manifest(spark, root, "t", done.version)
    assert all(len(parts) == 2 for parts in held["parts"].values()) and held["max_key"] == 1100
    with pytest.raises(Exception, match="(?i)parquet"):
        keyed.upsert(spark, root, "t", source(spark, [7]), ["k"], surrogate="tkey", meta=META, as_of=T1)


def test_many_parts_become_one(spark, root):
    keyed.create(spark, root, "t", target(spark, []).schema, ["k"], buckets=1)
    for i in range(keyed.MAX_PARTS + 1):
        done = keyed.upsert(spark, root, "t", source(spark, [i]), ["k"], surrogate="tkey", meta=META, as_of=T1)
    assert done.rewritten == [0] and len(snap.manifest(spark, root, "t", done.version)["parts"]["0"]) == 1
    got = snap.read_table(spark, root, "t")
    assert sorted((r.tkey, r.k) for r in got.collect()) == [(i + 1, i) for i in range(keyed.MAX_PARTS + 1)]


def test_null_keys_are_inserted_and_never_match(spark, root):
    keyed.load(target(spark, [1, 2]), root, "t", ["k"], "tkey", buckets=4)
    src = spark.createDataFrame([(None, "a", 1.0), (None, "a", 1.0), (2, "b", 1.0), (9, "c", 1.0)], "k long, name string, bal double")
    for n in (1, 2):
        done = keyed.upsert(spark, root, "t", src, ["k"], surrogate="tkey", meta=META, as_of=T1)
        assert (done.inserted, done.updated) == ((3, 1) if n == 1 else (2, 2))
    got = snap.read_table(spark, root, "t")
    assert sorted(r.tkey for r in got.collect()) == list(range(1, 8)) and got.where("k IS NULL").count() == 4
    assert {r.k: r.tkey for r in got.where("k IS NOT NULL").collect()} == {1: 1, 2: 2, 9: 3}


def test_repeated_keys_are_refused_and_unchanged_rows_stay(spark, root):
    keyed.load(target(spark, [1, 2]), root, "t", ["k"], "tkey", buckets=4)
    with pytest.raises(ValueError, match="1 business keys occur more than once \\(1 surplus rows\\)"):
        keyed.upsert(spark, root, "t", source(spark, [5, 5]), ["k"], surrogate="tkey")
    with pytest.raises(ValueError, match="kept by"):
        keyed.upsert(spark, root, "t", source(spark, [5]), ["name"], surrogate="tkey")
    keyed.upsert(spark, root, "t", source(spark, [1, 2]), ["k"], surrogate="tkey", meta=META, as_of=T0)
    before = snap.manifest(spark, root, "t", 2)["parts"]
    done = keyed.upsert(spark, root, "t", source(spark, [1, 2]), ["k"], surrogate="tkey", meta=META, as_of=T1, only_changed=True)
    assert (done.inserted, done.updated, done.rewritten) == (0, 0, [])
    assert snap.manifest(spark, root, "t", done.version)["parts"] == before


def test_profile_counts_checks_and_probes_in_one_pass(spark, root):
    keyed.load(target(spark, range(10)), root, "t", ["k"], "tkey", buckets=4)
    src = spark.createDataFrame([(1, "abc", None), (1, None, 1.0), (50, "abcdef", 1.0), (None, "x", 1.0)], "k long, name string, bal double")
    found = keyed.profile(spark, root, "t", snap.manifest(spark, root, "t", 1), src, ["k"], ["name", "bal"], {"name": 3})
    assert (found.rows, found.nulls, found.over) == (4, {"name": 1, "bal": 1}, {"name": 1})
    assert (found.dup_keys, found.surplus_rows, sum(found.buckets.values())) == (1, 1, 1)
    assert [r.k for r in found.hits.collect()] == [1] and keyed.NULLS in found.buckets


def test_a_failed_write_is_never_read_and_its_number_not_used_again(spark, root):
    keyed.load(target(spark, range(10)), root, "t", ["k"], "tkey", buckets=4)
    broken = source(spark, [3]).withColumn("name", F.raise_error(F.lit("broken row")).cast("string"))
    with pytest.raises(Exception, match="broken row"):
        keyed.upsert(spark, root, "t", broken, ["k"], surrogate="tkey")
    assert snap.current_version(spark, root, "t") == 1
    done = keyed.upsert(spark, root, "t", source(spark, [3]), ["k"], surrogate="tkey")
    assert done.version > 1 and snap.read_table(spark, root, "t").where("name = 'new 3'").count() == 1


def test_old_parts_go_when_no_kept_version_needs_them(spark, root):
    keyed.load(target(spark, range(40)), root, "t", ["k"], "tkey", buckets=2)
    for i in range(snap.RETAIN + 2):
        keyed.upsert(spark, root, "t", source(spark, range(40), f"load {i}"), ["k"], surrogate="tkey")
    assert len(snap.published_versions(spark, root, "t")) == snap.RETAIN
    assert not os.path.exists(f"{root}/t/v=1") and snap.read_table(spark, root, "t").count() == 40
    assert snap.read_table(spark, root, "t", snap.published_versions(spark, root, "t")[0]).count() == 40
