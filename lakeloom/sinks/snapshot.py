"""Versioned tables, logs and commits on plain Parquet.

Parquet files cannot be updated in place, so every change of a table writes new files and
only then publishes them.  One driver writes a store at a time; its threads may publish
different tables at once.

* A table published alone: ``<root>/<table>/v=<n>/``, then the marker ``<root>/_versions/<table>/<n>``.
  Readers take the greatest published version; a version whose write failed is never read and its number
  is not used again.  A marker may hold a JSON manifest (``keyed``).
* A transition that changes several tables and logs: ``Commit`` writes all of them, then one
  marker ``<root>/_commits/<n>`` that names every version and every log run.  Readers see all of
  it or nothing.
* Logs (K3, K4): a row is never rewritten; a later state of it is a later row.  A log is a list of
  runs, each sorted by the log's key and split into the last rows of their keys and those that a later
  row of the same run supersedes.  Each commit adds a run; ``FAN`` runs of one level are merged into one of the next, so
  a log of n commits has at most ``FAN`` times log n runs.  ``read_latest`` reads only last rows.

Markers are listed through the Hadoop file system of the session (metadata calls, no Spark
job).  Only the last ``RETAIN`` versions and commits stay.
"""

from __future__ import annotations

import json
import re
import threading
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

#: Published versions of a table, and commits, that are kept, the newest included.
RETAIN = 8
#: Runs of one level that are merged into one of the next, and rows of a merged run's file.
FAN, FILE_ROWS = 8, 1_000_000
SEQUENCE, LAST = "logsequence", "islast"
_COMMIT = threading.Lock()


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n) for n in _names(spark, path) if n.isdigit())


def write_json(spark: SparkSession, path: str, value) -> bool:
    """Make a file that did not exist; whether it did not.  Its content appears whole, by renaming."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return False
    part = _fs(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")[1]
    out = fs.create(part, False)
    out.write(json.dumps(value).encode())
    out.close()
    return fs.rename(part, p)


def read_json(spark: SparkSession, path: str):
    """The content of a file written by ``write_json``; None if it is empty."""
    fs, p = _fs(spark, path)
    size = fs.getFileStatus(p).getLen()
    if not size:
        return None
    data = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(data, "UTF-8")
    finally:
        data.close()
    return json.loads(text)


def optional_json(spark: SparkSession, path: str):
    """The content of a file, or None if there is none."""
    fs, p = _fs(spark, path)
    return read_json(spark, path) if fs.exists(p) else None


def _root(root: str) -> str:
    return root.rstrip("/")


def _vdir(root: str, table: str) -> str:
    return f"{_root(root)}/_versions/{table}"


def last_commit(spark: SparkSession, root: str) -> dict:
    """The newest commit's record: version by table, runs by log, and what its writer noted."""
    found = _numbers(spark, f"{_root(root)}/_commits")
    empty = {"number": 0, "tables": {}, "logs": {}, "note": None}
    return read_json(spark, f"{_root(root)}/_commits/{found[-1]}") if found else empty


def published_versions(spark: SparkSession, root: str, table: str) -> list[int]:
    """Versions with a marker of their own, and the version that the newest commit names."""
    own, together = _numbers(spark, _vdir(root, table)), last_commit(spark, root)["tables"].get(table)
    return sorted({*own, together} - {None})


def current_version(spark: SparkSession, root: str, table: str) -> int | None:
    """Greatest published version, or None when the table does not exist."""
    v = published_versions(spark, root, table)
    return v[-1] if v else None


def next_version(spark: SparkSession, root: str, table: str) -> int:
    """A number that no version has, published or not."""
    written = [int(n[2:]) for n in _names(spark, f"{_root(root)}/{table}") if re.fullmatch(r"v=\d+", n)]
    return max([0, *published_versions(spark, root, table), *written]) + 1


def table_exists(spark: SparkSession, root: str, table: str) -> bool:
    return current_version(spark, root, table) is not None


def manifest(spark: SparkSession, root: str, table: str, version: int) -> dict | None:
    """What the version's marker holds; None for a version that is a folder of its own."""
    return optional_json(spark, f"{_vdir(root, table)}/{version}")


def catalog_name(root: str, table: str, version: int) -> str:
    """Catalog name of a bucketed version (one table per version, never overwritten)."""
    import hashlib
    tag = hashlib.sha1(_root(root).encode()).hexdigest()[:10]
    return "lakeloom_" + re.sub(r"[^0-9A-Za-z_]", "_", f"{tag}_{table}_v{version}").lower()


def read_table(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame:
    v = version if version is not None else current_version(spark, root, table)
    if v is None:
        raise FileNotFoundError(f"table {table} has no published version under {root}")
    held = manifest(spark, root, table, v)
    if held is not None:
        from . import keyed  # which builds on this module
        return keyed.read(spark, root, table, held)
    name = catalog_name(root, table, v)
    if spark.catalog.tableExists(name):
        # a bucketed version: read through the catalog so the bucketing is known
        return spark.table(name)
    return spark.read.parquet(f"{_root(root)}/{table}/v={v}")


def publish(df: DataFrame, root: str, table: str, version: int | None = None,
            sort_by: list[str] | None = None, bucket: tuple[int, list[str]] | None = None,
            retain: int = RETAIN) -> int:
    """Write ``df`` as the next version of ``table``, then publish its marker.

    ``bucket=(n, keys)`` writes the version as an external catalog table
    bucketed and sorted by ``keys``: a later join on those keys (the next
    upsert) reads it already hash-partitioned, so only the other side moves."""
    spark = df.sparkSession
    v = version if version is not None else next_version(spark, root, table)
    path = f"{_root(root)}/{table}/v={v}"
    if bucket:
        n, keys = bucket
        (df.write.mode("errorifexists").format("parquet").option("path", path)
         .bucketBy(n, *keys).sortBy(*keys).saveAsTable(catalog_name(root, table, v)))
    else:
        w = df.sortWithinPartitions(*sort_by) if sort_by else df
        w.write.mode("errorifexists").parquet(path)
    mark(spark, root, table, v, None, retain)
    return v


def mark(spark: SparkSession, root: str, table: str, version: int, held: dict | None, retain: int = RETAIN) -> None:
    """Publish a written version by its marker, and remove what only versions before the last ``retain`` need."""
    path = f"{_vdir(root, table)}/{version}"
    fs, p = _fs(spark, path)
    if not (write_json(spark, path, held) if held is not None else fs.createNewFile(p)):
        raise RuntimeError(f"version {version} of {table} was published concurrently")
    kept = _numbers(spark, _vdir(root, table))
    for old in kept[:-retain]:
        fs.delete(_fs(spark, f"{_vdir(root, table)}/{old}")[1], False)
        if spark.catalog.tableExists(catalog_name(root, table, old)):
            spark.sql(f"DROP TABLE {catalog_name(root, table, old)}")
    if len(kept) > retain or held is not None:
        needed = set(kept[-retain:]) | set(published_versions(spark, root, table))
        for v in kept[-retain:]:
            needed |= {int(part[0]) for parts in ((manifest(spark, root, table, v) or {}).get("parts") or {}).values() for part in parts}
        for name in _names(spark, f"{_root(root)}/{table}"):
            if re.fullmatch(r"v=\d+", name) and int(name[2:]) < version and int(name[2:]) not in needed:
                fs.delete(_fs(spark, f"{_root(root)}/{table}/{name}")[1], True)


def create_empty(spark: SparkSession, root: str, table: str, schema: StructType) -> int:
    """CREATE TABLE IF NOT EXISTS: an empty first version with the derived schema (K7)."""
    cur = current_version(spark, root, table)
    if cur is not None:
        return cur
    return publish(spark.createDataFrame([], schema), root, table)


def truncate(spark: SparkSession, root: str, table: str) -> None:
    """An empty version of an existing table (K2); nothing if there is none."""
    if table_exists(spark, root, table):
        publish(read_table(spark, root, table).limit(0), root, table)


def overwrite(df: DataFrame, root: str, table: str) -> int:
    """Truncate-and-load of a bronze table (K2): simply the next full version."""
    return publish(df, root, table)


# ---------------------------------------------------------------------- commits


@dataclass
class Commit:
    """Tables and logs that become visible together.

    ``table`` and ``append`` only note what is to be written; ``publish`` writes it, as independent jobs, and then its marker."""

    spark: SparkSession
    root: str
    tables: dict[str, DataFrame] = field(default_factory=dict)
    logs: dict[str, tuple[DataFrame, StructType, list[str]]] = field(default_factory=dict)

    def table(self, name: str, df: DataFrame) -> Commit:
        self.tables[name] = df
        return self

    def append(self, name: str, df: DataFrame, schema: StructType, key: list[str]) -> Commit:
        """Rows for a log; they are later than all rows added before."""
        self.logs[name] = df, schema, key
        return self

    def publish(self, note: dict | None = None, merge: bool = True) -> dict:
        """The record of the commit; ``note`` is its own entry in it, with the runs that this commit added as ``runs``.

        merge: afterwards, merge the runs of its logs if there are enough."""
        spark, root = self.spark, _root(self.root)
        versions = {name: next_version(spark, root, name) for name in self.tables}
        runs = {name: {"path": f"run={uuid.uuid4().hex}", "level": 0} for name in self.logs}

        def write(name: str) -> None:
            if name in versions:
                self.tables[name].write.parquet(f"{root}/{name}/v={versions[name]}")
            if name in runs:
                df, schema, key = self.logs[name]
                rows = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields], F.lit(time.time_ns()).alias(SEQUENCE))
                # one row per run of a wave or less, whose records the driver holds anyway
                write_run(rows.coalesce(1).sortWithinPartitions(*key), f"{root}/{name}/{runs[name]['path']}", F.lit(True))

        names = [*versions, *runs]
        with ThreadPoolExecutor(max_workers=max(1, len(names))) as pool:
            list(pool.map(write, names))
        with _COMMIT:
            record = last_commit(spark, root)
            record["number"] += 1
            record["tables"] |= versions
            for name, run in runs.items():
                record["logs"][name] = [*record["logs"].get(name, []), run]
            if note is not None:
                record["note"] = note | {"runs": {n: r["path"] for n, r in runs.items()}}
            if not write_json(spark, f"{root}/_commits/{record['number']}", record):
                raise RuntimeError(f"commit {record['number']} was published concurrently")
        for name, (_, schema, key) in self.logs.items() if merge else ():
            _merge_runs(spark, root, name, schema, key)
        _clean(spark, root)
        return record


def _clean(spark: SparkSession, root: str) -> None:
    """Remove what only commits before the last RETAIN name."""
    numbers = _numbers(spark, f"{root}/_commits")
    if len(numbers) <= RETAIN:
        return
    fs, _ = _fs(spark, root)
    gone = [read_json(spark, f"{root}/_commits/{n}") for n in numbers[:-RETAIN]]
    kept = [read_json(spark, f"{root}/_commits/{n}") for n in numbers[-RETAIN:]]
    for name in {t for r in gone for t in r["tables"]}:
        needed = {r["tables"].get(name) for r in kept} | set(_numbers(spark, _vdir(root, name)))
        for v in {r["tables"].get(name) for r in gone} - needed:
            fs.delete(_fs(spark, f"{root}/{name}/v={v}")[1], True)
    for name in {t for r in gone for t in r["logs"]}:
        needed = {run["path"] for r in kept for run in r["logs"].get(name, [])}
        for path in {run["path"] for r in gone for run in r["logs"].get(name, [])} - needed:
            fs.delete(_fs(spark, f"{root}/{name}/{path}")[1], True)
    for n in numbers[:-RETAIN]:
        fs.delete(_fs(spark, f"{root}/_commits/{n}")[1], False)


# ------------------------------------------------------------------------- logs


def _logged(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(SEQUENCE, LongType())])


def create_log(spark: SparkSession, root: str, table: str, schema: StructType) -> None:
    """An empty log; a log without a run reads as empty, so there is nothing to write."""


def append(df: DataFrame, root: str, table: str, schema: StructType, key: list[str]) -> dict:
    """Add rows to one log, in a commit of their own."""
    return Commit(df.sparkSession, root).append(table, df, schema, key).publish()


def write_run(rows: DataFrame, path: str, last) -> None:
    rows.withColumn(LAST, last).write.partitionBy(LAST).parquet(path)


def _read_runs(spark: SparkSession, root: str, table: str, schema: StructType, runs: list[dict]) -> DataFrame:
    out = _logged(schema)
    if not runs:
        return spark.createDataFrame([], StructType([*out.fields, StructField(LAST, BooleanType())]))
    # a run's folders are islast=true and islast=false; basePath would need one common to all runs
    folders = [(last, f"{_root(root)}/{table}/{r['path']}/{LAST}={str(last).lower()}") for r in runs for last in (True, False)]
    parts = []
    for last in (True, False):
        paths = [p for flag, p in folders if flag == last and _fs(spark, p)[0].exists(_fs(spark, p)[1])]
        if paths:
            parts.append(spark.read.schema(out).parquet(*paths).withColumn(LAST, F.lit(last)))
    return parts[0].union(parts[1]) if len(parts) > 1 else parts[0]


def read_log(spark: SparkSession, root: str, table: str, schema: StructType, run: str | None = None) -> DataFrame:
    """All rows of a log, with SEQUENCE; of one run only, if given."""
    runs = [{"path": run}] if run else last_commit(spark, root)["logs"].get(table, [])
    return _read_runs(spark, root, table, schema, runs).drop(LAST)


def read_latest(spark: SparkSession, root: str, table: str, schema: StructType, keys: list[str]) -> DataFrame:
    """The last row of each key (W6).  Rows that a merge has found superseded are not read."""
    rows = _read_runs(spark, root, table, schema, last_commit(spark, root)["logs"].get(table, []))
    return latest(rows.where(F.col(LAST)).drop(LAST), keys)


def latest(log: DataFrame, keys: list[str]) -> DataFrame:
    """The last row of each key, by a partial aggregation; without SEQUENCE."""
    rest = [c for c in log.columns if c not in keys and c != SEQUENCE]
    last = log.groupBy(*keys).agg(F.max(F.struct(SEQUENCE, *rest)).alias("_l"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_l.{c}").alias(c) for c in log.columns if c != SEQUENCE])


def _merge_runs(spark: SparkSession, root: str, table: str, schema: StructType, key: list[str]) -> None:
    """Merge FAN runs of one level, from the lowest; a commit of its own, so a merge that fails loses nothing."""
    while True:
        runs = last_commit(spark, root)["logs"].get(table, [])
        level = next((k for k in sorted({r["level"] for r in runs}) if sum(r["level"] == k for r in runs) >= FAN), None)
        if level is None:
            return
        old = [r for r in runs if r["level"] == level][:FAN]
        rows = _read_runs(spark, root, table, schema, old).drop(LAST)
        newest = rows.groupBy(*[F.col(k).alias(f"_k_{k}") for k in key]).agg(F.max(SEQUENCE).alias("_newest"), F.count("*").alias("_n"))
        size = newest.agg(F.sum("_n")).first()[0] or 0
        same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key]
        marked = rows.join(newest, same).withColumn(LAST, F.col(SEQUENCE) == F.col("_newest")).select(*_logged(schema).names, LAST)
        marked = marked.repartitionByRange(-(-size // FILE_ROWS) or 1, *key).sortWithinPartitions(*key)
        new = {"path": f"run={uuid.uuid4().hex}", "level": level + 1}
        marked.write.partitionBy(LAST).parquet(f"{_root(root)}/{table}/{new['path']}")
        with _COMMIT:
            record = last_commit(spark, root)
            gone = {r["path"] for r in old}
            record["number"] += 1
            record["logs"][table] = [new, *[r for r in record["logs"][table] if r["path"] not in gone]]
            if not write_json(spark, f"{_root(root)}/_commits/{record['number']}", record):
                raise RuntimeError(f"commit {record['number']} was published concurrently")


def write_sorted(df: DataFrame, path: str, key: list[str], num_partitions: int | None = None,
                 mode: str = "errorifexists") -> None:
    """Gold-style clustered write (D3 ``ORDER BY tuple(pk)``): range-partition
    on the sort key and sort inside each file, so each file covers one key
    range and row-group min/max statistics prune key lookups."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(n, *key).sortWithinPartitions(*key)
     .write.mode(mode).parquet(path))
