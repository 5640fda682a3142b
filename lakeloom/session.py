"""Session construction and the shared scratch location.

Library code never picks a machine-local folder on a cluster: lineage is cut
with ``DataFrame.checkpoint()`` into the folder the cluster names in
``spark.checkpoint.dir``.  Only a local-mode session (tests, bench) without that
setting gets a fresh temporary folder.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "lakeloom", driver_memory: str = "8g", cpus: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """A session with the settings every job here assumes (UTC, AQE on, no UI)."""
    b = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf["spark.driver.memory"] = driver_memory
    if (master or "local").startswith("local"):
        # local sessions only: the catalog of bucketed versions lives in a scratch folder
        conf["spark.sql.warehouse.dir"] = tempfile.mkdtemp(prefix="lakeloom-wh-")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to a session built elsewhere (the driver's)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled"):
        try:
            spark.conf.set(k, _CONF[k])
        except Exception:  # static or locked conf: leave as configured
            pass
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # a remote (Connect) session has no local context
        return None


def checkpoint_dir(spark: SparkSession) -> str | None:
    sc = _context(spark)
    d = sc.getCheckpointDir() if sc is not None else None
    if d:
        return d
    try:
        return spark.conf.get("spark.checkpoint.dir", None)
    except Exception:
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the shared checkpoint folder; set one only for local sessions.

    A remote session checkpoints on the server side: its configured folder is
    returned as is."""
    sc = _context(spark)
    if sc is None:
        return checkpoint_dir(spark)
    d = sc.getCheckpointDir()
    if d:
        return d
    conf_dir = None
    try:
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:
        conf_dir = None
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    d = tempfile.mkdtemp(prefix="lakeloom-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def parallelism(spark: SparkSession) -> int:
    """Target task count of a stage: the shuffle-partition setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def broadcast_if_small(df, rows: int = 10_000):
    """``df`` with a broadcast hint if it has so few (narrow) rows, which are fetched to see it; else as it is, joined as any table."""
    some = df.limit(rows + 1).collect()
    return F.broadcast(df.sparkSession.createDataFrame(some, df.schema)) if len(some) <= rows else df


def ensure_parallelism(df, partitions: int | None = None):
    """Spread a CPU-heavy stage over ``partitions`` tasks, whatever its input's number of row groups."""
    return df.repartition(partitions or parallelism(df.sparkSession))
