"""Spark session helpers.

The library never creates a session behind the caller's back inside an
operator; these helpers are for scripts, the bench and the tests.
"""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this engine wants: AQE for runtime re-planning
# (partition coalescing, skew-join splitting, broadcast switch on measured
# sizes), UTC so day arithmetic never crosses DST, no UI server.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "basketlens", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's base settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder, setting a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is. Only a local session with nothing configured gets a fresh scratch folder;
    on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="basketlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df):
    """Reliable checkpoint (never a local one): survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Rows a partition of an iterative fit holds, and the fewest partitions it is cut down to.
FIT_ROWS = 50_000
FIT_PARTITIONS = 8


def fit_partitions(df, rows: int, least: int = FIT_PARTITIONS, each: int = FIT_ROWS):
    """``df`` (of ``rows`` rows) in no more partitions than an iterative fit needs.

    Such a fit runs hundreds of jobs over one customer-level table. A job's cost and what it
    sends to the driver grow with its tasks, whose number would otherwise be the shuffle partitions
    of the lines that the table came from. No row moves, and few partitions stay as they are.
    """
    return df.coalesce(max(least, math.ceil(rows / each)))


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
