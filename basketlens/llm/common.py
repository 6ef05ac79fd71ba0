"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A fresh sub-folder of the shared folder named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a scratch folder; on a
    cluster a missing setting is an error, since executors could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: cuts the
    lineage, fixes row placement and survives the loss of executors."""
    path = f"{shared_folder(df.sparkSession)}/{label}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(col):
    """A-Z lower-cased; every other character is left alone."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


_kept: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """What an operator keeps between the tasks of a Python worker. Workers serve
    one operator after another, so taking up one cache drops the others."""
    for other in [k for k in _kept if k != owner]:
        del _kept[other]
    return _kept.setdefault(owner, {})
