"""Shared working folder for written intermediate tables and stream state."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_OWN = "tidemark.local.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by the cluster; without one, a temporary folder per session in local mode only."""
    named = spark.conf.get(SETTING, None) or spark.conf.get(_OWN, None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError(f"set {SETTING} to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set(_OWN, own)
    return own


def new_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a table in the shared folder.

    Ends the lineage: what follows does not compute the rows again, and a
    lost executor costs a read of the table only.
    """
    path = new_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
