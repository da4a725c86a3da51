"""Dated snapshots of a table with a retention period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed


def write_snapshot(rows: DataFrame, path: str, day: str) -> None:
    """Store a snapshot under its day; a second one on the same day replaces the first."""
    (
        rows.withColumn("snapshot_date", F.lit(day).cast("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .parquet(path)
    )


def _age(as_of: Column) -> Column:
    return F.datediff(as_of, F.col("snapshot_date"))


def retained(snapshots: DataFrame, as_of: Column, days: int = fixed.RETENTION_DAYS) -> DataFrame:
    """Snapshots at most ``days`` whole days old. A partition filter: older ones are not opened."""
    return snapshots.filter(_age(as_of) <= days)


def expired_dates(snapshots: DataFrame, as_of: Column, days: int = fixed.RETENTION_DAYS) -> DataFrame:
    """Days whose snapshots may be removed from storage."""
    return snapshots.filter(_age(as_of) > days).select("snapshot_date").distinct()
