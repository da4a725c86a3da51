"""Neighbours, running totals and numbering, without one task per key or table.

A plain window over ``partitionBy(key)`` sends all rows of a key to one task,
and a single session log may hold a third of all rows. Here the key is cut
into buckets of bounded size. Windows run per (key, bucket); one summary row
per bucket carries values across the bucket edges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.workdir import saved

ROWS_PER_BUCKET = 10_000


def bucket_of(position: Column, rows: int = ROWS_PER_BUCKET) -> Column:
    """Bucket of an integer position that is unique within its key."""
    return F.floor(position / F.lit(rows)).cast("bigint")


def with_neighbours(
    df: DataFrame, keys: Sequence[str], bucket: str, order: str, columns: Sequence[str]
) -> DataFrame:
    """Add ``prev`` and ``next``: structs of ``columns`` of the adjacent rows of the key."""
    value = F.struct(*columns)
    inside = Window.partitionBy(*keys, bucket).orderBy(order)
    across = Window.partitionBy(*keys).orderBy(bucket)
    edges = (
        df.groupBy(*keys, bucket)
        .agg(
            F.min_by(value, F.col(order)).alias("first"),
            F.max_by(value, F.col(order)).alias("last"),
        )
        .select(
            *keys,
            bucket,
            F.lag("last").over(across).alias("before"),
            F.lead("first").over(across).alias("after"),
        )
    )
    rows = df.withColumns(
        {"prev": F.lag(value).over(inside), "next": F.lead(value).over(inside)}
    )
    return (
        rows.join(edges, [*keys, bucket], "left")
        .withColumns(
            {
                "prev": F.coalesce("prev", "before"),
                "next": F.coalesce("next", "after"),
            }
        )
        .drop("before", "after")
    )


def with_running_total(
    df: DataFrame, keys: Sequence[str], bucket: str, order: str, value: str, name: str
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over earlier rows of the key."""
    inside = (
        Window.partitionBy(*keys, bucket).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    across = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        df.groupBy(*keys, bucket)
        .agg(F.sum(value).alias("_sum"))
        .select(*keys, bucket, F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_base"))
    )
    return (
        df.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(bases, [*keys, bucket], "left")
        .withColumn(name, F.col(name) + F.col("_base"))
        .drop("_base")
    )


def with_numbers(df: DataFrame, keys: Sequence[str], name: str, buckets: int = 1024) -> DataFrame:
    """Add ``name``: 1, 2, … over the whole table, one number per row with unique ``keys``.

    Rows are numbered inside hash buckets and shifted by the sizes of the
    buckets before, so no single task sees the table.
    """
    hashed = df.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        hashed.groupBy("_bucket")
        .agg(F.count("*").alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    )
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(*keys))
    return (
        hashed.withColumn(name, place)
        .join(F.broadcast(bases), "_bucket")
        .withColumn(name, F.col(name) + F.col("_base"))
        .drop("_bucket", "_base")
    )


def with_ranks(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Add ``name``: 1, 2, … inside each key, in ``order``; a key may hold most rows.

    The rows are cut into ranges of (key, order), so a hot key spans many
    tasks. A rank is the place in the range, shifted by the sizes of the key's
    ranges before; only one row per key and range goes through a window.
    """
    ranges = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = saved(ranges.withColumn("_place", F.monotonically_increasing_id()), "ranks")
    placed = placed.withColumn("_range", F.shiftright("_place", 33))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(*keys, "_range").agg(F.min("_place").alias("_first"), F.count("*").alias("_size"))
    shifts = sizes.select(
        *[F.col(k).alias(f"_of_{k}") for k in keys],
        F.col("_range").alias("_of_range"),
        (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    same = F.col("_range") == F.col("_of_range")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return placed.join(shifts, same).select(*df.columns, (F.col("_place") + F.col("_shift")).cast("int").alias(name))
