"""Keyed tables stored in buckets, so that a batch rewrites the buckets of its keys only.

``rows/set=s/bucket=b`` holds what one change wrote; ``manifest/version=v`` is
one row that names, for every bucket, the set with its current rows. A change
writes its set first and its manifest last, as one new folder: readers see all
of a change or nothing, and a job that dies leaves a set that nothing names. Of
two changes to the same version the second fails and can be made again.

What reaches the driver is the manifest: one entry per bucket.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 64
_MANIFEST = "keys array<string>, buckets int, schema string, counter string, last bigint, holders map<int,string>, version bigint"


@dataclass(frozen=True)
class Version:
    """One version of a stored table. ``last`` is the largest value that the ``counter`` column ever had."""

    number: int
    keys: tuple[str, ...]
    buckets: int
    schema: StructType
    counter: str | None
    last: int | None
    holders: dict[int, str]

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")


def create(
    rows: DataFrame, root: str, keys: Sequence[str], buckets: int = BUCKETS, counter: str | None = None
) -> Version:
    """Store a table; rows of equal ``keys`` share a bucket."""
    empty = Version(-1, tuple(keys), buckets, rows.schema, counter, None, {})
    return _commit(rows, root, empty, list(range(buckets)))


def latest(spark: SparkSession, root: str) -> Version:
    """The newest version."""
    found = spark.read.schema(_MANIFEST).parquet(f"{root}/manifest")
    row = found.filter(F.col("version") == found.agg(F.max("version")).scalar()).first()
    schema = StructType.fromJson(json.loads(row["schema"]))
    return Version(row.version, tuple(row["keys"]), row.buckets, schema, row.counter, row.last, dict(row.holders))


def read(spark: SparkSession, root: str, version: Version | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
    """The rows of a version, or of some of its buckets; later changes do not show."""
    version = version or latest(spark, root)
    chosen = version.holders if buckets is None else {b: version.holders[b] for b in buckets if b in version.holders}
    if not chosen:
        return spark.createDataFrame([], version.schema)
    paths = [f"{root}/rows/set={name}/bucket={b}" for b, name in sorted(chosen.items())]
    return spark.read.schema(version.schema).parquet(*paths)


def change(
    spark: SparkSession, root: str, batch: DataFrame, rewrite: Callable[[DataFrame, Version], DataFrame]
) -> Version:
    """Replace the rows in the buckets of the batch's keys by ``rewrite(rows, version)``.

    ``rewrite`` may only add keys of the batch. A batch without rows changes nothing.
    """
    version = latest(spark, root)
    hit = sorted(r[0] for r in batch.select(version.bucket()).distinct().collect())
    if not hit:
        return version
    return _commit(rewrite(read(spark, root, version, hit), version), root, version, hit)


def _commit(rows: DataFrame, root: str, version: Version, hit: list[int]) -> Version:
    """Write the set of the buckets that changed, then the manifest that names it."""
    spark, name = rows.sparkSession, uuid.uuid4().hex
    path = f"{root}/rows/set={name}"
    # Split by size at run time, so that a bucket with a hot key becomes several files.
    placed = rows.select(*version.schema.fieldNames()).withColumn("bucket", version.bucket())
    placed.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path)
    written = spark.read.schema(StructType([*version.schema, *placed.select("bucket").schema])).parquet(path)
    top = F.max(version.counter) if version.counter else F.lit(None)
    found = {r.bucket: r.top for r in written.groupBy("bucket").agg(top.cast("bigint").alias("top")).collect()}
    if set(found) - set(hit):
        raise ValueError("rows with keys outside the batch")
    tops = [t for t in (version.last, *found.values()) if t is not None]
    holders = {b: s for b, s in version.holders.items() if b not in set(hit)} | dict.fromkeys(found, name)
    after = Version(
        version.number + 1, version.keys, version.buckets, version.schema, version.counter, max(tops, default=None), holders
    )
    row = (list(after.keys), after.buckets, after.schema.json(), after.counter, after.last, holders)
    entry = spark.createDataFrame([row], _MANIFEST.rsplit(",", 1)[0])
    entry.coalesce(1).write.mode("errorifexists").parquet(f"{root}/manifest/version={after.number}")
    return after
