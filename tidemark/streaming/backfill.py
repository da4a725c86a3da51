"""Continuous filling of missing vectors as new chunks land."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import backfill
from tidemark.streaming import changes

AVAILABLE_NOW: Mapping[str, object] = {"availableNow": True}
# A chunk that was tried: its vector, or its text where the call failed.
_TRIED = "chunk_id bigint, embedding array<float>, text string"


def _tried(spark: SparkSession, path: str, but: tuple[str, int] | None = None) -> DataFrame:
    return changes.current(spark, f"{path}/tried", _TRIED, but)


def _vectors(rows: DataFrame) -> DataFrame:
    made = rows.filter(F.col("embedding").isNotNull())
    return made.groupBy("chunk_id").agg(F.max_by("embedding", "version").alias("embedding"))


def _waiting(rows: DataFrame) -> DataFrame:
    failed = rows.filter(F.col("embedding").isNull()).groupBy("chunk_id").agg(F.max_by("text", "version").alias("text"))
    made = rows.filter(F.col("embedding").isNotNull()).select("chunk_id")
    return failed.join(made, "chunk_id", "left_anti")


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """All vectors made so far: (chunk_id, embedding), the newest of each chunk."""
    return _vectors(_tried(spark, path))


def waiting(spark: SparkSession, path: str) -> DataFrame:
    """Chunks whose embedding call failed and that have no vector yet: (chunk_id, text)."""
    return _waiting(_tried(spark, path))


def compact_vectors(spark: SparkSession, path: str) -> None:
    """Fold all vectors and waiting chunks so far into one set, which readers start from."""
    rows = read_vectors(spark, path).withColumn("text", F.lit(None).cast("string"))
    rows = rows.unionByName(waiting(spark, path), allowMissingColumns=True)
    changes.fold(rows.select("chunk_id", "embedding", "text"), f"{path}/tried", _TRIED)


def _embed(rows: DataFrame, embedder: backfill.Embedder, path: str, run: str, batch: int) -> int:
    tried = backfill.embed_chunks(rows.select("chunk_id", "text"), embedder, failed_text=True)
    return changes.write(tried, f"{path}/tried", _TRIED, run, batch)


def retry(spark: SparkSession, embedder: backfill.Embedder, path: str) -> None:
    """Try all chunks again whose call failed before."""
    again = waiting(spark, path)
    if not again.isEmpty():
        _embed(again, embedder, path, f"retry-{uuid.uuid4().hex}", 0)


def append_vectors(
    chunks: DataFrame,
    embedder: backfill.Embedder,
    path: str,
    checkpoint: str,
    trigger: Mapping = AVAILABLE_NOW,
    fold_after: int = changes.FOLD_AFTER,
) -> StreamingQuery:
    """Vectors of all pending chunks of a stream, appended below ``path``; see ``read_vectors``.

    The chunk table itself is not rewritten per micro-batch: readers merge
    the appended vectors with ``backfill.write_back``. A micro-batch writes one
    set of ``streaming.changes``, named by run and batch: a replayed one
    overwrites its own set, and a restart with another checkpoint adds to what is
    there and embeds only what has no vector yet. A failed call leaves its
    chunks waiting; they are tried again when the stream starts and with every
    micro-batch. After ``fold_after`` sets the stream folds them into one.
    """
    retry(chunks.sparkSession, embedder, path)

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, changes.run_of(batch)
        todo = backfill.pending(batch).select("chunk_id", "text")
        # What this batch wrote before a crash is made anew, not taken for done.
        before = _tried(spark, path, but=(run, batch_id))
        if changes.other_runs(spark, f"{path}/tried", _TRIED, run):
            # Another checkpoint may have been through the same chunks.
            todo = todo.join(_vectors(before).select("chunk_id"), "chunk_id", "left_anti")
        todo = todo.unionByName(_waiting(before)).dropDuplicates(["chunk_id"])
        if _embed(todo, embedder, path, run, batch_id) >= fold_after:
            compact_vectors(spark, path)

    return (
        chunks.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
