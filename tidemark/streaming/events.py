"""The event collector as streaming queries.

Event time and arrival time are both kept. No watermark, no deduplication: an
event of any age is appended. Every query runs to the end of the available
input; start it again, or pass another trigger, for continuous work.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import times
from tidemark.operators import events as ev
from tidemark.streaming import changes

AVAILABLE_NOW: Mapping[str, object] = {"availableNow": True}


def append_events(
    envelopes: DataFrame, path: str, checkpoint: str, trigger: Mapping = AVAILABLE_NOW, keep=()
) -> StreamingQuery:
    """Normalised events appended to a Parquet table by UTC day."""
    rows = ev.normalise(envelopes, keep).withColumn("day", times.utc_day(F.col("ts")))
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("day")
        .trigger(**trigger)
        .start()
    )


def append_alerts(
    envelopes: DataFrame, path: str, checkpoint: str, trigger: Mapping = AVAILABLE_NOW, keep=(),
    purchase: str = ev.fixed.PURCHASE,
) -> StreamingQuery:
    """Alert texts of purchase events, as a table of their own."""
    rows = ev.alerts(ev.normalise(envelopes, keep, with_raw=True), keep, purchase)
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


IDENTITY_SCHEMA = "app string, distinct_id string, user_id string, first_seen timestamp"


def read_identities(spark: SparkSession, root: str) -> DataFrame:
    """The identity table: the user of the newest change, and the first arrival."""
    rows = changes.current(spark, root, IDENTITY_SCHEMA)
    return rows.groupBy("app", "distinct_id").agg(
        F.max_by("user_id", "version").alias("user_id"), F.min_by("first_seen", "version").alias("first_seen")
    )


def compact_identities(spark: SparkSession, root: str) -> None:
    """Fold all changes so far into one set, which readers start from."""
    changes.fold(read_identities(spark, root), root, IDENTITY_SCHEMA)


def maintain_identities(
    envelopes: DataFrame,
    root: str,
    checkpoint: str,
    order=("received_at", "pos"),
    keep=(),
    trigger: Mapping = AVAILABLE_NOW,
    identify: str = ev.fixed.IDENTIFY,
    fold_after: int = changes.FOLD_AFTER,
) -> StreamingQuery:
    """Identity changes appended by micro-batches; ``read_identities`` folds them.

    A batch writes its own changes only, never the table, as a set of
    ``streaming.changes``: a lost executor or a restart, also with another
    checkpoint, can neither apply it twice nor drop earlier identities. After
    ``fold_after`` sets the stream folds them, so readers fold no more than that.
    """
    rows = ev.normalise(envelopes, keep)

    def apply(batch: DataFrame, batch_id: int) -> None:
        found = ev.identity_batch(batch, order, identify)
        sets = changes.write(found, root, IDENTITY_SCHEMA, changes.run_of(batch), batch_id)
        if sets >= fold_after:
            compact_identities(batch.sparkSession, root)

    return (
        rows.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
