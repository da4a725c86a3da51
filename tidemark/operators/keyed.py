"""Keyed table maintenance: each function takes tables and returns the next version."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import text as tx
from tidemark.operators import chunking, ordered
from tidemark.sources.workdir import saved


def last_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every key. An aggregate, so a hot key shrinks before the shuffle."""
    others = [c for c in batch.columns if c not in keys]
    last = F.max_by(F.struct(*others), F.struct(*order))
    return batch.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*")


def upsert(
    current: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
) -> DataFrame:
    """Insert new keys; for known keys overwrite the ``update`` columns.

    ``batch`` has one row per key. A left join plus an anti join over the key
    column alone, instead of a full outer join: with a small batch Spark can
    broadcast it and the current table is not shuffled with its payload.
    """
    columns = [c for c in current.columns if c not in keys]
    update = columns if update is None else update
    incoming = batch.select(
        *keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in update]
    )
    merged = current.join(incoming, list(keys), "left").select(
        *keys,
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in update
            else F.col(c)
            for c in columns
        ],
    )
    added = batch.join(current.select(*keys), list(keys), "left_anti")
    return merged.select(*current.columns).unionByName(
        added.select(*[c for c in current.columns if c in batch.columns]),
        allowMissingColumns=True,
    )


def _with_new_ids(sources: DataFrame, batch: DataFrame, last: Column | None = None) -> DataFrame:
    """Batch rows with ids above all ids in use; only rows that turn out new keep them."""
    last = sources.agg(F.coalesce(F.max("source_id"), F.lit(-1))).scalar() if last is None else last
    numbered = ordered.with_numbers(batch, ["kind", "origin"], "_number")
    return numbered.withColumn("source_id", last + F.col("_number")).drop("_number")


def upsert_sources(
    sources: DataFrame, batch: DataFrame, order: Sequence[str], last: Column | None = None
) -> DataFrame:
    """Sources by (kind, origin): title, metadata and updated_at change; id and created_at stay.

    ``last`` is the largest id in use, for callers whose ``sources`` are a part of the table.
    """
    keys = ["kind", "origin"]
    rows = last_per_key(batch, keys, order)
    if "source_id" in sources.columns:
        rows = _with_new_ids(sources, rows, last)
    return upsert(sources, rows, keys, ["title", "metadata", "updated_at"])


def upsert_chunks(chunks: DataFrame, batch: DataFrame) -> DataFrame:
    """Chunks by (source_id, chunk_index): text, size, vector and metadata are replaced."""
    columns = [c for c in ("text", "token_count", "embedding", "metadata") if c in chunks.columns]
    return upsert(chunks, batch, ["source_id", "chunk_index"], columns)


def replace_children(
    current: DataFrame, batch: DataFrame, parent: str = "source_id", parents: DataFrame | None = None
) -> DataFrame:
    """Drop all rows of the given parents, then add the batch."""
    replaced = (batch if parents is None else parents).select(parent).distinct()
    return current.join(replaced, parent, "left_anti").unionByName(batch, allowMissingColumns=True)


def delete_outcomes(
    sources: DataFrame, requests: DataFrame, deletable: str = fixed.NOTE_KIND
) -> DataFrame:
    """Per requested source: ``deleted`` and the reason when it was not."""
    kind = F.col("kind")
    reason = F.when(kind.isNull(), F.lit(fixed.NOT_FOUND)).when(
        kind != deletable, F.concat(F.lit("refuse: kind="), kind, F.lit(" cannot be deleted via MCP"))
    )
    asked = requests.select("source_id").distinct()
    return asked.join(sources.select("source_id", "kind"), "source_id", "left").select(
        "source_id", reason.isNull().alias("deleted"), reason.alias("reason")
    )


def delete_replies(outcomes: DataFrame) -> DataFrame:
    """Per request the JSON answer: deleted with the id, or not deleted with the reason."""
    named = F.when(F.col("deleted"), F.col("source_id")).alias("source_id")
    return outcomes.select("source_id", F.to_json(F.struct("deleted", "reason", named)).alias("reply"))


def guarded_delete(
    sources: DataFrame, chunks: DataFrame, requests: DataFrame, deletable: str = fixed.NOTE_KIND
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Outcomes, remaining sources, remaining chunks. Chunks go with their source."""
    outcomes = delete_outcomes(sources, requests, deletable)
    gone = outcomes.filter("deleted").select("source_id")
    return (
        outcomes,
        sources.join(gone, "source_id", "left_anti"),
        chunks.join(gone, "source_id", "left_anti"),
    )


def prepare_notes(requests: DataFrame) -> DataFrame:
    """Note requests (``content, tags, title``) to source rows; blank content is rejected."""
    return (
        requests.filter(tx.strip(F.col("content")) != "")
        .withColumn("text", tx.redact(F.col("content")))
        .withColumn("redacted_hits", tx.redaction_hits(F.col("content"), F.col("text")))
        .withColumn("title", tx.note_title(F.col("title"), F.col("text")))
        .withColumns(
            {
                "kind": F.lit(fixed.NOTE_KIND),
                "origin": F.concat_ws(
                    ":", F.lit("note"), F.col("title"), F.length("text").cast("string")
                ),
                "tags": F.coalesce("tags", F.array().cast("array<string>")),
            }
        )
        .withColumn("metadata", F.to_json(F.struct("tags", "redacted_hits")))
        .drop("content")
    )


def rejected_notes(requests: DataFrame) -> DataFrame:
    """The requests without content, with all their columns and the ``error`` they are answered with."""
    blank = F.coalesce(tx.strip(F.col("content")), F.lit("")) == ""
    return requests.filter(blank).withColumn("error", F.lit(fixed.EMPTY_CONTENT))


def add_notes(
    requests: DataFrame,
    sources: DataFrame,
    chunks: DataFrame,
    order: Sequence[str],
    now: Column,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Receipts, next sources, next chunks. New chunks wait for their vectors.

    The prepared notes are saved: numbering and the three results go over
    them several times, but the texts are redacted once.
    """
    keys = ["kind", "origin"]
    notes = saved(last_per_key(prepare_notes(requests), keys, order), "notes")
    known = sources.select(*keys, F.col("source_id").alias("_known"))
    owned = (
        _with_new_ids(sources, notes)
        .join(known, keys, "left")
        .withColumn("source_id", F.coalesce("_known", "source_id"))
        .drop("_known")
    )
    batch = owned.select(
        "source_id", *keys, "title", "metadata", now.alias("created_at"), now.alias("updated_at")
    )
    next_sources = upsert(sources, batch, keys, ["title", "metadata", "updated_at"])
    pieces = chunking.chunk_documents(owned, "text", ["source_id", "metadata"])
    added = pieces.withColumn("chunk_id", chunking.chunk_id(F.col("source_id"), F.col("chunk_index")))
    next_chunks = replace_children(chunks, added, parents=owned)
    counts = added.groupBy("source_id").agg(F.count("*").alias("chunk_count"))
    receipts = owned.join(counts, "source_id", "left").select(
        "source_id",
        F.coalesce("chunk_count", F.lit(0).cast("bigint")).alias("chunk_count"),
        "redacted_hits",
        "title",
        F.lit(fixed.NOTE_STATUS).alias("status"),
    )
    return receipts, next_sources, next_chunks


def touch(
    current: DataFrame, seen: DataFrame, keys: Sequence[str], column: str, value: Column
) -> DataFrame:
    """Set one column on every row whose key is in ``seen``."""
    marks = seen.select(*keys).distinct().withColumn("_hit", F.lit(True))
    changed = F.when(F.col("_hit"), value).otherwise(F.col(column))
    return current.join(marks, list(keys), "left").withColumn(column, changed).drop("_hit")


def fold_runs(log: DataFrame, key: str = "run_id") -> DataFrame:
    """Current state of every run from its opening and closing records."""
    at = F.coalesce("finished_at", "started_at")
    closing = F.col("finished_at").isNotNull()
    others = [c for c in log.columns if c not in (key, "started_at")]
    last = F.max_by(F.struct(*others), F.struct(closing, at))
    return (
        log.groupBy(key)
        .agg(F.min("started_at").alias("started_at"), last.alias("_last"))
        .select(key, "started_at", "_last.*")
    )


def with_new_columns(old: DataFrame, new: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Union of two schema versions; rows without a column get its default."""
    both = old.unionByName(new, allowMissingColumns=True)
    return both.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()})
