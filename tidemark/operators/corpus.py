"""Documents, inventory and counts of the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import fixed


def chunk_counts(chunks: DataFrame) -> DataFrame:
    """Chunks per source; partial counts absorb a source that holds most chunks."""
    return chunks.groupBy("source_id").agg(F.count("*").alias("chunk_count"))


def with_chunk_counts(sources: DataFrame, chunks: DataFrame) -> DataFrame:
    """Every source with its chunk count, 0 included."""
    counted = sources.join(chunk_counts(chunks), "source_id", "left")
    return counted.withColumn("chunk_count", F.coalesce("chunk_count", F.lit(0).cast("bigint")))


def get_document(sources: DataFrame, chunks: DataFrame, source_id: int) -> DataFrame:
    """One source with its chunks, a row per chunk in order.

    No row means not found; a source without chunks gives one row with a
    NULL chunk. Rows, not one array: a document has no size limit.
    """
    one = F.col("source_id") == source_id
    parts = chunks.filter(one).select("source_id", "chunk_index", "text")
    head = with_chunk_counts(sources.filter(one), parts)
    # The head is one row: the chunks of a long document stay where they are.
    return parts.join(F.broadcast(head), "source_id", "right").select(*head.columns, "chunk_index", "text").orderBy("chunk_index")


def document_heads(sources: DataFrame, chunks: DataFrame, requests: DataFrame) -> DataFrame:
    """Per requested source its row with the chunk count; ``error`` is set where there is none."""
    asked = requests.select("source_id").distinct()
    found = with_chunk_counts(
        sources.join(asked, "source_id", "left_semi").withColumn("_found", F.lit(True)),
        chunks.join(asked, "source_id", "left_semi"),
    )
    error = F.when(F.col("_found").isNull(), F.lit(fixed.NOT_FOUND))
    return asked.join(found, "source_id", "left").withColumn("error", error).drop("_found")


def list_sources(
    sources: DataFrame, chunks: DataFrame, kind: str | None = None, limit: int = 20
) -> DataFrame:
    """Newest sources with their chunk counts.

    The limit comes first, so chunks are counted for at most 200 sources.
    """
    limit = max(1, min(limit, fixed.SOURCES_LIMIT_MAX))
    if kind is not None:
        sources = sources.filter(F.col("kind") == kind)
    newest = [F.desc("created_at"), F.asc("source_id")]
    recent = sources.orderBy(*newest).limit(limit)
    theirs = chunks.join(F.broadcast(recent.select("source_id")), "source_id", "left_semi")
    return with_chunk_counts(recent, theirs).orderBy(*newest)


def kind_counts(sources: DataFrame) -> DataFrame:
    return sources.groupBy("kind").agg(F.count("*").alias("n"))


def kind_counts_json(sources: DataFrame) -> DataFrame:
    """Sources per kind as one JSON object; kinds are a short fixed list."""
    entry = F.struct("kind", "n")
    pairs = kind_counts(sources).agg(F.array_sort(F.collect_list(entry)).alias("pairs"))
    return pairs.select(F.to_json(F.map_from_entries("pairs")).alias("by_kind"))


def corpus_stats(sources: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row: sources, chunks, embedded chunks, sources per kind."""
    totals = chunks.agg(
        F.count("*").alias("chunks_total"), F.count("embedding").alias("chunks_embedded")
    )
    return totals.select(
        sources.agg(F.count("*")).scalar().alias("sources_total"),
        "chunks_total",
        "chunks_embedded",
        F.coalesce(kind_counts_json(sources).scalar(), F.lit("{}")).alias("by_kind"),
    )
