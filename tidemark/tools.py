"""The five corpus tools: search, get_document, add_note, list_sources, delete_note.

Each takes tables and returns tables; ``as_json`` gives the wire form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.operators import corpus, fusion, keyed


def search(
    spark: SparkSession,
    chunks: DataFrame,
    sources: DataFrame,
    query: str,
    query_vector: Sequence[float] | None = None,
    limit: int = 10,
    kind: str | None = None,
    index: DataFrame | None = None,
) -> DataFrame:
    """Best chunks for a query, best first, with the score rounded for display."""
    hits = fusion.search(spark, chunks, sources, query, query_vector, limit, kind, index)
    return hits.select(
        F.col("chunk_id").alias("id"),
        "source_id",
        F.col("kind").alias("source_kind"),
        F.col("origin").alias("source_origin"),
        F.col("title").alias("source_title"),
        "chunk_index",
        "text",
        F.round("fusion_score", fixed.SCORE_PLACES).alias("fusion_score"),
    )


def get_document(sources: DataFrame, chunks: DataFrame, source_id: int) -> DataFrame:
    """A source and its chunks in order; no rows when there is no such source."""
    return corpus.get_document(sources, chunks, source_id)


def get_document_head(
    spark: SparkSession, sources: DataFrame, chunks: DataFrame, source_id: int
) -> DataFrame:
    """One row in any case: the source with its chunk count, or the error."""
    request = spark.createDataFrame([(source_id,)], "source_id bigint")
    return corpus.document_heads(sources, chunks, request)


def add_note(
    spark: SparkSession,
    sources: DataFrame,
    chunks: DataFrame,
    content: str,
    tags: Sequence[str] = (),
    title: str | None = None,
    now: Column | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Receipt, next sources, next chunks. Blank content gives no receipt and changes nothing."""
    schema = "content string, tags array<string>, title string, at int"
    request = spark.createDataFrame([(content, list(tags), title, 0)], schema)
    at = F.current_timestamp() if now is None else now
    return keyed.add_notes(request, sources, chunks, ["at"], at)


def note_reply(spark: SparkSession, receipt: DataFrame, content: str | None) -> DataFrame:
    """The JSON answer to ``add_note``: its receipt, or the error of blank content."""
    request = spark.createDataFrame([(content,)], "content string")
    return as_json(receipt).unionByName(as_json(keyed.rejected_notes(request).select("error")))


def list_sources(
    sources: DataFrame, chunks: DataFrame, kind: str | None = None, limit: int = 20
) -> DataFrame:
    """Newest sources with their chunk counts."""
    rows = corpus.list_sources(sources, chunks, kind, limit)
    return rows.select(
        F.col("source_id").alias("id"), "kind", "origin", "title", "created_at", "chunk_count"
    )


def delete_note(
    spark: SparkSession, sources: DataFrame, chunks: DataFrame, source_id: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Outcome, remaining sources, remaining chunks."""
    request = spark.createDataFrame([(source_id,)], "source_id bigint")
    return keyed.guarded_delete(sources, chunks, request)


def as_json(rows: DataFrame) -> DataFrame:
    """One JSON object per row, in the order of the rows."""
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("json"))


def as_json_list(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The rows of one answer as one JSON array, ``[]`` without rows. For answers with a limit."""
    place = F.row_number().over(Window.orderBy(*order))
    numbered = rows.select(place.alias("at"), F.struct(*rows.columns).alias("row"))
    entries = F.transform(F.array_sort(F.collect_list(F.struct("at", "row"))), lambda e: e["row"])
    return numbered.agg(F.to_json(entries).alias("json"))
