"""Reciprocal rank fusion and the search entry points built on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import text as tx
from tidemark.operators import lexical, vector
from tidemark.operators.batches import best_per_group


def ranked(hits: DataFrame, group: Sequence[str] = (), id_col: str = "chunk_id") -> DataFrame:
    """Add ``rank`` from 0 by score. Call it on lists that are already cut to k."""
    order = Window.partitionBy(*group).orderBy(F.desc("score"), id_col)
    return hits.withColumn("rank", F.row_number().over(order) - 1)


def rrf(
    lists: Sequence[DataFrame],
    k: int = fixed.RRF_K,
    group: Sequence[str] = (),
    id_col: str = "chunk_id",
) -> DataFrame:
    """Fuse ranked lists by the sum of 1/(k + rank), rank counted from 0.

    ``score``, ``first_list`` and ``first_rank`` come from the first list
    that holds the id; they also decide ties.
    """
    rows = None
    for position, hits in enumerate(lists):
        part = hits.select(*group, id_col, "rank", "score", F.lit(position).alias("list"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy(*group, id_col).agg(
        F.sum(F.lit(1.0) / (F.lit(float(k)) + F.col("rank"))).alias("fusion_score"),
        F.min_by("score", "list").alias("score"),
        F.min("list").alias("first_list"),
        F.min_by("rank", "list").alias("first_rank"),
    )


_FUSED_ORDER = (F.desc, "fusion_score"), (F.asc, "first_list"), (F.asc, "first_rank")


def _fused_order():
    return [direction(name) for direction, name in _FUSED_ORDER]


def with_sources(hits: DataFrame, chunks: DataFrame, sources: DataFrame) -> DataFrame:
    """Attach chunk text and source fields to a list of at most a few hundred hits."""
    rows = chunks.select("chunk_id", "source_id", "chunk_index", "text")
    owner = sources.select("source_id", "kind", "origin", "title")
    found = rows.join(F.broadcast(hits), "chunk_id")
    return owner.join(F.broadcast(found), "source_id")


def search(
    spark: SparkSession,
    chunks: DataFrame,
    sources: DataFrame,
    query: str,
    query_vector: Sequence[float] | None,
    limit: int = 10,
    kind: str | None = None,
    index: DataFrame | None = None,
    vectors: DataFrame | None = None,
) -> DataFrame:
    """Hybrid top-``limit`` chunks; lexical only when there is no query vector.

    ``index`` holds stored postings; without it the texts are scanned.
    ``vectors`` holds the embedded chunks where ``chunks`` has no vectors.

    The lists are cut to twice the limit before fusion, so everything after
    the two top-k steps handles at most 200 rows. Texts join in at the end.
    """
    limit = max(1, min(limit, fixed.SEARCH_LIMIT_MAX))
    fetch = limit * fixed.OVERFETCH
    terms = lexical.query_terms(spark, query)
    if index is None:
        index = lexical.scan(chunks, terms, ["chunk_id", "source_id"])
    lists = []
    if query_vector is not None:
        lists.append(ranked(vector.vector_topk(chunks if vectors is None else vectors, query_vector, fetch, sources, kind)))
    lists.append(ranked(lexical.lexical_topk(index, terms, fetch, sources, kind)))
    best = rrf(lists).orderBy(*_fused_order()).limit(limit)
    return with_sources(best, chunks, sources).orderBy(*_fused_order())


def search_batch(
    chunks: DataFrame,
    queries: DataFrame,
    k: int = 3,
    key: str = "query_id",
    index: DataFrame | None = None,
    vectors: DataFrame | None = None,
) -> DataFrame:
    """Hybrid top-k for every row of ``queries`` (``key, query, embedding``).

    ``index`` holds stored postings; without it they are made from the texts.
    ``vectors`` holds the embedded chunks where ``chunks`` has no vectors.
    The postings and the vectors are each read once for all queries; a cell
    leaves at most ``2 * k`` rows per query.
    """
    index = lexical.postings(chunks) if index is None else index
    fetch = k * fixed.OVERFETCH
    by_vector = vector.vector_topk_batch(chunks if vectors is None else vectors, queries, fetch, key)
    by_word = lexical.lexical_topk_batch(index, queries, fetch, key)
    fused = rrf([by_vector, by_word], group=[key])
    return best_per_group(fused, [key], _fused_order(), k, "position")


def preview(hits: DataFrame) -> DataFrame:
    """Short title and text of every hit, on one line each."""
    return hits.withColumns(
        {
            "short_title": tx.preview_title(F.col("title")),
            "short_text": tx.preview_text(F.col("text")),
        }
    )
