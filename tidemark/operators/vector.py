"""Exact vector search: one query as an expression, many queries as a grid of blocks."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import vectors as vx
from tidemark.functions.once import computed_once
from tidemark.operators.batches import QUERY_BLOCK_ROWS, SCORES_IN_MEMORY, BestRows, best_of_cells, best_table, grid
from tidemark.operators.lexical import top


def with_norm(chunks: DataFrame, vector: str = "embedding") -> DataFrame:
    """Store the norm beside the vector, so that no search computes it again."""
    return chunks.withColumn("norm", vx.norm(F.col(vector)))


def vector_scores(
    chunks: DataFrame,
    query: Sequence[float],
    keep: Sequence[str] = ("chunk_id", "source_id"),
    vector: str = "embedding",
) -> DataFrame:
    """Cosine similarity of every embedded chunk to one query vector."""
    if "norm" not in chunks.columns:
        chunks = with_norm(chunks, vector)
    length = float(np.sqrt(sum(float(v) * float(v) for v in query)))
    score = vx.cosine(F.col(vector), vx.literal(query), F.col("norm"), F.lit(length))
    scored = computed_once(chunks.filter(F.col(vector).isNotNull()), "score", F.round(score, 12))
    return scored.filter(F.col("score").isNotNull()).select(*keep, "score")


def vector_topk(
    chunks: DataFrame,
    query: Sequence[float],
    k: int,
    sources: DataFrame | None = None,
    kind: str | None = None,
    keep: Sequence[str] = ("chunk_id", "source_id"),
) -> DataFrame:
    """Best k chunks by cosine, only among sources of ``kind`` if given."""
    if kind is not None:
        wanted = sources.filter(F.col("kind") == kind).select("source_id")
        chunks = chunks.join(wanted, "source_id", "left_semi")
    return top(vector_scores(chunks, query, keep), k)


def _unit(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of one length as rows of length one, and their lengths."""
    values = column.combine_chunks()
    matrix = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)
    lengths = np.linalg.norm(matrix, axis=1)
    return matrix / np.where(lengths > 0, lengths, 1.0)[:, None], lengths


def _nearest(k: int, key: str, id_col: str):
    """Cell task: the k best rows by cosine of every query."""

    def task(asked: pa.Table, rows: pa.Table) -> pa.Table:
        best, keys = BestRows(asked.num_rows, k), asked.column(key).combine_chunks()
        if asked.num_rows and rows.num_rows:
            queries, _ = _unit(asked.column("embedding"))
            matrix, lengths = _unit(rows.column("embedding"))
            usable = lengths > 0
            matrix, ids = matrix[usable], rows.column(id_col).to_numpy()[usable]
            step = max(1, SCORES_IN_MEMORY // len(queries))
            for start in range(0, len(ids), step):
                cosines = np.round(queries @ matrix[start : start + step].T, 12)
                for number, found in enumerate(cosines):
                    best.add(number, found, ids[start : start + step])
        return best_table(best, keys, key, id_col)

    return task


def vector_topk_batch(
    chunks: DataFrame,
    queries: DataFrame,
    k: int,
    key: str = "query_id",
    id_col: str = "chunk_id",
    block_rows: int = QUERY_BLOCK_ROWS,
    shared: Sequence[str] = (),
) -> DataFrame:
    """Best k chunks for each of many queries: (key, id, score, rank from 0).

    A grid of query blocks and chunk blocks; see ``batches``. With ``shared``
    columns a query meets only the chunks that agree in them.
    """
    embedding = F.col("embedding").cast("array<double>").alias("embedding")
    usable = queries.select(key, *shared, embedding).filter(vx.norm(F.col("embedding")) > 0)
    embedded = chunks.filter(F.col("embedding").isNotNull()).select(id_col, *shared, "embedding")
    schema = f"{key} {dict(queries.dtypes)[key]}, {id_col} long, score double"
    cells = grid(embedded, usable, id_col, key, _nearest(k, key, id_col), schema, shared, query_rows=block_rows)
    return best_of_cells(cells, key, id_col, k)
