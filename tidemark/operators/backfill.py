"""Embedding backlog: what is pending, in which order, and filling it in."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import fixed

# texts, mode ("query" or "document") -> one vector per text, or None on failure.
Embedder = Callable[[Sequence[str], str], "list[list[float]] | None"]

_WORD = re.compile(r"\w+")


def _slot(word: str) -> tuple[int, float]:
    digest = hashlib.md5(word.encode()).hexdigest()
    return int(digest[:4], 16), 1.0 if int(digest[4], 16) < 8 else -1.0


def hashing_embedder(dim: int = 64) -> Embedder:
    """Deterministic stand-in for a model: signed word counts, scaled to length one."""

    def embed(texts: Sequence[str], mode: str) -> list[list[float]]:
        out = np.zeros((len(texts), dim))
        slots: dict[str, tuple[int, float]] = {}
        for row, text in zip(out, texts):
            for word in _WORD.findall(text.lower()):
                if word not in slots:
                    slots[word] = _slot(word)
                slot, sign = slots[word]
                row[slot % dim] += sign
        lengths = np.linalg.norm(out, axis=1, keepdims=True)
        return (out / np.where(lengths > 0, lengths, 1.0)).tolist()

    return embed


def embed_chunks(
    chunks: DataFrame,
    embedder: Embedder,
    id_col: str = "chunk_id",
    mode: str = "document",
    batch: int = fixed.EMBED_BATCH,
    failed_text: bool = False,
) -> DataFrame:
    """(id, embedding) for every row; a failed call leaves its texts without vectors.

    With ``failed_text`` also ``text``, but only where the call failed.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found: list = []
            for start in range(0, len(rows), batch):
                texts = rows["text"].iloc[start : start + batch].tolist()
                vectors = embedder(texts, mode)
                found.extend([None] * len(texts) if vectors is None else vectors)
            out = {id_col: rows[id_col].to_numpy(), "embedding": found}
            if failed_text:
                out["text"] = [text if vector is None else None for text, vector in zip(rows["text"], found)]
            yield pd.DataFrame(out)

    id_type = dict(chunks.dtypes)[id_col]
    schema = f"{id_col} {id_type}, embedding array<float>" + ", text string" * failed_text
    return chunks.select(id_col, "text").mapInPandas(run, schema)


def pending(chunks: DataFrame) -> DataFrame:
    return chunks.filter(F.col("embedding").isNull())


def fifo_batch(chunks: DataFrame, size: int = fixed.FIFO_BATCH) -> DataFrame:
    """Oldest pending chunks."""
    return pending(chunks).select("chunk_id", "text").orderBy("chunk_id").limit(size)


def priority_batch(
    chunks: DataFrame,
    sources: DataFrame,
    size: int = fixed.BACKFILL_BATCH,
    first_kind: str = fixed.NOTE_KIND,
) -> DataFrame:
    """Pending notes newest first, then everything else oldest first."""
    owner = sources.select("source_id", (F.col("kind") == first_kind).alias("is_note"))
    rows = pending(chunks).join(owner, "source_id")
    order = [
        F.when(F.col("is_note"), 0).otherwise(1),
        F.when(F.col("is_note"), -F.col("chunk_id")).otherwise(F.col("chunk_id")),
    ]
    return rows.orderBy(*order).limit(size).select("chunk_id", "text", "is_note")


def pending_of_kind(
    chunks: DataFrame, sources: DataFrame, kind: str = fixed.NOTE_KIND
) -> DataFrame:
    """All pending chunks of one kind of source, in id order."""
    owner = sources.filter(F.col("kind") == kind).select("source_id")
    rows = pending(chunks).join(owner, "source_id", "left_semi")
    return rows.select("chunk_id", "text").orderBy("chunk_id")


def batch_label(
    batch: DataFrame, chunks: DataFrame, sources: DataFrame, first_kind: str = fixed.NOTE_KIND
) -> DataFrame:
    """Kinds of source in a batch, and ``NOTE`` or ``queue`` as its label."""
    theirs = chunks.join(F.broadcast(batch.select("chunk_id")), "chunk_id", "left_semi")
    kinds = sources.join(theirs.select("source_id").distinct(), "source_id", "left_semi")
    found = F.collect_set("kind")
    return kinds.agg(F.array_sort(found).alias("kinds")).withColumn(
        "label", F.when(F.array_contains("kinds", first_kind), "NOTE").otherwise("queue")
    )


def write_back(chunks: DataFrame, vectors: DataFrame, id_col: str = "chunk_id") -> DataFrame:
    """Set the new vectors by chunk id; other chunks keep what they have."""
    new = vectors.select(id_col, F.col("embedding").alias("_new"))
    merged = F.coalesce(F.col("_new"), F.col("embedding"))
    return chunks.join(new, id_col, "left").withColumn("embedding", merged).drop("_new")


def progress(batches: DataFrame, chunks: DataFrame) -> DataFrame:
    """Processed, remaining, chunks per minute and minutes left.

    ``batches`` has one row per finished batch: ``n_chunks, started_at, finished_at``.
    """
    seconds = (
        F.unix_micros(F.max("finished_at")) - F.unix_micros(F.min("started_at"))
    ) / F.lit(1_000_000.0)
    totals = batches.agg(F.sum("n_chunks").alias("processed"), seconds.alias("seconds"))
    rate = F.try_divide(F.col("processed") * 60.0, F.col("seconds"))
    return totals.select(
        "processed",
        pending(chunks).agg(F.count("*")).scalar().alias("remaining"),
        rate.alias("per_minute"),
    ).withColumn("minutes_left", F.try_divide(F.col("remaining"), F.col("per_minute")))
