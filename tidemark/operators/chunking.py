"""Documents and conversation turns to chunks."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import text as tx
from tidemark.operators import ordered

# 2^21 windows of one document cover the longest string Spark can hold.
CHUNKS_PER_SOURCE = 2_097_152


def chunk_id(source_id: Column, chunk_index: Column) -> Column:
    """Surrogate id from the natural key: stable, ordered, free of collisions."""
    return source_id * F.lit(CHUNKS_PER_SOURCE) + chunk_index


def with_pieces(
    df: DataFrame,
    text: str,
    target: int = fixed.TARGET_CHARS,
    overlap: int = fixed.OVERLAP_CHARS,
    min_chars: int = fixed.MIN_CHARS,
) -> DataFrame:
    """Add ``pieces``: overlapping windows of ``text``, trimmed, scraps dropped.

    The text is cut once into blocks of one step, and a window is its block
    plus the head of the next. Cost is linear in the text; taking substrings
    by offset would rescan the text from its start for every window.
    """
    if not 0 <= overlap < target:
        raise ValueError("overlap must be at least 0 and below target")
    step = target - overlap
    span = math.ceil(overlap / step)

    def window(block: Column, i: Column) -> Column:
        if span <= 1:
            rest = F.coalesce(F.get("_blocks", i + 1), F.lit(""))
        else:
            rest = F.array_join(F.slice("_blocks", i + 2, F.lit(span)), "")
        return tx.strip(F.concat(block, F.left(rest, F.lit(overlap))))

    # A block opens a window unless the window before it already reaches the end.
    opens = lambda w, i: (i == 0) | (i * step + overlap < F.col("_chars"))
    return (
        df.withColumn("_body", tx.strip(F.col(text)))
        .withColumns(
            {
                "_chars": F.length("_body"),
                "_blocks": F.regexp_extract_all("_body", F.lit(f"(?s).{{1,{step}}}"), F.lit(0)),
            }
        )
        .withColumn("_windows", F.filter(F.transform("_blocks", window), opens))
        .withColumn("pieces", F.filter("_windows", lambda p: F.length(p) >= min_chars))
        .drop("_body", "_chars", "_blocks", "_windows")
    )


def chunk_documents(
    sources: DataFrame, text: str = "text", keep: Sequence[str] = ("source_id",), **sizes: int
) -> DataFrame:
    """One row per chunk: the kept columns, ``chunk_index``, ``text``, ``token_count``."""
    return chunks_of_pieces(with_pieces(sources.select(*dict.fromkeys([*keep, text])), text, **sizes), keep)


def chunks_of_pieces(pieces: DataFrame, keep: Sequence[str] = ("source_id",)) -> DataFrame:
    """The chunks of rows that have ``pieces``."""
    # The outer form, because Spark would turn the inner one into a filter on
    # the size of the array and compute all windows a second time for it.
    rows = pieces.select(*keep, F.posexplode_outer("pieces").alias("chunk_index", "piece"))
    return rows.filter(F.col("piece").isNotNull()).select(
        *keep,
        F.col("chunk_index").cast("int").alias("chunk_index"),
        F.col("piece").alias("text"),
        F.length("piece").alias("token_count"),
    )


def pair_turns(
    messages: DataFrame,
    keys: Sequence[str] = ("session",),
    bucket: str = "bucket",
    order: str = "seq",
) -> DataFrame:
    """Messages (``role, text, turn_id, ts``) to turns, one per opener.

    A user message opens a turn and takes the next kept message if that is
    the assistant's; an assistant message that follows no user message is a
    turn of its own.
    """
    kept = messages.filter(F.col("role").isin("user", "assistant") & (tx.strip(F.col("text")) != ""))
    rows = ordered.with_neighbours(kept, keys, bucket, order, ["role", "text"])
    is_user = F.col("role") == "user"
    opener = is_user | F.coalesce(F.col("prev.role") != "user", F.lit(True))
    answer = F.when(is_user & (F.col("next.role") == "assistant"), F.col("next.text")).when(
        ~is_user, F.col("text")
    )
    return rows.filter(opener).select(
        *keys,
        bucket,
        order,
        "turn_id",
        "ts",
        F.when(is_user, F.col("text")).otherwise("").alias("user_text"),
        F.coalesce(answer, F.lit("")).alias("assistant_text"),
    )


def redact_turns(turns: DataFrame) -> DataFrame:
    """Redact both sides of every turn and add ``hits``."""
    return (
        turns.withColumns(
            {"_user": tx.redact(F.col("user_text")), "_asst": tx.redact(F.col("assistant_text"))}
        )
        .withColumn(
            "hits",
            tx.redaction_hits(F.col("user_text"), F.col("_user"))
            + tx.redaction_hits(F.col("assistant_text"), F.col("_asst")),
        )
        .withColumns({"user_text": F.col("_user"), "assistant_text": F.col("_asst")})
        .drop("_user", "_asst")
    )


def session_titles(
    turns: DataFrame,
    keys: Sequence[str] = ("session",),
    bucket: str = "bucket",
    order: str = "seq",
) -> DataFrame:
    """First line of the first turn with user text, per session."""
    line = F.when(
        F.col("user_text") != "", F.left(tx.first_line(F.col("user_text")), F.lit(fixed.TITLE_CHARS))
    )
    position = F.when(line.isNotNull(), F.struct(bucket, order))
    return turns.groupBy(*keys).agg(
        F.coalesce(F.min_by(line, position), F.lit(fixed.UNTITLED_SESSION)).alias("title"),
        F.count("*").alias("turn_count"),
    )


def chunk_turns(
    turns: DataFrame,
    keys: Sequence[str] = ("session",),
    bucket: str = "bucket",
    order: str = "seq",
) -> DataFrame:
    """Turns to chunks with a dense ``chunk_index`` per session.

    ``sub_chunk`` is NULL for a turn kept whole.
    """
    rendered = turns.withColumn(
        "rendered", tx.strip(tx.render_turn(F.col("user_text"), F.col("assistant_text")))
    )
    pieces = with_pieces(
        rendered.select(*keys, bucket, order, "turn_id", "ts", "rendered"), "rendered"
    ).withColumns(
        {
            "is_long": F.length("rendered") > fixed.TARGET_CHARS,
            "n_pieces": F.size("pieces"),
        }
    )
    placed = ordered.with_running_total(
        pieces.drop("rendered"), keys, bucket, order, "n_pieces", "base"
    )
    return placed.select(
        *keys, "turn_id", "ts", "is_long", "base", F.posexplode_outer("pieces").alias("sub", "text")
    ).filter(F.col("text").isNotNull()).select(
        *keys,
        (F.col("base") + F.col("sub")).cast("int").alias("chunk_index"),
        "turn_id",
        "ts",
        F.when(F.col("is_long"), F.col("sub")).alias("sub_chunk"),
        "text",
        F.length("text").alias("token_count"),
    )
