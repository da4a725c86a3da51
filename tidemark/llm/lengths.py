"""Exact histogram of encoded lengths with suffix sums.

Each task encodes its texts and counts how many have each length; the counts
are merged by length. Suffix sums over the lengths, from the longest down,
answer for every context limit how many documents are longer, what they hold,
and what is left of all when each is cut at the limit.

Defined results: a missing or empty text has length 0. Rows that repeat count
each. An empty table has an empty histogram.
"""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import rows
from tidemark.sources import workdir

BLOCK = 1024


def ranks(spark: SparkSession, path: str) -> Broadcast:
    """The token ranks of a vocabulary file, sent to the tasks once; their size does not depend on the data."""
    path = path if "://" in path else f"file://{path}"
    content = bytes(spark.read.format("binaryFile").load(path).select("content").first()["content"])
    pairs = (line.split() for line in content.splitlines() if line)
    return spark.sparkContext.broadcast({base64.b64decode(token): int(rank) for token, rank in pairs})


def encoded_length(text: Column, vocabulary: Broadcast, pattern: str) -> Column:
    """Number of tokens of a text."""

    @F.arrow_udf("long")
    def length(texts: pa.Array) -> pa.Array:
        import tiktoken

        encoding = cached.get("encoding")
        if encoding is None:
            encoding = cached["encoding"] = tiktoken.Encoding(
                "own", pat_str=pattern, mergeable_ranks=vocabulary.value, special_tokens={}
            )
        return pa.array([len(encoding.encode_ordinary(x)) if x else 0 for x in texts.to_pylist()], pa.int64())

    cached: dict = {}
    return length(text)


def histogram(docs: DataFrame, length: Column) -> DataFrame:
    """(length, docs): how many documents have each length; a saved table."""
    counted = docs.select(length.cast("long").alias("length")).groupBy("length").agg(F.count("*").alias("docs"))
    return workdir.saved(counted, "lengths")


def suffix_sums(hist: DataFrame, block: int = BLOCK) -> DataFrame:
    """Add to each length what documents of that length or more are and hold, and the totals.

    Lengths are summed inside blocks of ``block`` lengths, and the blocks' sums
    are carried across: no task sees more than a block's lengths or one row per block.
    """
    blocked = hist.withColumns({"block": F.floor(F.col("length") / block), "tokens": F.col("length") * F.col("docs")})
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per_block = blocked.groupBy("block").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    base = per_block.select(
        "block",
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("tokens_after"),
        F.sum("d").over(everything).alias("all_docs"),
        F.sum("t").over(everything).alias("all_tokens"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    return (
        blocked.withColumns({"docs_from": F.sum("docs").over(inside), "tokens_from": F.sum("tokens").over(inside)})
        .join(base, "block")
        .select(
            "length",
            "docs",
            "tokens",
            (F.col("docs_from") + F.col("docs_after")).alias("docs_from"),
            (F.col("tokens_from") + F.col("tokens_after")).alias("tokens_from"),
            "all_docs",
            "all_tokens",
        )
    )


def by_limit(hist: DataFrame) -> DataFrame:
    """For every length as a context limit: who is longer, what cutting leaves, and the length's place.

    ``truncated_tokens`` is the sum of min(length, limit) over all documents.
    ``first_rank`` to ``last_rank`` are the places (from 1) of the documents of
    this length in the order of lengths, so that any quantile is the length
    whose ranks hold it.
    """
    longer, beyond = F.col("docs_from") - F.col("docs"), F.col("tokens_from") - F.col("tokens")
    return suffix_sums(hist).select(
        F.col("length").alias("context_limit"),
        "docs",
        "tokens",
        longer.alias("docs_longer"),
        (F.col("all_tokens") - beyond + F.col("length") * longer).alias("truncated_tokens"),
        (beyond - F.col("length") * longer).alias("lost_tokens"),
        (F.col("all_docs") - F.col("docs_from") + 1).alias("first_rank"),
        (F.col("all_docs") - longer).alias("last_rank"),
        "all_docs",
        "all_tokens",
    )


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, docs_longer, truncated_tokens) for any limits, also between the lengths."""
    asked = hist.sparkSession.createDataFrame([(int(x),) for x in limits], "context_limit long")
    longer = F.broadcast(asked).join(hist, F.col("length") > F.col("context_limit"), "left").groupBy("context_limit").agg(
        F.coalesce(F.sum("docs"), F.lit(0)).alias("docs_longer"),
        F.coalesce(F.sum(F.col("docs") * (F.col("length") - F.col("context_limit"))), F.lit(0)).alias("lost"),
    )
    total = hist.agg(F.sum(F.col("length") * F.col("docs"))).first()[0] or 0
    return longer.select("context_limit", "docs_longer", (F.lit(total) - F.col("lost")).alias("truncated_tokens"))


def quantiles(hist: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the least length that this share of the documents does not exceed."""
    asked = hist.sparkSession.createDataFrame([(float(x),) for x in shares], "share double")
    place = F.greatest(F.ceil(F.col("share") * F.col("all_docs")), F.lit(1))
    held = by_limit(hist).join(F.broadcast(asked), place.between(F.col("first_rank"), F.col("last_rank")))
    return held.select("share", F.col("context_limit").alias("length"))


rows.shipped(__name__)
