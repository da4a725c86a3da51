"""A pipeline over ``documents``: each stage reads what its predecessor wrote.

Stages take ``(spark, docs, sf_dir)``. All but the last return the columns of
``documents``; the last adds the pieces of each text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, line_dedup, pieces, quality, rows, simhash
from tidemark.sources import workdir

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# A line that stands in this many documents is boilerplate.
MIN_DOCS = 10
# Near copies share 80 % of their distinct shingles of five words.
SHINGLE, SIMILAR = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the thresholds of their language and source."""
    return quality.quality_filter(docs)


def without_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the lines that stand in ``MIN_DOCS`` of them or more."""
    found = line_dedup.dedup_lines(docs, min_docs=MIN_DOCS)
    replaced = {"text": F.col("kept"), "n_chars": F.length("kept").cast(docs.schema["n_chars"].dataType)}
    return found.select(*[replaced.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the smallest id."""
    return simhash.one_of_each(docs, shingle=SHINGLE, percent=SIMILAR)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, rows.table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with the ids of its best segmentation and its best scores."""
    found = pieces.encode(docs, PIECE_MODEL)
    return found.select("doc.*", "ids", F.size("ids").cast("long").alias("n_pieces"), "scores", "restored")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", without_common_lines),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", benchmark_leaks),
    ("sentencepiece", encoded),
]

# Fingerprints, templates and segmentations are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, writing each one's result."""
    docs = rows.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = workdir.saved(stage(spark, docs, sf_dir), name)
    return docs
