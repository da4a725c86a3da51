"""Registered queries: each operator over its whole table, reduced to its contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, fim, interpolation, lengths, line_dedup, negatives, pieces, quality, rows, shards, simhash, substrings, token_files, warc
from tidemark.sources import workdir


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rows.table(spark, sf_dir, "documents")
    return substrings.without_repeats(docs.select("doc_id", "text")).select(
        "doc.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rows.table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = pieces.encode(docs, PIECE_MODEL)
    return encoded.select(
        "doc.doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        "scores",
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.to_json("runner_up").alias("runner_up"),
        "restored",
    )


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (rows.table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontaminate.leaks(docs, benchmark).drop("text_hash")


def op6_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rows.table(spark, sf_dir, "documents")
    return shards.sharded(docs, SHARDS).select(
        "doc.doc_id",
        "size",
        F.crc32(rows.text_of("doc.text").cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rows.table(spark, sf_dir, "documents")
    vocabulary = lengths.ranks(spark, RANKS)
    length = lengths.encoded_length(F.col("text"), vocabulary, SPLIT_PATTERN)
    return lengths.by_limit(lengths.histogram(docs, length))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = rows.table(spark, sf_dir, "pages")
    archive = workdir.new_dir(spark, "warc")
    warc.write(pages, archive)
    found = warc.records(spark, archive)
    number = lambda name: F.regexp_extract(name, "<urn:x-page:(-?[0-9]+)>", 1)
    return found.select(
        F.nullif(number("record_id"), F.lit("")).cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.nullif(number("refers_to"), F.lit("")).cast("long").alias("refers_to"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rows.table(spark, sf_dir, "documents")
    measured = workdir.saved(quality.measure(docs, keep=F.struct("doc_id")), "quality")
    return quality.judged(measured).select(
        "doc.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the byte-level vocabulary splits a text before merging.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SHARDS = 24
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
END_ID = 2


def op1_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rows.table(spark, sf_dir, "documents")
    rest = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7
    # Remainder 2 is not trained on; of the rest, 3 is deleted from the counts to learn the weights.
    role = (
        F.when(rest == 2, interpolation.TEST).when(rest == 3, interpolation.DELETED).otherwise(interpolation.COUNTED)
    )
    return interpolation.scored(docs, role).select(
        F.col("id").alias("doc_id"),
        (F.col("role") == interpolation.TEST).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rows.table(spark, sf_dir, "documents")
    return line_dedup.dedup_lines(docs).select(
        "doc.doc_id",
        F.size(F.split(rows.text_of("doc.text"), "\n")).cast("long").alias("n_lines"),
        "n_dropped",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rows.table(spark, sf_dir, "documents")
    marked = workdir.saved(docs.select("doc_id", simhash.fingerprint(F.col("text")).alias("fp")), "fingerprints")
    return simhash.clusters(marked).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rows.table(spark, sf_dir, "documents")
    made = fim.transformed(docs.select("doc_id", "text"))
    return made.select(
        "doc.doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = rows.table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.select("vec_id", "embedding", moved.alias("label")), F.col("vec_id") % 50 == 0)


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rows.table(spark, sf_dir, "documents")
    folder = workdir.new_dir(spark, "tokens")
    token_files.write(docs, folder, TOKENIZER, END_ID)
    return token_files.read(spark, folder).select("doc_id", "start", "n_tokens", token_files.crc32(F.col("ids")).alias("ids_crc32"))


QUERIES = {
    "op1_interpolation": op1_interpolation,
    "op2_line_dedup": op2_line_dedup,
    "op3_repeats": op3_repeats,
    "op4_pieces": op4_pieces,
    "op5_decontaminate": op5_decontaminate,
    "op6_histogram_sort": op6_histogram_sort,
    "op7_token_lengths": op7_token_lengths,
    "op8_warc": op8_warc,
    "op9_quality_rules": op9_quality_rules,
    "op10_simhash": op10_simhash,
    "op11_fim": op11_fim,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_token_files": op13_token_files,
}
