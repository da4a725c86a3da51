"""Files to rows: discovery, session logs, whole documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import blocks
from tidemark.functions import text as tx


def discover(
    spark: SparkSession,
    paths: Sequence[str] = (),
    globs: Sequence[str] = (),
    limit: int = 0,
    since: str | None = None,
) -> DataFrame:
    """Existing files of all patterns, once each, in pattern order: (path, modified, length).

    ``since`` keeps files changed at or after that day, UTC. ``limit`` 0 means all.
    Only the file listing is read, not the contents.
    """
    listing = None
    for position, pattern in enumerate([*paths, *globs]):
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        try:
            found = reader.load(pattern)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        rows = found.select(
            "path",
            F.col("modificationTime").alias("modified"),
            "length",
            F.lit(position).alias("position"),
        )
        listing = rows if listing is None else listing.unionByName(rows)
    if listing is None:
        return spark.createDataFrame([], "path string, modified timestamp, length bigint")
    files = listing.groupBy("path").agg(
        F.max("modified").alias("modified"),
        F.max("length").alias("length"),
        F.min("position").alias("position"),
    )
    files = modified_since(files, since)
    if limit > 0:
        files = files.orderBy("position", "path").limit(limit)
    return files.drop("position")


def modified_since(files: DataFrame, since: str | None, column: str = "modified") -> DataFrame:
    """Files whose modification second is at or after midnight UTC of ``since``."""
    if since is None:
        return files
    midnight = F.unix_seconds(F.lit(f"{since}T00:00:00Z").cast("timestamp"))
    return files.filter(F.unix_seconds(column) >= midnight)


def read_session_lines(
    spark: SparkSession,
    paths: Sequence[str] | str,
    session: Callable[[Column], Column] = lambda path: path,
    since: str | None = None,
) -> DataFrame:
    """JSON lines of session logs: (session, bucket, seq, event VARIANT).

    Blank and malformed lines are skipped. Lines are read by file split, not
    by file, so a huge log is shared by many tasks; ``bucket`` is the split
    and ``seq`` rises inside it, which together give the order of the lines.
    """
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .text(paths)
        .select(
            "value",
            "_metadata.file_path",
            "_metadata.file_block_start",
            F.col("_metadata.file_modification_time").alias("modified"),
            F.monotonically_increasing_id().alias("seq"),
        )
    )
    lines = modified_since(lines, since)
    text = tx.strip(F.make_valid_utf8("value"))
    return (
        lines.select(
            session(F.col("file_path")).alias("session"),
            F.struct("file_path", "file_block_start").alias("bucket"),
            "seq",
            F.try_parse_json(text).alias("event"),
        )
        .filter(F.col("event").isNotNull())
    )


def session_messages(lines: DataFrame) -> DataFrame:
    """Session events to messages: (session, bucket, seq, turn_id, ts, role, text)."""
    field = lambda path, kind="string": F.try_variant_get("event", path, kind)
    return lines.filter(field("$.type").isin("user", "assistant")).select(
        "session",
        "bucket",
        "seq",
        F.coalesce(field("$.uuid"), F.lit("")).alias("turn_id"),
        field("$.timestamp").alias("ts"),
        field("$.message.role").alias("role"),
        blocks.flatten_content(field("$.message.content", "variant")).alias("text"),
    )


def session_sources(
    titles: DataFrame, listing: DataFrame, kind: str = fixed.SESSION_KIND
) -> DataFrame:
    """Session titles (``session, title, turn_count``) to source rows.

    ``listing`` has ``session`` and ``modified``; a session in several files
    counts as changed with the last of them.
    """
    changed = listing.groupBy("session").agg(F.max("modified").alias("modified"))
    metadata = F.struct("turn_count", F.unix_seconds("modified").alias("file_mtime"))
    return titles.join(changed, "session", "left").select(
        F.lit(kind).alias("kind"),
        F.col("session").cast("string").alias("origin"),
        "title",
        F.to_json(metadata).alias("metadata"),
    )


def _joined(part_bytes: int):
    """Lines of one file and split put together to parts of some ``part_bytes``."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number, origin = [], 0, 0, None

        def part() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"path": [origin[0]], "block": [origin[1]], "number": [number], "text": ["\n".join(held)]}
            )

        for batch in batches:
            for path, block, line in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if held and ((path, block) != origin or size >= part_bytes):
                    yield part()
                    held, size, number = [], 0, number + 1
                origin = path, block
                held.append(line)
                size += len(line)
        if held:
            yield part()

    return join


def read_documents(
    spark: SparkSession,
    listing: DataFrame,
    roots: Sequence[str],
    max_bytes: int = fixed.DOCUMENT_BYTES,
    part_bytes: int = fixed.DOCUMENT_PART_BYTES,
) -> DataFrame:
    """Text of every listed file: (path, modified, part, text, error).

    Bad bytes become replacement characters. A file that is gone or fails when
    it is read keeps its row, with an error instead of text; the others do not
    notice. A file of more than ``max_bytes``, which no one value may hold, is
    streamed by its splits and comes in parts of some ``part_bytes`` that end with
    a line, numbered from 0; every other file is part 0. How a file falls into
    parts follows the session's split size: save the result to go over it twice.
    """
    isolated = {"recursiveFileLookup": "true", "ignoreMissingFiles": "true", "ignoreCorruptFiles": "true"}
    small = spark.read.format("binaryFile").options(**isolated).load(list(roots)).filter(F.col("length") <= max_bytes)
    valid = lambda value: F.make_valid_utf8(value.cast("string"))
    whole = small.select("path", F.lit(0).alias("part"), valid(F.col("content")).alias("text"))
    # The files' sizes are known from their listing: only large ones are opened.
    lines = spark.read.options(**isolated, lineSep="\n").text(list(roots)).filter(F.col("_metadata.file_size") > max_bytes)
    # This path is written as a URL, the listing's is not.
    plain = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    lines = lines.select(plain.alias("path"), F.col("_metadata.file_block_start").alias("block"), valid(F.col("value")).alias("line"))
    parts = lines.mapInArrow(_joined(part_bytes), "path string, block long, number long, text string")
    at = Window.partitionBy("path").orderBy("block", "number")  # one row per part
    parts = parts.select("path", (F.row_number().over(at) - 1).alias("part"), "text")
    key = lambda: F.regexp_replace("path", "^([a-z0-9]+):/+", "$1:/").alias("_key")
    contents = whole.unionByName(parts).select(key(), "part", "text")
    error = F.when(F.col("text").isNull(), F.lit("unreadable"))
    found = listing.select("*", key()).join(contents, "_key", "left").drop("_key")
    return found.withColumns({"part": F.coalesce("part", F.lit(0)), "error": error})


def file_sources(documents: DataFrame, kind: str) -> DataFrame:
    """Documents to source rows with redacted text; the path is the origin, for later parts with their number."""
    name = F.element_at(F.split("path", "/"), -1)
    return (
        documents.filter(F.col("error").isNull())
        .withColumn("raw", F.col("text"))
        .withColumn("text", tx.redact(F.col("raw")))
        .withColumn("hits", tx.redaction_hits(F.col("raw"), F.col("text")))
        .select(
            F.lit(kind).alias("kind"),
            F.when(F.col("part") > 0, F.concat_ws("#", "path", F.col("part").cast("string"))).otherwise(F.col("path")).alias("origin"),
            tx.document_title(F.col("text"), name).alias("title"),
            "path",
            "text",
            "hits",
            F.to_json(
                F.struct(F.unix_seconds("modified").alias("file_mtime"), F.length("text").alias("size"))
            ).alias("metadata"),
        )
    )


def file_results(documents: DataFrame, counted: DataFrame, embedded: DataFrame | None = None) -> DataFrame:
    """``path, chunks, hits, embedded, error`` of every listed file, read or not.

    ``counted`` has the chunks and hits of the files that were stored, and
    ``embedded`` the paths whose chunks got vectors in the same run.
    """
    rows = documents.groupBy("path").agg(F.max("error").alias("error"))
    sums = counted.groupBy("path").agg(F.sum("chunks").alias("chunks"), F.sum("hits").alias("hits"))
    rows = rows.join(sums, "path", "left")
    if embedded is None:
        return rows.withColumn("embedded", F.lit(False))
    done = embedded.select("path", F.lit(True).alias("embedded")).distinct()
    return rows.join(done, "path", "left").withColumn("embedded", F.coalesce("embedded", F.lit(False)))


def ingest_totals(results: DataFrame) -> DataFrame:
    """Totals over per-file results: ``path, chunks, hits, embedded, error``."""
    fine = F.col("error").isNull()
    return results.agg(
        F.count("*").alias("files"),
        F.sum(F.when(fine, F.col("chunks")).otherwise(0)).alias("chunks"),
        F.sum(F.when(fine, F.col("hits")).otherwise(0)).alias("hits"),
        F.count_if(fine & F.col("embedded")).alias("embedded_files"),
        F.count_if(~fine).alias("failed"),
    )


def first_failures(results: DataFrame, n: int = 10) -> DataFrame:
    failed = results.filter(F.col("error").isNotNull())
    return failed.select("path", "error").orderBy("path").limit(n)


def read_scans(spark: SparkSession, paths: Sequence[str], schema: str) -> list[DataFrame]:
    """One table per scan result that exists; a missing one is skipped."""
    scans = []
    for path in paths:
        try:
            scans.append(spark.read.schema(schema).parquet(path))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return scans
