"""WARC archives: written as one record per page, read by boundary-chain verification.

Archives are read in splits. Every place where the magic stands is a candidate
for the start of a record, also inside a payload that quotes an archive. A
task cuts its split at the magics, parses the header behind each and emits
where that record would end, which is where its successor starts. Offsets come
of the lengths of all that stands before. Pointer jumping from the start of
each file then marks what the chain reaches, in a number of rounds that is the
logarithm of the records of a file: in each round, every candidate's pointer
skips twice as far, and what a marked candidate points to is marked as well.
Only marked candidates are records. A payload that holds magics is put together
again from its fragments.

Defined results: a missing page is an empty one. A page without id is always a
response and its record has no number. Of rows that tie in id and page, each is
a response when the id is the smallest of that page. Line breaks in an address
are removed. What stands behind a break in the chain of a file is not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.llm import rows
from tidemark.sources import workdir

MAGIC = "WARC/1.1\r\n"
GAP = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REACH = 1 << 20


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a text in upper-case base 32."""
    # Five hexadecimal digits are four of base 32.
    parts = lambda h: [F.lpad(F.conv(F.substring(h, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    digits = rows.let(F.sha1(payload.cast("binary")), lambda h: F.concat(*parts(h)))
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def revisits(pages: DataFrame, page_id: str = "page_id", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload a page of smaller id has; a saved table."""
    payload = rows.text_of(html)
    seen = workdir.saved(
        pages.filter(F.octet_length(payload) >= min_bytes).select(F.col(page_id).alias("page_id"), base32_sha1(payload).alias("digest")),
        "digests",
    )
    groups = seen.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
    groups = workdir.saved(groups.filter("last > refers_to").drop("last"), "groups")
    return workdir.saved(seen.join(groups, "digest").filter("page_id > refers_to").distinct(), "revisits")


def write(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> None:
    """Write a response or revisit record for each page; one file per task."""
    payload = rows.text_of(html)
    known = revisits(pages, page_id, html, min_bytes).select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "refers_to")
    told = pages.select(
        F.col(page_id).alias("page_id"),
        F.regexp_replace(F.coalesce(F.col(url), F.lit("")), "[\r\n]", "").alias("url"),
        payload.alias("payload"),
        base32_sha1(payload).alias("digest"),
    )
    met = told.join(known, (F.col("page_id") == F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
    again = F.col("refers_to").isNotNull()
    name = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(GAP),
    )
    block = F.concat(http, F.when(again, F.lit("")).otherwise(F.col("payload")))
    record = rows.let(
        block,
        lambda b: F.concat(
            F.lit(MAGIC + "WARC-Type: "),
            F.when(again, "revisit").otherwise("response"),
            F.lit("\r\nWARC-Record-ID: "),
            name(F.col("page_id")),
            F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "),
            F.col("url"),
            F.lit("\r\nWARC-Payload-Digest: sha1:"),
            F.col("digest"),
            F.when(again, F.concat(F.lit("\r\nWARC-Refers-To: "), name(F.col("refers_to")), F.lit(f"\r\nWARC-Profile: {PROFILE}"))).otherwise(""),
            F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "),
            F.octet_length(b).cast("string"),
            F.lit(GAP),
            b,
            # The writer ends each line with the last of the four characters.
            F.lit(GAP[:-1]),
        ),
    )
    met.select(record.alias("value")).write.option("lineSep", GAP[-1]).text(path)


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, place, value): what stands between magics, in the order of ``place`` in each block."""
    lines = spark.read.option("lineSep", MAGIC).text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )


def _field(header: Column, name: str) -> Column:
    return F.regexp_extract(header, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)


def _parsed(value: Column) -> Column:
    """Header fields, lengths, and the payload's size and digest, of a text that starts behind a magic."""

    def of(header: Column) -> Column:
        size = F.octet_length(header)
        block_at = F.length(header) + len(GAP) + 1
        http = F.lower(_field(header, "Content-Type")).startswith("application/http")
        body = F.substring(value, block_at, F.length(value) - block_at + 1 - len(GAP))
        split = F.when(http, F.position(F.lit(GAP), value, block_at)).otherwise(0)
        payload = F.when(
            split > 0, F.substring(value, split + len(GAP), F.length(value) - split - 2 * len(GAP) + 1)
        ).otherwise(body)
        http_header = F.when(split > 0, F.substring(value, block_at, split - block_at)).otherwise("")
        return F.struct(
            size.alias("header_bytes"),
            F.instr(value, GAP).alias("gap_at"),
            _field(header, "Content-Length").try_cast("long").alias("content"),
            _field(header, "WARC-Type").alias("type"),
            _field(header, "WARC-Record-ID").alias("record_id"),
            F.nullif(_field(header, "WARC-Refers-To"), F.lit("")).alias("refers_to"),
            _field(header, "WARC-Target-URI").alias("target"),
            F.regexp_replace(_field(header, "WARC-Payload-Digest"), "^sha1:", "").alias("told_digest"),
            _field(http_header, "Content-Length").try_cast("long").alias("told_bytes"),
            F.octet_length(payload).cast("long").alias("payload_bytes"),
            base32_sha1(payload).alias("payload_digest"),
        )

    return rows.let(F.substring_index(value, GAP, 1), of)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """(file, off, end, next, key, bytes, r): every magic, where its fragment ends and where a record would."""
    cut = _fragments(spark, path).select("file", "block", "place", F.octet_length("value").cast("long").alias("bytes"), F.xxhash64("value").alias("key"), _parsed(F.col("value")).alias("r"))
    cut = workdir.saved(cut, "fragments")
    step = F.col("bytes") + len(MAGIC)
    inside = Window.partitionBy("file", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = cut.groupBy("file", "block").agg(F.sum(step).alias("n")).select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    off = F.col("base") + F.coalesce(F.sum(step).over(inside), F.lit(0)) - len(MAGIC)
    placed = cut.join(blocks, ["file", "block"]).withColumn("off", off).filter("off >= 0")
    length = F.col("r.header_bytes") + F.col("r.content") + len(MAGIC) + 2 * len(GAP)
    return workdir.saved(
        placed.select("file", "off", (F.col("off") + step).alias("end"), F.when(F.col("r.gap_at") > 0, F.col("off") + length).alias("next"), "key", "bytes", "r"),
        "candidates",
    )


def reached(found: DataFrame) -> DataFrame:
    """(file, off) of the candidates on the chain from the start of their file."""
    state = found.select("file", "off", F.col("next").alias("jump"), (F.col("off") == 0).alias("on"))
    while True:
        state = workdir.saved(state, "jumps")
        if not state.filter("on and jump is not null").limit(1).count():
            return state.filter("on").select("file", "off")
        hops = state.select("file", F.col("off").alias("jump"), F.col("jump").alias("further"))
        marks = state.filter("on and jump is not null").select("file", F.col("jump").alias("off"), F.lit(True).alias("hit")).distinct()
        state = (
            state.join(hops, ["file", "jump"], "left")
            .join(marks, ["file", "off"], "left")
            .select("file", "off", F.col("further").alias("jump"), (F.col("on") | F.col("hit").isNotNull()).alias("on"))
        )


def _whole(spark: SparkSession, path: str, on_chain: DataFrame, found: DataFrame) -> DataFrame:
    """(file, off, value): the texts of records that do not end where their fragment does, from their fragments.

    These hold magics, or something that is no record follows them.

    A record covers the fragments from its start to its end; both sides meet in
    stretches of a fixed length. Fragments are fetched by file, length and hash.
    """
    long_ = on_chain.filter("next <> end").select("file", F.col("off").alias("of"), "next")
    spread = long_.withColumn("stretch", F.explode(F.sequence(F.floor(F.col("of") / REACH), F.floor((F.col("next") - 1) / REACH))))
    parts = found.select("file", "off", "key", "bytes").withColumn("stretch", F.floor(F.col("off") / REACH))
    held = spread.join(parts, ["file", "stretch"]).filter("off >= of and off < next").select("file", "of", "next", "off", "key", "bytes")
    held = workdir.saved(held, "held")
    asked = workdir.saved(held.select("file", "key", "bytes").distinct(), "asked")
    again = _fragments(spark, path).select("file", F.xxhash64("value").alias("key"), F.octet_length("value").cast("long").alias("bytes"), "value")
    values = again.join(asked, ["file", "key", "bytes"]).groupBy("file", "key", "bytes").agg(F.any_value("value").alias("value"))
    ordered = F.sort_array(F.collect_list(F.struct("off", "value")))
    texts = held.join(values, ["file", "key", "bytes"]).groupBy("file", "of", "next").agg(ordered.alias("all"))
    joined = F.array_join("all.value", MAGIC).cast("binary")
    value = F.substring(joined, F.lit(1), (F.col("next") - F.col("of") - len(MAGIC)).cast("int")).cast("string")
    return texts.select("file", F.col("of").alias("off"), value.alias("value"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, off, type, record_id, refers_to, target, payload_bytes, payload_digest) of all records.

    Size and digest are those of the full payload: measured for records that
    hold it, as told in the header for revisits.
    """
    found = candidates(spark, path)
    on_chain = found.join(reached(found), ["file", "off"])
    short = on_chain.filter("next = end").select("file", "off", "r")
    whole = _whole(spark, path, on_chain, found).select("file", "off", _parsed(F.col("value")).alias("r"))
    again = F.col("r.type") == "revisit"
    return short.union(whole).select(
        "file",
        "off",
        "r.type",
        "r.record_id",
        "r.refers_to",
        "r.target",
        F.when(again, F.col("r.told_bytes")).otherwise(F.col("r.payload_bytes")).alias("payload_bytes"),
        F.when(again, F.col("r.told_digest")).otherwise(F.col("r.payload_digest")).alias("payload_digest"),
    )


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """(file, off, record_id, block) of all records: each one's content as written, headers of the payload included."""
    found = candidates(spark, path)
    on_chain = workdir.saved(found.join(reached(found), ["file", "off"]), "chain")
    whole = _whole(spark, path, on_chain.withColumn("end", F.lit(-1)), found)
    begin = F.instr("value", GAP) + len(GAP)
    block = F.substring(F.col("value"), begin, F.length("value") - begin + 1 - len(GAP))
    return whole.join(on_chain.select("file", "off", "r.record_id"), ["file", "off"]).select("file", "off", "record_id", block.alias("block"))
