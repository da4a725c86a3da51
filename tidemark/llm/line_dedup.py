"""Reversible line dedup: exact reference counts behind sharded cuckoo filters.

The index of a corpus is two tables. ``refs`` says for each line key in how
many documents it stands. ``filters`` holds, for each shard of the keys, a
cuckoo filter of those that stand in ``min_docs`` documents or more. Inserting
or deleting documents adds or subtracts their counts; keys that cross the
limit are inserted into their shard's filter or deleted from it.

Looking up documents sends 16-byte line keys to the shard's filter. What the
filter lets through, few lines more than the true ones, is verified in the
reference counts. A shard that holds a very frequent line is dealt out over
several tasks, each with a copy of the filter.

Defined results: a missing or empty text is one empty line, which stays, as do
all lines of white space only. Each row is a document of its own, also rows
that repeat. The last line need not end in a line feed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import cuckoo, rows, words
from tidemark.sources import workdir

MIN_DOCS = 10
SHARDS = 64
ROWS_PER_TASK = 2_000_000
_BLANK = b" \t\n\x0b\x0c\r"
_LOWER = words.LOWER.tobytes()


@dataclass(frozen=True)
class LineIndex:
    """refs (k1, k2, shard, docs) and filters (shard, keys, capacity, filter)."""

    refs: DataFrame
    filters: DataFrame
    shards: int = SHARDS
    min_docs: int = MIN_DOCS


_REFS = "k1 long, k2 long, shard int, docs long"
_FILTERS = "shard int, keys long, capacity long, filter binary"


def empty_index(spark: SparkSession, shards: int = SHARDS, min_docs: int = MIN_DOCS) -> LineIndex:
    return LineIndex(spark.createDataFrame([], _REFS), spark.createDataFrame([], _FILTERS), shards, min_docs)


def _keys(text: str | None) -> list[bytes | None]:
    """The key of every line as 16 bytes; None for blank ones."""
    lines = (text or "").encode().translate(_LOWER).split(b"\n")
    return [xxhash.xxh3_128_digest(key) if (key := line.strip(_BLANK)) else None for line in lines]


def line_keys(docs: DataFrame, text: str, shards: int, identity: list[Column]) -> DataFrame:
    """(identity.., line, k1, k2, shard): one row per line that is not blank."""
    names = [f"i{k}" for k in range(len(identity))]
    kept = docs.select(*[c.alias(n) for n, c in zip(names, identity)], F.col(text).alias("text"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                found = [_keys(x) for x in batch.column(len(names)).to_pylist()]
                row = np.repeat(np.arange(len(found)), [len(x) for x in found])
                line = np.concatenate([np.arange(len(x)) for x in found])
                filled = np.array([k is not None for x in found for k in x], bool)
                pair = np.frombuffer(b"".join(k for x in found for k in x if k), np.int64).reshape(-1, 2)
                of = pa.array(row[filled])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).take(of) for k in range(len(names))]
                    + [
                        pa.array(line[filled].astype(np.int32)),
                        pa.array(pair[:, 0].copy()),
                        pa.array(pair[:, 1].copy()),
                        pa.array((pair[:, 1] % shards).astype(np.int32)),
                    ],
                    names=[*names, "line", "k1", "k2", "shard"],
                )

    types = ", ".join(f"{n} {kept.schema[n].dataType.simpleString()}" for n in names)
    return kept.mapInArrow(split, f"{types}{', ' * bool(names)}line int, k1 long, k2 long, shard int")


def _counts(docs: DataFrame, text: str, shards: int) -> DataFrame:
    """(k1, k2, shard, docs): in how many rows each key stands, each row counted once."""
    kept = docs.select(F.col(text).alias("text"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = b"".join(k for x in batch.column(0).to_pylist() for k in {*_keys(x)} if k)
            pair = np.frombuffer(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0].copy()), pa.array(pair[:, 1].copy())], names=["k1", "k2"])

    shard = F.pmod("k2", F.lit(shards))
    counted = kept.mapInArrow(split, "k1 long, k2 long").groupBy("k1", "k2").agg(F.count("*").alias("docs"))
    return counted.select("k1", "k2", shard.cast("int").alias("shard"), "docs")


def _build_filters(index: LineIndex, changes: DataFrame) -> DataFrame:
    """New filters: changed in place, or built anew where a shard has none or outgrows it.

    Each task gets a shard's filter first, then the keys to delete and to insert.
    """
    frequent = index.refs.filter(F.col("docs") >= index.min_docs)
    sizes = frequent.groupBy("shard").agg(F.count("*").alias("need"))
    # One row per shard.
    fate = sizes.join(index.filters.drop("filter"), "shard", "full").select(
        "shard",
        F.coalesce("need", F.lit(0)).alias("need"),
        (F.coalesce("need", F.lit(0)) > F.coalesce("capacity", F.lit(-1))).alias("anew"),
    )
    part = lambda df, kind, key, blob: df.select(
        "shard", F.lit(kind).alias("kind"), "need", key.alias("key"), blob.alias("filter")
    )
    none, no_key = F.lit(None).cast("binary"), F.lit(None).cast("long")
    fate = F.broadcast(fate)
    steps = (
        part(index.filters.join(fate.filter("not anew"), "shard"), 0, no_key, F.col("filter"))
        .union(part(changes.filter("not up").join(fate.filter("not anew"), "shard"), 1, F.col("k1"), none))
        .union(part(changes.filter("up").join(fate.filter("not anew"), "shard"), 2, F.col("k1"), none))
        .union(part(frequent.join(fate.filter("anew"), "shard"), 2, F.col("k1"), none))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(shard, need, blob, out, into):
            if blob is None:
                table = cuckoo.built(np.concatenate(into) if into else np.zeros(0, np.uint64))
            else:
                table = np.frombuffer(blob, np.uint16).reshape(-1, cuckoo.SLOTS).copy()
                if out:
                    cuckoo.delete(table, np.concatenate(out))
                if into:
                    cuckoo.insert(table, np.concatenate(into))
            room = int(table.size * cuckoo.LOAD)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([need]), pa.array([room]), pa.array([table.tobytes()], pa.binary())],
                names=["shard", "keys", "capacity", "filter"],
            )

        now: tuple | None = None
        for batch in batches:
            shard, kind = (batch.column(k).to_numpy() for k in (0, 1))
            cuts = [0, *(np.flatnonzero((shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1])) + 1).tolist(), len(shard)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if now is None or now[0] != shard[a]:
                    if now is not None:
                        yield done(*now)
                    now = (int(shard[a]), batch.column(2)[a].as_py(), None, [], [])
                if kind[a] == 0:
                    now = (*now[:2], batch.column(4)[a].as_py(), *now[3:])
                else:
                    keys = batch.column(3).slice(a, b - a).to_numpy(zero_copy_only=False).astype(np.int64)
                    now[2 + int(kind[a])].append(keys.view(np.uint64))
        if now is not None:
            yield done(*now)

    return steps.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(run, _FILTERS)


def _changed(index: LineIndex, docs: DataFrame, text: str, sign: int) -> LineIndex:
    old = index.refs.select("k1", "k2", "shard", F.col("docs").alias("before"), F.lit(0).cast("long").alias("change"))
    new = _counts(docs, text, index.shards).select(
        "k1", "k2", "shard", F.lit(0).cast("long").alias("before"), (sign * F.col("docs")).alias("change")
    )
    both = old.union(new).groupBy("k1", "k2", "shard").agg(F.sum("before").alias("before"), F.sum("change").alias("change"))
    both = workdir.saved(both.withColumn("docs", F.col("before") + F.col("change")), "line-refs")
    refs = both.filter("docs > 0").select("k1", "k2", "shard", "docs")
    up = F.col("docs") >= index.min_docs
    changes = both.filter(up != (F.col("before") >= index.min_docs)).select("shard", "k1", up.alias("up"))
    filters = workdir.saved(_build_filters(LineIndex(refs, index.filters, index.shards, index.min_docs), changes), "line-filters")
    return LineIndex(refs, filters, index.shards, index.min_docs)


def inserted(index: LineIndex, docs: DataFrame, text: str = "text") -> LineIndex:
    """The index with the documents' lines counted once more."""
    return _changed(index, docs, text, 1)


def deleted(index: LineIndex, docs: DataFrame, text: str = "text") -> LineIndex:
    """The index without the documents' lines; the documents must have been inserted."""
    return _changed(index, docs, text, -1)


def frequent_lines(index: LineIndex, keyed: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The rows of ``line_keys`` whose key stands in ``min_docs`` documents or more."""
    names = [n for n in keyed.columns if n not in ("line", "k1", "k2", "shard")]
    # One row per shard: over how many tasks its lines are dealt.
    deals = index.refs.groupBy("shard").agg(F.ceil(F.sum("docs") / rows_per_task).cast("int").alias("deals"))
    deals = F.broadcast(deals)
    none = [F.lit(None).cast(keyed.schema[n].dataType).alias(n) for n in [*names, "line", "k1", "k2"]]
    copies = index.filters.join(deals, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)).alias("deal"), F.lit(0).alias("kind"), "filter", *none
    )
    lines = keyed.join(deals, "shard").select(
        "shard",
        F.pmod(F.xxhash64(*names, "line"), F.col("deals")).cast("int").alias("deal"),
        F.lit(1).alias("kind"),
        F.lit(None).cast("binary").alias("filter"),
        *names,
        "line",
        "k1",
        "k2",
    )
    kept = [*names, "line", "k1", "k2"]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, of = None, None
        for batch in batches:
            shard, deal, kind = (batch.column(k).to_numpy() for k in range(3))
            cuts = np.flatnonzero((shard[1:] != shard[:-1]) | (deal[1:] != deal[:-1]) | (kind[1:] != kind[:-1])) + 1
            cuts = [0, *cuts.tolist(), len(shard)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if kind[a] == 0:
                    table = np.frombuffer(batch.column(3)[a].as_py(), np.uint16).reshape(-1, cuckoo.SLOTS)
                    of = (shard[a], deal[a])
                elif of == (shard[a], deal[a]):
                    piece = batch.slice(a, b - a)
                    keys = piece.column(4 + kept.index("k1")).to_numpy(zero_copy_only=False).astype(np.int64)
                    hit = pa.array(cuckoo.contains(table, keys.view(np.uint64)))
                    yield piece.filter(hit).select(range(4, 4 + len(kept)))

    types = ", ".join(f"{n} {keyed.schema[n].dataType.simpleString()}" for n in kept)
    maybe = (
        copies.union(lines).repartition("shard", "deal").sortWithinPartitions("shard", "deal", "kind").mapInArrow(probe, types)
    )
    sure = index.refs.filter(F.col("docs") >= index.min_docs).select("k1", "k2")
    return maybe.join(sure, ["k1", "k2"]).select(*names, "line")


def _without(text: Column, dropped: Column) -> Column:
    """The text without the lines of the given numbers."""

    @F.arrow_udf("string")
    def kept(texts: pa.Array, numbers: pa.Array) -> pa.Array:
        out = []
        for whole, gone in zip(texts, numbers):
            value = whole.as_py() or ""
            if gone.is_valid:
                skip = set(gone.as_py())
                value = "\n".join(x for i, x in enumerate(value.split("\n")) if i not in skip)
            out.append(value)
        return pa.array(out, pa.string())

    return kept(text, dropped)


def without_lines(index: LineIndex, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, kept, n_dropped): each document with its text after the frequent lines are gone.

    A row is found again by its id and a hash of its text; rows that agree in
    both have the same lines.
    """
    identity = [F.col(doc_id), F.xxhash64(rows.text_of(text))]
    keyed = line_keys(docs, text, index.shards, identity)
    dropped = (
        frequent_lines(index, keyed).groupBy("i0", "i1").agg(F.collect_set("line").alias("dropped"))  # lines of one document
    )
    whole = docs.select(rows.packed(docs).alias("doc"), *[c.alias(n) for n, c in zip(("d0", "d1"), identity)])
    found = whole.join(dropped, F.col("d0").eqNullSafe(F.col("i0")) & (F.col("d1") == F.col("i1")), "left")
    return found.select(
        "doc",
        _without(F.col(f"doc.`{text}`"), F.col("dropped")).alias("kept"),
        F.when(F.col("dropped").isNull(), F.lit(0)).otherwise(F.size("dropped")).cast("long").alias("n_dropped"),
    )


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS, shards: int = SHARDS) -> DataFrame:
    """Index the documents and take their frequent lines out; see ``without_lines``."""
    index = inserted(empty_index(docs.sparkSession, shards, min_docs), docs, text)
    return without_lines(index, docs, doc_id, text)


rows.shipped(__name__)
