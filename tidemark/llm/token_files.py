"""Flat files of token ids with 64-bit offsets, written in order and read by memory mapping.

Documents are dealt to parts by ranges of their id. A task takes one part in
order, encodes it and writes three files: ``ids`` (unsigned integers, 16 bits
where the vocabulary allows, else 32, little-endian, nothing else), ``ends``
(64-bit offsets inside the part, one more than documents) and ``docs`` (64-bit
document ids; missing ones come first and stand as 0). Each is written under a
name of its own and then renamed, so an attempt that dies leaves nothing that
counts and a second one replaces what is there. The manifest has one row per
part; the prefix sum of the parts' tokens is the base that its offsets start
from.

Encoding: a byte-level vocabulary splits a text into words with their leading
space, runs of digits, signs and spaces, and encodes each alone. Texts are cut
at places where that splitting always cuts, so the encoding of the whole is
that of the pieces in a row, and each distinct piece is encoded once. The
strings of added tokens in a text are those tokens, as the library has it.

Defined results: a missing or empty text holds the end id only. Rows of one id
are in the order of their text's hash, equal ones in that of the input; every row
counts. An empty table gives one part without documents. The folder must be one
that ``pyarrow.fs`` opens for every task: a mounted path (mapped into memory) or
an object store.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import rows, words

# Bytes of text per part, on average; bytes encoded at once; pieces that a task remembers before it starts anew.
PART_BYTES = 128 << 20
SLICE_BYTES = 4 << 20
KNOWN = 3 << 18
# Words per joined text.
JOINED = 64
MANIFEST = "part int, name string, docs long, missing_ids long, tokens long"


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """A tokenizer file, sent to the tasks once; its size does not depend on the data."""
    path = path if "://" in path else f"file://{path}"
    content = spark.read.format("binaryFile").load(path).select("content").first()["content"]
    return spark.sparkContext.broadcast(bytes(content))


class Encoder:
    """Ids of many texts, each distinct piece encoded once."""

    def __init__(self, content: bytes):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(content)
        # Each piece is asked for once; the library's own memory would only cost.
        self.tokenizer.model._resize_cache(0)
        self.added = [token.content.encode() for token in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        # Of each known piece: its number; by number, how many ids it has and where in ``ids`` they start.
        self.known: dict[bytes, int] = {}
        self.ids, self.lengths = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]

    def _learn(self, fresh: list[bytes]) -> None:
        """Encode pieces: single words joined to short texts, whose words are counted; the rest one by one."""
        texts = [piece.decode() for piece in fresh]
        alone = [text[0] == " " and text[1:].isalpha() for text in texts]
        joined = [k for k, is_word in enumerate(alone) if is_word]
        runs = [joined[k : k + JOINED] for k in range(0, len(joined), JOINED)]
        order = [k for k, is_word in enumerate(alone) if not is_word]
        ids, lengths = [], []
        for run, told in zip(runs, self.tokenizer.encode_batch(["".join(texts[k] for k in run) for run in runs], add_special_tokens=False)):
            count = np.bincount(np.array(told.word_ids, np.int64), minlength=len(run))
            if len(count) != len(run):
                order += run
                continue
            ids.append(np.array(told.ids, np.uint32))
            lengths.append(count)
            self.known.update(zip((fresh[k] for k in run), range(len(self.known), len(self.known) + len(run))))
        told = self.tokenizer.encode([texts[k] for k in order], is_pretokenized=True, add_special_tokens=False)
        ids.append(np.array(told.ids, np.uint32))
        lengths.append(np.bincount(np.array(told.word_ids, np.int64), minlength=len(order)))
        self.known.update(zip((fresh[k] for k in order), range(len(self.known), len(self.known) + len(order))))
        self.ids += ids
        self.lengths += lengths

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text); ``bounds`` cuts the bytes into texts."""
        starts = self._whole(pieces(data, bounds), data, bounds)
        index, distinct = self._distinct(data, starts)
        if len(self.known) > KNOWN or sum(map(len, self.ids)) > 8 * KNOWN:
            self._forget()
        fresh = [piece for piece in distinct if piece not in self.known]
        if fresh:
            self._learn(fresh)
        flat, length = (np.concatenate(x) for x in (self.ids, self.lengths))
        self.ids, self.lengths = [flat], [length]
        number = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[index]
        first = np.cumsum(length) - length
        each = length[number]
        upto = np.cumsum(each)
        ids = flat[np.arange(int(each.sum())) + np.repeat(first[number] - (upto - each), each)]
        before = np.concatenate([[0], upto])[np.searchsorted(starts, bounds)]
        return ids, np.diff(before)

    def _whole(self, starts: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The pieces, but a text that holds one of the added tokens is one piece: the library takes those out first."""
        text, at = data.tobytes(), []
        for token in self.added:
            place = text.find(token) if token else -1
            while place >= 0:
                row = int(np.searchsorted(bounds, place, "right")) - 1
                at.append(row)
                place = text.find(token, int(bounds[row + 1]))
        for row in set(at):
            starts = starts[(starts <= bounds[row]) | (starts >= bounds[row + 1])]
        return starts

    @staticmethod
    def _distinct(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        offsets = np.append(starts, len(data)).astype(np.int64)
        column = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        return column.indices.to_numpy().astype(np.int64), column.dictionary.to_pylist()


# First bytes of the two-byte characters that are letters throughout (Latin and Cyrillic), but for two signs.
LETTER_LEADS = [0xC3, 0xC4, 0xC5, 0xD0, 0xD1]
NO_LETTERS = [0x97, 0xB7]


def pieces(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the pieces of the texts start; no empty ones.

    Cut are the end of a run of letters before any other ASCII character, and
    the place before a space and a letter that follow a character which is
    not a space. No match of the vocabulary's splitting reaches over either, and
    no piece but the last of a text ends in a space, whose match would depend on
    what follows.
    """
    small = data | 0x20
    ascii_letter = (small >= ord("a")) & (small <= ord("z")) & (data < 0x80)
    lead = np.isin(data, LETTER_LEADS)
    lead[:-1] &= ~((data[:-1] == 0xC3) & np.isin(data[1:], NO_LETTERS))
    tail = np.zeros(len(data), bool)
    tail[1:] = lead[:-1]
    starts_letter, ends_letter = ascii_letter | lead, ascii_letter | tail
    visible = (data > 0x20) & (data < 0x7F) | tail
    cut = np.zeros(len(data), bool)
    cut[1:] = ends_letter[:-1] & (data[1:] < 0x80) & ~ascii_letter[1:]
    cut[1:-1] |= visible[:-2] & (data[1:-1] == 0x20) & starts_letter[2:]
    edges = np.unique(bounds)
    cut[edges[edges < len(data)]] = True
    return np.flatnonzero(cut)


def _writer(content: Broadcast, folder: str, width: int, end_id: int):
    """Task function: writes the part it is given and tells of it."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        store, base = pafs.FileSystem.from_uri(folder)
        part = TaskContext.get().partitionId()
        name, own = f"part-{part:06d}", uuid.uuid4().hex
        encoder = Encoder(content.value)
        upto, docs, missing = 0, 0, 0
        kinds = {kind: store.open_output_stream(f"{base}/{name}.{kind}-{own}") for kind in ("ids", "ends", "docs")}
        kinds["ends"].write(np.zeros(1, "<u8").tobytes())
        for batch in batches:
            key = batch.column(0)
            missing += key.null_count
            kinds["docs"].write(key.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            for first, last, data, bounds in words.slices(batch.column(1), size=SLICE_BYTES):
                ids, lengths = encoder.encode(data, bounds)
                ends = np.cumsum(lengths + 1)
                out = np.full(int(ends[-1]), end_id, f"<u{width}")
                own_place = np.ones(len(out), bool)
                own_place[ends - 1] = False
                out[own_place] = ids
                kinds["ids"].write(out.tobytes())
                kinds["ends"].write((upto + ends).astype("<u8").tobytes())
                upto += int(ends[-1])
                docs += last - first
        for kind, stream in kinds.items():
            stream.close()
            store.move(f"{base}/{name}.{kind}-{own}", f"{base}/{name}.{kind}")
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "name": [name], "docs": [docs], "missing_ids": [missing], "tokens": [upto]}
        )

    return write


def write(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text", part_bytes: int = PART_BYTES
) -> DataFrame:
    """Write the documents' ids in ascending order of ``doc_id`` below ``path``; the manifest, read back.

    ``path`` is a new folder. Manifest: (part, name, docs, missing_ids, tokens,
    base, first_doc, width), where ``base`` and ``first_doc`` count the tokens and
    documents of all parts before.
    """
    spark = docs.sparkSession
    content = vocabulary(spark, tokenizer)
    encoder = Encoder(content.value)
    largest = max(encoder.tokenizer.get_vocab_size() - 1, end_id)
    width = 2 if largest < 1 << 16 else 4
    body = rows.text_of(f"`{text}`")
    size = docs.agg(F.sum(F.octet_length(body))).first()[0] or 0
    keyed = docs.select(F.col(f"`{doc_id}`").cast("long").alias("key"), body.alias("body"), F.xxhash64(body).alias("tie"))
    # The last key spreads rows that are equal in all else over parts.
    keyed = keyed.withColumn("place", F.monotonically_increasing_id())
    order = ["key", "tie", "place"]
    parts = keyed.repartitionByRange(1 + int(size // part_bytes), *order).sortWithinPartitions(*order)
    folder = path if "://" in path else f"file://{path}"
    store, base = pafs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    told = parts.select("key", "body").mapInArrow(_writer(content, folder, width, end_id), MANIFEST)
    told.write.parquet(f"{path}/told")
    told = spark.read.schema(MANIFEST).parquet(f"{path}/told")
    # One row per part.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda column: F.coalesce(F.sum(column).over(before), F.lit(0)).cast("long")
    based = told.select("*", total("tokens").alias("base"), total("docs").alias("first_doc"), F.lit(width).alias("width"))
    based.write.parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


class Part:
    """One part's files, mapped into memory where the folder is a mounted one."""

    def __init__(self, folder: str, name: str, width: int):
        store, base = pafs.FileSystem.from_uri(folder)
        if isinstance(store, pafs.LocalFileSystem):
            store = pafs.LocalFileSystem(use_mmap=True)
        self.file = store.open_input_file(f"{base}/{name}.ids")
        self.width = width
        self.ends = self._all(store, f"{base}/{name}.ends", "<u8").astype(np.int64)
        self.docs = self._all(store, f"{base}/{name}.docs", "<i8")

    @staticmethod
    def _all(store: pafs.FileSystem, path: str, kind: str) -> np.ndarray:
        with store.open_input_file(path) as file:
            return np.frombuffer(file.read_buffer(), kind)

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids of the documents ``first`` to ``last - 1``, in a row."""
        a, b = int(self.ends[first]), int(self.ends[last])
        buffer = self.file.read_at((b - a) * self.width, a * self.width) if b > a else b""
        return np.frombuffer(buffer, f"<u{self.width}")


def _reader(folder: str, most: int):
    """Task function: the documents of the parts it is given, some ``most`` ids at a time."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for told in batch.to_pylist():
                part = Part(folder, told["name"], told["width"])
                first = 0
                while first < told["docs"]:
                    last = max(first + 1, int(np.searchsorted(part.ends, part.ends[first] + most, "right")) - 1)
                    wide = part.ids(first, last).astype("<u4")
                    ends = part.ends[first : last + 1]
                    offsets = 4 * (ends - ends[0])
                    ids = pa.Array.from_buffers(
                        pa.large_binary(), last - first, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(wide)]
                    )
                    missing = np.arange(first, last) < told["missing_ids"]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(part.docs[first:last], mask=missing),
                            pa.array(told["base"] + ends[:-1]),
                            pa.array(np.diff(ends)),
                            ids.cast(pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )
                    first = last

    return read


def read(spark: SparkSession, path: str, ids_at_once: int = 1 << 21) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the files below ``path``.

    ``start`` counts the ids of all documents before; ``ids`` are 32-bit
    unsigned little-endian integers, whatever the files' width.
    """
    folder = path if "://" in path else f"file://{path}"
    manifest = spark.read.parquet(f"{path}/manifest").select("name", "docs", "missing_ids", "base", "width")
    parts = manifest.repartition(max(1, manifest.count()))
    schema = "doc_id long, start long, n_tokens long, ids binary"
    return parts.mapInArrow(_reader(folder, ids_at_once), schema)


def crc32(ids: Column) -> Column:
    """The unsigned CRC-32 of a document's ids as ``read`` gives them."""
    return F.crc32(ids)


rows.shipped(__name__)
