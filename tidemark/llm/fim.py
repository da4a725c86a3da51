"""Fill-in-middle transformation: a text is cut in three and its middle moved to the end.

Cuts are places between code points; the text is stored as UTF-8. A task keeps
a sparse exception index of its batch: the places of the characters of more
than one byte, and how many bytes each has beyond the first, summed up. A place
in code points is the place in bytes less the excess before it, so a binary
search in the index converts either way, and in spans without exceptions the
conversion is plain arithmetic. Only the cuts come back from Python; the pieces
are byte slices that Spark takes and joins.

Defined results: a missing text is an empty one and stays plain. Both cuts may
fall on one place or on an end of the text; the pieces are empty then. A missing
id is drawn for as an empty one. Rows that repeat give repeated results, and
the columns of the input stay packed in ``doc``, so none can clash. An empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import rows

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
FIELDS = ["n", "first", "second", "first_byte", "second_byte"]
CUTS = f"struct<{','.join(f'{name}:long' for name in FIELDS)}>"


class Exceptions:
    """The characters of more than one byte in a run of UTF-8: where they are and what they add."""

    def __init__(self, data: np.ndarray):
        at = np.flatnonzero(data >= 0xC0)
        lead = data[at]
        extra = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate([[0], np.cumsum(extra)])
        self.byte_at = at
        self.char_at = at - self.excess[:-1]

    def chars(self, byte: np.ndarray) -> np.ndarray:
        """Code points before a place in bytes; the place is at a character's start."""
        return byte - self.excess[np.searchsorted(self.byte_at, byte)]

    def bytes(self, char: np.ndarray) -> np.ndarray:
        """Bytes before a place in code points."""
        return char + self.excess[np.searchsorted(self.char_at, char)]


def _cuts(texts: pa.Array, draws: np.ndarray) -> pa.StructArray:
    """Length and ordered cuts of each text, in code points and in bytes."""
    if not len(texts):
        return pa.StructArray.from_arrays([pa.array([], pa.int64())] * len(FIELDS), FIELDS)
    texts = texts.fill_null("") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    index = Exceptions(whole[at[0] : at[-1]])
    at = at - at[0]
    start = index.chars(at)
    n = np.diff(start)
    char = np.sort(draws % (n + 1), axis=0)
    byte = index.bytes(start[:-1] + char) - at[:-1]
    return pa.StructArray.from_arrays([pa.array(x) for x in (n, *char, *byte)], FIELDS)


def cuts(text: Column, one: Column, two: Column) -> Column:
    """``CUTS`` of each text for two numbers, which are taken modulo its length + 1."""

    @F.arrow_udf(CUTS)
    def of(texts: pa.Array, a: pa.Array, b: pa.Array) -> pa.Array:
        return _cuts(texts, np.stack([x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (a, b)]))

    return of(text, one, two)


def draws(doc_id: Column, seed: str) -> list[Column]:
    """Four numbers below 2^32 that only the id and the seed decide."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def transformed(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", plain_percent: int = 10, spm_percent: int = 20, seed: str = "1"
) -> DataFrame:
    """(doc, n, form, prefix_chars, middle_chars, output) of each row.

    ``plain_percent`` of the texts, and those that are empty or hold one of the
    marks, stay as they are; of the rest, ``spm_percent`` put the suffix first.
    """
    body = rows.text_of(f"`{text}`")
    one, two, three, four = draws(F.col(f"`{doc_id}`"), seed)
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(body, F.lit(mark))
    plain = (body == "") | (three % 100 >= 100 - plain_percent) | marked
    form = F.when(plain, PLAIN).when(four % 100 < spm_percent, SPM).otherwise(PSM)
    cut = docs.select(rows.packed(docs).alias("doc"), body.alias("body"), form.alias("form"), cuts(body, one, two).alias("cut"))
    whole, first, second = F.col("body").cast("binary"), F.col("cut.first_byte").cast("int"), F.col("cut.second_byte").cast("int")
    prefix = F.substring(whole, F.lit(1), first)
    middle = F.substring(whole, first + 1, second - first)
    suffix = F.substring(whole, second + 1, F.octet_length("body") - second)
    mark = lambda name: F.lit(name).cast("binary")
    psm = F.concat(mark(PREFIX), prefix, mark(SUFFIX), suffix, mark(MIDDLE), middle)
    spm = F.concat(mark(SUFFIX), suffix, mark(PREFIX), prefix, mark(MIDDLE), middle)
    cut_only = lambda column: F.when(F.col("form") != PLAIN, column)
    return cut.select(
        "doc",
        F.col("cut.n").alias("n"),
        "form",
        cut_only(F.col("cut.first")).alias("prefix_chars"),
        cut_only(F.col("cut.second") - F.col("cut.first")).alias("middle_chars"),
        F.when(F.col("form") == PSM, psm.cast("string")).when(F.col("form") == SPM, spm.cast("string")).otherwise(F.col("body")).alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of.

    An output that is not plain holds each mark once: its text has none, and
    none can arise where a piece meets a mark, as a mark begins with the one
    character and ends with the other that no mark has inside.
    """
    return rows.let(
        F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE))),
        lambda part: F.when(form == PSM, F.concat(part[1], part[3], part[2]))
        .when(form == SPM, F.concat(part[2], part[3], part[1]))
        .otherwise(output),
    )


rows.shipped(__name__)
