"""Words of many texts at once, on the bytes of an Arrow column.

Used inside tasks. Texts are taken in slices of bounded size; one text that is
longer than a slice is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm import rows

SLICE = 1 << 20

IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def slices(texts: pa.Array, lower: bool = False, size: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, bounds of the rows in the bytes); null is empty."""
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1)
        piece = whole[at[first] : at[last]]
        yield first, last, LOWER[piece] if lower else piece, at[first : last + 1] - at[first]
        first = last


def bounds_of_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, index of each text's first word and, last, the number of words)."""
    word = IS_WORD[data]
    before = np.zeros(len(data), bool)
    before[1:] = word[:-1]
    before[bounds[:-1][bounds[:-1] < len(data)]] = False
    starts = np.flatnonzero(word & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = word[1:]
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every bit."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def factors(count: int) -> np.ndarray:
    """An odd 64-bit factor for each place in a word."""
    return mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: byte values times a factor of their place, summed and mixed."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    place = np.zeros(len(data), np.int64)
    inside = np.repeat(starts, lengths)
    at = np.flatnonzero(IS_WORD[data])
    place[at] = at - inside
    terms = np.zeros(len(data), np.uint64)
    terms[at] = (data[at].astype(np.uint64) + np.uint64(1)) * factors(int(lengths.max()))[place[at]]
    return mixed(np.add.reduceat(terms, starts) + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


rows.shipped(__name__)
