"""Cuckoo filters on numpy arrays, for use inside tasks.

A filter is a table of buckets with four 16-bit tags. A key may sit in two
buckets, each found from the other and the tag, so that tags can be moved and
deleted. A key that was inserted is always found.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm import rows, words

SLOTS = 4
LOAD = 0.85


def buckets_for(keys: int) -> int:
    """A power of two that holds the keys below the load limit."""
    need = max(1, int(keys / (SLOTS * LOAD)) + 1)
    return 1 << (need - 1).bit_length()


def empty(keys: int) -> np.ndarray:
    return np.zeros((buckets_for(keys), SLOTS), np.uint16)


def _places(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mixed = words.mixed(keys)
    tags = (mixed >> np.uint64(48)).astype(np.uint16) | np.uint16(1)
    return (mixed & np.uint64(len(table) - 1)).astype(np.int64), tags


def _other(table: np.ndarray, at: np.ndarray, tags: np.ndarray) -> np.ndarray:
    return at ^ (words.mixed(tags.astype(np.uint64)) & np.uint64(len(table) - 1)).astype(np.int64)


def contains(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at, tags = _places(table, keys)
    other = _other(table, at, tags)
    return (table[at] == tags[:, None]).any(axis=1) | (table[other] == tags[:, None]).any(axis=1)


def _fill(table: np.ndarray, at: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """Put tags into free slots of their buckets; which of them had no room."""
    order = np.argsort(at, kind="stable")
    bucket = at[order]
    first = np.concatenate([[True], bucket[1:] != bucket[:-1]])
    rank = np.arange(len(bucket)) - np.maximum.accumulate(np.where(first, np.arange(len(bucket)), 0))
    free = table[bucket] == 0
    room = rank < free.sum(axis=1)
    slot = (np.cumsum(free, axis=1) == rank[:, None] + 1).argmax(axis=1)
    table[bucket[room], slot[room]] = tags[order][room]
    left = np.ones(len(at), bool)
    left[order[room]] = False
    return left


def insert(table: np.ndarray, keys: np.ndarray, rounds: int = 500) -> np.ndarray:
    """Insert each key once more, all at a time; a table that proves too full is doubled by its caller."""
    at, tags = _places(table, keys)
    for turn in range(rounds):
        for _ in range(2):
            if not len(at):
                return table
            left = _fill(table, at, tags)
            at, tags = at[left], tags[left]
            at = _other(table, at, tags)
        # Both buckets are full: one of those that wait at a bucket trades places with a tag in it.
        bucket, who = np.unique(at, return_index=True)
        slot = (words.mixed(bucket.astype(np.uint64) + np.uint64(turn)) % np.uint64(SLOTS)).astype(np.int64)
        out = table[bucket, slot].copy()
        table[bucket, slot] = tags[who]
        tags[who] = out
        at[who] = _other(table, bucket, out)
    raise OverflowError("no room left")


def delete(table: np.ndarray, keys: np.ndarray) -> None:
    """Take out one tag of each key; the keys must have been inserted."""
    at, tags = _places(table, keys)
    other = _other(table, at, tags)
    for places in zip(at.tolist(), other.tolist(), tags.tolist()):
        for bucket in places[:2]:
            hit = np.flatnonzero(table[bucket] == places[2])
            if len(hit):
                table[bucket, hit[0]] = 0
                break


def built(keys: np.ndarray) -> np.ndarray:
    size = len(keys)
    while True:
        try:
            return insert(empty(size), keys)
        except OverflowError:
            size *= 2


rows.shipped(__name__)
