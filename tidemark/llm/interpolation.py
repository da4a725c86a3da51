"""Deleted interpolation: n-gram language model scores of whole documents.

The probability of a token mixes maximum-likelihood estimates of all orders
and a uniform one. The weights depend on how often the longest context that
was seen occurs: contexts are put into buckets by the power of two of their
count, and each bucket's weights are learned by expectation-maximisation on
tokens that were deleted from the counts, a part of the training documents.
Scores then use the counts of all training documents.

Counting and looking up share one exchange. Documents are packed into blocks
of tokens; a block sends each part of the key space its distinct n-grams, as
one sorted, compressed run with local counts, and gets their total counts back
in the same order. So an n-gram travels once per block, a frequent one as
often as a rare one, and no task holds more than a block or a part.

Defined results: a missing text is an empty one and consists of its end.
Documents without id train. Rows that repeat count and are scored each. Without
training text every token has probability 1. N-grams are told apart by 62-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import rows, words
from tidemark.sources import workdir

ORDER = 2
BLOCK_TOKENS = 400_000
PART_KEYS = 500_000
COUNTED, DELETED, TEST = 0, 1, 2
END = np.uint64(0x1F83D9ABFB41BD6B)
BEGIN = np.uint64(0x5BE0CD19137E2179)
CLASSES = 32
ROUNDS, ENOUGH = 15, 1e-4


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of their bytes."""
    planes = np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel()


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=np.uint64(0)))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data), dtype=np.uint64)


def blocks(docs: DataFrame, doc_id: str, text: str, role: Column, size: int = BLOCK_TOKENS) -> DataFrame:
    """(block, role, ids, sizes, vocab, tokens): documents of one role as word hashes; a saved table."""
    kept = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), role.cast("int").alias("role"))
    kind = kept.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial, id_type = 0, None
        waiting: dict[int, tuple[list, list, list]] = {r: ([], [], []) for r in (COUNTED, DELETED, TEST)}

        def packed(r: int) -> pa.RecordBatch:
            nonlocal serial
            ids, sizes, hashes = waiting[r]
            vocab, tokens = np.unique(np.concatenate(hashes), return_inverse=True)
            block = (TaskContext.get().partitionId() << 24) + serial
            serial += 1
            waiting[r] = ([], [], [])
            all_ids = pa.concat_arrays(ids)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([block]),
                    pa.array([r], pa.int32()),
                    pa.ListArray.from_arrays(pa.array([0, len(all_ids)], pa.int32()), all_ids),
                    pa.array([_pack(np.concatenate(sizes))], pa.binary()),
                    pa.array([_pack_sorted(vocab)], pa.binary()),
                    pa.array([_pack(tokens)], pa.binary()),
                ],
                names=["block", "role", "ids", "sizes", "vocab", "tokens"],
            )

        for batch in batches:
            id_type = batch.column(0).type
            roles = batch.column(2).to_numpy()
            for first, last, data, bounds in words.slices(batch.column(1), lower=True):
                starts, ends, at = words.bounds_of_words(data, bounds)
                found = words.hashes(data, starts, ends)
                counts = np.diff(at)
                # An end behind each text's words.
                place = np.cumsum(counts + 1) - 1
                tokens = np.full(len(found) + len(counts), END)
                inside = np.ones(len(tokens), bool)
                inside[place] = False
                tokens[inside] = found
                owner = np.repeat(np.arange(len(counts)), counts + 1)
                for r in waiting:
                    mine = roles[first:last] == r
                    if not mine.any():
                        continue
                    ids, sizes, hashes = waiting[r]
                    ids.append(batch.column(0).slice(first, last - first).filter(pa.array(mine)))
                    sizes.append(counts[mine] + 1)
                    hashes.append(tokens[mine[owner]])
                    if sum(map(len, hashes)) >= size:
                        yield packed(r)
        for r in waiting:
            if waiting[r][0]:
                yield packed(r)

    schema = f"block long, role int, ids array<{kind}>, sizes binary, vocab binary, tokens binary"
    return workdir.saved(kept.mapInArrow(run, schema), "blocks")


@dataclass
class _Block:
    """The tokens of a block and the keys of the n-grams that end at each of them."""

    sizes: np.ndarray
    keys: list[np.ndarray]  # one array per order; the lowest two bits say which
    begins: np.ndarray  # whether a token is its document's first


def _block(sizes: bytes, vocab: bytes, tokens: bytes, order: int) -> _Block:
    counts = _unpack(sizes).astype(np.int64)
    word = _unpack_sorted(vocab)[_unpack(tokens).astype(np.int64)]
    begins = np.zeros(len(word), bool)
    begins[np.cumsum(counts) - counts] = True
    grams, level, start = [word], word, BEGIN
    for _ in range(1, order):
        before = np.concatenate([[start], level[:-1]]).astype(np.uint64)
        before[begins] = start
        level = words.mixed(before * np.uint64(0x9E3779B97F4A7C15) + word)
        start = words.mixed(np.array([start]))[0]
        grams.append(level)
    return _Block(counts, [(g & ~np.uint64(3)) | np.uint64(k) for k, g in enumerate(grams)], begins)


def counts(packed: DataFrame, parts: int, order: int = ORDER) -> DataFrame:
    """(block, role, part, counted, deleted, n_counted, n_deleted, v_counted, v_all); a saved table.

    The counts of a block's n-grams of a part, in the order of their keys. Rows
    without block sum up a part: its training tokens and distinct words.
    """
    shift = np.uint64(64 - int(math.log2(parts))) if parts > 1 else None

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(batch.num_rows):
                # One row at a time: a batch may hold many blocks.
                row = {c: batch.column(c)[place].as_py() for c in batch.schema.names}
                b = _block(row["sizes"], row["vocab"], row["tokens"], order)
                keys, n = np.unique(np.concatenate(b.keys), return_counts=True)
                cuts = np.searchsorted(keys >> shift, np.arange(parts + 1, dtype=np.uint64)) if shift is not None else np.array([0, len(keys)])
                some = np.flatnonzero(np.diff(cuts))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(some.astype(np.int32)),
                        pa.array(np.full(len(some), row["block"])),
                        pa.array(np.full(len(some), row["role"], np.int32)),
                        pa.array([_pack_sorted(keys[cuts[p] : cuts[p + 1]]) for p in some], pa.binary()),
                        pa.array([_pack(n[cuts[p] : cuts[p + 1]]) if row["role"] != TEST else None for p in some], pa.binary()),
                    ],
                    names=["part", "block", "role", "keys", "n"],
                )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in rows.groups(batches, 0):
            runs = [_unpack_sorted(x.as_py()) for x in table["keys"]]
            sent = [_unpack(x.as_py()) if x.is_valid else None for x in table["n"]]
            roles, of, part = table["role"].to_numpy(), table["block"].to_numpy(), table["part"][0].as_py()
            keys, at = np.unique(np.concatenate(runs), return_inverse=True)
            total = [np.zeros(len(keys), np.int64) for _ in (COUNTED, DELETED)]
            begin = np.concatenate([[0], np.cumsum([len(x) for x in runs])])
            for k, n in enumerate(sent):
                if n is not None:
                    total[roles[k]][at[begin[k] : begin[k + 1]]] += n.astype(np.int64)
            single = (keys & np.uint64(3)) == 0
            sums = [int(t[single].sum()) for t in total]
            distinct = [int((total[0][single] > 0).sum()), int(((total[0] + total[1])[single] > 0).sum())]
            out = []
            for k in range(len(runs)):
                mine = at[begin[k] : begin[k + 1]]
                out.append((int(of[k]), int(roles[k]), part, _pack(total[0][mine]), _pack(total[1][mine]), 0, 0, 0, 0))
            out.append((None, None, part, None, None, *sums, *distinct))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    names = ["block", "role", "part", "counted", "deleted", "n_counted", "n_deleted", "v_counted", "v_all"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()] + [pa.int64()] * 4
    asked = packed.drop("ids").mapInArrow(ask, "part int, block long, role int, keys binary, n binary")
    answered = asked.repartition("part").sortWithinPartitions("part", "block").mapInArrow(
        answer, "block long, role int, part int, counted binary, deleted binary, n_counted long, n_deleted long, v_counted long, v_all long"
    )
    return workdir.saved(answered, "counts")


def _met(packed: DataFrame, found: DataFrame, columns: list[str]) -> DataFrame:
    """Each block's tokens, and behind them its counts in the order of the parts."""
    none = F.lit(None)
    left = packed.select("block", F.lit(-1).alias("part"), "role", *columns, none.cast("binary").alias("counted"), none.cast("binary").alias("deleted"))
    right = found.filter("block is not null").select(
        "block", "part", "role", *[none.cast(packed.schema[c].dataType).alias(c) for c in columns], "counted", "deleted"
    )
    return left.union(right).repartition("block").sortWithinPartitions("block", "part")


def _looked_up(table: pa.Table, order: int, with_deleted: bool) -> tuple[_Block, list[np.ndarray], list[np.ndarray]]:
    """(block, count of each token's n-gram by order, count of its context by order)."""
    b = _block(*(table[c][0].as_py() for c in ("sizes", "vocab", "tokens")), order)
    keys, at = np.unique(np.concatenate(b.keys), return_inverse=True)
    total = np.concatenate([_unpack(x.as_py()) for x in table["counted"].slice(1)]).astype(np.int64)
    if with_deleted:
        total = total + np.concatenate([_unpack(x.as_py()) for x in table["deleted"].slice(1)]).astype(np.int64)
    grams = np.split(total[at], order)
    return b, grams, [np.concatenate([[0], g[:-1]]) for g in grams[:-1]]


def _bucket(contexts: list[np.ndarray]) -> np.ndarray:
    """Bucket of the longest context that was seen, 0 if none was."""
    out = np.zeros(len(contexts[0]) if contexts else 0, np.int64)
    for k, c in enumerate(contexts):
        seen = c > 0
        out[seen] = 1 + k * CLASSES + np.minimum(np.log2(c[seen]).astype(np.int64), CLASSES - 1)
    return out


def held_out_counts(packed: DataFrame, found: DataFrame, documents: int, order: int = ORDER) -> DataFrame:
    """(bucket, c1, c2, x2, .., n): how often deleted tokens met these counts of n-grams and contexts."""
    only = F.col("role") == DELETED
    names = ["bucket", "c1"] + [x for k in range(2, order + 1) for x in (f"c{k}", f"x{k}")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in rows.groups(batches, 0):
            b, grams, contexts = _looked_up(table, order, False)
            for c in contexts:
                c[b.begins] = documents
            columns = [_bucket(contexts), grams[0]]
            for g, c in zip(grams[1:], contexts):
                columns += [g, c]
            code = np.zeros(len(grams[0]), np.uint64)
            for c in columns:
                code = words.mixed(code * np.uint64(0x9E3779B97F4A7C15) + c.astype(np.uint64))
            _, first, n = np.unique(code, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(c[first]) for c in columns] + [pa.array(n)], names=[*names, "n"])

    met = _met(packed.filter(only), found.filter(only), ["sizes", "vocab", "tokens"])
    tuples = met.mapInArrow(run, ", ".join(f"{x} long" for x in [*names, "n"]))
    return workdir.saved(tuples.groupBy(*names).agg(F.sum("n").alias("n")), "held-out")


def learned(held: DataFrame, tokens: int, vocabulary: int, order: int = ORDER) -> np.ndarray:
    """Weights (bucket, order) by expectation-maximisation; column 0 weighs the uniform estimate.

    Each round is one aggregation to a row per bucket. A bucket leans on the
    weights of all buckets by one token's worth.
    """
    size = 1 + (order - 1) * CLASSES
    weights = np.full((size, order + 1), 1.0 / (order + 1))
    if not tokens:
        return np.eye(1, order + 1).repeat(size, axis=0)
    estimate = [F.lit(1.0 / (vocabulary + 1)), F.col("c1") / F.lit(float(tokens))]
    for k in range(2, order + 1):
        estimate.append(F.when(F.col(f"x{k}") > 0, F.col(f"c{k}") / F.col(f"x{k}")).otherwise(0.0))
    last = -math.inf
    for _ in range(ROUNDS):
        shares = [F.array(*[F.lit(float(x)) for x in weights[:, k]])[F.col("bucket").cast("int")] * p for k, p in enumerate(estimate)]
        mixed = held.select("bucket", "n", *[s.alias(f"s{k}") for k, s in enumerate(shares)])
        whole = sum((F.col(f"s{k}") for k in range(1, order + 1)), F.col("s0"))
        sums = mixed.groupBy("bucket").agg(
            *[F.sum(F.col("n") * F.col(f"s{k}") / whole).alias(f"g{k}") for k in range(order + 1)], F.sum(F.col("n") * F.log10(whole)).alias("fit"), F.sum("n").alias("n")
        )
        got = np.zeros((size, order + 1))
        fit = n = 0.0
        for row in sums.collect():  # one row per bucket
            got[row["bucket"]] = [row[f"g{k}"] for k in range(order + 1)]
            fit, n = fit + row["fit"], n + row["n"]
        if not n:
            break
        everything = got.sum(axis=0) / got.sum()
        everything = np.maximum(everything, 1e-9) / np.maximum(everything, 1e-9).sum()
        weights = got + everything
        weights = weights / weights.sum(axis=1, keepdims=True)
        if fit / n - last < ENOUGH:
            break
        last = fit / n
    return weights


def scored(docs: DataFrame, role: Column, doc_id: str = "doc_id", text: str = "text", order: int = ORDER, block_tokens: int = BLOCK_TOKENS, part_keys: int = PART_KEYS) -> DataFrame:
    """(id, role, n_tokens, n_known, train_tokens, base_score, score): one row per document.

    ``role`` says of each document whether its tokens are counted (0), deleted
    from the counts to learn the weights (1), or neither (2). ``score`` is the
    model's log10 probability, ``base_score`` that of single tokens with one
    added to each count.
    """
    packed = blocks(docs, doc_id, text, role, block_tokens)
    per = packed.select("role", F.size("ids").alias("docs"), F.octet_length("tokens").alias("bytes"))
    sizes = {r["role"]: r for r in per.groupBy("role").agg(F.sum("docs").alias("docs"), F.sum("bytes").alias("bytes"), F.count("*").alias("n")).collect()}
    everything = sum(r["n"] for r in sizes.values()) * block_tokens * order
    parts = 1 << max(0, math.ceil(math.log2(max(1, everything / 2 / part_keys))))
    found = counts(packed, parts, order)
    stat = found.filter("block is null").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_counted", "n_deleted", "v_counted", "v_all")]).first()
    documents = {r: x["docs"] for r, x in sizes.items()}
    held = held_out_counts(packed, found, documents.get(COUNTED, 0), order)
    weights = learned(held, stat[0], stat[2], order)
    tokens, vocabulary = stat[0] + stat[1], stat[3]
    begun = documents.get(COUNTED, 0) + documents.get(DELETED, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in rows.groups(batches, 0):
            b, grams, contexts = _looked_up(table, order, True)
            for c in contexts:
                c[b.begins] = begun
            mix = weights[_bucket(contexts)] if contexts else np.broadcast_to(weights[0], (len(grams[0]), order + 1))
            p = mix[:, 0] / (vocabulary + 1) + mix[:, 1] * grams[0] / max(tokens, 1)
            for k, (g, c) in enumerate(zip(grams[1:], contexts)):
                p = p + mix[:, k + 2] * g / np.maximum(c, 1)
            base = np.log10((grams[0] + 1.0) / (tokens + vocabulary + 1.0))
            at = np.cumsum(b.sizes) - b.sizes
            ids = table["ids"].combine_chunks().slice(0, 1).flatten()
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(np.full(len(ids), table["role"][0].as_py(), np.int32)),
                    pa.array(b.sizes),
                    pa.array(np.add.reduceat((grams[0] > 0).astype(np.int64), at)),
                    pa.array(np.full(len(ids), tokens, np.int64)),
                    pa.array(np.add.reduceat(base, at)),
                    pa.array(np.add.reduceat(np.log10(p), at)),
                ],
                names=["id", "role", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    met = _met(packed, found, ["ids", "sizes", "vocab", "tokens"])
    kind = docs.schema[doc_id].dataType.simpleString()
    return met.mapInArrow(run, f"id {kind}, role int, n_tokens long, n_known long, train_tokens long, base_score double, score double")


rows.shipped(__name__)
