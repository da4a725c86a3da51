"""SimHash near-duplicates by the generalised pigeonhole principle.

Two 64-bit fingerprints within distance ``t`` of each other cannot differ by
more than T_i in every part i of the bits when the T_i + 1 add up to t + 1.
Correlated bits are put into the same part, so that the other parts stay
selective, and the T_i are allotted by dynamic programming on estimated
numbers of candidates: a part may be skipped (-1), must be equal (0) or may
differ in T_i bits, which are then enumerated. Candidates share a part's value
and are verified on all bits.

Equal fingerprints are one class from the start, so copies are never paired.
A value that a large group of near copies shares is not paired either: its
members are compared with its smallest and largest first, and then only with
members that are still in other components.

Defined results: a missing text is an empty one; texts without words have the
fingerprint zero and are linked like any other. Rows that repeat belong
together. An empty table has no fingerprints and no links.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import components, rows, words
from tidemark.llm.interpolation import _pack, _pack_sorted, _unpack, _unpack_sorted
from tidemark.sources import workdir

BITS = 64
SEED = 42
# A signature is shuffled; a candidate is compared where it is.
SIGNATURE_COST = 6
# Near copies share this part of their five-word shingles, in percent.
SIMILAR = 80
# Independent fingerprints of a text for near copies, and the distance at which one of them finds a pair for certain.
FINGERPRINTS, CERTAIN = 64, 2
# Random words of their bits, of which a shingle's hash chooses one; so many fingerprints share a choice.
HASH_WORDS, SHARING = 1024, 8
# The first fingerprints tell candidates from chance meetings and far relatives: so many, and standard deviations beyond the mean.
CHECKED, DEVIATIONS = 32, 5
# An even number of shingles may be tied. The share of bits that differs between four and five, and below which
# the bits set tell of less than some 40.
TIED, FEW = 3 / 16, 0.44
# Nodes that meet in a value of up to this many others are compared on its whole fingerprint there.
MET_DEVIATIONS, MET_LAGS = 3.5, 64
# Times that each node's nearest is verified before all others.
ROUNDS = 2
# Part values of three nodes or more are broadcast up to this number.
BROADCAST_VALUES = 200_000
# Part values that a block of nodes sends at once, and that a task brings together.
BLOCK_VALUES, TASK_VALUES = 800_000, 1_000_000


def _shingle_hashes(data: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, and the index of each text's first one."""
    starts, ends, first = words.bounds_of_words(data, bounds)
    counts = np.diff(first)
    shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    offsets = np.concatenate([[0], np.cumsum(shingles)])
    head = np.repeat(first[:-1] - offsets[:-1], shingles) + np.arange(offsets[-1])
    tail = np.minimum(head + size, np.repeat(first[1:], shingles)) - 1
    # Words that follow each other at one character are joined already.
    gap = np.zeros(len(starts) + 1, np.int64)
    gap[1:-1] = np.cumsum(starts[1:] != ends[:-1] + 1) if len(starts) else 0
    joined = gap[tail] == gap[head]
    buffer = np.where(words.IS_WORD[data], data, np.uint8(0x20)).tobytes()
    hash_of, s, e = xxhash.xxh64_intdigest, starts[head].tolist(), ends[tail].tolist()
    found = np.fromiter((hash_of(buffer[a:b], SEED) for a, b in zip(s, e)), np.uint64, len(s))
    for k in np.flatnonzero(~joined).tolist():
        found[k] = hash_of(b" ".join(buffer[s[k] : e[k]].split(b" ")[i] for i in _filled(buffer[s[k] : e[k]])), SEED)
    return found, offsets


def _filled(piece: bytes) -> list[int]:
    return [i for i, word in enumerate(piece.split(b" ")) if word]


def _majority(found: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One fingerprint per text: the bits that are set in over half of its hashes."""
    counts = np.diff(offsets)
    out = np.zeros(len(counts), np.uint64)
    filled = np.flatnonzero(counts)
    if len(filled):
        bits = np.unpackbits(found.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, offsets[filled], axis=0, dtype=np.int64)
        out[filled] = np.packbits(2 * ones > counts[filled, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprint(text: Column, size: int = 3) -> Column:
    """The 64-bit fingerprint of a text as a signed long; without words it is zero."""

    @F.arrow_udf("bigint")
    def of(texts: pa.Array) -> pa.Array:
        out = [np.zeros(0, np.uint64)]
        for _, _, data, bounds in words.slices(texts, lower=True):
            out.append(_majority(*_shingle_hashes(data, bounds, size)))
        return pa.array(np.concatenate(out).view(np.int64))

    return of(text)


def _bit_pairs(classes: DataFrame) -> tuple[np.ndarray, int]:
    """How many nodes have both of two bits set, as 64 x 64 sums over all nodes, and how many nodes there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at].astype(np.int64))], ["at", "n"])

    sums = classes.select("fp").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    table = np.zeros(BITS * BITS)
    for row in sums.collect():  # 4096 rows at most
        table[row["at"]] = row["n"]
    return table.reshape(BITS, BITS), classes.count()


def _groups(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """Split the bits into parts of near equal width, each filled with the bits that go with it most."""
    left, out = set(range(BITS)), []
    for k in range(parts):
        width = BITS // parts + (k < BITS % parts)
        group = [max(left, key=lambda b: (correlation[b, sorted(left)].sum(), -b))]
        left.remove(group[0])
        while len(group) < width:
            group.append(max(left, key=lambda b: (correlation[b, group].max(), -b)))
            left.remove(group[-1])
        out.append(sorted(group))
    return out


def _likely(both: np.ndarray, n: int, group: list[int], t: int) -> float:
    """Estimated share of pairs of classes that differ in at most ``t`` bits of the part.

    Mean and variance of the distance follow from the bit pairs; correlated bits
    count as fewer independent ones.
    """
    p = both / max(n, 1)
    one = np.diag(p)
    i, j = np.meshgrid(group, group)
    differ = 2 * one[group] * (1 - one[group])
    p11, p10, p01 = p[i, j], one[i] - p[i, j], one[j] - p[i, j]
    joint = 2 * (p11 * (1 - p11 - p10 - p01) + p10 * p01)
    np.fill_diagonal(joint, differ)
    variance = float((joint - np.outer(differ, differ)).sum())
    q = min(max(float(differ.mean()), 1e-6), 0.5)
    bits = len(group) * min(1.0, len(group) * q * (1 - q) / max(variance, 1e-9))
    odds = q / (1 - q)
    return min(1.0, (1 - q) ** bits * sum(math.comb(len(group), k) * odds**k for k in range(t + 1)))


def plan(both: np.ndarray, n: int, distance: int) -> list[tuple[list[int], int]]:
    """(bits, allowed difference) of each part that is probed, at the least estimated cost.

    The cost counts the signatures and the candidates. For every number of
    parts, ``best[s]`` is the cheapest way to let the T_i + 1 so far add up to s.
    """
    one = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(one * (1 - one), 1e-9))
    correlation = np.abs(both / max(n, 1) - np.outer(one, one)) / np.outer(spread, spread)
    np.fill_diagonal(correlation, 0)
    answer: tuple[float, list] = (math.inf, [])
    for parts in range(1, distance + 3):
        best: dict[int, tuple[float, list]] = {0: (0.0, [])}
        for group in _groups(correlation, parts):
            step: dict[int, tuple[float, list]] = {}
            for used, (cost, chosen) in best.items():
                for t in range(-1, distance - used + 1):
                    probes = sum(math.comb(len(group), k) for k in range(t + 1))
                    more = SIGNATURE_COST * n * (probes + (t >= 0)) + (n * n / 2 * _likely(both, n, group, t) if t >= 0 else 0)
                    key, value = used + t + 1, (cost + more, chosen + [(group, t)] * (t >= 0))
                    if key not in step or value[0] < step[key][0]:
                        step[key] = value
            best = step
        answer = min(answer, best[distance + 1], key=lambda x: x[0])
    return answer[1]


def _mask(bits: list[int] | tuple[int, ...]) -> int:
    """The bits as a signed 64-bit value."""
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


def _all_flips(group: list[int], t: int) -> list[int]:
    return [_mask(c) for k in range(t + 1) for c in itertools.combinations(group, k)]


def links(nodes: DataFrame, distance: int, verified: Callable[[DataFrame], DataFrame] = lambda pairs: pairs) -> DataFrame:
    """(a, b): links between nodes ``(node, fp)`` that join all that is linked; a saved table.

    Candidates meet in a value of one part. First each node is compared with the
    smallest and the largest node of each of its values, which is linear. Most of a large group of
    copies is one component then. Then the candidates of different components
    are compared: pairs inside a component could add nothing. ``verified`` may
    drop pairs by a closer look.
    """
    nodes = nodes.select("node", "fp")
    parts = plan(*_bit_pairs(nodes), distance)
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other_fp"))) <= distance

    def index(rows_: DataFrame) -> DataFrame:
        values = [F.struct(F.lit(k).alias("part"), F.col("fp").bitwiseAND(F.lit(_mask(g))).alias("key")) for k, (g, _) in enumerate(parts)]
        return rows_.select("*", F.explode(F.array(*values)).alias("at"))

    def probes(rows_: DataFrame) -> DataFrame:
        flips = [F.struct(F.lit(k).alias("part"), F.lit(_mask(g)).alias("mask"), F.lit(x).alias("flip")) for k, (g, t) in enumerate(parts) for x in _all_flips(g, t)]
        at = F.struct(F.col("p.part").alias("part"), F.col("fp").bitwiseAND(F.col("p.mask")).bitwiseXOR(F.col("p.flip")).alias("key"))
        return rows_.withColumn("p", F.explode(F.array(*flips))).withColumn("at", at).drop("p")

    both = F.struct("node", "fp")
    ends = index(nodes).groupBy("at").agg(F.array(F.min(both), F.max(both)).alias("ends"))
    leaders = ends.select("at", F.explode("ends").alias("l")).select("at", F.col("l.node").alias("other"), F.col("l.fp").alias("other_fp"))
    near_leader = index(nodes).join(leaders, "at").filter((F.col("node") != F.col("other")) & near)
    pairs = near_leader.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    linked = workdir.saved(verified(pairs), "links")
    roots = components.roots(linked).withColumnRenamed("root", "part_of")
    parted = nodes.join(roots, "node", "left").select("node", "fp", F.coalesce("part_of", "node").alias("part_of"))
    parted = workdir.saved(parted, "parted")
    others = index(parted).select("at", F.col("node").alias("other"), F.col("fp").alias("other_fp"), F.col("part_of").alias("other_of"))
    mixed = others.groupBy("at").agg(F.min("other_of").alias("low"), F.max("other_of").alias("high"))
    # A value whose nodes are one component matters to nodes of other components only.
    apart = (F.col("part_of") != F.col("low")) | (F.col("part_of") != F.col("high"))
    asking = probes(parted).join(mixed, "at").filter(apart).drop("low", "high")
    rest = asking.join(others, "at").filter((F.col("part_of") != F.col("other_of")) & near)
    pairs = rest.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    return linked.union(workdir.saved(verified(pairs), "links"))


def clusters(marked: DataFrame, doc_id: str = "doc_id", fp: str = "fp", distance: int = 2) -> DataFrame:
    """Add ``component_id``, the smallest ``doc_id`` reachable, to rows that have a fingerprint.

    ``marked`` is read several times and should be a saved table. Rows of equal
    fingerprints belong together, repeated ones too. Missing ids are not the
    smallest unless a component has no other; then its id is missing as well.
    """
    ids = F.col(doc_id)
    classes = workdir.saved(marked.groupBy(F.col(fp).alias("fp")).agg(F.min(ids).alias("least")), "classes")
    roots = components.roots(links(classes.select(F.col("fp").alias("node"), "fp"), distance))
    rooted = classes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = rooted.join(least, "root").select(F.col("fp").alias("_fp"), "component_id")
    return marked.join(of_fp, F.col(fp) == F.col("_fp")).drop("_fp")


def shingle_set(text: Column, size: int) -> Column:
    """Distinct hashes of the word shingles of a text; the whole of a shorter one."""

    def windows(words_: Column) -> Column:
        count = F.size(words_)
        starts = F.slice(words_, 1, F.greatest(count - (size - 1), F.lit(1)))
        return F.array_distinct(
            F.transform(starts, lambda w, i: F.xxhash64(w, *[F.get(words_, i + k) for k in range(1, size)]))
        )

    return rows.let(rows.words_of(rows.ascii_lower(text)), windows)


def similar(pairs: DataFrame, sets: DataFrame, percent: int = SIMILAR) -> DataFrame:
    """The pairs whose shingle sets ``(node, shingles)`` are alike in ``percent`` of their union or more."""
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("mine")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("theirs")), "b")
    common = F.size(F.array_intersect("mine", "theirs"))
    sized = both.select("a", "b", common.alias("common"), (F.size("mine") + F.size("theirs")).alias("sizes"))
    return sized.filter(F.col("common") * (100 + percent) >= percent * F.col("sizes")).select("a", "b")


def fingerprints(text: Column, shingle: int) -> Column:
    """``FINGERPRINTS`` independent 64-bit fingerprints of the distinct shingles of a text.

    A shingle's hash chooses a random word of bits, and whether it is inverted, anew
    for every ``SHARING`` fingerprints; a bit is 1 if it is set in over half of the
    words. Sums are whole numbers, so a text has the same bits in every batch.
    """

    @F.arrow_udf("array<bigint>")
    def of(texts: pa.Array) -> pa.Array:
        drawn = np.random.default_rng(SEED).integers(0, 1 << 64, (HASH_WORDS, FINGERPRINTS), np.uint64)
        signs = np.unpackbits(drawn.view(np.uint8), axis=1, bitorder="little").astype(np.float32) * 2 - 1
        out = [np.zeros((0, FINGERPRINTS), np.uint64)]
        for _, _, data, bounds in words.slices(texts, lower=True):
            found, offsets = _shingle_hashes(data, bounds, shingle)
            for first in range(0, len(offsets) - 1, 256):
                cut = offsets[first : first + 257]
                count, mine = len(cut) - 1, found[cut[0] : cut[-1]]
                owner = np.repeat(np.arange(count, dtype=np.uint64), np.diff(cut))
                distinct = np.unique((owner << np.uint64(48)) | (mine >> np.uint64(16)))
                owner, key = (distinct >> np.uint64(48)) * np.uint64(HASH_WORDS), distinct & np.uint64((1 << 48) - 1)
                sums = []
                for turn in range(0, FINGERPRINTS, SHARING):
                    chosen = words.mixed(key + (np.uint64(turn + 1) << np.uint64(48)))
                    weight = np.where(chosen >> np.uint64(63), -1.0, 1.0)
                    place = (owner + chosen % np.uint64(HASH_WORDS)).astype(np.int64)
                    weights = np.bincount(place, weight, count * HASH_WORDS).reshape(count, HASH_WORDS).astype(np.float32)
                    sums.append(weights @ signs[:, turn * BITS : (turn + SHARING) * BITS])
                out.append(np.packbits(np.hstack(sums) > 0, axis=1, bitorder="little").view(np.uint64))
        whole = np.concatenate(out).view(np.int64)
        ends = np.arange(0, whole.size + 1, FINGERPRINTS)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(whole.ravel()))

    return of(text)


def _chance(percent: int) -> float:
    """The chance that a bit differs between sets alike in ``percent`` of their union."""
    share = percent / 100
    return math.acos(2 * share / (1 + share)) / math.pi


def _most(p: float, bits: int, deviations: float) -> int:
    """How many bits differ at most, but by rare chance, if each does with the chance ``p``."""
    return math.floor(bits * p + deviations * math.sqrt(bits * p * (1 - p)))


def _columns(parts: list[tuple[list[int], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fingerprint, mask, what is flipped and the part's salt) of every value that a text has."""
    number, mask, change = [], [], []
    for k, (group, t) in enumerate(parts):
        for n in range(FINGERPRINTS):
            salt = words.mixed(np.array([n * len(parts) + k]))
            for flip in np.array(_all_flips(group, t), np.int64).view(np.uint64):
                number.append(n)
                mask.append(_mask(group))
                change.append((flip ^ salt)[0])
    return np.array(number), np.array(mask, np.int64).view(np.uint64), np.array(change, np.uint64)


def _met(at: np.ndarray, prints: np.ndarray, most: int) -> np.ndarray:
    """Which of the values, in order of ``at``, have an equal one whose fingerprint differs in ``most`` bits at most."""
    met = np.zeros(len(at), bool)
    for lag in range(1, MET_LAGS + 1):
        first = np.flatnonzero(at[lag:] == at[:-lag])
        if not len(first):
            break
        first = first[np.bitwise_count(prints[first] ^ prints[first + lag]) <= most]
        met[first] = met[first + lag] = True
    return met


def shared_values(nodes: DataFrame, parts: list[tuple[list[int], int]], most: int = BITS) -> DataFrame:
    """(at, row): the nodes ``(row, prints)`` at each part's value that more than one of them has; a saved table.

    Of the nodes that meet in a value of up to ``MET_LAGS`` of them only those are kept that differ
    from another one there in ``most`` bits of the part's whole fingerprint at most.

    Most values stand alone or are met by chance, so they travel packed: a block
    of nodes sends each task that brings values together the numbers of the
    values, of the rows and the fingerprints. A task unpacks one block's
    share at a time, and values of many nodes are not gathered, so a value may have any number.
    """
    number, mask, change = _columns(parts)
    width = len(number)
    tasks = max(1, math.ceil(nodes.count() * width / TASK_VALUES))
    size = max(1, BLOCK_VALUES // width)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(0).to_numpy().view(np.uint64)
            every = batch.column(1).flatten().to_numpy().view(np.uint64).reshape(-1, FINGERPRINTS)
            for first in range(0, len(numbers), size):
                prints = np.ascontiguousarray(every[first : first + size].T)
                task = np.empty((width, prints.shape[1]), np.uint16 if tasks <= 1 << 16 else np.uint32)
                for k in range(width):
                    at = words.mixed((prints[number[k]] & mask[k]) ^ change[k])
                    task[k] = (at >> np.uint64(32)) % np.uint64(tasks)
                order = np.argsort(task.ravel(), kind="stable")
                cuts = [0, *np.cumsum(np.bincount(task.ravel(), minlength=tasks)).tolist()]
                some = [k for k in range(tasks) if cuts[k] < cuts[k + 1]]
                packed = []
                for k in some:
                    column, row = np.divmod(order[cuts[k] : cuts[k + 1]], prints.shape[1])
                    packed.append((_pack_sorted(column.astype(np.uint64)), _pack(numbers[first + row]), _pack(prints[number[column], row])))
                columns = [pa.array(some, pa.int64()), *[pa.array(x, pa.binary()) for x in zip(*packed)]]
                yield pa.RecordBatch.from_arrays(columns, ["task", "columns", "rows", "prints"])

    def values(table: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray]:
        column = _unpack_sorted(table["columns"][k].as_py()).astype(np.int64)
        bits = _unpack(table["prints"][k].as_py())
        return words.mixed((bits & mask[column]) ^ change[column]), bits

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in rows.groups(batches, 0):
            several, often = [], []
            for k in range(len(table)):
                at, count = np.unique(values(table, k)[0], return_counts=True)
                several.append(at)
                often.append(count.astype(np.int32))
            several, often = np.concatenate(several), np.concatenate(often)
            order = np.argsort(several)
            several, often = several[order], often[order]
            start = np.flatnonzero(np.diff(several, prepend=~several[:1]))
            several, often = several[start], np.add.reduceat(often, start)
            gathered = []
            for k in range(len(table)):
                at, bits = values(table, k)
                row = _unpack(table["rows"][k].as_py())
                count = often[np.searchsorted(several, at)]
                if (held := count > MET_LAGS + 1).any():
                    yield pa.RecordBatch.from_arrays([pa.array(at[held].view(np.int64)), pa.array(row[held].view(np.int64))], ["at", "row"])
                held = (count > 1) & ~held
                gathered.append((at[held], row[held], bits[held]))
            at, row, bits = (np.concatenate(x) for x in zip(*gathered))
            order = np.argsort(at, kind="stable")
            order = order[_met(at[order], bits[order], most)]
            yield pa.RecordBatch.from_arrays([pa.array(at[order].view(np.int64)), pa.array(row[order].view(np.int64))], ["at", "row"])

    sent = nodes.select("row", "prints").mapInArrow(send, "task long, columns binary, rows binary, prints binary")
    return workdir.saved(sent.repartition("task").sortWithinPartitions("task").mapInArrow(meet, "at long, row long"), "shared")


def print_links(nodes: DataFrame, percent: int, verified: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(a, b): verified links between nodes ``(node, prints)`` that share a part's value; a saved table.

    Parts and thresholds are planned for the distance ``CERTAIN`` on the first
    fingerprint; the others are drawn in the same way and take the same plan.
    Pairs within that distance in any fingerprint are found for certain, others
    by chance in any part of any of them. Members of a value are compared with
    its smallest first. The smallest and the nearest of those are verified for each node
    before any other pair, and again the nearest in another component; most of a
    large group is one component then. Verified after that are only pairs of
    different components: what is left of these, and other members of a value.
    Until then a node is its row's number, which is short.
    """
    ones = F.aggregate("prints", F.lit(0), lambda n, x: n + F.bit_count(x))
    few = (ones < FEW * BITS * FINGERPRINTS).alias("few")
    nodes = workdir.saved(nodes.select(F.monotonically_increasing_id().alias("row"), "node", "prints", few), "texts")
    parts = plan(*_bit_pairs(nodes.select(F.get("prints", F.lit(0)).alias("fp"))), CERTAIN)
    checks = [f"c{k}" for k in range(CHECKED)]
    checked = nodes.select("row", "node", "few", *[F.get("prints", F.lit(k)).alias(c) for k, c in enumerate(checks)])
    differ = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"other_{c}"))) for c in checks), F.lit(0))
    others_of = lambda df: df.select(*[F.col(c).alias(f"other_{c}") for c in df.columns])
    ordered = lambda df: df.select(F.least("node", "other_node").alias("a"), F.greatest("node", "other_node").alias("b")).distinct()
    limit = lambda p: F.lit(_most(p, BITS * CHECKED, DEVIATIONS))
    usual = _chance(percent)
    near = differ <= F.when(F.col("few") | F.col("other_few"), limit(max(TIED, usual))).otherwise(limit(usual))

    posted = shared_values(nodes, parts, max(CERTAIN, _most(usual, BITS - min(len(group) for group, _ in parts), MET_DEVIATIONS)))
    ends = posted.groupBy("at").agg(F.min("row").alias("low"), F.max("row").alias("high"), F.count("*").alias("n"))
    ends = workdir.saved(ends.filter("low < high"), "ends")
    large = ends.filter("n > 2").select("at", "low")
    large = F.broadcast(large) if large.count() <= BROADCAST_VALUES else large
    shared = workdir.saved(posted.join(large, "at"), "large")
    met = ends.filter("n = 2").select(F.col("low").alias("a"), F.col("high").alias("b"))
    met = met.union(shared.filter("row <> low").select("low", "row"))
    left = met.distinct().join(checked.withColumnRenamed("row", "a"), "a")
    close = left.join(others_of(checked).withColumnRenamed("other_row", "b"), "b").filter(near)
    close = close.select(F.col("a").alias("row"), "node", F.col("b").alias("other_row"), "other_node", differ.alias("differ"))
    close = workdir.saved(close, "close")

    tried, linked, roots, left = [], [], None, close
    for turn in range(ROUNDS):
        turned = left.select(*[F.col(c).alias(d) for c, d in zip(["other_row", "other_node", "row", "node", "differ"], close.columns)])
        wanted = [F.min(F.struct("differ", "other_row", "other_node")).other_node]
        if not turn:
            wanted.append(F.min(F.struct("other_row", "other_node")).other_node)
        best = left.union(turned).groupBy("node").agg(F.array_distinct(F.array(*wanted)).alias("best"))
        tried.append(workdir.saved(ordered(best.select("node", F.explode("best").alias("other_node"))), "best"))
        linked.append(workdir.saved(verified(tried[-1]), "links"))
        roots = components.roots(functools.reduce(DataFrame.union, linked)).withColumnRenamed("root", "part_of")
        apart = F.coalesce("part_of", "node") != F.coalesce("other_part_of", "other_node")
        left = close.join(roots, "node", "left").join(others_of(roots), "other_node", "left").filter(apart).select(close.columns)

    parted = shared.select("at", "row").join(checked, "row").join(roots, "node", "left")
    parted = parted.select("at", "node", "few", *checks, F.coalesce("part_of", "node").alias("part_of"))
    mixed = parted.groupBy("at").agg(F.min("part_of").alias("low"), F.max("part_of").alias("high")).filter(F.col("low") != F.col("high"))
    asking = workdir.saved(parted.join(mixed.select("at"), "at"), "parted")
    others = others_of(asking).withColumnRenamed("other_at", "at")
    rest = asking.join(others, "at").filter((F.col("part_of") != F.col("other_part_of")) & (F.col("node") < F.col("other_node")) & near)
    rest = ordered(rest.select("node", "other_node").union(left.select("node", "other_node")))
    rest = rest.join(functools.reduce(DataFrame.union, tried), ["a", "b"], "left_anti")
    linked.append(workdir.saved(verified(rest), "links"))
    return functools.reduce(DataFrame.union, linked)


def _chosen(marked: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``marked`` whose number ``row`` is in ``chosen``. One bit a row is broadcast, so whole rows are not shuffled."""
    number = F.col("row") + 1  # buckets are counted from 1
    numbers = chosen.select(F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("place"))
    bits = numbers.repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("place").alias("bits"))
    place = F.bitmap_bit_position(number).cast("int")
    byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    has = F.getbit(byte, place % 8) == 1
    return marked.join(F.broadcast(bits), (F.bitmap_bucket_number(number) == F.col("bucket")) & has, "left_semi")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = SIMILAR) -> DataFrame:
    """One document of each group of near copies, the one of the smallest id, with its own columns.

    Candidates are proposed by ``FINGERPRINTS`` independent fingerprints; those that
    share ``percent`` of their distinct shingles of ``shingle`` words are linked.
    At a share s a bit differs with a chance of p = acos(2s / (1 + s)) / pi at
    most, whatever the kind of edit, and with three parts a pair is missed with
    (1 - (1 - p) ** (64 / 3)) ** (3 * FINGERPRINTS): 0.28 % at 0.80, 0.0032 % at 0.85
    (0.281 % with the fingerprint compared where the pair meets, 0.279 % without).
    Sets of less than some 40 shingles are tied more often: 3 / 16 of the bits of four and five differ.
    Groups are connected components. Equal texts are one node. Of
    rows that tie in id and text, one stays; missing ids come last.
    """
    whole = rows.text_of(text)
    marked = docs.select(
        rows.packed(docs).alias("doc"),
        F.col(doc_id).alias("id"),
        F.xxhash64(whole).alias("node"),
        F.monotonically_increasing_id().alias("row"),
    )
    marked = workdir.saved(marked, "marked")
    # One row of each text.
    nodes = workdir.saved(marked.groupBy("node").agg(F.min("row").alias("row")), "nodes")
    printed = _chosen(marked, nodes).select("node", fingerprints(F.col(f"doc.`{text}`"), shingle).alias("prints"))

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = workdir.saved(pairs, "pairs")
        asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        met = _chosen(marked, nodes.join(asked, "node", "left_semi"))
        sets = met.select("node", shingle_set(rows.text_of(f"doc.`{text}`"), shingle).alias("shingles"))
        return similar(pairs, workdir.saved(sets, "shingles"), percent)

    roots = components.roots(print_links(printed, percent, verified))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    first = marked.select("node", order.alias("o")).groupBy("node").agg(F.min("o").alias("o"))
    rooted = first.join(roots, "node", "left").select("o", F.coalesce("root", "node").alias("root"))
    stays = rooted.groupBy("root").agg(F.min("o").alias("o")).select(F.col("o.row").alias("row"))
    return rows.unpacked(_chosen(marked, stays))


rows.shipped(__name__)
