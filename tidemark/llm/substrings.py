"""Removal of word sequences that occur more than once, by suffix automata of reference shards.

A suffix automaton of the whole corpus, or one per piece of it that every
document passes through, would cost the square of the corpus. So the reference
is cut by content: each window of ``window`` words has an anchor, the
``ANCHOR`` words in it of the smallest hash. Equal windows have equal anchors;
windows in a row with one anchor form a run. Only runs whose anchor stands in
two places or more can repeat. Where the runs of an anchor are all equal, they
repeat as they are. The distinct texts of the others are the reference; its
shards are dealt by anchor, and each shard's automaton goes with the runs of
its anchors to one task. The runs stream through it for their matching
statistics: at each word, the longest suffix that occurs at least twice. Where
that is ``window`` words or more, a window repeats; the union of these spans is
removed.

An anchor that thousands of different runs share would make one shard large.
The windows of such anchors are counted one by one by their own hash instead,
which gives the same answer and splits at will.

Defined results: a missing text has no words. Rows that repeat are copies of
each other. Texts of fewer words than a window keep all. Words are told apart
by 64-bit hashes.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import rows, words
from tidemark.sources import workdir

WINDOW = 35
ANCHOR = 8
SHARD_WORDS = 200_000
HOT_RUNS = 4096
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, count: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(count - 1, 0), base)]), dtype=np.uint64)[:count]


class _Sequences:
    """Hashes of any stretch of words in constant time."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * _powers(_BASE, len(hashes)), dtype=np.uint64)])
        self.back = _powers(_INVERSE, len(hashes) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return words.mixed((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def _argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest value, the first of equals, of every ``width`` values in a row."""
    at, span = np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        left, right = at[:-step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        span += step
    return at


def _runs(hashes: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(text, start within it, windows, anchor, text hash) of each run of windows with one anchor."""
    counts = np.diff(first)
    none = np.zeros(0, np.int64)
    if len(hashes) < window:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    sequences = _Sequences(hashes)
    grams = np.arange(len(hashes) - ANCHOR + 1)
    anchors = sequences.of(grams, grams + ANCHOR)
    least = _argmin(anchors, window - ANCHOR + 1)
    whole = np.maximum(counts - window + 1, 0)
    begin = np.concatenate([[0], np.cumsum(whole)])
    text = np.repeat(np.arange(len(counts)), whole)
    start = np.arange(begin[-1]) - begin[text] + first[text]
    at = least[start]
    head = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])]))[: len(start)]
    size = np.diff(np.append(head, len(start)))
    return text[head], start[head] - first[text[head]], size, anchors[at[head]], sequences.of(start[head], start[head] + size + window - 1)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def anchors(docs: DataFrame, text: str, window: int = WINDOW) -> DataFrame:
    """(anchor) of all runs whose anchor stands in two places or more; a saved table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, _, data, bounds in words.slices(batch.column(0)):
                starts, ends, first = words.bounds_of_words(data, bounds)
                found.append(_runs(words.hashes(data, starts, ends), first, window)[3])
            anchor, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0))
            yield pa.RecordBatch.from_arrays([_signed(anchor), pa.array(n.astype(np.int64))], names=["anchor", "n"])

    counted = docs.select(text).mapInArrow(run, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    return workdir.saved(counted.filter("n > 1").select("anchor"), "anchors")


def _identity(doc_id: str, text: str) -> list[Column]:
    return [F.col(doc_id).alias("id"), F.xxhash64(rows.text_of(text)).alias("hash")]


def occurrences(docs: DataFrame, repeated: DataFrame, doc_id: str, text: str, window: int = WINDOW) -> DataFrame:
    """(anchor, run, place, id, hash) of all runs of the repeated anchors; a saved table.

    ``run`` is the hash of the run's words, ``place`` its start and number of windows in one value.
    """
    kept = docs.select(*_identity(doc_id, text), F.col(text).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, bounds in words.slices(batch.column(2)):
                starts, ends, first = words.bounds_of_words(data, bounds)
                of, start, size, anchor, run = _runs(words.hashes(data, starts, ends), first, window)
                take = pa.array(of)
                own = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [_signed(anchor), _signed(run), pa.array((start << 8) | size), own.column(0).take(take), own.column(1).take(take)],
                    names=["anchor", "run", "place", "id", "hash"],
                )

    kind = kept.schema["id"].dataType.simpleString()
    found = kept.mapInArrow(cut, f"anchor long, run long, place long, id {kind}, hash long")
    return workdir.saved(found.join(repeated, "anchor"), "occurrences")


def _references(docs: DataFrame, found: DataFrame, doc_id: str, text: str, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(anchor, run, twice, hot, words) for each distinct run, its words from one place where it stands; a saved table.

    Where all places of an anchor have the same run, that run repeats as a
    whole and there is nothing to match it with; the second table has these as
    (run, spans).
    """
    one = F.min(F.struct("id", "hash", "place")).alias("one")
    distinct = found.groupBy("anchor", "run").agg(F.count("*").alias("n"), one)
    distinct = workdir.saved(distinct.select("anchor", "run", (F.col("n") > 1).alias("twice"), "one.*"), "runs")
    per = distinct.groupBy("anchor").agg(F.count("*").alias("runs"), F.min(F.struct("run", "place")).alias("only"))
    per = workdir.saved(per, "anchor-runs")
    windows = F.col("only.place").bitwiseAND(F.lit(255)).cast("int")
    alone = per.filter("runs = 1").select("only.run", F.array(F.struct(F.lit(0).alias("from"), windows.alias("to"))).alias("spans"))
    several = per.filter("runs > 1").select("anchor", (F.col("runs") > HOT_RUNS).alias("hot"))
    marked = distinct.join(several, "anchor")
    # The list holds runs of one document.
    wanted = marked.groupBy("id", "hash").agg(F.collect_list(F.struct("place", "anchor", "run", "twice", "hot")).alias("runs"))
    texts = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(rows.text_of(text)).alias("_hash"), F.col(text).alias("text"))
    met = texts.join(wanted, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_hash") == F.col("hash"))).select("text", "runs")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, bounds in words.slices(batch.column(0)):
                starts, ends, first = words.bounds_of_words(data, bounds)
                hashes = words.hashes(data, starts, ends)
                lists = batch.column(1).slice(a, b - a)
                runs = lists.flatten()
                place = runs.field("place").to_numpy()
                sizes = np.diff(lists.offsets.to_numpy())
                begin = np.repeat(first[:-1], sizes) + (place >> 8)
                stretch = [hashes[s : s + n].tobytes() for s, n in zip(begin.tolist(), ((place & 255) + window - 1).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [runs.field("anchor"), runs.field("run"), runs.field("twice"), runs.field("hot"), pa.array(stretch, pa.binary())],
                    names=["anchor", "run", "twice", "hot", "words"],
                )

    once = met.mapInArrow(fetch, "anchor long, run long, twice boolean, hot boolean, words binary")
    # A text that stands in several rows was fetched from each.
    return workdir.saved(once.dropDuplicates(["anchor", "run"]), "references"), alone


class Automaton:
    """Suffix automaton of several sequences, with how often its substrings occur, up to twice.

    Nearly all states have one move, which lies in two flat arrays; the further
    moves of the others are in a dictionary for each.
    """

    def __init__(self) -> None:
        self.symbol, self.target = array("i", [-1]), array("i", [0])
        self.more: dict[int, dict[int, int]] = {}
        self.link, self.length, self.count = array("i", [-1]), array("i", [0]), array("q", [0])

    def _move(self, state: int, symbol: int) -> int:
        if self.symbol[state] == symbol:
            return self.target[state]
        more = self.more.get(state)
        return more.get(symbol, -1) if more else -1

    def _set(self, state: int, symbol: int, target: int) -> None:
        if self.symbol[state] in (-1, symbol):
            self.symbol[state], self.target[state] = symbol, target
        else:
            self.more.setdefault(state, {})[symbol] = target

    def _split(self, p: int, symbol: int, q: int) -> int:
        """The part of state ``q`` that ends the paths from ``p``, as a state of its own."""
        clone = len(self.link)
        self.symbol.append(self.symbol[q])
        self.target.append(self.target[q])
        if q in self.more:
            self.more[clone] = self.more[q].copy()
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.count.append(0)
        self.link[q] = clone
        while p >= 0 and self._move(p, symbol) == q:
            self._set(p, symbol, clone)
            p = self.link[p]
        return clone

    def add(self, sequence: list[int], times: int) -> array:
        """Add a sequence that occurs ``times`` times; the states of its prefixes, which no later one changes."""
        link, length, count, first, target, more = self.link, self.length, self.count, self.symbol, self.target, self.more
        last, states = 0, array("i")
        for symbol in sequence:
            q = self._move(last, symbol)
            if q >= 0:  # the prefix is known
                last = q if length[q] == length[last] + 1 else self._split(last, symbol, q)
                count[last] += times
            else:
                new, p = len(link), last
                first.append(-1)
                target.append(0)
                length.append(length[last] + 1)
                count.append(times)
                link.append(0)
                q = -1
                while p >= 0:
                    if first[p] == -1:
                        first[p], target[p] = symbol, new
                    elif first[p] == symbol:
                        q = target[p]
                        break
                    else:
                        further = more.get(p)
                        if further is None:
                            more[p] = {symbol: new}
                        elif symbol in further:
                            q = further[symbol]
                            break
                        else:
                            further[symbol] = new
                    p = link[p]
                if p >= 0:
                    link[new] = q if length[q] == length[p] + 1 else self._split(p, symbol, q)
                last = new
            states.append(last)
        return states

    def finish(self) -> None:
        """Let every state count what its longer ones do, and know its longest suffix that occurs twice."""
        link, count = self.link, self.count
        order = np.argsort(np.frombuffer(self.length, np.int32), kind="stable").tolist()
        for state in reversed(order):
            if link[state] >= 0:
                count[link[state]] += count[state]
        self.twice = array("i", bytes(4 * len(order)))
        for state in order:
            self.twice[state] = state if state and count[state] > 1 else self.twice[link[state]] if state else 0

    def statistics(self, states: array) -> np.ndarray:
        """For each prefix of an added sequence, the length of its longest suffix that occurs twice."""
        twice, length = np.frombuffer(self.twice, np.int32), np.frombuffer(self.length, np.int32)
        return length[twice[np.frombuffer(states, np.int32)]] if len(states) else np.zeros(0, np.int32)


def _ranges(flags: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"from": int(a), "to": int(b)} for a, b in zip(edges[::2], edges[1::2])]


_SPANS = "array<struct<from:int,to:int>>"
_SPAN_TYPE = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))


def repeated_runs(references: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(run, spans): the windows of each distinct run that repeat, from..to exclusive."""
    cool = references.filter("not hot")
    total = cool.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    shards = max(1, -(-total // 8 // shard_words))
    dealt = cool.select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "run", "twice", "words")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in rows.groups(batches, 0):
            stretches = [np.frombuffer(x.as_py(), np.uint64) for x in table["words"]]
            _, symbols = np.unique(np.concatenate(stretches), return_inverse=True)
            cuts = np.cumsum([len(x) for x in stretches])[:-1]
            del stretches
            automaton = Automaton()
            # Sequences become lists one at a time; what is kept of each is flat.
            paths = [
                automaton.add(x.tolist(), 1 + twice)[window - 1 :]
                for x, twice in zip(np.split(symbols.astype(np.int32), cuts), table["twice"].to_pylist())
            ]
            del symbols
            automaton.finish()
            runs, spans = [], []
            for run, path in zip(table["run"].to_pylist(), paths):
                hit = automaton.statistics(path) >= window
                if hit.any():
                    runs.append(run)
                    spans.append(_ranges(hit))
            del automaton, paths
            yield pa.RecordBatch.from_arrays([pa.array(runs, pa.int64()), pa.array(spans, _SPAN_TYPE)], names=["run", "spans"])

    in_shards = dealt.repartition(F.col("shard")).sortWithinPartitions("shard").mapInArrow(match, f"run long, spans {_SPANS}")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, twice, stretch in zip(*(batch.column(c).to_pylist() for c in range(3))):
                hashes = np.frombuffer(stretch, np.uint64)
                start = np.arange(len(hashes) - window + 1)
                found = _Sequences(hashes).of(start, start + window)
                size = len(start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(size, run)), pa.array(start.astype(np.int32)), _signed(found), pa.array(np.full(size, 1 + twice))],
                    names=["run", "at", "key", "n"],
                )

    single = workdir.saved(
        references.filter("hot").select("run", "twice", "words").mapInArrow(windows, "run long, at int, key long, n long"), "hot-windows"
    )
    often = single.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key")
    one = F.struct(F.col("at").alias("from"), (F.col("at") + 1).alias("to"))
    in_windows = single.join(often, "key").groupBy("run").agg(F.sort_array(F.collect_list(one)).alias("spans"))
    return workdir.saved(in_shards.union(in_windows), "repeats")


def _kept(text: Column, spans: Column, window: int) -> Column:
    """(kept, n_words, n_removed): the words outside of the windows, joined by single spaces."""

    @F.arrow_udf("kept string, n_words long, n_removed long")
    def cut(texts: pa.Array, lists: pa.Array) -> pa.Array:
        out: tuple[list, list, list] = ([], [], [])
        for text_, found in zip(texts.to_pylist(), lists.to_pylist()):
            # bytes.split() splits at the same six characters.
            tokens = (text_ or "").encode().split()
            kept, at = [], 0
            for a, b in sorted({(s["from"], s["to"]) for s in found or ()}):
                if a > at:
                    kept += tokens[at:a]
                at = max(at, b + window - 1)
            kept += tokens[at:]
            for column, value in zip(out, (b" ".join(kept).decode(), len(tokens), len(tokens) - len(kept))):
                column.append(value)
        return pa.StructArray.from_arrays([pa.array(out[0], pa.string()), *(pa.array(c, pa.int64()) for c in out[1:])], ["kept", "n_words", "n_removed"])

    return cut(text, spans)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc, kept, n_words, n_removed): each row with its text after the repeats are gone."""
    found = occurrences(docs, anchors(docs, text, window), doc_id, text, window)
    references, alone = _references(docs, found, doc_id, text, window)
    spans = repeated_runs(references, window).union(alone)
    start = F.shiftright("place", 8).cast("int")
    placed = found.join(spans, "run").select(
        "id",
        "hash",
        F.explode(F.transform("spans", lambda s: F.struct((start + s["from"]).alias("from"), (start + s["to"]).alias("to")))).alias("span"),
    )
    of_doc = placed.groupBy("id", "hash").agg(F.collect_set("span").alias("spans"))  # windows of one document
    whole = docs.select(rows.packed(docs).alias("doc"), *[c.alias(n) for c, n in zip(_identity(doc_id, text), ("_id", "_hash"))])
    met = whole.join(of_doc, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_hash") == F.col("hash")), "left")
    return met.select("doc", _kept(F.col(f"doc.`{text}`"), F.col("spans"), window).alias("r")).select("doc", "r.*")


rows.shipped(__name__)
