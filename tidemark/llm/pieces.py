"""N-best segmentation into the pieces of a SentencePiece model, and back.

A text is a lattice: every piece that matches at a place is an edge with the
piece's score. The forward Viterbi scores say exactly what the best way from
the start to any place is worth, so a backward A* search that adds them to the
score of its suffix completes segmentations in order, the best first.

No piece has a space behind another character or a line feed beside one, so
the lattice has a cut before each run of spaces and around each line feed. The
chunks between cuts are searched apart, and a text's n best segmentations are
the n best sums: a chunk whose second-best way loses more than that of n - 1
others in the text cannot differ in any of them. Forward and backward scores
are computed for all distinct chunks of a slice of texts at once; A* runs in
the few chunks that can differ.

The spaces of the model are plain spaces here, with one put before a text that
is not empty. A character that is no piece costs ten less than the least score
and is spelt in the byte pieces. Decoding inverts this for every text.

Defined results: missing and empty texts have no pieces, one segmentation and
a score of zero. Of equal scores, the segmentation with the longer last piece
comes first. A text with fewer than n segmentations returns all.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import rows, words

# A task holds over 100 bytes for each byte of a slice.
SLICE = 1 << 19
# Chunks of more bytes are scored edge by edge; the others all together.
LONG = 512
_LOW = -1e30
_UNKNOWN_BELOW = 10.0


@dataclass(frozen=True)
class Vocabulary:
    """Pieces as bytes with scores and ids, and the id of each byte's piece."""

    pieces: list[tuple[bytes, float, int]]
    byte_ids: list[int]
    size: int


def vocabulary(spark: SparkSession, model: str) -> Broadcast:
    """The pieces of a model file, sent to the tasks once. Its size does not depend on the data."""
    import sentencepiece

    path = model if "://" in model else f"file://{model}"
    content = spark.read.format("binaryFile").load(path).select("content").first()["content"]
    loaded = sentencepiece.SentencePieceProcessor(model_proto=bytes(content))
    pieces, byte_ids = [], [-1] * 256
    for i in range(loaded.vocab_size()):
        name = loaded.id_to_piece(i)
        if loaded.is_byte(i):
            byte_ids[int(name[3:5], 16)] = i
        elif not (loaded.is_control(i) or loaded.is_unknown(i) or loaded.is_unused(i)):
            piece = name.replace("▁", " ")
            if " " in piece.lstrip(" ") or "\n" in piece:
                raise ValueError(f"piece {i} crosses a cut")
            pieces.append((piece.encode(), float(loaded.get_score(i)), i))
    if -1 in byte_ids:
        raise ValueError("the model has no piece for some byte")
    return spark.sparkContext.broadcast(Vocabulary(pieces, byte_ids, loaded.vocab_size()))


class Tables:
    """Trie of the pieces as two arrays indexed by (inner node, byte); made once per task."""

    def __init__(self, vocab: Vocabulary) -> None:
        nodes: dict[bytes, int] = {b"": 0}
        for piece, _, _ in vocab.pieces:
            for k in range(1, len(piece)):
                nodes.setdefault(piece[:k], len(nodes))
        self.child = np.zeros((len(nodes), 256), np.int32)
        self.piece = np.full((len(nodes), 256), -1, np.int32)
        for prefix, node in nodes.items():
            if prefix:
                self.child[nodes[prefix[:-1]], prefix[-1]] = node
        self.scores = np.zeros(vocab.size)
        self.longest = max(len(p) for p, _, _ in vocab.pieces)
        for piece, score, i in vocab.pieces:
            self.piece[nodes[piece[:-1]], piece[-1]] = i
            self.scores[i] = score
        low = min(s for _, s, _ in vocab.pieces if s > -1e8)
        self.unknown = low - _UNKNOWN_BELOW
        self.byte_ids = np.array(vocab.byte_ids)
        self.bytes_of = [b""] * vocab.size
        for piece, _, i in vocab.pieces:
            self.bytes_of[i] = piece
        for byte, i in enumerate(vocab.byte_ids):
            self.bytes_of[i] = bytes([byte])


def _char_lengths(data: np.ndarray) -> np.ndarray:
    """Bytes of the character that starts at each place, 0 inside one."""
    return np.select([data < 0x80, data < 0xC0, data < 0xE0, data < 0xF0], [1, 0, 2, 3], 4)


class Lattices:
    """The lattices of distinct chunks, laid end to end in ``data`` at ``starts``.

    ``edge[l]`` has at each place the id of the piece of length l that starts
    there, -1 for none and -2 for a character spelt in bytes.
    """

    def __init__(self, tables: Tables, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        self.tables, self.data, self.starts, self.ends = tables, data, starts, ends
        chunk_end = np.repeat(ends, ends - starts)
        self.edge: dict[int, np.ndarray] = {}
        self.score: dict[int, np.ndarray] = {}
        at, node = np.arange(len(data)), np.zeros(len(data), np.int64)
        first = _char_lengths(data)
        single = np.zeros(len(data), bool)
        for length in range(1, tables.longest + 1):
            inside = at + length <= chunk_end[at]
            at, node = at[inside], node[inside]
            if not len(at):
                break
            byte = data[at + length - 1]
            piece = tables.piece[node, byte]
            hit = piece >= 0
            if hit.any():
                self._add(length, at[hit], piece[hit], tables.scores[piece[hit]])
                single[at[hit][first[at[hit]] == length]] = True
            node = tables.child[node, byte]
            deeper = node > 0
            at, node = at[deeper], node[deeper]
        for length in range(1, 5):
            spelt = np.flatnonzero((first == length) & ~single)
            if len(spelt):
                self._add(length, spelt, np.int32(-2), tables.unknown)
        self.lengths = sorted(self.edge)
        self._forward()
        self._backward()
        self._best()

    def _add(self, length: int, at: np.ndarray, piece, score) -> None:
        if length not in self.edge:
            self.edge[length] = np.full(len(self.data), -1, np.int32)
            self.score[length] = np.full(len(self.data), _LOW)
        self.edge[length][at] = piece
        self.score[length][at] = score

    def _forward(self) -> None:
        """Best score from the chunk's start to each place, and the length of the last edge."""
        count = self.ends - self.starts
        self.shift = np.arange(len(self.starts))  # a chunk of n bytes has n + 1 places
        self.f = np.full(len(self.data) + len(self.starts), _LOW)
        self.last = np.zeros(len(self.f), np.int32)
        self.f[self.starts + self.shift] = 0.0
        for chunk in np.flatnonzero(count > LONG):
            self._forward_alone(chunk)
        count = np.where(count > LONG, 0, count)
        order = np.argsort(-count, kind="stable")
        sorted_counts = -count[order]
        for p in range(1, int(count.max(initial=0)) + 1):
            live = order[: np.searchsorted(sorted_counts, -p, "right")]
            start, place = self.starts[live] + p, self.starts[live] + self.shift[live] + p
            best, last = np.full(len(live), _LOW), np.zeros(len(live), np.int32)
            for length in self.lengths:
                if length > p:
                    break
                value = self.f[place - length] + self.score[length][start - length]
                better = value >= best  # the longer piece of equals
                best = np.where(better, value, best)
                last[better] = length
            self.f[place], self.last[place] = best, last

    def _backward(self) -> None:
        count = self.ends - self.starts
        self.b = np.full(len(self.f), _LOW)
        self.b[self.ends + self.shift] = 0.0
        for chunk in np.flatnonzero(count > LONG):
            self._backward_alone(chunk)
        count = np.where(count > LONG, 0, count)
        order = np.argsort(-count, kind="stable")
        sorted_counts = -count[order]
        for p in range(1, int(count.max(initial=0)) + 1):
            live = order[: np.searchsorted(sorted_counts, -p, "right")]
            start, place = self.ends[live] - p, self.ends[live] + self.shift[live] - p
            best = np.full(len(live), _LOW)
            for length in self.lengths:
                if length > p:
                    break
                best = np.maximum(best, self.b[place + length] + self.score[length][start])
            self.b[place] = best

    def _edges(self, chunk: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, length, score) of all edges of a chunk, shorter ones first; places from its start."""
        start, end = int(self.starts[chunk]), int(self.ends[chunk])
        found = []
        for length in self.lengths:
            at = np.flatnonzero(self.edge[length][start:end] != -1)
            found.append((at, np.full(len(at), length), self.score[length][start + at]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def _forward_alone(self, chunk: int) -> None:
        """The same for one long chunk, edge by edge."""
        at, length, score = self._edges(chunk)
        order = np.argsort(at + length, kind="stable")
        size = int(self.ends[chunk] - self.starts[chunk])
        best, last = [0.0] + [_LOW] * size, [0] * (size + 1)
        for a, n, s in zip(at[order].tolist(), length[order].tolist(), score[order].tolist()):
            value = best[a] + s
            if value >= best[a + n]:
                best[a + n], last[a + n] = value, n
        first = int(self.starts[chunk] + self.shift[chunk])
        self.f[first : first + size + 1], self.last[first : first + size + 1] = best, last

    def _backward_alone(self, chunk: int) -> None:
        at, length, score = self._edges(chunk)
        order = np.argsort(-at, kind="stable")
        size = int(self.ends[chunk] - self.starts[chunk])
        best = [_LOW] * size + [0.0]
        for a, n, s in zip(at[order].tolist(), length[order].tolist(), score[order].tolist()):
            value = best[a + n] + s
            if value > best[a]:
                best[a] = value
        first = int(self.starts[chunk] + self.shift[chunk])
        self.b[first : first + size + 1] = best

    def _best(self) -> None:
        """The best path's edges in order, and what the second-best way of each chunk loses."""
        place = self.ends + self.shift
        chunk = np.arange(len(place))
        found = []
        while len(place):
            length = self.last[place]
            place = place - length
            found.append(np.stack([place - chunk, length]))
            more = place > self.starts[chunk] + chunk
            place, chunk = place[more], chunk[more]
        path = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        path = path[:, np.argsort(path[0], kind="stable")]
        self.path_at, self.path_length = path
        used = np.zeros(len(self.data), np.int32)
        used[self.path_at] = self.path_length
        of = np.repeat(self.shift, self.ends - self.starts)
        rest = np.full(len(self.data), _LOW)
        spot = np.arange(len(self.data)) + of
        for length in self.lengths:
            at = np.flatnonzero((self.edge[length] != -1) & (used != length))
            rest[at] = np.maximum(rest[at], self.f[spot[at]] + self.score[length][at] + self.b[spot[at] + length])
        self.total = self.f[self.ends + self.shift]
        second = np.maximum.reduceat(rest, self.starts) if len(self.starts) else np.zeros(0)
        self.gap = np.where(second > _LOW / 2, self.total - second, np.inf)

    def path_ids(self) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all best paths end to end, index of each chunk's first one and, last, their number)."""
        ids = np.zeros(len(self.path_at), np.int64)
        for length in self.lengths:
            here = self.path_length == length
            ids[here] = self.edge[length][self.path_at[here]]
        sizes = np.where(ids == -2, self.path_length, 1)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        out = np.repeat(ids, sizes)
        within = np.arange(offsets[-1]) - np.repeat(offsets[:-1], sizes)
        spelt = out == -2
        out[spelt] = self.tables.byte_ids[self.data[(np.repeat(self.path_at, sizes) + within)[spelt]]]
        first = np.searchsorted(self.path_at, self.starts)
        return out, np.concatenate([offsets[first], offsets[-1:]])

    def _into(self, chunk: int) -> Callable[[int], list[tuple[int, float]]]:
        """What tells (length, score) of the edges that end at a place, shorter ones first."""
        start, size = int(self.starts[chunk]), int(self.ends[chunk] - self.starts[chunk])
        if size <= LONG:
            return lambda at: [
                (n, float(self.score[n][at - n])) for n in self.lengths if at - n >= start and self.edge[n][at - n] != -1
            ]
        at, length, score = self._edges(chunk)
        order = np.argsort(at + length, kind="stable")
        first = np.searchsorted((at + length)[order], np.arange(size + 2)).tolist()
        length, score = length[order].tolist(), score[order].tolist()

        def of(at: int) -> list[tuple[int, float]]:
            here = slice(first[at - start], first[at - start + 1])
            return list(zip(length[here], score[here]))

        return of

    def nbest(self, chunk: int, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations of a chunk, by A* from its end to its start; of equals, the path of ``path_ids`` first.

        The heuristic is exact, so a place is reached by its best suffixes first,
        and no more than n of them can lie on the n best ways: it is expanded n
        times at most. Of equal sums the newest entry, which is nearest to the
        start, goes first. So ties cost no more than n ways through the chunk.
        """
        start, end, shift = int(self.starts[chunk]), int(self.ends[chunk]), int(self.shift[chunk])
        into = self._into(chunk)
        heap: list = [(-float(self.f[end + shift]), 0, end, 0.0, None)]
        serial, found, expanded = 0, [], {}
        while heap and len(found) < n:
            _, _, at, suffix, path = heapq.heappop(heap)
            if at == start:
                found.append((suffix, self._spelt(path)))
                continue
            expanded[at] = expanded.get(at, 0) + 1
            if expanded[at] > n:
                continue
            for length, edge_score in into(at):
                before = at - length
                value = float(self.f[before + shift])
                if value <= _LOW / 2:
                    continue
                score = suffix + edge_score
                serial -= 1
                heapq.heappush(heap, (-(score + value), serial, before, score, (before, length, path)))
        best = self._viterbi(start, end, shift)
        others = [x for x in found if x[1] != best]
        return [(float(self.f[end + shift]), best), *others][:n]

    def _viterbi(self, start: int, end: int, shift: int) -> list[int]:
        path, at = None, end
        while at > start:
            length = int(self.last[at + shift])
            at -= length
            path = (at, length, path)
        return self._spelt(path)

    def _spelt(self, path: tuple | None) -> list[int]:
        ids = []
        while path is not None:
            at, length, path = path
            piece = int(self.edge[length][at])
            ids += [piece] if piece >= 0 else [int(self.tables.byte_ids[x]) for x in self.data[at : at + length]]
        return ids


def _chunks(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the chunks of texts that begin with their extra space; index of each text's first chunk."""
    space, feed = data == 0x20, data == 0x0A
    start = np.zeros(len(data), bool)
    start[1:] = (space[1:] & ~space[:-1]) | feed[1:] | feed[:-1]
    start[bounds[:-1][bounds[:-1] < len(data)]] = True
    starts = np.flatnonzero(start)
    return starts, np.searchsorted(starts, bounds)


def _distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a chunk of each kind, kind of each chunk); chunks of equal 64-bit hashes are equal."""
    lengths = ends - starts
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    longest = int(lengths.max(initial=0))
    terms = (data.astype(np.uint64) + np.uint64(1)) * words.factors(longest)[place]
    key = np.add.reduceat(terms, starts) + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    _, first, kind = np.unique(key, return_index=True, return_inverse=True)
    return first, kind


@dataclass
class Encoded:
    """Best ids of the texts of a slice end to end with bounds, and the n best as changes of chunks."""

    ids: np.ndarray
    bounds: np.ndarray
    scores: list[list[float]]
    changes: list[list[list[tuple[int, int, list[int]]]]]  # per text and rank: (from, to, ids instead)


def _gathered(values: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs values[offsets[k]:offsets[k + 1]] for each kind in turn, and where each begins."""
    sizes = offsets[kinds + 1] - offsets[kinds]
    begin = np.concatenate([[0], np.cumsum(sizes)])
    take = np.arange(begin[-1]) + np.repeat(offsets[kinds] - begin[:-1], sizes)
    return values[take], begin


def encode_slice(tables: Tables, texts: pa.Array, n: int) -> Encoded:
    spaced = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(pa.scalar(" ", texts.type), texts, ""))
    _, offsets, buffer = spaced.buffers()
    wide = np.int64 if pa.types.is_large_string(spaced.type) else np.int32
    at = np.frombuffer(offsets, wide)[spaced.offset : spaced.offset + len(spaced) + 1].astype(np.int64)
    data = np.frombuffer(buffer, np.uint8)[at[0] : at[-1]] if buffer is not None else np.zeros(0, np.uint8)
    starts, first = _chunks(data, at - at[0])
    if not len(starts):
        return Encoded(np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64), [[0.0]] * len(texts), [[[]]] * len(texts))
    ends = np.append(starts[1:], len(data))
    one, kind = _distinct(data, starts, ends)
    sizes = ends[one] - starts[one]
    begin = np.concatenate([[0], np.cumsum(sizes)])
    packed = data[np.arange(begin[-1]) + np.repeat(starts[one] - begin[:-1], sizes)]
    lattices = Lattices(tables, packed, begin[:-1], begin[1:])
    ids, begin_ids = _gathered(*lattices.path_ids(), kind)
    totals, gaps = lattices.total[kind], lattices.gap[kind]
    cache: dict[int, list] = {}
    scores, changes = [], []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        best = float(totals[a:b].sum())
        ways: list[tuple[float, list]] = [(0.0, [])]
        for c in _least(gaps[a:b], n - 1).tolist():
            k = int(kind[a + c])
            if k not in cache:
                cache[k] = lattices.nbest(k, n)
            options = [(float(totals[a + c]) - s, (a + c, r)) for r, (s, _) in enumerate(cache[k])]
            ways = heapq.nsmallest(n, ((w + g, [*done, o] if o[1] else done) for w, done in ways for g, o in options), key=lambda x: x[0])
        scores.append([best - lost for lost, _ in ways])
        base = int(begin_ids[a])
        changes.append([[(int(begin_ids[c]) - base, int(begin_ids[c + 1]) - base, cache[int(kind[c])][r][1]) for c, r in sorted(way)] for _, way in ways])
    return Encoded(ids, begin_ids[first], scores, changes)


def _least(gaps: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` smallest finite gaps, the earlier of equals."""
    if count <= 0:
        return np.zeros(0, np.int64)
    finite = np.flatnonzero(np.isfinite(gaps))
    if len(finite) > 4 * count:
        limit = np.partition(gaps[finite], count - 1)[count - 1]
        finite = finite[gaps[finite] <= limit]
    return finite[np.argsort(gaps[finite], kind="stable")[:count]]


def decoded(tables: Tables, ids: list[int]) -> str:
    """The text that a segmentation stands for."""
    return b"".join(map(tables.bytes_of.__getitem__, ids)).decode("utf-8", "replace")[1:]


def slices(column: pa.Array) -> Iterator[pa.Array]:
    """Runs of rows of bounded size; null is empty."""
    texts = pc.fill_null(column, "") if column.null_count else column
    at = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1)])
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + SLICE, "right")) - 1)
        yield texts.slice(first, last - first)
        first = last


def nbest(docs: DataFrame, model: str, text: str = "text", n: int = 4) -> DataFrame:
    """(doc, segmentations): all columns packed, and the n best (score, ids), the best first."""
    vocab = vocabulary(docs.sparkSession, model)
    kept = docs.select(rows.packed(docs).alias("doc"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(vocab.value)
        kind = pa.list_(pa.struct([("score", pa.float64()), ("ids", pa.list_(pa.int32()))]))
        for batch in batches:
            done = 0
            for part in slices(batch.column(1)):
                e = encode_slice(tables, part, n)
                out = []
                for k in range(len(part)):
                    best = e.ids[e.bounds[k] : e.bounds[k + 1]].tolist()
                    out.append([{"score": s, "ids": _changed(best, c)} for s, c in zip(e.scores[k], e.changes[k])])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(part)), pa.array(out, kind)], names=["doc", "segmentations"])
                done += len(part)

    types = f"doc {kept.schema['doc'].dataType.simpleString()}, segmentations array<struct<score:double,ids:array<int>>>"
    return kept.mapInArrow(run, types)


def _changed(best: list[int], changes: list[tuple[int, int, list[int]]]) -> list[int]:
    for start, end, ids in reversed(changes):
        best = best[:start] + ids + best[end:]
    return best


def encode(docs: DataFrame, model: str, text: str = "text", n: int = 4) -> DataFrame:
    """(doc, ids, scores, runner_up, restored): the best ids, the n best scores, where the second differs, and the round trip.

    ``runner_up`` lists (from, to, ids): what the second-best segmentation has
    in place of the best one's ids from..to.
    """
    vocab = vocabulary(docs.sparkSession, model)
    kept = docs.select(rows.packed(docs).alias("doc"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(vocab.value)
        change = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32()), ("ids", pa.list_(pa.int32()))]))
        for batch in batches:
            done = 0
            for part in slices(batch.column(1)):
                e = encode_slice(tables, part, n)
                ids = pa.ListArray.from_arrays(pa.array(e.bounds.astype(np.int32)), pa.array(e.ids.astype(np.int32)))
                second = [
                    [{"from": a, "to": b, "ids": x} for a, b, x in c[1]] if len(c) > 1 else None for c in e.changes
                ]
                same = [
                    decoded(tables, e.ids[a:b].tolist()) == x
                    for a, b, x in zip(e.bounds[:-1].tolist(), e.bounds[1:].tolist(), part.to_pylist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(done, len(part)),
                        ids,
                        pa.array(e.scores, pa.list_(pa.float64())),
                        pa.array(second, change),
                        pa.array(same),
                    ],
                    names=["doc", "ids", "scores", "runner_up", "restored"],
                )
                done += len(part)

    types = (
        f"doc {kept.schema['doc'].dataType.simpleString()}, ids array<int>, scores array<double>, "
        "runner_up array<struct<from:int,to:int,ids:array<int>>>, restored boolean"
    )
    return kept.mapInArrow(run, types)


rows.shipped(__name__)
