"""Shards of near equal bytes by histogram sort.

The shards are consecutive ranges of the key, and so are the parts of a shard
that are sorted one by one. The bytes below candidate
boundaries are counted exactly, in one aggregation for all of them; each round
narrows the interval of every boundary that has not met the tolerance to a
64th. Then all rows are exchanged once and sorted within their partitions.
What reaches the driver is one sum per probe.

A boundary may fall among the rows of one key, when a key holds more bytes
than the tolerance: the same search goes on over a hash of the text among that
key's rows only, and among rows that agree in key and text over their place in
the table. Where a table doesn't come in the same order twice, such rows are
dealt about evenly instead of exactly.

Defined results: a missing key sorts first; a missing text has no bytes. Empty
shards have no rows. Where one row is larger than the tolerance, the boundary
takes the nearer side of it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import rows
from tidemark.sources import workdir

PROBES = 64
TOLERANCE = 0.001
PART_BYTES = 128 << 20
LEAST = -(1 << 63)


@dataclass
class _Boundary:
    """Where a boundary must lie: from ``low``, with ``below`` bytes before it, up to ``high``."""

    target: float
    low: int
    high: int
    below: int
    above: int  # bytes before ``high``
    rows: int  # rows from low to high
    at: int | None = None  # the boundary, once found

    def settle(self, tolerance: float) -> None:
        before, after = self.target - self.below, self.above - self.target
        if min(before, after) <= tolerance:
            self.at = self.low if before <= after else self.high


def _refined(narrow: DataFrame, column: str, targets: list[float], start: int, tolerance: float) -> list[_Boundary]:
    """Boundaries of ``column`` with as many bytes below as the targets say, or a single value wide."""
    ends = narrow.agg(F.min(column), F.max(column), F.sum("size"), F.count("*"), F.sum(F.when(F.col(column) < 0, F.col("size"))), F.count(F.when(F.col(column) < 0, 1))).first()
    low, high, total, count = ends[0], ends[1] + 1, ends[2], ends[3]
    found = [_Boundary(t, low, high, start, start + total, count) for t in targets]
    if low < 0 < high:  # differences then fit in 64 bits
        below, few = ends[4] or 0, ends[5]
        for b in found:
            if b.target < start + below:
                b.high, b.above, b.rows = 0, start + below, few
            else:
                b.low, b.below, b.rows = 0, start + below, count - few
    for b in found:
        b.settle(tolerance)
    while True:
        open_ = [b for b in found if b.at is None and b.high - b.low > 1]
        if not open_:
            return found
        spans = sorted({(b.low, b.high) for b in open_})
        steps = [-(-(high - low) // PROBES) for low, high in spans]
        value, span, probe = F.col(column), None, None
        for k, ((low, high), step) in enumerate(zip(spans, steps)):
            here = (value >= low) & (value <= high - 1)
            at = F.expr(f"(`{column}` - cast('{low}' as bigint)) div {step}")
            span = F.when(here, k) if span is None else span.when(here, k)
            probe = F.when(here, at) if probe is None else probe.when(here, at)
        counted = narrow.select(span.alias("span"), probe.alias("probe"), "size").filter("span is not null")
        sums = {(r["span"], r["probe"]): (r["bytes"], r["rows"]) for r in counted.groupBy("span", "probe").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()}
        for b in open_:
            k = spans.index((b.low, b.high))
            low, high, below = b.low, b.high, b.below
            for j in range(PROBES):
                size, count = sums.get((k, j), (0, 0))
                if below + size > b.target or low + (j + 1) * steps[k] >= high:
                    b.low, b.high = low + j * steps[k], min(low + (j + 1) * steps[k], high)
                    b.below, b.above, b.rows = below, below + size, count
                    break
                below += size
            b.settle(tolerance)


def splitters(narrow: DataFrame, ranges: int, tolerance: float = TOLERANCE) -> list[tuple[int, int, int]]:
    """The least (key, tie, place) of each range but the first, from rows of ``key``, ``tie``, ``place`` and ``size``."""
    total = narrow.agg(F.sum("size")).first()[0] or 0
    if not total:
        return []
    targets = [total * k / ranges for k in range(1, ranges)]
    return sorted(_split(narrow, ["key", "tie", "place"], targets, 0, tolerance * total / ranges))


def _split(narrow: DataFrame, columns: list[str], targets: list[float], start: int, allowed: float) -> list[tuple]:
    """The splitters at the targets: a value of each column, or ``LEAST`` for all of its rows."""
    column, *others = columns
    out, inside = [], {}
    for b in _refined(narrow, column, targets, start, allowed):
        if b.at is None and b.rows > 1 and others:
            inside.setdefault((b.low, b.below), []).append(b.target)
        else:
            out.append((_nearer(b), *[LEAST] * len(others)))
    for (value, below), mine in inside.items():
        found = _split(narrow.filter(F.col(column) == value), others, mine, below, allowed)
        out += [(value, *f) for f in found]
    return out


def _nearer(b: _Boundary) -> int:
    if b.at is not None:
        return b.at
    return b.low if b.target - b.below <= b.above - b.target else b.high


def range_of(place: list[Column], found: list[tuple]) -> Column:
    """How many splitters a row is not below, by binary search."""
    ends = []
    for splitter in found:
        at = list(splitter)
        while at and at[-1] >= 1 << 63:  # beyond the largest value: the next one of the column before
            at.pop()
            if at:
                at[-1] += 1
        if at:
            ends.append(F.struct(*[F.lit(x).cast("long") for x in at + [LEAST] * (len(place) - len(at))]))
    if not ends:
        return F.lit(0)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(ends).bit_length()))])
    mine = F.struct(*[c.alias(f"col{k + 1}") for k, c in enumerate(place)])
    beyond = lambda n: F.coalesce(F.get(F.array(*ends), n - 1) <= mine, F.lit(False))
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when(beyond(n + step), n + step).otherwise(n))


def sharded(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text", tolerance: float = TOLERANCE, part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc, size, shard, part, slot): all columns packed, and each row's place.

    A shard is ``part`` after part of about ``part_bytes``, consecutive ranges
    of the key as well; a part is sorted by key. ``slot`` numbers the rows of a
    shard without gaps from 0.
    """
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(LEAST))
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8
    place = [key.alias("key"), F.xxhash64(rows.text_of(text)).alias("tie"), F.monotonically_increasing_id().alias("place")]
    narrow = workdir.saved(docs.select(*place, size.alias("size")), "sizes")
    total = narrow.agg(F.sum("size")).first()[0] or 0
    parts = max(1, -(-total // shards // part_bytes))
    found = splitters(narrow, shards * parts, tolerance)
    placed = docs.select(rows.packed(docs).alias("doc"), *place, size.alias("size"))
    placed = placed.withColumn("range", range_of([F.col("key"), F.col("tie"), F.col("place")], found))
    placed = placed.withColumns({"shard": F.expr("cast(range div %d as int)" % parts), "part": F.expr("range %% %d" % parts)}).drop("range")
    moved = placed.repartitionById(shards * parts, F.col("shard") * parts + F.col("part"))
    ordered = moved.sortWithinPartitions("shard", "part", "key", "tie").withColumn("row", F.monotonically_increasing_id())
    ordered = workdir.saved(ordered.drop("key", "tie", "place"), "shards")
    # One row per part: rows of a part are consecutive.
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begin = ordered.groupBy("shard", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    begin = begin.select("shard", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return ordered.join(F.broadcast(begin), ["shard", "part"]).select(
        "doc", "size", "shard", "part", (F.col("row") + F.col("shift")).alias("slot")
    )
