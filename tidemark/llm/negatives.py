"""Hard negatives by angular triangle filtering.

Vectors are rounded down to integers, and the integer inner product with the
anchor is a row's score. Every row stores its angle to each of a few reference
directions. For an anchor and a row, the triangle inequality on the sphere
bounds their angle from below by the largest difference of their angles to a
reference, and from above by the smallest sum. The cosines of these bounds
times both norms, widened for rounding, hold the score; only where that
interval meets a window that is asked for is the score computed, exactly.

Rows are dealt into blocks of near directions, anchors as well. A pair of
blocks whose intervals cannot meet is never formed; every other pair is one
group of a cogrouped job, so the anchors are compared with all rows a block at a
time, each group gives its best rows only, and no row is left out. First the
anchors meet the rows of their own label and keep the best as positives; the
positives' scores give the windows in which negatives are sought.

Reference directions are a farthest-first choice among ``SAMPLE`` rows, those of
the least hash. They decide what is skipped, never the result. The less the
vectors cluster, the less is skipped: of random directions, almost nothing.

Defined results: rows with a missing label, vector or component, or a component
that is not finite, take no part, nor do rows whose squared length does not fit 62
bits, as scores are 64-bit integers. A shorter vector ends in zeros. Equal scores
go by id, missing ids last. Rows that repeat count each, also as each other's
positives. A zero vector scores 0 with everything. An anchor without a positive,
or a positive without a negative in its window, has no row. An empty table gives
an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import rows
from tidemark.sources import workdir

REFERENCES = 8
SAMPLE = 1024
# Bands of angle per reference; rows and anchors per block; anchors compared at once.
BANDS = 16
ROWS, ANCHORS, STRIP = 16_384, 1_024, 64
# Beyond the rounding of angles and of products.
PAD, RELATIVE = 1e-9, 1e-12
EXACT = float(1 << 53)


def usable(vectors: DataFrame, id: str, label: str, embedding: str, anchor: Column, scale: int) -> DataFrame:
    """(row, id, label, anchor, q) of the rows that take part."""
    limit = float(1 << 31)
    whole = F.forall(F.col(embedding), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double") * scale) < limit))
    taken = vectors.filter(F.col(label).isNotNull() & F.col(embedding).isNotNull()).filter(whole)
    q = F.transform(F.col(embedding), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    picked = taken.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id).cast("long").alias("id"),
        F.col(label).cast("string").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        q.alias("q"),
    )
    length = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return picked.filter(length < float(1 << 62))


def directions(sample: np.ndarray, count: int) -> np.ndarray:
    """``count`` unit vectors of the sample, or fewer, each far from those before."""
    norm = np.linalg.norm(sample, axis=1)
    units = sample[norm > 0] / norm[norm > 0, None]
    if not len(units):
        return np.ones((1, sample.shape[1])) / math.sqrt(max(sample.shape[1], 1))
    chosen = [units[0]]
    near = units @ chosen[0]
    while len(chosen) < count and near.min() < 1 - 1e-9:
        chosen.append(units[near.argmin()])
        near = np.maximum(near, units @ chosen[-1])
    return np.array(chosen)


def angles(q: np.ndarray, norm: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angle of each row to each reference; accurate also near 0 and pi."""
    units = q / np.where(norm > 0, norm, 1)[:, None]
    off = lambda r: 2 * np.arctan2(np.linalg.norm(units - r, axis=1), np.linalg.norm(units + r, axis=1))
    return np.stack([off(r) for r in references], axis=1)


def _matrix(column: pa.ChunkedArray, width: int, kind: type) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), width)


def marked(taken: DataFrame, dim: int, references: np.ndarray) -> DataFrame:
    """Add norm, angles and zone: the nearest reference and the band of the angle to it."""

    def mark(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _matrix(batch.column("q"), dim, np.int64)
            norm = np.linalg.norm(q.astype(float), axis=1)
            off = angles(q, norm, references)
            nearest = off.argmin(axis=1)
            band = np.minimum((off.min(axis=1) / math.pi * BANDS).astype(np.int64), BANDS - 1)
            bounds = np.arange(0, off.size + 1, off.shape[1], dtype=np.int32)
            added = {
                "norm": pa.array(norm),
                "angles": pa.ListArray.from_arrays(bounds, pa.array(off.ravel())),
                "zone": pa.array(nearest * BANDS + band, pa.int64()),
            }
            yield pa.RecordBatch.from_arrays([*batch.columns, *added.values()], [*batch.schema.names, *added])

    padded = F.concat("q", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("q")))
    schema = "row long, id long, label string, anchor boolean, q array<long>, norm double, angles array<double>, zone long"
    return taken.withColumn("q", padded).mapInArrow(mark, schema)


def blocked(df: DataFrame, name: str, size: int) -> DataFrame:
    """Add a block number: zones in order, small ones joined and large ones split to some ``size`` rows."""
    counts = sorted(df.groupBy("zone").count().collect())  # at most REFERENCES * BANDS rows
    plan, block, held = [], 0, 0
    for zone, count in counts:
        if held and held + count > size:
            block, held = block + 1, 0
        parts = -(-count // size)
        plan.append((zone, block, parts))
        block, held = block + parts - 1, count if parts == 1 else size
    known = df.sparkSession.createDataFrame(plan, "zone long, first int, parts int")
    dealt = df.join(F.broadcast(known), "zone")
    return dealt.withColumn(name, F.col("first") + F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")).drop("first", "parts")


def bounds(a_angles: np.ndarray, a_norm: np.ndarray, x_angles: np.ndarray, x_norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What no score of these anchors and rows is below and above."""
    low = np.zeros((len(a_norm), len(x_norm)))
    far = np.zeros_like(low)
    for k in range(a_angles.shape[1]):
        a, x = a_angles[:, k, None], x_angles[None, :, k]
        gap = a - x
        np.maximum(low, np.abs(gap, out=gap), out=low)
        gap = a + x
        gap -= math.pi
        np.maximum(far, np.abs(gap, out=gap), out=far)
    size = a_norm[:, None] * x_norm[None, :]
    pad = size * RELATIVE + 1
    high = np.clip(math.pi - far + PAD, 0, math.pi)
    low = np.clip(low - PAD, 0, math.pi)
    return np.cos(high) * size - pad, np.cos(low) * size + pad


def scores(a: np.ndarray, x: np.ndarray, wanted: np.ndarray, largest: float) -> np.ndarray:
    """Exact inner products where ``wanted``, elsewhere 0; ``largest`` bounds the product of norms.

    Where much is wanted, products of whole rows are cheaper; below 2^53 floating point adds integers exactly.
    """
    found = np.zeros(wanted.shape, np.int64)
    if largest < EXACT and wanted.mean() > 0.125:
        columns = np.flatnonzero(wanted.any(axis=0))
        found[:, columns] = (a.astype(float) @ x[columns].astype(float).T).astype(np.int64)
        return np.where(wanted, found, 0)
    i, j = np.nonzero(wanted)
    step = max(1, (1 << 22) // max(a.shape[1], 1))
    for k in range(0, len(i), step):
        s = slice(k, k + step)
        found[i[s], j[s]] = np.einsum("ij,ij->i", a[i[s]], x[j[s]])
    return found


class Side:
    """The rows of one side of a group as arrays."""

    def __init__(self, table: pa.Table, dim: int, references: int):
        get = lambda name: table.column(name).combine_chunks()
        self.row = get("row").to_numpy()
        self.label = get("label")
        self.missing = get("id").is_null().to_numpy(zero_copy_only=False)
        self.id = get("id").fill_null(0).to_numpy(zero_copy_only=False)
        self.q = _matrix(table.column("q"), dim, np.int64)
        self.norm = get("norm").to_numpy()
        self.angles = _matrix(table.column("angles"), references, np.float64)

    def best(self, at: np.ndarray, score: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``count`` rows of ``at`` with the highest scores, in order."""
        if len(at) > count:
            kept = score >= np.partition(score, -count)[-count]
            at, score = at[kept], score[kept]
        order = np.lexsort((self.row[at], self.id[at], self.missing[at], -score))[:count]
        return at[order], score[order]


def _strips(anchors: Side, others: Side):
    for k in range(0, len(anchors.row), STRIP):
        s = slice(k, k + STRIP)
        low, high = bounds(anchors.angles[s], anchors.norm[s], others.angles, others.norm)
        yield k, s, low, high, float(anchors.norm[s].max(initial=0)) * float(others.norm.max(initial=0))


def _nullable(side: Side, at: list[int]) -> pa.Array:
    return pa.array(side.id[at], pa.int64(), mask=side.missing[at])


POSITIVE = "row long, positive_row long, positive_id long, positive_score long"
NEGATIVE = "row long, place int, negative_row long, negative_id long, negative_score long"


def _nearest(dim: int, references: int, count: int):
    """Group function: each anchor's best ``count`` of the rows it meets, other than itself."""

    def of(left: pa.Table, right: pa.Table) -> pa.Table:
        anchors, others = Side(left, dim, references), Side(right, dim, references)
        found: list[list] = [[], [], []]
        for k, s, low, high, largest in _strips(anchors, others):
            own = anchors.row[s, None] == others.row[None, :]
            low[own], high[own] = -np.inf, -np.inf
            if len(others.row) > count:
                # The score of that rank is no lower than the lower bound of that rank.
                rank = np.partition(low, -count, axis=1)[:, -count]
                wanted = (high >= rank[:, None]) & ~own
            else:
                wanted = ~own
            score = scores(anchors.q[s], others.q, wanted, largest)
            for i in range(len(wanted)):
                at = np.flatnonzero(wanted[i])
                at, value = others.best(at, score[i, at], count)
                for column, values in zip(found, ([k + i] * len(at), at, value)):
                    column.extend(values)
        who, at, value = (np.array(x, np.int64) for x in found)
        return pa.table(
            {"row": anchors.row[who], "positive_row": others.row[at], "positive_id": _nullable(others, at), "positive_score": value}
        )

    return of


def _inside(dim: int, references: int, count: int):
    """Group function: of the rows of another label, the best ``count`` in each window of each anchor."""

    def of(left: pa.Table, right: pa.Table) -> pa.Table:
        anchors, others = Side(left, dim, references), Side(right, dim, references)
        codes = pa.chunked_array([anchors.label, others.label]).combine_chunks().dictionary_encode().indices.to_numpy()
        own, theirs = codes[: len(anchors.row)], codes[len(anchors.row) :]
        windows = left.column("windows").to_pylist()
        found: list[list] = [[], [], [], []]
        for k, s, low, high, largest in _strips(anchors, others):
            wanted = np.zeros(low.shape, bool)
            for i in range(len(low)):
                for window in windows[k + i]:
                    wanted[i] |= (high[i] >= window["lowest"]) & (low[i] <= window["highest"])
            wanted &= own[s, None] != theirs[None, :]
            score = scores(anchors.q[s], others.q, wanted, largest)
            for i in range(len(wanted)):
                seen = np.flatnonzero(wanted[i])
                value = score[i, seen]
                for window in windows[k + i]:
                    fits = (value >= window["lowest"]) & (value <= window["highest"])
                    at, best = others.best(seen[fits], value[fits], count)
                    for column, values in zip(found, ([k + i] * len(at), [window["place"]] * len(at), at, best)):
                        column.extend(values)
        who, place, at, value = (np.array(x, np.int64) for x in found)
        return pa.table(
            {
                "row": anchors.row[who],
                "place": pa.array(place, pa.int32()),
                "negative_row": others.row[at],
                "negative_id": _nullable(others, at),
                "negative_score": value,
            }
        )

    return of


def _top(df: DataFrame, keys: list[str], what: str, count: int, name: str) -> DataFrame:
    order = [F.desc(f"{what}_score"), F.asc_nulls_last(f"{what}_id"), F.asc(f"{what}_row")]
    placed = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return placed.filter(F.col(name) <= count)


def _met(anchors: DataFrame, others: DataFrame, cells: DataFrame, left: list[str], right: list[str], task, schema: str) -> DataFrame:
    """Run ``task`` on every cell: a block of anchors and a block of rows."""
    keys = [*left, *[name for name in right if name not in left]]
    # Named anew, so that two sides of one origin can be told apart.
    a, b = (side.join(cells, on) for side, on in ((anchors, left), (others, right)))
    # A number of partitions of their own: groups are few rows but much work, not to be gathered in few tasks.
    tasks = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a, b = (side.toDF(*side.columns).repartition(tasks, *keys).groupBy(*keys) for side in (a, b))
    return a.cogroup(b).applyInArrow(task, schema)


def positives(table: DataFrame, dim: int, references: int, count: int) -> DataFrame:
    """(row, place, positive_row, positive_id, positive_score): each anchor's best rows of its own label.

    A label's rows and anchors are split into parts, so that no group grows with the label.
    """
    dealt = table
    for name, size, which in (("r_part", ROWS, F.lit(True)), ("a_part", ANCHORS, F.col("anchor"))):
        parts = table.filter(which).groupBy("label").agg(F.ceil(F.count("*") / size).cast("int").alias("parts"))
        dealt = dealt.join(parts, "label", "left")
        dealt = dealt.withColumn(name, F.pmod(F.xxhash64(F.lit(name), "row"), F.col("parts")).cast("int")).drop("parts")
    anchors = dealt.filter("anchor")
    split = lambda df, name: df.groupBy("label").agg(F.max(name).alias("last")).select(
        "label", F.explode(F.sequence(F.lit(0), "last")).alias(name)
    )
    cells = split(anchors, "a_part").join(split(dealt, "r_part"), "label")
    met = _met(
        anchors.drop("r_part"), dealt.drop("a_part"), cells, ["label", "a_part"], ["label", "r_part"], _nearest(dim, references, count), POSITIVE
    )
    return _top(met, ["row"], "positive", count, "place")


def _of_block(df: DataFrame, block: str, references: int, more: dict[str, Column]) -> DataFrame:
    side = block[0]
    found = {f"{side}_least": F.min("norm"), f"{side}_most": F.max("norm")}
    for k in range(references):
        found |= {f"{side}_from{k}": F.min(F.col("angles")[k]), f"{side}_to{k}": F.max(F.col("angles")[k])}
    return df.groupBy(block).agg(*[value.alias(name) for name, value in (found | more).items()])


def _may_meet(references: int) -> Column:
    """Whether the scores of two blocks can lie in the anchors' windows."""
    pi = F.lit(math.pi)
    c = F.col
    gaps = [F.greatest(c(f"r_from{k}") - c(f"a_to{k}"), c(f"a_from{k}") - c(f"r_to{k}"), F.lit(0.0)) for k in range(references)]
    sums = []
    for k in range(references):
        least, most = c(f"a_from{k}") + c(f"r_from{k}"), c(f"a_to{k}") + c(f"r_to{k}")
        sums.append(F.when(most < pi, most).when(least > pi, 2 * pi - least).otherwise(pi))
    low = reduce(lambda x, y: F.greatest(x, y), gaps) - PAD
    high = reduce(lambda x, y: F.least(x, y), sums) + PAD
    above, below = F.cos(F.greatest(low, F.lit(0.0))), F.cos(F.least(high, pi))
    most, least = c("a_most") * c("r_most"), c("a_least") * c("r_least")
    pad = most * RELATIVE + 1
    upper = F.when(above >= 0, above * most).otherwise(above * least) + pad
    lower = F.when(below >= 0, below * least).otherwise(below * most) - pad
    return (upper >= c("a_lowest")) & (lower <= c("a_highest"))


def mine(
    vectors: DataFrame,
    anchor: Column,
    id: str = "vec_id",
    label: str = "label",
    embedding: str = "embedding",
    scale: int = 256,
    positive_count: int = 5,
    negative_count: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    references: int = REFERENCES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` tells which rows are anchors. Negatives of a positive are the best
    ``negative_count`` rows of other labels whose score lies between
    ``low_percent`` and ``high_percent`` of the positive's.
    """

    taken = usable(vectors, id, label, embedding, anchor, scale)
    dim = taken.agg(F.max(F.size("q"))).first()[0] or 0
    hashed = taken.select("q").orderBy(F.xxhash64("q")).limit(SAMPLE).collect()
    sample = np.zeros((len(hashed), dim))
    for k, r in enumerate(hashed):
        sample[k, : len(r.q)] = r.q
    chosen = directions(sample, references)
    n = len(chosen)
    table = workdir.saved(marked(taken, dim, chosen), "vectors")
    found = workdir.saved(positives(table, dim, n, positive_count), "positives")
    # low <= 100 * score / positive <= high in whole numbers; empty below 0.
    p = F.col("positive_score").cast("decimal(38,0)")
    lowest, highest = F.ceil(p * low_percent / 100).cast("long"), F.floor(p * high_percent / 100).cast("long")
    window = F.struct("place", lowest.alias("lowest"), highest.alias("highest"))
    windows = found.filter(highest >= lowest).groupBy("row").agg(F.collect_list(window).alias("windows"))
    asking = table.filter("anchor").join(windows, "row")
    asking = workdir.saved(blocked(asking, "a_block", ANCHORS), "anchors")
    others = workdir.saved(blocked(table, "r_block", ROWS), "blocks")
    asked = {
        "a_lowest": F.min(F.array_min(F.transform("windows", lambda w: w["lowest"]))),
        "a_highest": F.max(F.array_max(F.transform("windows", lambda w: w["highest"]))),
    }
    of_rows = workdir.saved(_of_block(others, "r_block", n, {}), "row_blocks")
    last = of_rows.agg(F.max("r_block")).first()[0] or 0
    of_anchors = _of_block(asking, "a_block", n, asked).withColumn("r_block", F.explode(F.sequence(F.lit(0), F.lit(last))))
    cells = of_anchors.join(of_rows, "r_block").filter(_may_meet(n)).select("a_block", "r_block")
    cells = workdir.saved(cells, "cells")
    met = _met(asking, others, cells, ["a_block"], ["r_block"], _inside(dim, n, negative_count), NEGATIVE)
    best = _top(met, ["row", "place"], "negative", negative_count, "rank")
    ids = table.filter("anchor").select("row", F.col("id").alias("anchor_id"))
    return (
        best.join(found.select("row", "place", "positive_id", "positive_score"), ["row", "place"])
        .join(ids, "row")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


rows.shipped(__name__)
