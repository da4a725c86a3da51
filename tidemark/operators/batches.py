"""Many queries against one table: a grid of query blocks and row blocks, k best rows per cell.

A cell holds a block of queries and a block of rows, both of bounded size, and
leaves the k best rows per query; these are ranked again over all cells of a
query. Every row is sent to each query block and every query to each row block
that it may meet: the rows are read once, nothing passes the driver, and a
(query, row) pair is never a row of a table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Queries and rows of a cell, some.
QUERY_BLOCK_ROWS = 4096
ROW_BLOCK_ROWS = 65_536
# (query, row) scores that one task holds at a time.
SCORES_IN_MEMORY = 4_000_000


def _keep_best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best entries by (score descending, id); ties at the cut are resolved by id."""
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        within = scores >= cut
        scores, ids = scores[within], ids[within]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


class BestRows:
    """The k best rows seen so far, for a fixed number of queries."""

    def __init__(self, n_queries: int, k: int):
        self.k = k
        self.kept: list[tuple[np.ndarray, np.ndarray] | None] = [None] * n_queries

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = _keep_best(scores, ids, self.k)
        if self.kept[query] is not None:
            scores = np.concatenate([self.kept[query][0], scores])
            ids = np.concatenate([self.kept[query][1], ids])
            scores, ids = _keep_best(scores, ids, self.k)
        self.kept[query] = scores, ids

    def rows(self, query: int) -> tuple[np.ndarray, np.ndarray]:
        return self.kept[query] or (np.array([]), np.array([]))


def best_per_group(
    rows: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, name: str
) -> DataFrame:
    """The k first rows of every group, with their place ``name`` from 0.

    The filter is on the row number itself: that is the form for which Spark
    applies the limit in every task before the shuffle, so a group that holds
    most rows sends k rows per task and not all of them.
    """
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return rows.withColumn(name, place).filter(F.col(name) <= k).withColumn(name, F.col(name) - 1)


def grid(
    rows: DataFrame,
    queries: DataFrame,
    id_col: str,
    key: str,
    task: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
    shared: Sequence[str] = (),
    query_rows: int = QUERY_BLOCK_ROWS,
    row_rows: int = ROW_BLOCK_ROWS,
) -> DataFrame:
    """``task`` on every cell of queries and rows that agree in the ``shared`` columns (all, where there are none).

    Rows of one ``id_col`` are in one block, queries of one ``key`` as well. The
    shared columns have few values, as lists of an index do: the sizes per
    value, one row each, are sent to all tasks.
    """
    spark = rows.sparkSession
    shared = list(shared) or ["_all"]
    if shared == ["_all"]:
        rows, queries = rows.withColumn("_all", F.lit(0)), queries.withColumn("_all", F.lit(0))
        # One value for all: cells for every task, not only as many as the sizes ask for.
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    else:
        least = 1
    blocks = lambda df, size, column, least: df.groupBy(*shared).agg(
        F.greatest(F.ceil(F.count("*") / size), F.lit(least)).cast("int").alias(f"_{column}_blocks")
    )
    sizes = blocks(rows, row_rows, id_col, least).join(blocks(queries, query_rows, key, 1), shared)
    mine, other = F.broadcast(sizes), lambda column: F.explode(F.sequence(F.lit(0), F.col(f"_{column}_blocks") - 1))
    dealt = lambda column: F.pmod(F.xxhash64(column), F.col(f"_{column}_blocks")).cast("int")
    both = ["_q", "_r"]
    left = queries.join(mine, shared).select(*queries.columns, dealt(key).alias("_q"), other(id_col).alias("_r"))
    right = rows.join(mine, shared).select(*rows.columns, dealt(id_col).alias("_r"), other(key).alias("_q"))
    # Cells are few rows but much work: as many partitions as the session's, not merged.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    left, right = (df.toDF(*df.columns).repartition(tasks, *shared, *both).groupBy(*shared, *both) for df in (left, right))
    return left.cogroup(right).applyInArrow(task, schema)


def best_table(best: BestRows, keys: pa.Array, key: str, id_col: str) -> pa.Table:
    """What a cell leaves: (key, id, score)."""
    found = [best.rows(number) for number in range(len(best.kept))]
    who = np.repeat(np.arange(len(found)), [len(ids) for _, ids in found])
    columns = [np.concatenate([x[place] for x in found] or [np.array([])]) for place in (1, 0)]
    ids = pa.array(columns[0], pa.int64())
    return pa.table({key: keys.take(pa.array(who)), id_col: ids, "score": pa.array(columns[1], pa.float64())})


def best_of_cells(cells: DataFrame, key: str, id_col: str, k: int) -> DataFrame:
    """Rank what the cells keep, from 0."""
    return best_per_group(cells, [key], [F.desc("score"), F.asc(id_col)], k, "rank")
