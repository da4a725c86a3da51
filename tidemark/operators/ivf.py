"""Approximate vector search over centroid lists."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.operators.vector import vector_topk, vector_topk_batch, with_norm


@dataclass
class Lists:
    """Chunks with their ``list_id``, and one centroid per list."""

    chunks: DataFrame
    centroids: np.ndarray


def build_lists(chunks: DataFrame, n_lists: int = fixed.IVF_LISTS, seed: int = 7) -> Lists:
    """Assign every embedded chunk to its nearest centroid.

    Centroids are trained on all rows, at every size.
    """
    usable = with_norm(chunks.filter(F.col("embedding").isNotNull())).filter(F.col("norm") > 0)
    unit = F.transform("embedding", lambda v: v.cast("double") / F.col("norm"))
    points = usable.withColumn("features", array_to_vector(unit))
    model = KMeans(k=n_lists, seed=seed, maxIter=10, predictionCol="list_id").fit(points.select("features"))
    return Lists(model.transform(points).drop("features"), np.array(model.clusterCenters()))


def write_lists(lists: Lists, path: str) -> None:
    """Store the chunks by list, in as many files as a list's size asks for, and the centroids beside them."""
    _append(lists.chunks, path, "overwrite")
    rows = [(n, [float(x) for x in c]) for n, c in enumerate(lists.centroids)]
    stored = lists.chunks.sparkSession.createDataFrame(rows, "list_id int, centroid array<double>")
    stored.coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")


def _append(chunks: DataFrame, path: str, mode: str) -> None:
    spread = chunks.hint("rebalance", F.col("list_id"))
    spread.write.mode(mode).partitionBy("list_id").parquet(f"{path}/lists")


def open_lists(spark: SparkSession, path: str) -> Lists:
    """Stored lists with their centroids, one row each; a search opens only the lists that it probes."""
    rows = spark.read.parquet(f"{path}/centroids").orderBy("list_id").collect()
    return Lists(spark.read.parquet(f"{path}/lists"), np.array([r.centroid for r in rows]))


def assigned(chunks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Embedded chunks with norm and the ``list_id`` of the nearest centroid, as training assigns them."""
    half = (centroids**2).sum(axis=1) / 2

    @F.arrow_udf("int")
    def nearest(vectors: pa.Array, lengths: pa.Array) -> pa.Array:
        points = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
        points = points / lengths.to_numpy()[:, None]
        return pa.array((points @ centroids.T - half).argmax(axis=1).astype(np.int32))

    usable = with_norm(chunks.filter(F.col("embedding").isNotNull())).filter(F.col("norm") > 0)
    return usable.withColumn("list_id", nearest("embedding", "norm"))


def add_to_lists(chunks: DataFrame, path: str) -> None:
    """Append new chunks to stored lists; no chunk that is stored is read or moved, and nothing trained again."""
    centroids = open_lists(chunks.sparkSession, path).centroids
    _append(assigned(chunks, centroids), path, "append")


def nearest_lists(centroids: np.ndarray, query: Sequence[float], n_probe: int) -> list[int]:
    """Lists whose centroids are closest in angle to the query."""
    lengths = np.linalg.norm(centroids, axis=1)
    cosines = centroids @ np.asarray(query, dtype=np.float64) / np.where(lengths > 0, lengths, 1.0)
    return [int(i) for i in np.argsort(-cosines, kind="stable")[:n_probe]]


def ivf_topk(lists: Lists, query: Sequence[float], k: int, n_probe: int = 1) -> DataFrame:
    """Exact ranking inside the ``n_probe`` nearest lists.

    On stored lists the filter prunes the partitions that are not probed.
    With ``n_probe`` equal to the number of lists the result is exact.
    """
    probed = lists.chunks.filter(
        F.col("list_id").isin(nearest_lists(lists.centroids, query, n_probe))
    )
    return vector_topk(probed, query, k)


def list_order(queries: DataFrame, centroids: np.ndarray, key: str = "query_id") -> DataFrame:
    """(key, list_id, place from 0): the lists in the order in which a query probes them."""
    lengths = np.linalg.norm(centroids, axis=1)
    units = centroids / np.where(lengths > 0, lengths, 1.0)[:, None]

    @F.arrow_udf("array<int>")
    def order(vectors: pa.Array) -> pa.Array:
        points = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
        found = np.argsort(-(points @ units.T), axis=1, kind="stable").astype(np.int32)
        return pa.array(list(found), pa.list_(pa.int32()))

    usable = with_norm(queries.filter(F.col("embedding").isNotNull())).filter(F.col("norm") > 0)
    return usable.select(key, F.posexplode(order("embedding")).alias("place", "list_id"))


def ivf_topk_batch(lists: Lists, queries: DataFrame, k: int, n_probe: int, key: str = "query_id") -> DataFrame:
    """Best k chunks of each query among its ``n_probe`` nearest lists: (key, chunk_id, score, rank from 0).

    Queries and chunks meet by list, in blocks; a list that no query probes is not opened.
    """
    probes = list_order(queries, lists.centroids, key).filter(F.col("place") < n_probe).drop("place")
    asked = queries.select(key, "embedding").join(probes, key)
    return vector_topk_batch(lists.chunks, asked, k, key, shared=["list_id"])


def recall(lists: Lists, queries: DataFrame, k: int, key: str = "query_id") -> DataFrame:
    """(n_probe, recall): the share of the exact k best that each number of probed lists finds.

    One exact search answers for all numbers at once: a hit is found from the
    place on that its list has in the query's order.
    """
    exact = vector_topk_batch(lists.chunks, queries, k, key).select(key, "chunk_id")
    where = lists.chunks.select("chunk_id", "list_id").join(exact, "chunk_id")
    placed = where.join(list_order(queries, lists.centroids, key), [key, "list_id"]).groupBy("place").agg(F.count("*").alias("n"))
    total = placed.agg(F.sum("n")).scalar()
    upto = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)  # a row per list
    counted = placed.withColumn("found", F.sum("n").over(upto))
    return counted.select((F.col("place") + 1).alias("n_probe"), (F.col("found") / total).alias("recall"))


def probes_for(lists: Lists, queries: DataFrame, k: int, least: float = 0.9, key: str = "query_id") -> int:
    """The smallest number of probed lists that finds a share of ``least`` of the exact k best of these queries."""
    enough = recall(lists, queries, k, key).filter(F.col("recall") >= least).agg(F.min("n_probe").alias("n")).first().n
    return enough or len(lists.centroids)
