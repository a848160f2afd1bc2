"""The plain Euclidean silhouette: distance sums of all points, in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourvault.session import shared_dir

#: Points of a block, which goes to all tasks; and points of a task that it is held against at a time.
BLOCK_POINTS = 4096
AT_A_TIME = 512

SUMS = "slot int, other int, total double"


def distance_sums(rows: DataFrame, block: pa.Table) -> DataFrame:
    """Sums of the distances of each point of a block to the points of each cluster, one row for each task: SUMS.

    `rows` and `block` hold x (array<double>) and cluster. Distances are added up where they are made: no pair of points
    becomes a row.
    """
    centres = np.array(block["x"].to_pylist(), float)
    sent = rows.sparkSession.sparkContext.broadcast(centres)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sums = sent.value, {}
        squares = np.einsum("ij,ij->i", own, own)
        for batch in batches:
            clusters = batch.column("cluster").to_numpy()
            flat = batch.column("x").flatten().to_numpy().reshape(len(clusters), -1) if len(clusters) else own[:0]
            order = np.argsort(clusters, kind="stable")
            for low in range(0, len(order), AT_A_TIME):
                part = order[low:low + AT_A_TIME]
                points = flat[part]
                gaps = squares[None, :] + np.einsum("ij,ij->i", points, points)[:, None] - 2 * points @ own.T
                # The expansion cancels for points close together: those few are taken again, term by term.
                i, j = np.nonzero(gaps < 1e-9 * (squares[None, :] + 1))
                for k in range(0, len(i), 1 << 16):
                    some = slice(k, k + (1 << 16))
                    gaps[i[some], j[some]] = ((points[i[some]] - own[j[some]]) ** 2).sum(axis=1)
                gaps = np.sqrt(np.maximum(gaps, 0))
                names, first = np.unique(clusters[part], return_index=True)
                for name, total in zip(names.tolist(), np.add.reduceat(gaps, first, axis=0), strict=True):
                    sums[name] = sums.get(name, 0) + total
        for name, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array([name] * len(total), pa.int32()), pa.array(total)],
                                             names=["slot", "other", "total"])

    return rows.select("x", "cluster").mapInArrow(over, SUMS)


def point_silhouettes(points: DataFrame, features: str = "features", cluster: str = "cluster", block_points: int = BLOCK_POINTS) -> DataFrame:
    """cluster and silhouette of every point, from plain Euclidean distances.

    The mean distance to the other points of its cluster against that to the nearest other cluster; 0 for a point alone
    in its cluster. Points with a null cluster or vector take no part; with less than two clusters there are no rows.

    The work grows with the square of the points, so the points are dealt into blocks by a hash, and each block is held
    against all points in a job of its own. The rows of a block's sums are as many as its points x clusters x tasks,
    summed up on the way.
    """
    spark = points.sparkSession
    rows = points.filter(F.col(features).isNotNull() & F.col(cluster).isNotNull()).select(
        vector_to_array(features).alias("x"), F.col(cluster).cast("int").alias("cluster"))
    path = shared_dir(spark, "silhouette")
    rows.withColumn("_deal", F.xxhash64("x", F.monotonically_increasing_id())).write.parquet(f"{path}/points")
    rows = spark.read.parquet(f"{path}/points")
    sizes = {r.cluster: r.n for r in rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()}
    schema = "cluster int, silhouette double"
    if len(sizes) < 2:
        return spark.createDataFrame([], schema)
    counts = spark.createDataFrame(list(sizes.items()), "other int, n bigint")
    blocks = -(-sum(sizes.values()) // block_points)
    for k in range(blocks):
        block = rows.filter(F.pmod("_deal", F.lit(blocks)) == k).select("x", "cluster").toArrow()
        own = spark.createDataFrame(pa.table({"slot": pa.array(np.arange(block.num_rows, dtype=np.int32)), "cluster": block["cluster"]})) if block.num_rows else None
        if own is None:
            continue
        means = distance_sums(rows, block).groupBy("slot", "other").agg(F.sum("total").alias("total")).join(F.broadcast(counts), "other").join(F.broadcast(own), "slot")
        alike = F.col("other") == F.col("cluster")
        both = means.groupBy("slot", "cluster").agg(
            F.max(F.when(alike & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))).alias("a"), F.min(F.when(~alike, F.col("total") / F.col("n"))).alias("b"))
        apart = F.greatest("a", "b")
        both.select("cluster", F.when(F.col("a").isNull() | (apart == 0), 0.0).otherwise((F.col("b") - F.col("a")) / apart).alias("silhouette")).write.parquet(
            f"{path}/scores/block={k}")
    return spark.read.schema(schema).parquet(f"{path}/scores")


def exact_silhouette(points: DataFrame, features: str = "features", cluster: str = "cluster", block_points: int = BLOCK_POINTS) -> DataFrame:
    """One row: points and their mean plain silhouette (null without two clusters)."""
    return point_silhouettes(points, features, cluster, block_points).agg(F.count(F.lit(1)).alias("points"), F.avg("silhouette").alias("silhouette"))
