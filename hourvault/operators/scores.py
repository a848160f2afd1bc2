"""Cluster quality on labelled points (a `cluster` column and a vector `features`).

Everything here is linear in the points: they are reduced to one row per
cluster, or compared with the cluster centres only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CENTRE_BLOCK = 2048
NOISE = -1


def cluster_stats(points: DataFrame) -> DataFrame:
    """Per cluster: size, centre and sum of squared distances to the centre, from one pass."""
    summary = Summarizer.metrics("count", "mean", "variance").summary(F.col("features"))
    stats = points.groupBy("cluster").agg(summary.alias("s"))
    total_variance = F.aggregate(vector_to_array("s.variance"), F.lit(0.0), lambda a, v: a + v)
    return stats.select("cluster", F.col("s.count").alias("n"), vector_to_array("s.mean").alias("centre"),
                        (total_variance * (F.col("s.count") - 1)).alias("sse"))


def calinski_harabasz(points: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """One row `calinski`: between-cluster over within-cluster dispersion. `stats` saves the pass over the points."""
    stats = cluster_stats(points) if stats is None else stats
    parts = stats.select("cluster", "n", "sse", F.posexplode("centre").alias("dim", "c"))
    means = parts.groupBy("dim").agg((F.sum(F.col("n") * F.col("c")) / F.sum("n")).alias("mean"))
    gap = F.col("c") - F.col("mean")
    between = parts.join(means, "dim").agg(F.sum(F.col("n") * gap * gap).alias("b"))
    within = stats.agg(F.sum("sse").alias("w"), F.sum("n").alias("n"), F.count("*").alias("k"))
    total = within.select("*", between.scalar().alias("b"))
    ratio = (F.col("b") / (F.col("k") - 1)) / (F.col("w") / (F.col("n") - F.col("k")))
    return total.select(F.when(F.col("w") == 0, F.lit(1.0)).otherwise(ratio).alias("calinski"))


def cluster_spread(points: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Per cluster: centre and mean distance of its points to it."""
    centres = (cluster_stats(points) if stats is None else stats).select("cluster", "centre")
    squares = F.zip_with(vector_to_array("features"), F.col("centre"), lambda x, c: (x - c) * (x - c))
    distance = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda a, v: a + v))
    spread = points.join(centres, "cluster").groupBy("cluster").agg(F.avg(distance).alias("spread"))
    return centres.join(spread, "cluster")


def davies_bouldin(points: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """One row `davies`: mean over clusters of the worst ratio of spreads to centre distance.

    The ratio needs every pair of centres, never of points. Centres go out in
    blocks of bounded size and each task compares its own centres with one
    block at a time, so no pair is emitted and any number of clusters works.
    """
    spread = cluster_spread(points, stats).persist()
    worst: DataFrame | None = None
    for labels, centres, spreads in _centre_blocks(spread):
        part = spread.mapInPandas(_worst_against(labels, centres, spreads), "cluster string, worst double")
        worst = part if worst is None else worst.unionByName(part)
    if worst is None:
        return spread.agg(F.lit(0.0).alias("davies"))
    return worst.groupBy("cluster").agg(F.max("worst").alias("worst")).agg(F.avg("worst").alias("davies"))


def _centre_blocks(spread: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    rows = []
    for row in spread.toLocalIterator():
        rows.append(row)
        if len(rows) == CENTRE_BLOCK:
            yield _arrays(rows)
            rows = []
    if rows:
        yield _arrays(rows)


def _arrays(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (np.array([str(r["cluster"]) for r in rows]), np.array([r["centre"] for r in rows], dtype=float),
            np.array([r["spread"] for r in rows], dtype=float))


def _worst_against(labels: np.ndarray, centres: np.ndarray, spreads: np.ndarray):
    """Per centre the largest (spread + spread) / distance within a block of other centres."""
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            own = batch["cluster"].astype(str).to_numpy()
            gaps = np.stack(batch["centre"].to_numpy())[:, None, :] - centres[None, :, :]
            distance = np.sqrt((gaps * gaps).sum(axis=2))
            both = batch["spread"].to_numpy()[:, None] + spreads[None, :]
            ratio = np.divide(both, distance, out=np.zeros_like(both), where=distance > 0)
            ratio[own[:, None] == labels[None, :]] = 0.0
            yield pd.DataFrame({"cluster": own, "worst": ratio.max(axis=1)})

    return compare


def silhouette(points: DataFrame) -> float:
    """Mean silhouette with squared Euclidean distances, which cluster sums give without any point pairs."""
    rows = points.select("features", F.col("cluster").cast("double").alias("prediction"))
    return ClusteringEvaluator(metricName="silhouette", distanceMeasure="squaredEuclidean").evaluate(rows)


def cluster_profile(points: DataFrame, columns: list[str]) -> DataFrame:
    """Size and mean of each feature column per cluster."""
    return points.groupBy("cluster").agg(F.count("*").alias("size"), *[F.avg(c).alias(c) for c in columns])


def evaluate(points: DataFrame, noise: str = "score") -> DataFrame:
    """One row with n_clusters, silhouette, calinski and davies.

    Noise never counts as a cluster. With `noise='score'` noise points are
    scored as a group of their own, with `noise='reject'` any noise gives the
    worst scores, as fewer than two clusters always does.
    """
    if noise not in ("score", "reject"):
        raise ValueError("noise must be 'score' or 'reject'")
    stats = cluster_stats(points).persist()
    labels = stats.agg(
        F.count_if(F.col("cluster") != NOISE).alias("n"), F.count_if(F.col("cluster") == NOISE).alias("noise")).first()
    spark = points.sparkSession
    if labels["n"] < 2 or (noise == "reject" and labels["noise"]):
        values = (-1.0, -1.0, float("inf"))
    else:
        values = (silhouette(points), calinski_harabasz(points, stats).first()[0], davies_bouldin(points, stats).first()[0])
    stats.unpersist()
    return _scores(spark, labels["n"], *values)


def evaluate_cuts(points: DataFrame, cuts: dict[str, int], features: str = "features") -> dict[str, tuple[int, float, float, float]]:
    """Scores as of `evaluate` of many clusterings of the same points: (n_clusters, silhouette, calinski, davies) by name.

    `cuts` names columns with labels from 0 and how many clusters each has at most; rows without a label are left out.
    All are scored in three passes over the points, whatever their number: sums, distances to the centres, silhouettes.
    A task returns a row per cluster (and dimension), and the rows of all clusters are what reaches the driver.
    """
    names, first = list(cuts), np.cumsum([0, *cuts.values()])
    rows = points.select(vector_to_array(features).alias("_x"), *[F.col(n).cast("int").alias(n) for n in names])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Number of a clustering, its labelled points and their slots, batch by batch."""
        for batch in batches:
            lists = batch.column("_x")
            if len(lists):
                x = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
                for j, name in enumerate(names):
                    known = batch.column(name).is_valid().to_numpy(zero_copy_only=False)
                    yield j, x[known], batch.column(name).drop_null().to_numpy(zero_copy_only=False) + first[j]

    def summed(over, keys: list[str], values: list[str]) -> list:
        schema = ", ".join([*[f"{k} int" for k in keys], *[f"{v} double" for v in values]])
        return rows.mapInArrow(over, schema).groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values]).collect()

    def batch_of(names: list[str], *columns: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(first[-1]), None
        for _, x, slot in each(batches):
            total = np.zeros((first[-1], x.shape[1])) if total is None else total
            n += np.bincount(slot, minlength=first[-1])
            for d in range(x.shape[1]):
                total[:, d] += np.bincount(slot, x[:, d], first[-1])
        if total is not None:
            slot, dim = np.indices(total.shape, np.int32)
            yield batch_of(["slot", "dim", "n", "total"], slot.ravel(), dim.ravel(), np.repeat(n, total.shape[1]), total.ravel())

    found = summed(sums, ["slot", "dim"], ["n", "total"])
    n, centres = np.zeros(first[-1]), np.zeros((first[-1], 1 + max((r.dim for r in found), default=0)))
    for r in found:
        n[r.slot], centres[r.slot, r.dim] = r.n, r.total / r.n if r.n else 0.0

    def gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sse, spread = np.zeros(first[-1]), np.zeros(first[-1])
        for _, x, slot in each(batches):
            square = ((x - centres[slot]) ** 2).sum(axis=1)
            sse += np.bincount(slot, square, first[-1])
            spread += np.bincount(slot, np.sqrt(square), first[-1])
        yield batch_of(["slot", "sse", "spread"], np.arange(first[-1], dtype=np.int32), sse, spread)

    sse, spread = np.zeros(first[-1]), np.zeros(first[-1])
    for r in summed(gaps, ["slot"], ["sse", "spread"]):
        sse[r.slot], spread[r.slot] = r.sse, r.spread / n[r.slot] if n[r.slot] else 0.0

    def silhouettes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(len(names))
        for j, x, slot in each(batches):
            used = np.flatnonzero(n[first[j]:first[j + 1]]) + first[j]
            if len(used) < 2:
                continue
            # Mean squared distance to the points of a cluster: that to its centre, and its own spread.
            square = np.stack([((x - centres[c]) ** 2).sum(axis=1) + sse[c] / n[c] for c in used], axis=1)
            at = np.searchsorted(used, slot), np.arange(len(slot))
            own = square[at[1], at[0]] * n[slot] / np.maximum(n[slot] - 1, 1)
            square[at[1], at[0]] = np.inf
            near = square.min(axis=1)
            most = np.maximum(own, near)
            out[j] += np.where((n[slot] > 1) & (most > 0), (near - own) / np.where(most > 0, most, 1), 0.0).sum()
        yield batch_of(["cut", "total"], np.arange(len(names), dtype=np.int32), out)

    totals = {r.cut: r.total for r in summed(silhouettes, ["cut"], ["total"])}
    scores = {}
    for j, name in enumerate(names):
        used = np.flatnonzero(n[first[j]:first[j + 1]]) + first[j]
        if len(used) < 2:
            scores[name] = len(used), -1.0, -1.0, float("inf")
            continue
        m, c, size = n[used], centres[used], float(n[used].sum())
        between = float((m * ((c - (m @ c) / size) ** 2).sum(axis=1)).sum())
        within = float(sse[used].sum())
        calinski = 1.0 if within == 0 else (between / (len(used) - 1)) / (within / (size - len(used)))
        distance = np.sqrt(((c[:, None, :] - c[None, :, :]) ** 2).sum(axis=2))
        both = spread[used][:, None] + spread[used][None, :]
        worst = np.divide(both, distance, out=np.zeros_like(both), where=distance > 0)
        scores[name] = len(used), totals[j] / size, calinski, float(worst.max(axis=1).mean())
    return scores


def _scores(spark: SparkSession, n: int, s: float, c: float, d: float) -> DataFrame:
    return spark.createDataFrame([(n, float(s), float(c), float(d))],
                                 "n_clusters bigint, silhouette double, calinski double, davies double")
