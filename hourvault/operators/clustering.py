"""Clustering models, sweeps over their parameters, ranking and run records."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourvault.operators.density import density_clusters
from hourvault.operators.features import as_points
from hourvault.operators.hierarchy import LEAVES, ward
from hourvault.operators.scores import evaluate, evaluate_cuts

# Parameters of the standard sweeps.
KMEANS_K = 5
SEED = 42
SWEEP_K = range(2, 11)
SWEEP_EPS = (0.3, 0.5, 0.7, 1.0)
WIDE_SWEEP_EPS = (0.5, 1.0, 1.5)
SWEEP_MIN_SAMPLES = (3, 5, 10)


def kmeans(points: DataFrame, k: int = KMEANS_K, seed: int = SEED) -> tuple[DataFrame, KMeansModel]:
    """Points with a `cluster` column, and the fitted model."""
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(points)
    return model.transform(points), model


def hierarchical(points: DataFrame, k: int, leaves: int = LEAVES) -> DataFrame:
    """Points clustered from the bottom up (Ward) into k clusters, over at most `leaves` clustering features."""
    return ward(points, leaves).transform(points, {"cluster": k})


def _scored(labelled: DataFrame, model: str, params: dict, noise: str) -> DataFrame:
    return evaluate(labelled, noise).select(F.lit(model).alias("model"), F.lit(json.dumps(params)).alias("params"), "*")


def _scored_cuts(labelled: DataFrame, model: str, names: dict[str, int], noise: str) -> DataFrame:
    """One row of scores per k of the labels of all points, scored together; these methods leave no noise."""
    if noise not in ("score", "reject"):
        raise ValueError("noise must be 'score' or 'reject'")
    labelled = labelled.persist()
    rows = [(model, json.dumps({"k": names[name]}), *map(float, values[1:]), int(values[0])) for name, values in evaluate_cuts(labelled, names).items()]
    labelled.unpersist()
    return labelled.sparkSession.createDataFrame(
        rows, "model string, params string, silhouette double, calinski double, davies double, n_clusters bigint").select(
        "model", "params", "n_clusters", "silhouette", "calinski", "davies")


def kmeans_sweep(points: DataFrame, ks=SWEEP_K, seed: int = SEED, noise: str = "score") -> DataFrame:
    """One row of scores per k."""
    points = points.persist()
    names = {f"_cluster_{k}": k for k in ks}
    labelled = points.select("features")
    for name, k in names.items():
        labelled = kmeans(points, k, seed)[1].setPredictionCol(name).transform(labelled)
    rows = _scored_cuts(labelled, "KMeans", names, noise)
    points.unpersist()
    return rows


def hierarchical_sweep(points: DataFrame, ks=SWEEP_K, leaves: int = LEAVES, noise: str = "score") -> DataFrame:
    """One row of scores per k, all cut from one hierarchy."""
    names = {f"_cluster_{k}": k for k in ks}
    return _scored_cuts(ward(points, leaves).transform(points, names).select("features", *names), "Hierarchical", names, noise)


def density_sweep(features: DataFrame, key: str, eps_values=SWEEP_EPS, min_samples=SWEEP_MIN_SAMPLES,
                  noise: str = "score") -> DataFrame:
    """One row of scores per (eps, min_samples). Scores are values, so nothing is kept in memory afterwards."""
    columns = [c for c in features.columns if c != key]
    features = features.persist()
    rows = []
    for eps in eps_values:
        for m in min_samples:
            labelled = density_clusters(features, key, columns, eps, m)
            points = as_points(features, key).join(labelled.select(key, "cluster"), key).persist()
            rows.append(_scored(points, "DBSCAN", {"eps": eps, "min_samples": m}, noise))
            points.unpersist()
    features.unpersist()
    return reduce(DataFrame.unionByName, rows)


def best_models(results: DataFrame, n: int = 10) -> DataFrame:
    """The n best results by silhouette."""
    return results.orderBy(F.col("silhouette").desc(), "model", "params").limit(n)


def centroids(model: KMeansModel, columns: list[str]) -> DataFrame:
    """Cluster centres as rows; there are as many as clusters."""
    spark = SparkSession.active()
    rows = [(i, *[float(v) for v in centre]) for i, centre in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cluster int, " + ", ".join(f"`{c}` double" for c in columns))


def run_record(results: DataFrame) -> DataFrame:
    """The best result as a row of the `model_runs` table."""
    return best_models(results, 1).select(
        "params", "silhouette", "calinski", "davies", F.col("model").alias("model_type"),
        F.current_timestamp().alias("recorded_at"))


def append_run(results: DataFrame, path: str) -> None:
    run_record(results).write.mode("append").parquet(path)
