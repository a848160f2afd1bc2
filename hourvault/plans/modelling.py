"""Clustering of metric tables: features, model, scores, centres and a run record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourvault.operators.clustering import KMEANS_K, SEED, append_run, centroids, kmeans
from hourvault.operators.features import as_points, merged_features
from hourvault.operators.scores import evaluate
from hourvault.sources.sinks import write_centroids
from hourvault.sources.tables import read_dataset


def run(spark: SparkSession, inputs: list[str], out: str, key: str = "repo_id", k: int = KMEANS_K, seed: int = SEED,
        percent: int | None = None) -> DataFrame:
    """Cluster the entities of the input tables; missing inputs are skipped. Returns the scores row."""
    features = merged_features([read_dataset(spark, p) for p in inputs], key, percent)
    points = as_points(features, key).persist()
    labelled, model = kmeans(points, k, seed)
    scores = evaluate(labelled).select(F.lit("KMeans").alias("model"), F.lit(f'{{"k": {k}}}').alias("params"), "*")
    append_run(scores, f"{out.rstrip('/')}/model_runs")
    write_centroids(centroids(model, [c for c in features.columns if c != key]), f"{out.rstrip('/')}/cluster_centroids")
    points.unpersist()
    return scores
