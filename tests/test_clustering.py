"""Density clustering and scores against brute force."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from hourvault.operators import density, scores
from hourvault.operators.clustering import best_models, hierarchical_sweep
from hourvault.operators.density import connected_components, density_clusters


def brute_force(points, eps, least):
    """Clusters named by their first core point; a border point takes the smallest name in reach."""
    near = ((points[:, None] - points[None]) ** 2).sum(2) <= eps * eps
    core = near.sum(1) >= least
    label = -np.ones(len(points), int)
    for start in range(len(points)):
        if core[start] and label[start] < 0:
            label[start], stack = start, [start]
            while stack:
                for v in np.where(near[stack.pop()] & core & (label < 0))[0]:
                    label[v] = start
                    stack.append(v)
    for i in np.where(~core)[0]:
        around = np.where(near[i] & core)[0]
        if len(around):
            label[i] = label[around].min()
    return label, core


@pytest.mark.parametrize("d, n, eps, least, per_task", [(2, 400, 0.3, 5, 7), (1, 200, 0.05, 4, 100_000), (3, 200, 0.7, 5, 20)])
def test_density_equals_brute_force(spark, monkeypatch, d, n, eps, least, per_task):
    """`per_task` small makes every larger cell spread over several tasks."""
    monkeypatch.setattr(density, "POINTS_PER_TASK", per_task)
    rng = np.random.default_rng(d)
    points = np.concatenate([rng.normal(size=(n // 2, d)), np.round(rng.normal(size=(n // 4, d)) * 2, 1), np.zeros((n - n // 2 - n // 4, d))])
    columns = [f"f{j}" for j in range(d)]
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id bigint, " + ", ".join(f"{c} double" for c in columns))
    found = {r.id: (r.cluster, r.is_core) for r in density_clusters(df, "id", columns, eps, least).collect()}
    label, core = brute_force(points, eps, least)
    assert found == {i: (label[i], bool(core[i])) for i in range(n)}


def test_two_bands_just_apart_and_just_touching(spark):
    """Parallel rows of points whose gap is next to eps: bounding boxes alone cannot decide."""
    xs = np.arange(0, 3, 0.05)
    for gap, clusters in ((0.5001, 2), (0.4999, 1)):
        points = np.concatenate([np.c_[xs, np.zeros_like(xs)], np.c_[xs, np.full_like(xs, gap)]])
        df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "id bigint, x double, y double")
        found = density_clusters(df, "id", ["x", "y"], 0.5, 3).select("cluster").distinct().count()
        assert found == clusters


def test_components_of_long_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1001 + i) for i in range(200)]
    edges = spark.createDataFrame(chain + star, "a bigint, b bigint")
    density.enable_checkpoints(spark)
    found = {r.node: r.component for r in connected_components(edges).collect()}
    assert {found[i] for i in range(1, 301)} == {0} and {found[1001 + i] for i in range(200)} == {1000}


def labelled(spark, points, labels):
    return spark.createDataFrame([(int(c), Vectors.dense([float(v) for v in p])) for c, p in zip(labels, points)], ["cluster", "features"])


def test_scores_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(scores, "CENTRE_BLOCK", 2)
    rng = np.random.default_rng(3)
    labels = rng.integers(0, 5, 120)
    points = rng.normal(size=(120, 3)) + labels[:, None]
    df = labelled(spark, points, labels)
    centres = np.array([points[labels == c].mean(0) for c in range(5)])
    sizes = np.bincount(labels)
    within = sum(((points[labels == c] - centres[c]) ** 2).sum() for c in range(5))
    between = (sizes * ((centres - points.mean(0)) ** 2).sum(1)).sum()
    assert np.isclose(scores.calinski_harabasz(df).first()[0], (between / 4) / (within / 115))
    spread = np.array([np.sqrt(((points[labels == c] - centres[c]) ** 2).sum(1)).mean() for c in range(5)])
    gap = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(2))
    ratio = np.where(gap > 0, (spread[:, None] + spread[None]) / np.where(gap > 0, gap, 1), 0)
    assert np.isclose(scores.davies_bouldin(df).first()[0], ratio.max(1).mean())
    square = ((points[:, None] - points[None]) ** 2).sum(2)
    own = np.array([square[i][labels == labels[i]].sum() / (sizes[labels[i]] - 1) for i in range(120)])
    near = np.array([min(square[i][labels == c].mean() for c in range(5) if c != labels[i]) for i in range(120)])
    assert np.isclose(scores.silhouette(df), ((near - own) / np.maximum(near, own)).mean())


def test_guards(spark):
    points = [[0.0], [0.1], [5.0], [5.1], [9.0]]
    one = scores.evaluate(labelled(spark, points, [0, 0, 0, 0, -1])).first()
    assert (one.n_clusters, one.silhouette, one.calinski, one.davies) == (1, -1.0, -1.0, float("inf"))
    noisy = labelled(spark, points, [0, 0, 1, 1, -1])
    assert scores.evaluate(noisy, "reject").first().silhouette == -1.0
    kept = scores.evaluate(noisy, "score").first()
    assert kept.n_clusters == 2 and kept.silhouette > 0.5
    with pytest.raises(ValueError):
        scores.evaluate(noisy, "drop")
    ranked = best_models(spark.createDataFrame([("a", "{}", 0.1), ("b", "{}", 0.9)], "model string, params string, silhouette double"))
    assert [r.model for r in ranked.collect()] == ["b", "a"]


def test_cuts_are_scored_as_one_by_one(spark):
    """Clusterings scored together: with an unused label, single points, equal points and rows without a label."""
    rng = np.random.default_rng(9)
    points = np.concatenate([rng.normal(size=(60, 2)) + 1000, rng.normal(size=(40, 2)), np.zeros((5, 2))])
    cuts = {"three": rng.integers(0, 3, 105), "gap": rng.integers(0, 2, 105) * 2, "one": np.zeros(105, int), "lone": (np.arange(105) == 7).astype(int)}
    rows = [(Vectors.dense(p), *(int(v[i]) for v in cuts.values())) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, ["features", *cuts]).repartition(3)
    found = scores.evaluate_cuts(df.unionByName(df.limit(1).select("features", *[(df[c] * None).alias(c) for c in cuts])), {"three": 3, "gap": 3, "one": 1, "lone": 2})
    for name in cuts:
        alone = scores.evaluate(df.select("features", df[name].alias("cluster"))).first()
        assert np.allclose(found[name], (alone.n_clusters, alone.silhouette, alone.calinski, alone.davies), rtol=1e-9)


def test_a_sweep_passes_over_the_points_a_few_times(spark):
    """Jobs of a sweep must not grow with the number of clusterings that are scored."""
    points = spark.createDataFrame([(i, Vectors.dense([float(i % 7), float(i % 3)])) for i in range(200)], ["id", "features"])
    context, counts = spark.sparkContext, []
    for ks in ((2, 3), range(2, 8)):
        context.setJobGroup(f"sweep-{len(ks)}", "")
        assert hierarchical_sweep(points, ks=ks).count() == len(ks)
        counts.append(len(context.statusTracker().getJobIdsForGroup(f"sweep-{len(ks)}")))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert counts[0] == counts[1]
