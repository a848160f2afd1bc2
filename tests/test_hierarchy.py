"""Ward's hierarchy over a clustering-feature tree against plain merges."""

import itertools
import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from hourvault.operators import distances
from hourvault.operators import hierarchy as h
from hourvault.operators.clustering import hierarchical_sweep


def plain_ward(points, k):
    """Clusters as sets of points, by the smallest growth of the square sum each."""
    clusters = [[p] for p in range(len(points))]
    while len(clusters) > k:
        def growth(pair):
            a, b = (points[clusters[x]] for x in pair)
            return len(a) * len(b) / (len(a) + len(b)) * ((a.mean(axis=0) - b.mean(axis=0)) ** 2).sum()

        i, j = min(itertools.combinations(range(len(clusters)), 2), key=growth)
        clusters[i] += clusters.pop(j)
    return {frozenset(c) for c in clusters}


def as_sets(labels):
    return {frozenset(np.flatnonzero(labels == x).tolist()) for x in set(labels.tolist())}


@pytest.mark.parametrize("width", [1, 2, 6])
def test_merges_equal_plain_ward(width):
    points = np.random.default_rng(width).normal(size=(40, width))
    merges = h.ward_merges(np.ones(40), points)
    assert len(merges) == 39 and [m[2] for m in merges] == sorted(m[2] for m in merges)
    for k in (1, 2, 3, 7, 10, 39, 40):
        assert as_sets(h.cut(merges, 40, k)) == plain_ward(points, k)
    assert h.ward_merges(np.zeros(0), np.zeros((0, 2))) == [] and h.cut([], 1, 5).tolist() == [0]


def test_weighted_leaves_merge_as_their_points():
    points = np.random.default_rng(9).normal(size=(12, 2))
    n = np.arange(1, 13)
    weighted = [[n[p], points[p]] for p in range(12)]
    merges = h.ward_merges(n, points)
    i, j = min(itertools.combinations(range(12), 2), key=lambda p: weighted[p[0]][0] * weighted[p[1]][0] / (weighted[p[0]][0] + weighted[p[1]][0])
               * ((weighted[p[0]][1] - weighted[p[1]][1]) ** 2).sum())
    assert merges[0][:2] == (i, j)


def test_tree_keeps_sums_and_its_bound():
    r = np.random.default_rng(3)
    points = np.concatenate([r.normal(c, 0.1, size=(400, 3)) for c in (0, 10, 20)])
    r.shuffle(points)
    for leaves in (5000, 100, 10):
        tree = h.FeatureTree(3, leaves)
        for p in points:
            tree.insert(1.0, p, float(p @ p))
        n, total, square = tree.leaves()
        assert len(n) == tree.count <= leaves and n.sum() == len(points)
        assert np.allclose(total.sum(axis=0), points.sum(axis=0)) and np.isclose(square.sum(), (points ** 2).sum())
        assert (len(n) == 1200) == (leaves == 5000)
        # No leaf takes in points of two places.
        assert (np.abs((total / n[:, None])[:, 0] / 10 - np.round((total / n[:, None])[:, 0] / 10)) < 0.1).all()


def made(spark, points):
    return spark.createDataFrame([(k, None if p is None else Vectors.dense(p), "x") for k, p in enumerate(points)], ["id", "features", "cluster_"])


def test_labels_of_points(spark):
    r = random.Random(2)
    points = [[r.gauss(c, 1), r.gauss(-c, 1)] for c in (0, 50, 90) for _ in range(40)]
    points += points[:30]  # repeated points lie in the leaf of the first
    distinct = np.array(points[:120])
    odd = [None, [float("nan"), 1.0], [float("inf"), 1.0]]
    found = h.ward(made(spark, points + odd))
    assert len(found.n) == 120 and found.n.sum() == 150
    rows = sorted(found.transform(made(spark, points + odd), {"two": 2, "three": 3, "nine": 9}).collect())
    assert rows[0].asDict().keys() == {"id", "cluster_", "features", "two", "three", "nine"}
    assert all(x.two is None for x in rows[150:]) and len(rows) == 153
    for name, k in (("two", 2), ("three", 3)):
        got = np.array([x[name] for x in rows[:120]])
        assert as_sets(got) == {frozenset(c) for c in plain_ward(distinct, k)}
    assert all(rows[k].nine == rows[120 + k].nine for k in range(30))
    # Few leaves: the places stay apart.
    coarse = h.ward(made(spark, points), leaves=20)
    assert len(coarse.n) <= 20
    got = np.array([x.three for x in sorted(coarse.transform(made(spark, points), {"three": 3}).collect())])
    assert as_sets(got[:120]) == {frozenset(range(40 * c, 40 * c + 40)) for c in range(3)}


def test_sweep_and_empty_input(spark):
    r = random.Random(5)
    points = made(spark, [[r.gauss(c, 1)] for c in (0, 100, 200) for _ in range(20)])
    rows = {x.params: x for x in hierarchical_sweep(points, ks=(2, 3, 4)).collect()}
    assert max(rows.values(), key=lambda x: x.silhouette).params == '{"k": 3}' and [rows[p].n_clusters for p in sorted(rows)] == [2, 3, 4]
    empty = h.ward(points.limit(0))
    assert empty.transform(points, {"c": 2}).filter("c IS NOT NULL").count() == 0


@pytest.mark.parametrize("block", [4096, 7])
def test_plain_silhouette(spark, block):
    r = np.random.default_rng(6)
    points = np.concatenate([r.normal(c, 1, size=(n, 3)) for c, n in ((0, 20), (4, 15), (9, 1))] + [np.zeros((6, 3))])
    labels = np.array([0] * 20 + [1] * 15 + [2] + [3] * 6)
    rows = [(int(x), Vectors.dense(p)) for x, p in zip(labels, points)] + [(None, Vectors.dense([1.0, 1.0, 1.0])), (1, None)]
    df = spark.createDataFrame(rows, ["cluster", "features"]).repartition(3)
    gaps = np.linalg.norm(points[:, None] - points[None], axis=2)
    want = []
    for k, x in enumerate(labels):
        own = (labels == x).sum() - 1
        a = gaps[k][labels == x].sum() / own if own else None
        b = min(gaps[k][labels == y].mean() for y in set(labels) - {x})
        want.append((int(x), 0.0 if a is None or max(a, b) == 0 else (b - a) / max(a, b)))
    got = sorted((r.cluster, r.silhouette) for r in distances.point_silhouettes(df, block_points=block).collect())
    assert [g[0] for g in got] == [w[0] for w in sorted(want)] and np.allclose([g[1] for g in got], [w[1] for w in sorted(want)], atol=1e-9)
    assert distances.exact_silhouette(df.filter("cluster = 1")).first().silhouette is None
