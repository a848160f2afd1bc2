"""Bottom-up clustering: a clustering-feature tree over all points, then Ward merges over its leaves."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourvault.session import enable_checkpoints

#: Leaves of a tree, and children of a node in it.
LEAVES = 1024
BRANCHES = 32
#: Trees that one task merges into one.
FAN_IN = 16

FEATURE = "n double, total array<double>, square double"


@dataclass
class Node:
    """Children of a tree node: their counts, sums and square sums; leaves of the tree have no nodes below."""

    width: int
    below: list[Node] | None = None
    n: np.ndarray = field(init=False)
    total: np.ndarray = field(init=False)
    square: np.ndarray = field(init=False)
    size: int = 0

    def __post_init__(self) -> None:
        self.n, self.total, self.square = np.zeros(BRANCHES + 1), np.zeros((BRANCHES + 1, self.width)), np.zeros(BRANCHES + 1)

    def nearest(self, n: float, total: np.ndarray) -> int:
        gap = self.total[:self.size] / self.n[:self.size, None] - total / n
        return int(np.einsum("ij,ij->i", gap, gap).argmin())

    def add(self, k: int, n: float, total: np.ndarray, square: float) -> None:
        self.n[k] += n
        self.total[k] += total
        self.square[k] += square

    def append(self, n: float, total: np.ndarray, square: float, below: Node | None = None) -> None:
        k, self.size = self.size, self.size + 1
        self.n[k], self.total[k], self.square[k] = n, total, square
        if below is not None:
            self.below.append(below)

    def sums(self) -> tuple[float, np.ndarray, float]:
        return float(self.n[:self.size].sum()), self.total[:self.size].sum(axis=0), float(self.square[:self.size].sum())

    def split(self) -> tuple[Node, Node]:
        """Two nodes around the two children that lie farthest apart."""
        centres = self.total[:self.size] / self.n[:self.size, None]
        squares = np.einsum("ij,ij->i", centres, centres)
        gaps = squares[:, None] + squares[None, :] - 2 * centres @ centres.T
        x, y = np.unravel_index(int(gaps.argmax()), gaps.shape)
        parts = tuple(Node(self.width, None if self.below is None else []) for _ in range(2))
        second = gaps[:, y] < gaps[:, x]
        second[x], second[y] = False, True  # also where all lie together
        for k in range(self.size):
            parts[int(second[k])].append(self.n[k], self.total[k], self.square[k], None if self.below is None else self.below[k])
        return parts


def spread_of(n: float, total: np.ndarray, square: float) -> float:
    """Mean squared distance of the points to their centre."""
    return max(0.0, square / n - float(total @ total) / (n * n))


class FeatureTree:
    """Clustering features (count, sum, square sum) in a tree; a leaf takes in what keeps its spread within a threshold.

    Without a threshold every entry keeps a leaf of its own, up to `leaves` of them. With more, the threshold begins or
    grows, and the leaves are entered into a new tree.
    """

    def __init__(self, width: int, leaves: int = LEAVES, threshold: float = 0.0):
        self.width, self.most, self.threshold = width, leaves, threshold
        self.root, self.count = Node(width), 0

    def insert(self, n: float, total: np.ndarray, square: float) -> None:
        parts = self._insert(self.root, n, total, square)
        if parts:
            self.root = Node(self.width, [])
            for part in parts:
                self.root.append(*part.sums(), part)
        if self.count > self.most:
            self._coarsen()

    def _insert(self, node: Node, n: float, total: np.ndarray, square: float) -> tuple[Node, Node] | None:
        k = node.nearest(n, total) if node.size else -1
        if node.below is None:
            if k >= 0 and self._fits(node, k, n, total, square):
                node.add(k, n, total, square)
                return None
            node.append(n, total, square)
            self.count += 1
        else:
            parts = self._insert(node.below[k], n, total, square)
            node.add(k, n, total, square)
            if parts:
                node.below[k] = parts[0]
                node.n[k], node.total[k], node.square[k] = parts[0].sums()
                node.append(*parts[1].sums(), parts[1])
        return node.split() if node.size > BRANCHES else None

    def _fits(self, node: Node, k: int, n: float, total: np.ndarray, square: float) -> bool:
        return bool(self.threshold) and spread_of(node.n[k] + n, node.total[k] + total, node.square[k] + square) <= self.threshold

    def _coarsen(self) -> None:
        n, total, square = self.leaves()
        # Half of the leaves would fit with a neighbour of their own.
        centres = total / n[:, None]
        near = []
        for low in range(0, len(n), 256):
            part = centres[low:low + 256]
            gaps = ((part[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2) if self.width <= 16 else (
                (part ** 2).sum(axis=1)[:, None] + (centres ** 2).sum(axis=1)[None, :] - 2 * part @ centres.T)
            gaps[np.arange(len(part)), low + np.arange(len(part))] = np.inf
            k = gaps.argmin(axis=1)
            near += [spread_of(n[low + i] + n[j], total[low + i] + total[j], square[low + i] + square[j]) for i, j in enumerate(k.tolist())]
        threshold = max(float(np.median(near)), 2 * self.threshold, np.finfo(float).tiny)
        self.__init__(self.width, self.most, threshold)
        for x in zip(n.tolist(), total, square.tolist(), strict=True):
            self.insert(*x)

    def leaves(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        out: list[Node] = []
        todo = [self.root]
        while todo:
            node = todo.pop()
            if node.below is None:
                out.append(node)
            else:
                todo += node.below
        return (np.concatenate([x.n[:x.size] for x in out]), np.concatenate([x.total[:x.size] for x in out]),
                np.concatenate([x.square[:x.size] for x in out]))


def as_array(features: str) -> Column:
    return F.when(F.col(features).isNotNull(), vector_to_array(features))


def feature_leaves(points: DataFrame, leaves: int = LEAVES, features: str = "features") -> tuple[np.ndarray, np.ndarray]:
    """Counts and centres of at most `leaves` clustering features of all points, in the order of the centres.

    Each task builds a tree of its points; trees are merged FAN_IN at a time, so that no task reads more than
    FAN_IN x `leaves` features, and the last one's leaves are all that reaches the driver. Points with a null or
    non-finite coordinate have no place and are left out.
    """
    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = None
        for batch in batches:
            for n, total, square in zip(*(batch.column(c).to_pylist() for c in ("n", "total", "square")), strict=True):
                total = np.array(total, float)
                tree = FeatureTree(len(total), leaves) if tree is None else tree
                tree.insert(n, total, square)
        if tree is not None:
            n, total, square = tree.leaves()
            yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(list(total), pa.list_(pa.float64())), pa.array(square)], names=["n", "total", "square"])

    points = points.select(as_array(features).alias("total")).filter(F.col("total").isNotNull() & F.forall("total", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    # Equal points are counted before a tree sees them, so that its entries are distinct.
    square = F.aggregate("total", F.lit(0.0), lambda s, v: s + v * v)
    entries = points.groupBy("total").agg(F.count(F.lit(1)).cast("double").alias("n")).select(
        "n", F.transform("total", lambda v: v * F.col("n")).alias("total"), (square * F.col("n")).alias("square"))
    enable_checkpoints(entries.sparkSession)
    parts = entries.sparkSession.sparkContext.defaultParallelism
    entries = entries.repartition(parts, "total").sortWithinPartitions("total").mapInArrow(built, FEATURE).checkpoint()
    while parts > 1:
        parts = -(-parts // FAN_IN)
        entries = entries.repartition(parts, "total").sortWithinPartitions("total").mapInArrow(built, FEATURE).checkpoint()
    found = entries.toArrow()
    n = found["n"].to_numpy()
    if not len(n):
        return n, np.zeros((0, 0))
    centres = np.array(found["total"].to_pylist(), float) / n[:, None]
    order = np.lexsort(centres.T[::-1])
    return n[order], centres[order]


def ward_merges(n: np.ndarray, centres: np.ndarray) -> list[tuple[int, int, float]]:
    """Merges of the nearest two clusters each, by the growth of the square sum: pairs of clusters and that growth.

    Clusters are numbered as leaves, then as they come about. Ties go to the clusters with the smallest numbers of leaves.
    """
    m = len(n)
    n, centres = n.astype(float).copy(), centres.astype(float).copy()
    number = list(range(m))
    cost = np.full((m, m), np.inf)

    def costs(k: int) -> np.ndarray:
        gap = centres - centres[k]
        out = n * n[k] / (n + n[k]) * np.einsum("ij,ij->i", gap, gap)
        out[~alive] = np.inf
        out[k] = np.inf
        return out

    alive = np.ones(m, bool)
    for k in range(m):
        cost[k] = costs(k)
    near = cost.argmin(axis=1) if m else np.zeros(0, int)
    least = cost[np.arange(m), near] if m else np.zeros(0)
    merges = []
    for step in range(m - 1):
        i = int(least.argmin())
        i, j = sorted((i, int(near[i])))
        merges.append((number[i], number[j], float(cost[i, j])))
        centres[i] = (n[i] * centres[i] + n[j] * centres[j]) / (n[i] + n[j])
        n[i] += n[j]
        number[i], alive[j] = m + step, False
        cost[j], cost[:, j], least[j] = np.inf, np.inf, np.inf
        cost[i] = costs(i)
        cost[:, i] = cost[i]
        for k in np.flatnonzero(alive & ((near == i) | (near == j))).tolist() + [i]:
            near[k] = int(cost[k].argmin())
            least[k] = cost[k, near[k]]
        closer = alive & (cost[i] < least)
        near[closer], least[closer] = i, cost[i][closer]
    return merges


def cut(merges: list[tuple[int, int, float]], m: int, k: int) -> np.ndarray:
    """Cluster of each of m leaves after all merges but the last k - 1: numbers from 0 in the order of the first leaf."""
    low = list(range(2 * m))
    for step, (i, j, _) in enumerate(merges[:max(0, m - k)]):
        low[i] = low[j] = m + step
    root = []
    for leaf in range(m):
        while low[leaf] != leaf:
            leaf = low[leaf]
        root.append(leaf)
    number = {r: x for x, r in enumerate(dict.fromkeys(root))}
    return np.array([number[r] for r in root], np.int32)


@dataclass
class Hierarchy:
    """Ward's hierarchy over the leaves of a feature tree: all points can be cut into any number of clusters."""

    n: np.ndarray
    centres: np.ndarray
    merges: list[tuple[int, int, float]]

    def labels(self, k: int) -> np.ndarray:
        return cut(self.merges, len(self.n), k)

    def transform(self, points: DataFrame, ks: dict[str, int], features: str = "features") -> DataFrame:
        """Points with a column for each number of clusters: that of the nearest leaf; null for points without a place."""
        labels = {name: self.labels(k) for name, k in ks.items()}
        centres, squares = self.centres, np.einsum("ij,ij->i", self.centres, self.centres)
        schema = ", ".join(["_row struct<" + ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in points.schema.fields if f.name != features) + ">",
                            "_x array<double>", *[f"`{name}` int" for name in ks]])

        def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = batch.column("_x").to_pylist()
                sound = np.array([x is not None and len(x) == centres.shape[1] and None not in x and bool(np.isfinite(x).all()) for x in lists], bool)
                leaf = np.full(len(lists), -1)
                at = np.flatnonzero(sound)
                for low in range(0, len(at) if len(centres) else 0, 4096):
                    part = np.array([lists[k] for k in at[low:low + 4096]], float)
                    # Distances themselves, not their expansion: equal points must be at distance 0.
                    near = (squares[None, :] - 2 * part @ centres.T).argpartition(min(7, len(centres) - 1), axis=1)[:, :8]
                    exact = ((part[:, None, :] - centres[near]) ** 2).sum(axis=2)
                    leaf[at[low:low + 4096]] = near[np.arange(len(part)), exact.argmin(axis=1)]
                out = [pa.array([int(labels[name][k]) if k >= 0 else None for k in leaf], pa.int32()) for name in ks]
                yield pa.RecordBatch.from_arrays([batch.column("_row"), batch.column("_x"), *out], names=["_row", "_x", *ks])

        others = [F.col(f"`{c}`") for c in points.columns if c != features]
        rows = points.select(F.struct(*others).alias("_row"), as_array(features).alias("_x"))
        return rows.mapInArrow(over, schema).select("_row.*", F.when(F.col("_x").isNotNull(), array_to_vector("_x")).alias(features), *ks)


def ward(points: DataFrame, leaves: int = LEAVES, features: str = "features") -> Hierarchy:
    """The hierarchy of all points. With up to `leaves` distinct points it is that of the points themselves."""
    n, centres = feature_leaves(points, leaves, features)
    return Hierarchy(n, centres, ward_merges(n, centres))
