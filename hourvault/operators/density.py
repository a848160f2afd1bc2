"""Density clustering (DBSCAN) by grid cells, exact, without comparing all points.

The grid side is eps / sqrt(dimensions), so two points of one cell are always
neighbours. A cell holding `min_samples` points or more consists of core
points only, and all core points of a cell share a cluster. What remains:

* points of sparse cells, fewer than `min_samples` distinct per cell, are
  compared with the points of nearby cells: linear in the points;
* pairs of core cells are connected when their closest core points are near.
  Bounding boxes settle most pairs; the others are split into smaller boxes,
  round by round, until every pair is settled;
* connected cells are labelled by alternating star contraction.

Equal points are merged first and carry their number as a weight.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourvault.session import enable_checkpoints

NOISE = -1
POINTS_PER_TASK = 100_000
SPLIT_FLAT = 4
SPLIT_DEEP = 2
GRID_DIMENSIONS = 3


def density_clusters(points: DataFrame, key: str, columns: list[str], eps: float, min_samples: int) -> DataFrame:
    """Key, `cluster` and `is_core` of every point.

    A cluster is named by the smallest key among its core points, noise is -1.
    A border point near several clusters joins the one with the smallest name.
    Keys are integers, one per row.
    """
    spark = points.sparkSession
    enable_checkpoints(spark)
    d, side = len(columns), eps / math.sqrt(len(columns)) * (1 - 1e-9)
    xs = [f"x{i}" for i in range(d)]
    located = points.select(F.col(key).cast("bigint").alias("key"), *[
        (F.col(c).cast("double") + F.lit(0.0)).alias(x) for c, x in zip(columns, xs)])
    distinct = located.groupBy(*xs).agg(F.count("*").alias("weight"), F.min("key").alias("key")).withColumn(
        "cell", F.array(*[F.floor(F.col(x) / side) for x in xs])).checkpoint()

    cells = distinct.groupBy("cell").agg(
        F.sum("weight").alias("cell_weight"), F.count("*").alias("cell_points"), *_box(xs)).checkpoint()
    nearby = _nearby_cells(cells, d, side, eps).checkpoint()
    sparse_cells = cells.filter(F.col("cell_weight") < min_samples).select("cell", "cell_weight")

    sparse = distinct.join(sparse_cells, "cell")
    counted = _neighbour_weight(sparse, distinct, cells, nearby, xs, eps)
    sparse_core = counted.filter(F.col("neighbours") >= min_samples).select("key")
    dense_core = distinct.join(cells.filter(F.col("cell_weight") >= min_samples).select("cell"), "cell", "left_semi")
    core = dense_core.unionByName(distinct.join(sparse_core, "key", "left_semi")).checkpoint()

    core_cells = core.groupBy("cell").agg(F.min("key").alias("node"), F.count("*").alias("cell_points"), *_box(xs)).checkpoint()
    edges = _connected_cells(core, core_cells, nearby, xs, side, eps)
    labels = core_cells.select("cell", "node").join(connected_components(edges), "node", "left").select(
        "cell", F.coalesce("component", "node").alias("cluster")).checkpoint()

    core_labels = core.join(labels, "cell").select("key", "cluster", F.lit(True).alias("is_core"))
    rest = sparse.join(core.select("key"), "key", "left_anti")
    border = _border_labels(rest, core, core_cells, nearby, labels, xs, eps).withColumn("is_core", F.lit(False))
    named = distinct.select("key", *xs).join(core_labels.unionByName(border), "key", "left").select(
        *xs, F.coalesce("cluster", F.lit(NOISE).cast("bigint")).alias("cluster"),
        F.coalesce("is_core", F.lit(False)).alias("is_core"))
    return located.join(named, xs).select(F.col("key").alias(key), "cluster", "is_core")


def _box(xs: list[str]) -> list[Column]:
    return [F.min(x).alias(f"lo_{x}") for x in xs] + [F.max(x).alias(f"hi_{x}") for x in xs]


def _square_sum(terms: list[Column]) -> Column:
    total = terms[0] * terms[0]
    for t in terms[1:]:
        total = total + t * t
    return total


def _distance2(a: str, b: str, xs: list[str]) -> Column:
    return _square_sum([F.col(f"{a}.{x}") - F.col(f"{b}.{x}") for x in xs])


def _least_distance2(a: str, b: str, xs: list[str]) -> Column:
    """Smallest squared distance between two boxes."""
    return _square_sum([F.greatest(F.col(f"{a}.lo_{x}") - F.col(f"{b}.hi_{x}"),
                                   F.col(f"{b}.lo_{x}") - F.col(f"{a}.hi_{x}"), F.lit(0.0)) for x in xs])


def _most_distance2(a: str, b: str, xs: list[str]) -> Column:
    """Largest squared distance between two boxes."""
    return _square_sum([F.greatest(F.col(f"{a}.hi_{x}") - F.col(f"{b}.lo_{x}"),
                                   F.col(f"{b}.hi_{x}") - F.col(f"{a}.lo_{x}")) for x in xs])


def _point_boxes(points: DataFrame, xs: list[str]) -> DataFrame:
    """Points as boxes without extent, to compare them with cell boxes."""
    return points.withColumns({f"{end}_{x}": F.col(x) for x in xs for end in ("lo", "hi")})


def _nearby_cells(cells: DataFrame, d: int, side: float, eps: float) -> DataFrame:
    """Ordered pairs of different occupied cells whose boxes come within eps.

    Candidates come from an equi-join on shifted grid coordinates (the first
    three dimensions), never from all pairs of cells.
    """
    m = min(d, GRID_DIMENSIONS)
    reach = int(math.floor(math.sqrt(d) + 1e-6)) + 1
    offsets = [o for o in itertools.product(range(-reach, reach + 1), repeat=m)
               if sum(max(abs(v) - 1, 0) ** 2 for v in o) <= d]
    xs = [f"x{i}" for i in range(d)]
    place = F.slice("cell", 1, m)
    shifted = F.array(*[F.array(*[F.lit(v).cast("bigint") for v in o]) for o in offsets])
    moved = cells.withColumn("o", F.explode(shifted)).withColumn("place", F.zip_with(place, "o", lambda c, o: c + o))
    pairs = moved.alias("a").join(cells.withColumn("place", place).alias("b"), "place").filter(
        F.col("a.cell") != F.col("b.cell"))
    return pairs.filter(_least_distance2("a", "b", xs) <= eps * eps).select(
        F.col("a.cell").alias("cell"), F.col("b.cell").alias("other"))


def _candidates(queries: DataFrame, boxes: DataFrame, nearby: DataFrame, xs: list[str], eps: float) -> DataFrame:
    """Each query point with every nearby cell whose box it reaches, and whether it reaches all of that box."""
    other = boxes.withColumnRenamed("cell", "other")
    pairs = _point_boxes(queries, xs).join(nearby, "cell").alias("p").join(other.alias("c"), "other")
    return pairs.filter(_least_distance2("p", "c", xs) <= eps * eps).select(
        F.col("p.key").alias("key"), *[F.col(f"p.{x}").alias(x) for x in xs], F.col("other"),
        (_most_distance2("p", "c", xs) <= eps * eps).alias("covers"), F.col("c.cell_points").alias("cell_points"),
        *[F.col(f"c.{n}").alias(n) for n in boxes.columns if n in ("cell_weight", "cluster")])


def _near_pairs(candidates: DataFrame, targets: DataFrame, sizes: DataFrame, xs: list[str], eps: float) -> DataFrame:
    """Query keys with the target points within eps.

    The points of a large cell are dealt over several tasks and the few query
    points that reach the cell are copied to each of them.
    """
    tasks = F.ceil(F.col("cell_points") / POINTS_PER_TASK).cast("int")
    queries = candidates.withColumn("part", F.explode(F.sequence(F.lit(0), tasks - 1)))
    dealt = targets.join(sizes.select("cell", tasks.alias("tasks")), "cell").withColumn(
        "part", F.pmod(F.xxhash64("key"), F.col("tasks")).cast("int"))
    joined = queries.alias("q").join(dealt.alias("t"), (F.col("q.other") == F.col("t.cell")) & (F.col("q.part") == F.col("t.part")))
    return joined.filter(_distance2("q", "t", xs) <= eps * eps)


def _neighbour_weight(sparse: DataFrame, distinct: DataFrame, cells: DataFrame, nearby: DataFrame,
                      xs: list[str], eps: float) -> DataFrame:
    """Number of points within eps of each point of a sparse cell, itself included."""
    candidates = _candidates(sparse, cells, nearby, xs, eps).checkpoint()
    whole = candidates.filter("covers").select("key", F.col("cell_weight").alias("w"))
    partly = _near_pairs(candidates.filter("NOT covers"), distinct, cells, xs, eps).select(
        F.col("q.key").alias("key"), F.col("t.weight").alias("w"))
    own = sparse.select("key", F.col("cell_weight").alias("w"))
    return own.unionByName(whole).unionByName(partly).groupBy("key").agg(F.sum("w").alias("neighbours"))


def _border_labels(rest: DataFrame, core: DataFrame, core_cells: DataFrame, nearby: DataFrame, labels: DataFrame,
                   xs: list[str], eps: float) -> DataFrame:
    """Smallest cluster name among the core points within eps of each point that is not core itself."""
    own = rest.join(labels, "cell").select("key", "cluster")
    boxes = core_cells.join(labels, "cell")
    candidates = _candidates(rest.select("key", "cell", *xs), boxes, nearby, xs, eps).checkpoint()
    whole = candidates.filter("covers").select("key", "cluster")
    partly = _near_pairs(candidates.filter("NOT covers"), core, core_cells, xs, eps).select(
        F.col("q.key").alias("key"), F.col("q.cluster").alias("cluster"))
    return own.unionByName(whole).unionByName(partly).groupBy("key").agg(F.min("cluster").alias("cluster"))


def _connected_cells(core: DataFrame, core_cells: DataFrame, nearby: DataFrame, xs: list[str], side: float,
                     eps: float) -> DataFrame:
    """Pairs of core cells (by node) holding two core points within eps of each other."""
    ends = [f"{end}_{x}" for x in xs for end in ("lo", "hi")]
    a = core_cells.select(F.col("node").alias("a"), "cell", F.col("cell").alias("p_grid"), F.struct(*ends).alias("p"))
    b = core_cells.select(F.col("node").alias("b"), F.col("cell").alias("other"), F.col("cell").alias("q_grid"),
                          F.struct(*ends).alias("q"))
    open_pairs = nearby.join(a, "cell").join(b, "other").filter("a < b").drop("cell", "other")
    located = core.join(core_cells.select("cell", "node"), "cell").select("node", *xs)
    settled: DataFrame | None = None
    width = side
    while True:
        near, far = _least_distance2("p", "q", xs), _most_distance2("p", "q", xs)
        judged = open_pairs.filter(near <= eps * eps).withColumn("joined", far <= eps * eps).checkpoint()
        edges = judged.filter("joined").select("a", "b").distinct()
        settled = edges if settled is None else settled.unionByName(edges)
        left = judged.join(edges, ["a", "b"], "left_anti")
        if left.isEmpty():
            return settled
        finer = width / (SPLIT_FLAT if len(xs) <= 2 else SPLIT_DEEP)
        open_pairs = _split_boxes(left, located, xs, ends, width, finer)
        width = finer


def _split_boxes(left: DataFrame, located: DataFrame, xs: list[str], ends: list[str], width: float, finer: float) -> DataFrame:
    """The undecided box pairs with each box replaced by the tight boxes of the finer grid inside it."""
    def grid(side: float) -> Column:
        return F.array(*[F.floor(F.col(x) / side) for x in xs])

    sides = F.array(F.struct(F.col("a").alias("node"), F.col("p_grid").alias("grid")),
                    F.struct(F.col("b").alias("node"), F.col("q_grid").alias("grid")))
    wanted = left.select(F.explode(sides).alias("s")).select("s.*").distinct()
    members = located.withColumn("grid", grid(width)).join(wanted, ["node", "grid"])
    parts = members.groupBy("node", "grid", grid(finer).alias("sub_grid")).agg(*_box(xs)).select(
        "node", "grid", "sub_grid", F.struct(*ends).alias("sub")).checkpoint()
    of_a = parts.select(F.col("node").alias("a"), F.col("grid").alias("p_grid"), F.col("sub_grid").alias("pg"), F.col("sub").alias("ps"))
    of_b = parts.select(F.col("node").alias("b"), F.col("grid").alias("q_grid"), F.col("sub_grid").alias("qg"), F.col("sub").alias("qs"))
    return left.select("a", "b", "p_grid", "q_grid").join(of_a, ["a", "p_grid"]).join(of_b, ["b", "q_grid"]).select(
        "a", "b", F.col("pg").alias("p_grid"), F.col("ps").alias("p"), F.col("qg").alias("q_grid"), F.col("qs").alias("q"))


def connected_components(edges: DataFrame) -> DataFrame:
    """`node` and `component`, the smallest node it is connected to, for undirected edges (a, b).

    Alternating large-star and small-star steps: every round hooks each node's
    neighbours to its smallest neighbour, so the number of rounds grows with
    the logarithm of the nodes, not with the length of a chain.
    """
    def with_least(pairs: DataFrame) -> DataFrame:
        least = pairs.groupBy("u").agg(F.min("v").alias("m"))
        return pairs.join(least.select("u", F.least("u", "m").alias("m")), "u")

    def large_star(e: DataFrame) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        return with_least(both).filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))

    def small_star(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        hooked = with_least(down)
        return hooked.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            hooked.select(F.col("u").alias("a"), F.col("m").alias("b"))).filter("a != b").distinct()

    current = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct().checkpoint()
    before = None
    while True:
        current = small_star(large_star(current)).checkpoint()
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
