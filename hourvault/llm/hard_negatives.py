"""Hard negatives of anchors by exact integer scores, looked up in subset-sum tables (the method of the Four Russians)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourvault.llm.common import stored
from hourvault.llm.registry import query, table

EVERY = 100
POSITIVES = 5
NEGATIVES = 10
LEAST_PERCENT, MOST_PERCENT = 30, 90
SCALE = 256
#: A quantised component beyond this counts as this: scores of up to 2^16 components then fit in 64 bits.
MOST = 1 << 23
GROUP = 8
#: Bytes of anchor vectors that go out at a time (as 32-bit integers); their tables take 32 times as much in a task.
ANCHOR_BYTES = 1 << 19
#: Anchors that share a table, and candidates looked up at a time: table and scores stay in a core's cache.
TABLE_ANCHORS, SLICE = 128, 512

#: Score of a positive that isn't there.
NONE = -(1 << 62)
FOUND = "slot int, place int, id bigint, score bigint"
RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def quantised(vectors: pa.Array, width: int) -> np.ndarray:
    """floor(256 * x) of each component, one row a vector, in `width` columns: shorter vectors end in zeros."""
    vectors = vectors.cast(pa.large_list(pa.float64()))
    size = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(vectors), width), np.int64)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    row = np.repeat(np.arange(len(vectors)), size)
    inside = column < width
    out[row[inside], column[inside]] = np.clip(np.floor(SCALE * flat[inside]), -MOST, MOST).astype(np.int64)
    return out


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Bytes of the bits of whole numbers in two's complement: plane, group of eight columns, row. The last plane is the sign."""
    bits = max(int(x).bit_length() for x in (values.max(initial=0), ~values.min(initial=0))) + 1
    groups = -(-values.shape[1] // GROUP)
    padded = np.zeros((len(values), groups * GROUP), np.int64)
    padded[:, :values.shape[1]] = values
    return np.stack([np.packbits(((padded >> k) & 1).astype(np.uint8), axis=1, bitorder="little").T for k in range(bits)])


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """For each group of eight columns and each byte, the anchors' sums over the columns whose bit is set: group, byte, anchor.

    Doubling: the sums with a column's bit are those without it, and the column.
    """
    groups = -(-anchors.shape[1] // GROUP)
    padded = np.zeros((groups * GROUP, len(anchors)), kind)
    padded[:anchors.shape[1]] = anchors.T
    out = np.zeros((groups, 1 << GROUP, len(anchors)), kind)
    for k in range(GROUP):
        out[:, 1 << k:2 << k] = out[:, :1 << k] + padded.reshape(groups, GROUP, -1)[:, k][:, None]
    return out


def looked_up(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products of candidates (by their planes) and anchors (by their tables): from the sign down, shift and add."""
    total = np.zeros((planes.shape[2], tables.shape[2]), tables.dtype)
    part = np.empty_like(total)
    for k in range(len(planes) - 1, -1, -1):
        total <<= 1
        add = np.subtract if k == len(planes) - 1 else np.add
        for group in range(len(tables)):
            np.take(tables[group], planes[k, group], axis=0, out=part)
            add(total, part, out=total)
    return total


@dataclass
class Anchors:
    """A block of anchors and, once known, the scores of their positives."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    positive_scores: np.ndarray | None = None  # anchor, place; NONE where there is none
    tables: dict = field(default_factory=dict)  # made in the task

    def table(self, rows: np.ndarray, key: object, kind: type) -> np.ndarray:
        if (key, kind) not in self.tables:
            self.tables[key, kind] = subset_sums(self.vectors[rows], kind)
        return self.tables[key, kind]


@dataclass
class Best:
    """The best (score, id) of each list so far: higher scores first, then smaller ids; equal pairs count once."""

    score: np.ndarray
    id: np.ndarray

    @staticmethod
    def empty(lists: int, size: int, floor: np.ndarray) -> Best:
        score = np.repeat(floor.astype(np.int64)[:, None], size, axis=1)
        return Best(score, np.full((lists, size), np.iinfo(np.int64).max))

    def least(self) -> np.ndarray:
        """Scores that a candidate must reach."""
        return self.score[:, -1]

    def add(self, where: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        lists = np.unique(where)
        size = self.score.shape[1]
        where = np.concatenate([np.repeat(lists, size), where])
        score = np.concatenate([self.score[lists].ravel(), score.astype(np.int64)])
        ids = np.concatenate([self.id[lists].ravel(), ids])
        order = np.lexsort((ids, -score, where))
        where, score, ids = where[order], score[order], ids[order]
        known = ids != np.iinfo(np.int64).max
        same = np.zeros(len(where), bool)
        same[1:] = (where[1:] == where[:-1]) & (score[1:] == score[:-1]) & (ids[1:] == ids[:-1]) & known[1:]
        where, score, ids = where[~same], score[~same], ids[~same]
        rank = np.arange(len(where)) - np.searchsorted(where, where)
        kept = rank < size
        # An entry without an id is a floor: it goes behind every candidate of its own score.
        self.score[where[kept], rank[kept]], self.id[where[kept], rank[kept]] = score[kept], ids[kept]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lists, rank = np.nonzero(self.id != np.iinfo(np.int64).max)
        return lists, self.id[lists, rank], self.score[lists, rank]


def scored(batches: Iterator[pa.RecordBatch], block: Anchors, per_label: bool) -> Iterator[tuple]:
    """Scores of slices of candidates and parts of the block: anchors' places, candidates' ids and labels, scores by candidate and anchor.

    `per_label`: only anchors and candidates of one label.
    """
    width = block.vectors.shape[1]
    largest = np.abs(block.vectors).sum(axis=1).max(initial=0)
    order = np.argsort(block.labels, kind="stable") if per_label else np.arange(len(block.ids))
    cuts = np.flatnonzero(np.diff(block.labels[order])) + 1 if per_label else []
    parts = [(p[k:k + TABLE_ANCHORS], int(block.labels[p[0]])) for p in np.split(order, cuts) for k in range(0, len(p), TABLE_ANCHORS)]
    for batch in batches:
        ids, labels = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy().astype(np.int64)
        if not len(ids):
            continue
        values = quantised(batch.column("embedding"), width)
        # Tables and sums in 32 bits where no score can pass them.
        kind = np.int32 if 2 * int(largest) * (int(np.abs(values).max(initial=0)) + 1) < 1 << 31 else np.int64
        groups = [(None, np.arange(len(ids)))] if not per_label else [(v, np.flatnonzero(labels == v)) for v in np.unique(labels).tolist()]
        for label, rows in groups:
            for low in range(0, len(rows), SLICE):
                at = rows[low:low + SLICE]
                planes = None
                for key, (anchors, own) in enumerate(parts):
                    if per_label and own != label:
                        continue
                    planes = bit_planes(values[at]) if planes is None else planes
                    yield anchors, ids[at], labels[at], looked_up(block.table(anchors, key, kind), planes)


def positives(batches: Iterator[pa.RecordBatch], block: Anchors, k: int) -> Best:
    """The k best other rows of each anchor's label among these candidates."""
    best = Best.empty(len(block.ids), k, np.full(len(block.ids), np.iinfo(np.int64).min + 1))
    for anchors, ids, _, score in scored(batches, block, True):
        candidate, column = np.nonzero(score >= best.least()[anchors])
        other = ids[candidate] != block.ids[anchors[column]]
        candidate, column = candidate[other], column[other]
        if len(candidate):
            best.add(anchors[column], score[candidate, column], ids[candidate])
    return best


def negatives(batches: Iterator[pa.RecordBatch], block: Anchors, n: int, least: int, most: int) -> Best:
    """For each anchor and positive, the n best rows of other labels in the window under the positive's score."""
    # least * p <= 100 * s <= most * p in whole numbers, also where p is below 0 (then no s will do).
    there = block.positive_scores != NONE
    p = np.where(there, block.positive_scores, 0)
    low, high = -((-least * p) // 100), (most * p) // 100
    high = np.where(there, high, low - 1)
    places = p.shape[1]
    best = Best.empty(p.size, n, low.ravel())
    for anchors, ids, labels, score in scored(batches, block, False):
        unlike = labels[:, None] != block.labels[anchors][None, :]
        for place in range(places):
            lists = anchors * places + place
            candidate, column = np.nonzero((score >= best.least()[lists]) & (score <= high[anchors, place]) & unlike)
            if len(candidate):
                best.add(lists[column], score[candidate, column], ids[candidate])
    return best


def best_of_block(rows: DataFrame, block: Anchors, places: int, run) -> DataFrame:
    """The lists' best candidates of every task: one row for each."""
    shared = rows.sparkSession.sparkContext.broadcast(block)
    names = ("slot", "place", "id", "score")

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, ids, scores = run(batches, shared.value).rows()
        for k in range(0, len(lists), 1 << 16):
            part = slice(k, k + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in ((lists[part] // places).astype(np.int32), (lists[part] % places).astype(np.int32),
                                                                   ids[part], scores[part])], names=list(names))

    return rows.mapInArrow(over, FOUND)


def best_overall(found: DataFrame, k: int) -> DataFrame:
    """The k best of each list over all tasks, with their rank from 1; a pair that two tasks found counts once."""
    ordered = Window.partitionBy("slot", "place").orderBy(F.desc("score"), "id")
    return found.distinct().withColumn("rank", F.row_number().over(ordered)).filter(F.col("rank") <= k)


def taking_part(rows: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """vec_id, label, embedding of rows without nulls and with finite components only."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return (rows.select(F.col(f"`{id_column}`").cast("bigint").alias("vec_id"), F.col(f"`{label_column}`").cast("bigint").alias("label"),
                        F.col(f"`{vector_column}`").cast("array<double>").alias("embedding"))
            .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & finite))


def hard_negatives(rows: DataFrame, every: int = EVERY, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES,
                   least_percent: int = LEAST_PERCENT, most_percent: int = MOST_PERCENT, anchor_bytes: int = ANCHOR_BYTES,
                   id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """Negatives close to each anchor: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are rows whose id is divisible by `every`. Components become floor(256 * x); scores are whole inner products
    with the anchor, higher first, ties by smaller id. An anchor's positives are the first other rows of its label; for
    each, its negatives are the first rows of other labels with a score of `least_percent` to `most_percent` of the
    positive's.

    Each block of anchors (`anchor_bytes` of vectors) goes to all tasks, which make its subset-sum tables once and look
    up every candidate by the bytes of its bit planes: no pairs become rows. A task returns the best of each list; work
    is dealt by rows, so common labels and repeated vectors weigh no more than others.

    Rows with a null id, label or vector, or a null or non-finite component, take no part. A row of the anchor's own id
    is not another row. A repeated row adds nothing; rows of one id with different vectors or labels are rows of their
    own. Shorter vectors are filled with zeros, components of a candidate beyond those of all anchors of its block score
    nothing, and quantised components beyond 2^23 count as 2^23. Without anchors, positives or negatives there are no
    rows; other columns are not read.
    """
    spark = rows.sparkSession
    rows = taking_part(rows, id_column, vector_column, label_column)
    anchors = rows.filter(F.col("vec_id") % every == 0).distinct()
    n, width = anchors.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    blocks = max(1, -(-n * max(1, width or 0) * 4 // anchor_bytes))
    anchors = stored(anchors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")), "anchors", "block")
    out = None
    for number in range(blocks):
        found = of_block(rows, anchors.filter(F.col("block") == number), n_positives, n_negatives, least_percent, most_percent)
        if found is not None:
            # With several blocks each one's few rows are written at once, so that a lost executor repeats one block only.
            found = found if blocks == 1 else stored(found, "hard-negatives")
            out = found if out is None else out.union(found)
    return out if out is not None else spark.createDataFrame([], RESULT)


def of_block(rows: DataFrame, anchors: DataFrame, n_positives: int, n_negatives: int, least: int, most: int) -> DataFrame | None:
    spark = rows.sparkSession
    got = anchors.select("vec_id", "label", "embedding").toArrow().combine_chunks()
    if not got.num_rows:
        return None
    width = max(1, int(np.diff(got["embedding"].combine_chunks().cast(pa.large_list(pa.float64())).offsets.to_numpy()).max()))
    block = Anchors(got["vec_id"].to_numpy(), got["label"].to_numpy().astype(np.int64), quantised(got["embedding"].combine_chunks(), width))
    best = best_overall(best_of_block(rows, block, 1, lambda batches, b: positives(batches, b, n_positives)), n_positives).toArrow()
    block.positive_scores = np.full((len(block.ids), n_positives), NONE)
    place = best["rank"].to_numpy() - 1
    block.positive_scores[best["slot"].to_numpy(), place] = best["score"].to_numpy()
    pairs = spark.createDataFrame(pa.table({
        "slot": best["slot"], "place": pa.array(place.astype(np.int32)), "anchor_id": pa.array(block.ids[best["slot"].to_numpy()]),
        "positive_id": best["id"], "positive_score": best["score"]}))
    found = best_of_block(rows, block, n_positives, lambda batches, b: negatives(batches, b, n_negatives, least, most))
    return (best_overall(found, n_negatives).join(F.broadcast(pairs), ["slot", "place"])
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


def relabelled(rows: DataFrame) -> DataFrame:
    """The labels that the query is stated on: where vec_id is divisible by 7, (label + 1) % 10."""
    label = F.col("label").cast("bigint")
    return rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))


NEGATIVES_SQL = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS q
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS alike, b.vec_id AS id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % {EVERY} = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE alike
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES})
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT alike
  AND {LEAST_PERCENT} * positive_score <= 100 * score AND 100 * score <= {MOST_PERCENT} * positive_score
QUALIFY rank <= {NEGATIVES}
"""


@query("op11_hard_negatives", NEGATIVES_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(relabelled(table(spark, sf_dir, "embeddings")))
