"""Near-duplicate documents by fast similarity sketches, banding and exact verification."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourvault.llm.common import WordHashes, map_rows, mix, stored, texts
from hourvault.llm.registry import query, table

SHINGLE_WORDS = 5
PERCENT = 80
BANDS = 32
BAND_ROWS = 5
#: Bytes of sets in one unit of work, of documents apart from a bucket's main group and of those they are held against.
APART_BYTES = 4 << 20
AGAINST_BYTES = 16 << 20
#: Documents in it, on the two sides: short sets would make many comparisons out of few bytes.
APART_ROWS = 1 << 10
AGAINST_ROWS = 1 << 11

SKETCHED = "n_shingles bigint, set_key binary, bands array<bigint>"
_MAX = np.uint64(0xFFFFFFFFFFFFFFFF)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(words: list[bytes], size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of runs of `size` words; of the whole text if it has fewer, none if it has none."""
    if not words:
        return np.zeros(0, np.uint64)
    own = hashes.of(words)
    size = min(size, len(words))
    h = np.full(len(own) - size + 1, size, np.uint64)
    for k in range(size):
        h = mix(h * _MULTIPLIER + own[k:len(own) - size + 1 + k])
    return np.unique(h)


def sketch(shingles: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """Fast similarity sketch with `size` coordinates of a set that isn't empty.

    Round i < size throws every element into a bin with a value in [i, i + 1); a bin keeps its least value. Two
    sketches agree in a coordinate with the probability of the sets' similarity, with the concentration of sampling
    without replacement. Rounds size + j, for bins that are still empty, put all elements into bin j, so that every
    coordinate fills. Values of later rounds never replace those of earlier ones, so rounds can run in blocks.
    """
    out = np.full(size, _MAX)
    n, i = len(shingles), 0
    low = np.uint64((1 << 48) - 1)
    while i < size and (out == _MAX).any():
        rounds = np.arange(i, min(size, i + max(1, 2048 // n)), dtype=np.uint64)
        h = mix(shingles[None, :] ^ mix((rounds + np.uint64(seed)) * _MULTIPLIER)[:, None])
        bins = ((h >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
        np.minimum.at(out, bins.ravel().astype(np.int64), ((rounds[:, None] << np.uint64(48)) | (h & low)).ravel())
        i += len(rounds)
    for j in np.flatnonzero(out == _MAX):
        h = mix(shingles ^ mix(np.array([size + j + seed], np.uint64) * _MULTIPLIER))
        out[j] = (np.uint64(size + j) << np.uint64(48)) | (h & low).min()
    return out


def sketched(docs: DataFrame, shingle_words: int) -> DataFrame:
    """Set size, 128-bit key of the set and hashes of its sketch's bands in place of each row's text; no shuffle."""
    hashes = WordHashes()
    others = [f for f in docs.schema.fields if f.name != "text"]
    schema = T.StructType([*others, *T._parse_datatype_string(SKETCHED).fields])

    def run(batch: pa.RecordBatch) -> dict:
        sizes, keys, bands = [], [], []
        for text in texts(batch, "text"):
            found = shingle_hashes(text.lower().split(), shingle_words, hashes)
            sizes.append(len(found))
            if not len(found):
                keys.append(None)
                bands.append(None)
                continue
            keys.append(xxhash.xxh3_128_digest(found.tobytes()))
            rows = sketch(found, BANDS * BAND_ROWS).tobytes()
            width = 8 * BAND_ROWS
            bands.append([xxhash.xxh3_64_intdigest(rows[k * width:(k + 1) * width], k + 1) - (1 << 63) for k in range(BANDS)])
        return {f.name: batch.column(f.name) for f in others} | {"n_shingles": sizes, "set_key": keys, "bands": bands}

    return map_rows(docs, run, schema)


def full_sets(docs: DataFrame, wanted: DataFrame, shingle_words: int, repeated: bool) -> DataFrame:
    """The shingle sets of wanted classes (class, rep, set_key), made again from the text of a row with id `rep`: id, shingles."""
    hashes = WordHashes()

    def sets(batch: pa.RecordBatch) -> dict:
        keys, out, kept = batch.column("set_key").to_pylist(), [], []
        for key, text in zip(keys, texts(batch, "text"), strict=True):
            found = shingle_hashes(text.lower().split(), shingle_words, hashes).tobytes()
            # Another row of a repeated id may hold another text.
            kept.append(not repeated or xxhash.xxh3_128_digest(found) == key)
            if kept[-1]:
                out.append(found)
        return {"id": batch.column("class").filter(pa.array(kept, pa.bool_())), "shingles": out}

    rows = docs.join(wanted, docs.doc_id == wanted.rep).select("class", "set_key", "text")
    found = map_rows(rows, sets, "id bigint, shingles binary")
    return stored(found.dropDuplicates(["id"]) if repeated else found, "near-sets")


def verified(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) of classes, those whose full sets are similar enough."""
    def check(batch: pa.RecordBatch) -> dict:
        left, right = (batch.column(c).cast(pa.large_binary()) for c in ("left_set", "right_set"))
        keep = pa.array([similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                         for x, y in zip(left, right, strict=True)], pa.bool_())
        return {c: batch.column(c).filter(keep) for c in ("a", "b")}

    # The right set travels with the pair; the left one, the first of its bucket, is joined last and isn't repeated.
    both = (pairs.join(full.select(F.col("id").alias("b"), F.col("shingles").alias("right_set")), "b")
            .join(full.select(F.col("id").alias("a"), F.col("shingles").alias("left_set")), "a"))
    return map_rows(both.select("a", "b", "left_set", "right_set"), check, "a bigint, b bigint")


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    union = len(np.union1d(x, y))
    return 100 * (len(x) + len(y) - union) >= percent * union


def bitmaps(sets: list[np.ndarray], width: int) -> np.ndarray:
    """One bit for each shingle's hash modulo `width` (a power of two)."""
    out = np.zeros((len(sets), width), bool)
    for k, x in enumerate(sets):
        out[k, (x & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(out, axis=1).view(np.uint64)


def linked_apart(ids: list[int], groups: list[int], sets: list[np.ndarray], other_ids: list[int], other_groups: list[int],
                 others: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between two lists of sets, one for each document of the first list and group of the second.

    A bit set on one side only stands for a shingle that the other side lacks, so bitmaps bound the intersection
    from above; only pairs that pass the bound are held against each other in full.
    """
    sizes, other_sizes = (np.array([len(x) for x in y], np.int64) for y in (sets, others))
    width = 1 << max(11, int(16 * sizes.max()).bit_length())
    width = min(width, 1 << 16)
    # In slices, so that the bitmaps of many large sets never stand in memory at once.
    step = max(1, (32 << 20) // width)
    found = []
    for low in range(0, len(others), step):
        right = bitmaps(others[low:low + step], width)
        for k, x in enumerate(sets):
            left = bitmaps([x], width)
            m = other_sizes[low:low + step]
            lacking = np.bitwise_count(left & ~right).sum(axis=1, dtype=np.int64)
            extra = np.bitwise_count(right & ~left).sum(axis=1, dtype=np.int64)
            common = np.minimum(sizes[k] - lacking, m - extra)
            done = {groups[k]}
            for j in np.flatnonzero(100 * common >= percent * (sizes[k] + m - common)) + low:
                if other_groups[j] not in done and similar(x, others[j], percent):
                    done.add(other_groups[j])
                    found.append((ids[k], other_ids[j]))
    return found


def links_apart(members: DataFrame, labels: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Links between members of one bucket that stand in different groups so far.

    In each bucket, documents outside the group with the most members are held against all members of other groups,
    in units of bounded size that are dealt over the tasks: no pairs are made as rows.
    """
    grouped = (members.join(labels.select(F.col("id").alias("class"), "component"), "class", "left")
               .select("bucket", "class", "size", F.coalesce("component", "class").alias("component")))
    shares = grouped.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    mixed = (shares.groupBy("bucket").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("n"),
                                          F.sum("size").alias("all_size"), F.max(F.struct("n", "component", "size")).alias("top"),
                                          F.count(F.lit(1)).alias("groups"))
             .filter("groups > 1 AND n > 2")
             .select("bucket", "main",
                     F.ceil(F.greatest((F.col("all_size") - F.col("top.size")) * 8 / APART_BYTES, (F.col("n") - F.col("top.n")) / APART_ROWS))
                     .cast("int").alias("blocks"),
                     F.ceil(F.greatest(F.col("all_size") * 8 / AGAINST_BYTES, F.col("n") / AGAINST_ROWS)).cast("int").alias("chunks")))
    rows = grouped.join(mixed, "bucket")
    share = lambda n: F.pmod(F.xxhash64("class"), F.col(n)).cast("int")
    apart = rows.filter("component <> main").withColumn("against", F.lit(False)).withColumn("block", share("blocks")).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    against = rows.withColumn("against", F.lit(True)).withColumn("chunk", share("chunks")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    names = ["bucket", "block", "chunk", "against", "class", "component"]
    units = apart.select(*names).union(against.select(*names)).join(full.withColumnRenamed("id", "class"), "class")
    units = units.repartition(F.col("bucket"), F.col("block"), F.col("chunk")).sortWithinPartitions("bucket", "block", "chunk", "against")
    schema = "a bigint, b bigint"
    fields = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def over(batches):
        links: list[tuple[int, int]] = []

        def close():
            (a, b, c), (d, e, f) = sides
            if a and d:
                links.extend(linked_apart(a, b, c, d, e, f, percent))

        key, sides = None, (([], [], []), ([], [], []))
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in (*names, "shingles")]
            for bucket, block, chunk, is_against, rep, component, data in zip(*columns, strict=True):
                if key != (bucket, block, chunk):
                    close()
                    key, sides = (bucket, block, chunk), (([], [], []), ([], [], []))
                for to, value in zip(sides[is_against], (rep, component, np.frombuffer(data, np.uint64)), strict=True):
                    to.append(value)
            if len(links) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links, strict=True)], schema=fields)
                links.clear()
        close()
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links, strict=True)], schema=fields)

    return units.select(*names, "shingles").mapInArrow(over, schema)


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """The smallest id that each linked id reaches: columns id, component.

    Every round sends the smallest neighbouring label over the links (aggregated before it is shuffled), then jumps
    to the label's own label. Rounds follow the logarithm of a component's width; each is written, so nothing is
    recomputed after a loss.
    """
    ends = stored(links.select(F.col("a").alias("u"), F.col("b").alias("v"))
                  .union(links.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct(), label)
    labels = stored(ends.groupBy("u").agg(F.min("v").alias("low")).select(
        F.col("u").alias("id"), F.least("u", "low").alias("component")), label)
    while True:
        near = (ends.join(labels.select(F.col("id").alias("u"), "component"), "u")
                .groupBy("v").agg(F.min("component").alias("near")).withColumnRenamed("v", "id"))
        hop = labels.join(near, "id", "left").select("id", F.col("component").alias("old"), F.least("component", "near").alias("to"))
        jump = labels.select(F.col("id").alias("to"), F.col("component").alias("beyond"))
        new = stored(hop.join(jump, "to", "left").select("id", "old", F.least("to", "beyond").alias("component")), label)
        changed = new.filter("component <> old").limit(1).count()
        labels = new.select("id", "component")
        if not changed:
            return labels


def grouped(rows: DataFrame, shingle_words: int, percent: int) -> tuple[DataFrame, bool]:
    """Each row (doc_id, text, and what else it has but the text) with n_shingles, component_id, kept and `component`, the number of
    its group (null without a set); and whether an id stands in several rows.

    Nodes are classes of equal sets, not ids: rows of one id with different sets are in different classes.
    """
    marks = stored(sketched(rows, shingle_words), "near-sketches")
    repeated = marks.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").limit(1).count() > 0
    classes = stored(
        marks.filter("set_key IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_key")
        .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("members"), F.first("n_shingles").alias("size"), F.first("bands").alias("bands"))
        .withColumn("class", F.monotonically_increasing_id()),
        "near-classes")
    entries = classes.select("class", "size", F.explode("bands").alias("bucket"))
    crowded = (entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("class", "size")).alias("first")).filter("n > 1"))
    members = stored(entries.join(crowded, "bucket").select("bucket", "class", "size", "first"), "near-buckets")
    # The sizes alone rule out a pair.
    pairs = stored(members.filter(F.col("class") != F.col("first.class"))
                   .filter(100 * F.least("size", "first.size") >= percent * F.greatest("size", "first.size"))
                   .select(F.col("first.class").alias("a"), F.col("class").alias("b")).distinct(), "near-pairs")
    wanted = members.select("class").distinct().join(classes.select("class", "rep", "set_key"), "class")
    full = full_sets(rows, wanted, shingle_words, repeated)
    links = stored(verified(pairs, full, percent), "near-links")
    labels = components(links)
    links = stored(links.union(links_apart(members, labels, full, percent)), "near-links")
    labels = stored(components(links).join(classes.select(F.col("class").alias("id"), "rep"), "id"), "near-labels")
    low = labels.groupBy("component").agg(F.min("rep").alias("low"))
    spread = (classes.select("set_key", "class", "rep", "members")
              .join(labels.join(low, "component").select(F.col("id").alias("class"), "component", "low"), "class", "left")
              .filter("members > 1 OR component IS NOT NULL")
              .select("set_key", F.coalesce("low", "rep").alias("low"), F.coalesce("component", "class").alias("component")))
    # Documents alone in class and group need no partner: only the others stand on the right side.
    found = (marks.drop("bands").join(spread, "set_key", "left")
             .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("low", "doc_id"))).drop("low")
             .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
    return found, repeated


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT,
                    id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The group of near copies that each document belongs to: doc_id, n_shingles, component_id, kept.

    A document's set holds its distinct runs of `shingle_words` words, ASCII letters in lower case; a shorter text is
    one run. Sets with an intersection of `percent` of their union are linked, and a group is what links reach.
    Documents with equal sets form a class, joined by the key of the set and never by pairs. One document of each
    class is sketched into buckets, one for each band of the sketch; two sets at the threshold miss each other in all
    buckets with a probability of 3e-6. Members of a bucket are compared with its first member on full sets; where
    members are then in different groups, those outside the main one are compared with all others.

    Null and empty texts have no set and are linked with nothing. Repeated rows get a row each, and rows of one id with
    different texts are documents of their own. A row with a null id cannot be linked: its component is null and it is
    kept. Other columns are not read.
    """
    rows = docs.selectExpr(f"CAST(`{id_column}` AS BIGINT) AS doc_id", f"`{text_column}` AS text")
    return grouped(rows, shingle_words, percent)[0].select("doc_id", "n_shingles", "component_id", "kept")


def without_near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT,
                            id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One document of each group, that with the smallest id, in the columns of `docs`; rows without an id stay.

    Rows are told apart by id and text: of unlike texts under one id each stays, of repeated rows one.
    """
    text_key = F.md5(F.coalesce(F.col(f"`{text_column}`"), F.lit("")))
    rows = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.col(f"`{text_column}`").alias("text"), text_key.alias("text_key"))
    found, repeated = grouped(rows, shingle_words, percent)
    kept = found.filter("kept AND doc_id IS NOT NULL")
    own_id = F.col(f"`{id_column}`").cast("bigint")
    if not repeated:
        kept = kept.select(F.col("doc_id").alias("_near_id"))
        out = docs.join(kept, own_id == kept["_near_id"], "left_semi")
    else:
        # A group keeps one row of its smallest id; an empty text has no group, its rows are one.
        kept = (kept.groupBy("doc_id", "component").agg(F.min("text_key").alias("_near_key"))
                .select(F.col("doc_id").alias("_near_id"), "_near_key").distinct())
        marked = docs.withColumn("_near_own", text_key)
        out = (marked.join(kept, (own_id == kept["_near_id"]) & (marked["_near_own"] == kept["_near_key"]), "left_semi")
               .dropDuplicates([id_column, "_near_own"]).drop("_near_own"))
    return out.union(docs.filter(docs[f"`{id_column}`"].isNull()))


NEAR_SQL = """
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws
           FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 1 THEN [ws[1]]
        ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
e AS (SELECT a AS u, b AS v FROM l UNION SELECT b, a FROM l),
r AS (SELECT DISTINCT u AS id, u AS x FROM e UNION SELECT r.id, e.v FROM r JOIN e ON e.u = r.x),
m AS (SELECT id, min(x) AS low FROM r GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(low, d.doc_id) AS component_id,
       coalesce(low, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.id = d.doc_id
"""


@query("op2_near_duplicates", NEAR_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2)
