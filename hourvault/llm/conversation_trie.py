"""Trie of the prefixes of conversations, its subtree totals by time-forward processing."""

from __future__ import annotations

import hashlib
import heapq
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourvault.llm.common import stored
from hourvault.llm.registry import query, table

GROUP = 100
HEADS = 6
#: Nodes of a shard, on average: bounds a task's labels. Messages that a queue holds in memory, beyond which it spills.
SHARD_NODES = 1 << 17
QUEUE_ROWS = 1 << 17
#: Numbers of turns in a stretch, and ids in one text of a list of conversations.
STRETCH = 4096
LIST_IDS = 4096
BATCH = 1 << 14

RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def in_order(df: DataFrame, *keys: str, parts: int) -> DataFrame:
    """Rows in the order of the keys, over tasks and in each, with numbers `id` in that order. Stored rows are best: they are read twice."""
    return df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("id", F.monotonically_increasing_id())


def along(rows: DataFrame, stretch: Column, order: list, within: dict[str, Column], totals: dict[str, Column], before: dict[str, Column]) -> DataFrame:
    """Running values along conversations that are cut into stretches, so that a long one is dealt over tasks.

    `within` are running values in the stretch, `totals` those of a whole stretch, and `before` sums them up over the
    conversation's earlier stretches (columns of that name, null in the first one).
    """
    rows = rows.withColumn("_stretch", stretch)
    earlier = Window.partitionBy("conv_id").orderBy(F.col("_stretch").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    passed = (rows.groupBy("conv_id", "_stretch").agg(*[c.alias(n) for n, c in totals.items()])
              .withColumn("_stretches", F.count(F.lit(1)).over(whole)).withColumns({n: c.over(earlier) for n, c in before.items()})
              .filter("_stretches > 1").select("conv_id", "_stretch", *before))
    passed = passed.withColumnsRenamed({"conv_id": "_conv", "_stretch": "_part"})
    inside = Window.partitionBy("conv_id", "_stretch").orderBy(*order)
    rows = rows.join(passed, (rows["conv_id"] == passed["_conv"]) & rows["_stretch"].eqNullSafe(passed["_part"]), "left").drop("_conv", "_part")
    return rows.withColumns({n: c.over(inside) for n, c in within.items()})


def numbered_turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv_id, place (from 1 in the order of turns), digest of role and text, code points of the text."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    narrow = (turns.select(F.col(f"`{conv}`").cast("bigint").alias("conv_id"), F.col(f"`{turn}`").cast("bigint").alias("turn"),
                           F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
                           F.char_length(text).cast("bigint").alias("chars"))
              .filter("conv_id IS NOT NULL"))
    rows = along(narrow, F.floor(F.col("turn") / STRETCH), [F.col("turn").asc_nulls_first(), "digest"], {"_place": F.row_number()},
                 {"_n": F.count(F.lit(1))}, {"_before": F.sum("_n")})
    return stored(rows.select("conv_id", (F.col("_place") + F.coalesce("_before", F.lit(0))).cast("bigint").alias("place"), "digest", "chars"), "trie-turns")


def rebuilt_turns(turns: DataFrame, group: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, length) and their turns (conv_id, depth, digest, chars, length) as the trie takes them."""
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    convs = turns.groupBy("conv_id").agg(F.max("place").alias("n"))
    first = (turns.filter(F.col("place") < heads).groupBy("conv_id")
             .agg(F.sort_array(F.collect_list(F.struct("place", "digest", "chars"))).alias("turns")))
    convs = (convs.withColumn("h", head).withColumn("lender", F.col("conv_id") - F.col("conv_id") % group)
             .join(first.withColumnRenamed("conv_id", "lender"), "lender", "left")
             .withColumn("taken", F.coalesce(F.expr("slice(turns, 1, CAST(h AS INT))"), F.expr("slice(turns, 1, 0)")))
             .withColumn("m", F.greatest(F.coalesce(F.size("taken"), F.lit(0)), F.lit(0)).cast("bigint"))
             .withColumn("length", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
             .select("conv_id", "h", "m", "length", "taken"))
    convs = stored(convs, "trie-conversations")
    lent = convs.select("conv_id", F.explode("taken").alias("t"), "length").select(
        "conv_id", F.col("t.place").alias("depth"), "t.digest", "t.chars", "length")
    own = (turns.filter(F.col("place") > head).join(convs.select("conv_id", "h", "m", "length"), "conv_id")
           .select("conv_id", (F.col("place") - F.col("h") + F.col("m")).alias("depth"), "digest", "chars", "length"))
    return convs.select("conv_id", "length"), lent.union(own)


def prefixes(rows: DataFrame) -> DataFrame:
    """Each turn with the 128-bit key (a, b) of the turns up to it, and that of the turns before it (pa, pb).

    The key is the exclusive or of two hashes of each (depth, digest): a prefix is the set of these, so that keys can be
    made for each stretch of a conversation and put together.
    """
    rows = rows.withColumn("ha", F.xxhash64("depth", "digest")).withColumn("hb", F.xxhash64("digest", "depth", F.lit(1))).drop("digest")
    keys = {"a": "ha", "b": "hb"}
    rows = along(rows, F.floor(F.col("depth") / STRETCH), ["depth"], {f"_{k}": F.bit_xor(h) for k, h in keys.items()},
                 {f"_all_{k}": F.bit_xor(h) for k, h in keys.items()}, {f"_before_{k}": F.bit_xor(f"_all_{k}") for k in keys})
    zero = F.lit(0).cast("bigint")
    rows = rows.withColumns({k: F.col(f"_{k}").bitwiseXOR(F.coalesce(f"_before_{k}", zero)) for k in keys})
    return stored(rows.select("conv_id", "depth", "length", "chars", "a", "b", F.col("a").bitwiseXOR(F.col("ha")).alias("pa"),
                              F.col("b").bitwiseXOR(F.col("hb")).alias("pb")), "trie-prefixes")


def end_hashes(ends: DataFrame) -> DataFrame:
    """SHA-256 of the conversations that end at each node: a, b, depth, ends_sha256.

    Ids are joined to texts for each range of LIST_IDS ids; a node with one such text is hashed at once. The texts of
    the others go on in the order of their ids and are hashed in a row, as SHA-256 must be, without being held.
    """
    schema = "a bigint, b bigint, depth bigint, ends_sha256 string"

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha, out = None, None, []
        for batch in batches:
            for a, b, depth, ids in zip(*(batch.column(n).to_pylist() for n in ("a", "b", "depth", "ids")), strict=True):
                if node != (a, b, depth):
                    if node is not None:
                        out.append((*node, sha.hexdigest()))
                    node, sha = (a, b, depth), hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
        if node is not None:
            out.append((*node, sha.hexdigest()))
        if out:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                             names=["a", "b", "depth", "ends_sha256"])

    key = ["a", "b", "depth"]
    texts = stored(ends.groupBy(*key, F.floor(F.col("conv_id") / LIST_IDS).alias("range"))
                   .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")), "trie-ends")
    counted = texts.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("ids").alias("ids"))
    several = counted.filter("n > 1").select(*key)
    shared = texts.join(several, key, "left_semi").repartition(*key).sortWithinPartitions(*key, "range").mapInArrow(hashed, schema)
    return counted.filter("n = 1").select(*key, F.sha2(F.col("ids").cast("binary"), 256).alias("ends_sha256")).union(shared)


class SpillingQueue:
    """Priority queue of (order, id, leaves, saved): beyond `limit` messages, a sorted run goes to a private file of the task.

    Messages to one node are added up before they are written. The files have no name and go with the task.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self.heap: list[tuple[int, int, int, int]] = []
        self.heads: list[tuple[tuple[int, int, int, int], int, Iterator]] = []

    def push(self, message: tuple[int, int, int, int]) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            self.spill()

    def spill(self) -> None:
        rows = np.array(sorted(self.heap), np.int64)
        first = np.flatnonzero(np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]))
        rows = np.hstack([rows[first, :2], np.add.reduceat(rows[:, 2:], first)])
        run = tempfile.TemporaryFile()
        rows.tofile(run)
        run.seek(0)
        self.heap = []
        self.follow(len(self.heads), self.read(run))

    @staticmethod
    def read(run) -> Iterator[tuple[int, int, int, int]]:
        with run:
            while len(block := np.fromfile(run, np.int64, 4 * 1024)):
                yield from map(tuple, block.reshape(-1, 4).tolist())

    def follow(self, number: int, run: Iterator) -> None:
        head = next(run, None)
        if head is not None:
            heapq.heappush(self.heads, (head, number, run))

    def first(self) -> tuple[int, int] | None:
        """Order and id of the next message."""
        if self.heap and (not self.heads or self.heap[0] <= self.heads[0][0]):
            return self.heap[0][:2]
        return self.heads[0][0][:2] if self.heads else None

    def pop(self) -> tuple[int, int, int, int]:
        if self.heap and (not self.heads or self.heap[0] <= self.heads[0][0]):
            return heapq.heappop(self.heap)
        head, number, run = heapq.heappop(self.heads)
        self.follow(number, run)
        return head

    def pop_all(self, order: int, node: int) -> tuple[int, int]:
        """Sums of the messages to a node."""
        leaves = saved = 0
        while self.first() == (order, node):
            _, _, x, y = self.pop()
            leaves, saved = leaves + x, saved + y
        return leaves, saved


SENT = "shard bigint, id bigint, leaves bigint, saved bigint, inside boolean"


def shard_of(column: str | Column, tasks: int) -> Column:
    """The shard of a node: `tasks` tasks' share of the numbers that in_order gave."""
    return F.floor(F.shiftright(column, 33) / tasks)


def time_forward(rows: DataFrame, queue_rows: int) -> DataFrame:
    """Subtree totals of the nodes of each shard (inside), and what the shards' roots send to nodes of other shards.

    `rows`: shard, level, id, arrived (totals that came for the node from outside), parent, parent_level, leaves, saved.
    Nodes are sorted externally by reverse level; each takes the messages to it from the queue and sends its totals on,
    so that every message waits in the queue until its receiver's turn. Messages that no node of the shard takes are
    for other shards, one for each receiver.
    """
    fields = pa.schema([(n, pa.int64()) for n in ("shard", "id", "leaves", "saved")] + [("inside", pa.bool_())])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        queue, own, extra = SpillingQueue(queue_rows), None, (0, 0)

        def send_out(order: int | None, node: int | None) -> None:
            """Messages to nodes that the shard would have shown by now."""
            while (first := queue.first()) is not None and (order is None or first < (order, node)):
                out.append((own, first[1], *queue.pop_all(*first), False))

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("shard", "level", "id", "arrived", "parent", "parent_level", "leaves", "saved")]
            for shard, level, node, arrived, parent, parent_level, leaves, saved in zip(*columns, strict=True):
                if shard != own:
                    send_out(None, None)
                    own = shard
                if arrived:
                    extra = leaves, saved
                    continue
                send_out(-level, node)
                x, y = queue.pop_all(-level, node)
                leaves, saved, extra = leaves + x + extra[0], saved + y + extra[1], (0, 0)
                out.append((shard, node, leaves, saved, True))
                if parent is not None:
                    queue.push((-parent_level, parent, leaves, saved))
                if len(out) >= BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), fields, strict=True)], schema=fields)
                    out.clear()
        send_out(None, None)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), fields, strict=True)], schema=fields)

    ordered = rows.repartition("shard").sortWithinPartitions("shard", F.desc("level"), "id", F.desc("arrived"))
    return ordered.mapInArrow(over, SENT)


def outside_parents(nodes: DataFrame, tasks: int) -> DataFrame:
    """id, level, outside: the node of another shard under which the node's part of the shard hangs (null under none)."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = None, {}
        for batch in batches:
            out = []
            for node, parent in zip(batch.column("id").to_pylist(), batch.column("parent").to_pylist(), strict=True):
                if (node >> 33) // tasks != own:
                    own, known = (node >> 33) // tasks, {}
                known[node] = value = known[parent] if parent is not None and (parent >> 33) // tasks == own else parent
                out.append(value)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("level"), pa.array(out, pa.int64())], names=["id", "level", "outside"])

    ordered = nodes.select("shard", "id", "level", "parent").repartition("shard").sortWithinPartitions("shard", "level", "id").drop("shard")
    return ordered.mapInArrow(over, "id bigint, level bigint, outside bigint")


def subtree_totals(tree: DataFrame, n: int, shard_nodes: int = SHARD_NODES, queue_rows: int = QUEUE_ROWS, shards: int = 1) -> DataFrame:
    """id, leaves, saved: sums over the subtree of every node of a stored forest of n nodes.

    `tree`: id (from in_order), level, parent, parent_level, leaves, saved (own values); a parent's level is below its
    children's. The numbers are cut into at least `shards` shards of about `shard_nodes` nodes. Within shards by
    time_forward; what goes out of a shard under one outside parent is a node of a smaller tree, over which the same
    is done; its totals are then sent into the shards once more.
    """
    made = (tree.agg(F.max(F.shiftright("id", 33))).first()[0] or 0) + 1
    tasks = max(1, made // max(shards, -(-n // shard_nodes)))
    nodes = tree.select(shard_of("id", tasks).alias("shard"), "level", "id", F.lit(False).alias("arrived"), "parent", "parent_level", "leaves", "saved")
    sent = stored(time_forward(nodes, queue_rows), "trie-sent")
    outgoing = sent.filter("NOT inside")
    out = outgoing.count() if made > tasks else 0
    if not out:
        return sent.filter("inside").select("id", "leaves", "saved")
    marks = stored(outside_parents(nodes, tasks), "trie-marks")
    hung = stored(outgoing.join(marks.select(F.col("id").alias("_id"), "level", "outside"), outgoing["id"] == F.col("_id")).select(
        F.col("id").alias("under"), "shard", "level", F.col("outside").alias("above"), "leaves", "saved"), "trie-hung")
    # Half as many nodes at least, or else all in one shard, whose queue spills.
    most = shard_nodes if 2 * out <= n else out
    roots = stored(in_order(hung, "under", "shard", parts=-(-out // most)), "trie-roots")
    parents = roots.select(F.col("id").alias("parent"), F.col("under").alias("above"), F.col("shard").alias("_shard"), F.col("level").alias("parent_level"))
    smaller = stored(roots.withColumn("_shard", shard_of("under", tasks)).join(parents, ["above", "_shard"], "left")
                     .select("id", "level", "parent", "parent_level", "leaves", "saved"), "trie-smaller")
    totals = subtree_totals(smaller, out, most, queue_rows)
    arriving = (totals.join(roots.select("id", "under", "level"), "id").groupBy("under", "level")
                .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
                .select(shard_of("under", tasks).alias("shard"), "level", F.col("under").alias("id"), F.lit(True).alias("arrived"),
                        F.lit(None).cast("bigint").alias("parent"), F.lit(None).cast("bigint").alias("parent_level"), "leaves", "saved"))
    return time_forward(nodes.union(arriving), queue_rows).filter("inside").select("id", "leaves", "saved")


def conversation_trie(turns: DataFrame, group: int = GROUP, heads: int = HEADS, shard_nodes: int = SHARD_NODES, queue_rows: int = QUEUE_ROWS,
                      conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """The trie of rebuilt conversations: one row for each distinct prefix (RESULT).

    Turns are ordered by `turn`, null first, ties by the SHA-256 of length of role, role and text. Conversation c begins
    with the first h turns of conversation c - c % `group` (all if fewer, none if there is none) and goes on with its own
    turns after its first h; h is crc32(c) % `heads`. A node is a distinct sequence of first turns; the root has none.

    Prefixes are compared by 128-bit keys. A long conversation is cut into stretches of STRETCH turn numbers; equal
    prefixes are counted before they are shuffled. Subtree totals are passed up by time-forward
    processing in shards of about `shard_nodes` nodes, then over the shards' roots.

    Null roles and texts are empty; rows with a null conv_id belong to no conversation and are left out. Repeated rows
    are turns of their own. An empty table has no nodes, not even a root. Other columns are not read.
    """
    spark = turns.sparkSession
    convs, rebuilt = rebuilt_turns(numbered_turns(turns, conv_column, turn_column, role_column, text_column), group, heads)
    rows = prefixes(rebuilt)
    zero = F.lit(0).cast("bigint")
    none = F.lit(None).cast("bigint")
    root = (convs.groupBy(zero.alias("a"), zero.alias("b"), zero.alias("depth"))
            .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), zero.alias("chars"), none.alias("pa"), none.alias("pb")))
    counted = rows.groupBy("a", "b", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"), F.max("pa").alias("pa"), F.max("pb").alias("pb"))
    ends = (rows.filter("depth = length").select("a", "b", "depth", "conv_id")
            .union(convs.filter("length = 0").select(zero.alias("a"), zero.alias("b"), zero.alias("depth"), "conv_id")))
    found = stored(root.union(counted).join(end_hashes(ends), ["a", "b", "depth"], "left"), "trie-found")
    n = found.count()
    kids = found.filter("depth > 0").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"))
    shards = spark.sparkContext.defaultParallelism
    nodes = stored(in_order(found, "conv_id", "depth", parts=max(shards, -(-n // shard_nodes))).join(kids, ["a", "b", "depth"], "left"), "trie-nodes")
    above = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), (F.col("depth") + 1).alias("depth"), F.col("id").alias("parent"),
                         F.col("conv_id").alias("parent_conv_id"))
    tree = stored(nodes.drop("a", "b").join(above, ["pa", "pb", "depth"], "left").withColumn("n_children", F.coalesce("n_children", zero))
                  .select("id", F.col("depth").alias("level"), "parent", (F.col("depth") - 1).alias("parent_level"),
                          F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("leaves"),
                          ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
                          "conv_id", "parent_conv_id", "n_convs", "n_children", "ends_sha256"), "trie-tree")
    totals = subtree_totals(tree.select("id", "level", "parent", "parent_level", "leaves", "saved"), n, shard_nodes, queue_rows, shards)
    return (tree.drop("leaves", "saved").join(totals, "id")
            .select("conv_id", F.col("level").alias("depth"), "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
                    F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256")))


TRIE_SQL = f"""
WITH RECURSIVE bits AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b::BIGINT, range(8)),
           lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t),
o AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) AS place
      FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, conv_id - conv_id % {GROUP} AS lender, xor(list_reduce(list_prepend(4294967295::BIGINT,
             list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ord(d)::BIGINT)),
           lambda x, b: xor(x >> 8, t[1 + (xor(x, b) & 255)])), 4294967295) % {HEADS} AS h FROM (SELECT DISTINCT conv_id FROM o), bits),
r AS (SELECT c.conv_id, place, role, text FROM c JOIN o ON o.conv_id = lender AND place <= h
      UNION ALL SELECT conv_id, place + {HEADS}, role, text FROM c JOIN o USING (conv_id) WHERE place > h),
t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth, count(*) OVER (PARTITION BY conv_id) AS n, role, text FROM r),
p AS (SELECT conv_id, 0::BIGINT AS depth, coalesce((SELECT max(n) FROM t WHERE t.conv_id = c.conv_id), 0) AS n, '' AS key, CAST(NULL AS VARCHAR) AS up, 0::BIGINT AS chars FROM c
      UNION ALL SELECT t.conv_id, t.depth, t.n, sha256(key || strlen(role) || ':' || role || text), key, length(text)
      FROM p JOIN t ON t.conv_id = p.conv_id AND t.depth = p.depth + 1),
e AS (SELECT key, min(conv_id) AS conv_id, depth, count(*) AS n_convs, any_value(up) AS up, any_value(chars) AS chars,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = n), '')) AS ends_sha256 FROM p GROUP BY key, depth),
below AS (SELECT DISTINCT x.key AS top, y.key FROM p x JOIN p y ON x.conv_id = y.conv_id AND y.depth >= x.depth),
kids AS (SELECT up AS key, count(*) AS n_children FROM e GROUP BY up)
SELECT e.conv_id, e.depth, u.conv_id AS parent_conv_id, e.n_convs, coalesce(k.n_children, 0) AS n_children,
       (SELECT count(*) FROM below b LEFT JOIN kids ON kids.key = b.key WHERE b.top = e.key AND kids.key IS NULL) AS n_leaves,
       (SELECT CAST(sum((x.n_convs - 1) * x.chars) AS BIGINT) FROM below b JOIN e x ON x.key = b.key WHERE b.top = e.key) AS saved_tokens,
       e.ends_sha256
FROM e LEFT JOIN e u ON u.key = e.up LEFT JOIN kids k ON k.key = e.key
"""


@query("op12_conversation_trie", TRIE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))
