"""Benchmark decontamination with suffix arrays over shards of the training text."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourvault.llm.common import arrow_schema, map_rows, stored, texts
from hourvault.llm.registry import query, table

#: Lower-cases A-Z and turns every ASCII byte that is neither letter nor digit into a space.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
WINDOW = 10
#: Words of training text in one suffix array; bounds a task's memory.
SHARD_WORDS = 1_000_000
#: Bytes of benchmark text that are sent to the tasks at a time; a larger benchmark takes several passes.
BLOCK_BYTES = 32 << 20

RESULT = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, longest_match bigint"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


@dataclass
class Tests:
    """A block of test items as numbers: every suffix of every item, cut to the words that items hold."""

    vocabulary: dict[bytes, int]
    words: np.ndarray  # all items' words in a row, numbers from 1
    starts: np.ndarray  # of suffixes that are looked up
    lengths: np.ndarray  # words from there to the item's end
    needed: np.ndarray  # words of the item's window
    item: np.ndarray
    ids: list[str]

    @staticmethod
    def of(rows: list[tuple[str, bytes]], window: int = WINDOW) -> Tests:
        vocabulary: dict[bytes, int] = {}
        words, starts, lengths, needed, item = [], [], [], [], []
        for k, (_, text) in enumerate(rows):
            own = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
            size = min(window, len(own))
            for i in range(len(own) - size + 1 if own else 0):
                starts.append(len(words) + i)
                lengths.append(len(own) - i)
                needed.append(size)
                item.append(k)
            words += own
        return Tests(vocabulary, *(np.array(x, np.int64) for x in (words, starts, lengths, needed, item)), [i for i, _ in rows])


def suffix_array(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The positions `at` in the order of the text from there on, compared over `depth` words or more.

    `words` ends every text with a 0; ranks of all positions are doubled in reach until they cover the depth or differ.
    """
    rank, reach = words.astype(np.int64), 1
    while reach < depth:
        ahead = np.concatenate([rank[reach:], np.zeros(min(reach, len(rank)), np.int64)])
        key = rank * (int(rank.max(initial=0)) + 1) + ahead
        new = np.unique(key, return_inverse=True)[1].astype(np.int64)
        reach *= 2
        done = new.max(initial=0) == rank.max(initial=0) and reach > 2
        rank = new
        if done:
            break
    return at[np.argsort(rank[at], kind="stable")]


def compare(words: np.ndarray, left: np.ndarray, tests: Tests, which: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Common words of text at `left` and test suffixes `which`, up to `limit` of them, and whether the text is smaller."""
    common = np.zeros(len(left), np.int64)
    less = np.zeros(len(left), bool)
    going = np.arange(len(left))
    while len(going):
        going = going[common[going] < limit[going]]
        a = words[left[going] + common[going]]
        b = tests.words[tests.starts[which[going]] + common[going]]
        less[going[a < b]] = True
        going = going[a == b]
        common[going] += 1
    return common, less


def search(words: np.ndarray, order: np.ndarray, tests: Tests, which: np.ndarray, limit: np.ndarray, upper: bool) -> np.ndarray:
    """Binary search of many test suffixes at once; first place whose text isn't smaller, or with `upper` is larger."""
    low, high = np.zeros(len(which), np.int64), np.full(len(which), len(order), np.int64)
    while len(open_ := np.flatnonzero(low < high)):
        middle = (low[open_] + high[open_]) // 2
        common, less = compare(words, order[middle], tests, which[open_], limit[open_])
        right = less | (upper & (common == limit[open_]))
        low[open_[right]] = middle[right] + 1
        high[open_[~right]] = middle[~right]
    return low


def matches(texts_words: list[list[bytes]], tests: Tests) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Looks up every test suffix in the suffix array of a shard of texts.

    Returns the hit flag per word of the shard (each text followed by one place for its end), and per occurrence of a
    window its place, its item and the longest match from there.
    """
    look = tests.vocabulary.get
    coded = [look(w, 0) for words in texts_words for w in (*words, b"\n")]
    words = np.array(coded, np.int64)
    hit = np.zeros(len(words), bool)
    nothing = np.zeros(0, np.int64)
    if not len(tests.starts) or not len(words):
        return hit, nothing, nothing, nothing, nothing
    # Words that no item holds are 0 and end a match: suffixes shorter than the shortest window can't hold one.
    run = np.flatnonzero(words == 0)
    ahead = run[np.searchsorted(run, np.arange(len(words)))] - np.arange(len(words))
    at = np.flatnonzero(ahead >= tests.needed.min())
    if not len(at):
        return hit, nothing, nothing, nothing, nothing
    order = suffix_array(words, at, int(min(tests.lengths.max(), ahead.max())))
    words = np.append(words, 0)
    every = np.arange(len(tests.starts))
    low = search(words, order, tests, every, tests.needed, False)
    found = low < len(order)
    common = np.zeros(len(every), np.int64)
    common[found] = compare(words, order[low[found]], tests, every[found], tests.needed[found])[0]
    every = every[common >= tests.needed]
    if not len(every):
        return hit, nothing, nothing, nothing, nothing
    high = search(words, order, tests, every, tests.needed[every], True)
    low = low[every]
    times = high - low
    which = np.repeat(every, times)
    place = order[np.repeat(low - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum())]
    edge = np.zeros(len(hit) + 1, np.int64)
    np.add.at(edge, place, 1)
    np.add.at(edge, place + tests.needed[which], -1)
    longest = compare(words, place, tests, which, tests.lengths[which])[0]
    return np.cumsum(edge)[:-1] > 0, place, tests.item[which], longest, tests.starts[which]


def _blocks(spark: SparkSession, benchmark: DataFrame, item_column: str, text_column: str, block_bytes: int):
    """The benchmark in blocks of about `block_bytes`, chosen by a hash of the item, each broadcast on its own."""
    items = benchmark.select(F.col(item_column).cast("string").alias("item"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-int(total) // block_bytes))
    for k in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).collect()
        yield k + 1 == n, spark.sparkContext.broadcast(Tests.of([(r.item or "", r.text.encode()) for r in rows]))


def _with_matches(docs: DataFrame, text_column: str, tests, shard_words: int) -> DataFrame:
    """Adds to `_hits` (one bit per word), `_items` and `_longest` what a block of tests finds."""
    schema = docs.schema
    fields = arrow_schema(schema)

    def flush(parts: list[pa.RecordBatch], own: list[list[bytes]]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        hit, place, item, longest, _ = matches(own, tests.value)
        ends = np.cumsum([len(w) + 1 for w in own])
        begins = np.concatenate([[0], ends[:-1]])
        doc = np.searchsorted(ends, place, side="right")
        found: dict[int, set[str]] = {}
        reach: dict[int, int] = {}
        for d, i, n in zip(doc.tolist(), item.tolist(), longest.tolist(), strict=True):
            found.setdefault(d, set()).add(tests.value.ids[i])
            reach[d] = max(reach.get(d, 0), n)
        hits, items, far = (whole.column(n).to_pylist() for n in ("_hits", "_items", "_longest"))
        for d in found:
            bits = hit[begins[d]:ends[d] - 1]
            if hits[d]:
                bits = bits | np.unpackbits(np.frombuffer(hits[d], np.uint8), count=len(bits)).astype(bool)
            hits[d], items[d], far[d] = np.packbits(bits).tobytes(), sorted(found[d].union(items[d] or ())), max(far[d] or 0, reach[d])
        new = {"_hits": hits, "_items": items, "_longest": far}
        return pa.RecordBatch.from_arrays(
            [pa.array(new[f.name], f.type) if f.name in new else whole.column(f.name).cast(f.type) for f in fields], schema=fields)

    def over(batches):
        parts, own, size = [], [], 0
        for batch in batches:
            column = texts(batch, text_column)
            begin = 0
            for k, text in enumerate(column):
                words = words_of(text)
                own.append(words)
                size += len(words) + 1
                if size >= shard_words:
                    parts.append(batch.slice(begin, k + 1 - begin))
                    yield flush(parts, own)
                    parts, own, size, begin = [], [], 0, k + 1
            if begin < batch.num_rows:
                parts.append(batch.slice(begin))
        if parts:
            yield flush(parts, own)

    return docs.mapInArrow(over, schema)


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id",
                      item_text_column: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Adds `_hits` (bits of words in matches), `_items` (item ids as text) and `_longest` (words of the longest
    verbatim match) to the rows of `docs`; all null where nothing matches.

    Every task cuts its rows into shards of `shard_words`, sorts the suffixes of a shard that can hold a match, and
    binary-searches every suffix of every item in it. Nothing is shuffled. The benchmark goes out in blocks of bounded
    size; with more than one block, the rows are stored between passes.
    """
    spark = docs.sparkSession
    out = docs.withColumns({"_hits": F.lit(None).cast("binary"), "_items": F.lit(None).cast("array<string>"),
                            "_longest": F.lit(None).cast("bigint")})
    for last, tests in _blocks(spark, benchmark, item_column, item_text_column, block_bytes):
        out = _with_matches(out, text_column, tests, shard_words)
        if not last:
            out = stored(out, "decontaminate")
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """Words of each document that stand in a benchmark window, and the items.

    A window is ten consecutive words of an item, or the whole of a shorter one. Null and empty texts have no words
    and no hits; items without words match nothing; repeated rows get a row each; null ids stay null. An empty
    benchmark leaves every document clean.
    """
    rows = docs.selectExpr(f"`{id_column}` AS doc_id", f"`{text_column}` AS text")

    def run(batch: pa.RecordBatch) -> dict:
        hits, items = batch.column("_hits").to_pylist(), [x or [] for x in batch.column("_items").to_pylist()]
        n_hit = [int(np.unpackbits(np.frombuffer(h, np.uint8)).sum()) if h else 0 for h in hits]
        return {"doc_id": batch.column("doc_id"), "n_words": [len(words_of(t)) for t in texts(batch, "text")], "n_hit": n_hit,
                "n_items": [len(x) for x in items], "items_sha256": [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items],
                "contaminated": [n > 0 for n in n_hit], "longest_match": [x or 0 for x in batch.column("_longest").to_pylist()]}

    return map_rows(benchmark_matches(rows, benchmark, **options), run, RESULT)


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """The rows of `docs` without any benchmark window, in their own columns."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_column}`").alias("text"))
    kept = benchmark_matches(packed, benchmark, **options).filter("_items IS NULL")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
CONTAMINATION_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{WORD}') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{WORD}') AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, size, array_to_string(ws[i:i + size - 1], ' ') AS k
        FROM (SELECT item_id, ws, least(len(ws), {WINDOW}) AS size, unnest(range(1, len(ws) - least(len(ws), {WINDOW}) + 2)) AS i
              FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
dw AS (SELECT r, size, i, array_to_string(ws[i:i + size - 1], ' ') AS k
       FROM (SELECT r, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM d, sizes WHERE len(ws) >= size)),
m AS (SELECT r, i, dw.size, item_id FROM dw JOIN win USING (size, k)),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS p FROM m) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
        FROM (SELECT DISTINCT r, item_id::VARCHAR AS x FROM m) GROUP BY r)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN its USING (r)
"""


@query("op9_benchmark_contamination", CONTAMINATION_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("longest_match")
