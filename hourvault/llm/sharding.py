"""Proportional stratified interleaving of documents into shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourvault.llm.common import positions, stored
from hourvault.llm.registry import query, table


def _numbered(df: DataFrame, order: list[str], label: str) -> DataFrame:
    """Rows in a total order over all tasks, with _mid growing along it."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                  .withColumn("_mid", F.monotonically_increasing_id()), label)


def interleaved_shards(docs: DataFrame, shards: int = 16, seed: str = "mix-1", id_column: str = "doc_id",
                       text_column: str = "text", source_column: str = "source") -> DataFrame:
    """Deal documents into shards of row counts at most one apart, each with the mixture of sources of the whole.

    Rows of a source are shuffled by a seeded hash of the id and ranked; row r of n gets the place (r - 1/2) / n on
    the unit line. Sorted by place, the sources interleave in proportion, and the line is cut into `shards` pieces of
    equal row counts. Returns doc_id, size (UTF-8 bytes + 1), text_crc32, law ('rows'), shard, slot (from 0, in order
    of place) and grown_shard (null: this law moves rows when shards are added), then source and place.

    Ranks and cuts come from two range-partitioned sorts of narrow rows: a source with a third of all rows is spread
    over many tasks, since its rows sort by hash. Only one row count per task meets in a window.

    Null text is empty (size 1), null source is a source of its own, rows with a null or repeated id are placed like
    any other; rows that tie in everything are interchangeable. An empty table gives no rows, other columns are not
    read. Copies of a text are rows like all others and may lie in different shards.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))).cast("binary")).alias("_draw"))
    draws = _numbered(rows, ["source", "_draw", "text_crc32", "size"], "shard-draws")
    # A task holds consecutive rows of a source: the first number among them gives the rank.
    starts = positions(draws, ["source"]).withColumnRenamed("source", "_source").withColumnRenamed("_task", "_t")
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.shiftright("_mid", 33) == F.col("_t"))
    rank = F.col("_before") + F.col("_mid") - F.col("_first") + 1
    placed = draws.join(starts, same).select(
        "doc_id", "source", "size", "text_crc32", "_draw",
        ((2 * rank - 1).cast("double") / (2 * F.col("_total")).cast("double")).alias("place"))
    line = _numbered(placed, ["place", "source", "_draw", "text_crc32", "size"], "shard-line")
    cuts = positions(line, [])
    at = F.col("_before") + F.col("_mid") - F.col("_first")
    shard = F.expr(f"(_at * {shards} + {shards} - 1) div _total")
    return (line.withColumn("_task", F.shiftright("_mid", 33)).join(cuts, "_task").withColumn("_at", at)
            .withColumn("_shard", shard)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("_shard").cast("int").alias("shard"),
                    (F.col("_at") - F.expr(f"(_shard * _total) div {shards}")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "source", "place"))


CRC_SQL = """
bits AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b::BIGINT, range(8)),
           lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t),
crcs AS (SELECT doc_id AS crc_id, xor(list_reduce(list_prepend(4294967295::BIGINT,
             list_transform(range(strlen(text)), lambda i: (16 * (strpos('0123456789ABCDEF', hx[2 * i + 1]) - 1)
               + strpos('0123456789ABCDEF', hx[2 * i + 2]) - 1)::BIGINT)),
           lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) AS text_crc32
         FROM (SELECT doc_id, coalesce(text, '') AS text, string_split(hex(encode(coalesce(text, ''))), '') AS hx FROM documents), bits)
"""

SHARDS_SQL = "WITH " + CRC_SQL + """,
drawn AS (SELECT doc_id, source, strlen(coalesce(text, '')) + 1 AS size, text_crc32, md5('mix-1:' || doc_id) AS draw
          FROM documents JOIN crcs ON doc_id = crc_id),
placed AS (SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY draw, text_crc32, size) - 1)::DOUBLE
                     / (2 * count(*) OVER (PARTITION BY source))::DOUBLE AS place FROM drawn),
line AS (SELECT *, row_number() OVER (ORDER BY place, source, draw, text_crc32, size) - 1 AS pos, count(*) OVER () AS n
         FROM placed),
cut AS (SELECT *, (pos * 16 + 15) // n AS shard FROM line)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard, pos - (shard * n) // 16 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard, source, place
FROM cut
"""


@query("op10_interleaved_shards", SHARDS_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleaved_shards(table(spark, sf_dir, "documents"), shards=16)
