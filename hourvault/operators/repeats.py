"""Which stored hours may hold a new event already: Bloom filters of event ids, kept for each hour."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourvault.session import shared_dir

HOUR = ["file_date", "hour_bucket"]
#: Ids in a block of 32,768 bits, on average, and bits set for each. 32 bits an id: of 10^7 other ids, one or two pass.
BLOCK_IDS = 1024
BLOCK_BITS = 1 << 15
PROBES = 16
#: New ids that are held against the filters at a time; they go to all tasks.
IDS_AT_A_TIME = 500_000

FILTER = "file_date string, hour_bucket string, n bigint, low bigint, high bigint, blocks bigint, block bigint, bits binary"


def _hashed(rows: DataFrame, key: str) -> DataFrame:
    """`h` deals ids over blocks, `p` and `q` give their bits."""
    return rows.withColumn("h", F.xxhash64(key)).withColumn("p", F.pmod(F.xxhash64(F.lit("p"), key), F.lit(BLOCK_BITS))).withColumn(
        "q", F.pmod(F.xxhash64(F.lit("q"), key), F.lit(BLOCK_BITS // 2)) * 2 + 1)


def _block(blocks: str) -> Column:
    """The block of an id: its hash's place among equal ranges, so that sorted hashes of a block lie side by side."""
    return F.expr(f"((h >> 32) + 2147483648) * {blocks} DIV 4294967296")


def id_filters(events: DataFrame, key: str = "event_id", hour: list[str] = HOUR) -> DataFrame:
    """A Bloom filter of each hour's ids, in blocks (FILTER): also the number, least and greatest of its ids as numbers.

    A filter's size follows the number of its ids, so the share of false hits is the same for all hours. Bits are set
    on the map side, block by block: a busy hour is many blocks. Null ids have no place in a filter.
    """
    date, bucket = hour
    rows = events.select(F.col(date).cast("string").alias("file_date"), F.col(bucket).cast("string").alias("hour_bucket"),
                         F.col(key).cast("string").alias("_key")).filter("_key IS NOT NULL")
    number = F.col("_key").try_cast("bigint")
    # Ids that are no numbers have no range: null bounds stand for every id.
    sizes = rows.groupBy("file_date", "hour_bucket").agg(
        F.count(F.lit(1)).alias("n"), F.when(F.count(number) == F.count(F.lit(1)), F.min(number)).alias("low"),
        F.when(F.count(number) == F.count(F.lit(1)), F.max(number)).alias("high")).withColumn("blocks", F.ceil(F.col("n") / BLOCK_IDS).cast("bigint"))
    placed = _hashed(rows.join(sizes, ["file_date", "hour_bucket"]), "_key").withColumn("block", _block("blocks"))
    # Copies of an id go before rows are gathered by block; 16 bits an id are set where the rows of a block arrive.
    columns = ["file_date", "hour_bucket", "n", "low", "high", "blocks", "block"]
    placed = placed.select(*columns, "p", "q").distinct()
    return placed.repartition(*columns).sortWithinPartitions(*columns).mapInArrow(_set_bits, FILTER)


def _set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a block from rows sorted by block; a block that goes on in the next batch is held back."""
    held, columns = None, ["file_date", "hour_bucket", "n", "low", "high", "blocks", "block"]

    def rows_of(done: list[tuple[tuple, np.ndarray]]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.string(), *[pa.int64()] * 5]
        parts = [pa.array([key[i] for key, _ in done], kind) for i, kind in enumerate(kinds)]
        bits = pa.array([np.packbits(b, bitorder="little").tobytes() for _, b in done], pa.binary())
        return pa.RecordBatch.from_arrays([*parts, bits], names=[*columns, "bits"])

    for batch in batches:
        if not batch.num_rows:
            continue
        p, q = (batch.column(c).to_numpy()[:, None] for c in ("p", "q"))
        bits, done = (p + np.arange(PROBES) * q) % BLOCK_BITS, []
        date, hour, block = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("file_date", "hour_bucket", "block"))
        starts = np.flatnonzero(np.r_[True, (date[1:] != date[:-1]) | (hour[1:] != hour[:-1]) | (block[1:] != block[:-1])])
        for begin, end in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows], strict=True):
            key = tuple(batch.column(c)[begin].as_py() for c in columns)
            if held is None or held[0] != key:
                if held is not None:
                    done.append(held)
                held = key, np.zeros(BLOCK_BITS, bool)
            held[1][bits[begin:end].ravel()] = True
        if done:
            yield rows_of(done)
    if held is not None:
        yield rows_of([held])


def _stored(rows: DataFrame, *by: str) -> DataFrame:
    path = shared_dir(rows.sparkSession, "ids")
    rows.write.partitionBy(*by).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def hits(filters: DataFrame, ids: DataFrame, key: str = "event_id") -> DataFrame:
    """file_date, hour_bucket and id for each new id that an hour may hold; no id that an hour holds is left out.

    New ids go out in blocks of IDS_AT_A_TIME, sorted by their hash; a task holds each block of a filter against the
    ids of its range, by their bounds and their bits. The pairs that fail never become rows.
    """
    spark = filters.sparkSession
    new = _hashed(ids.select(F.col(key).cast("string").alias("_key")).filter("_key IS NOT NULL").distinct(), "_key").withColumn(
        "number", F.col("_key").try_cast("bigint")).select("_key", "h", "p", "q", "number")
    # Stored once, then by part: a part is fetched without a look at the others or at the ids' source.
    new = _stored(new)
    parts = -(-new.count() // IDS_AT_A_TIME)
    schema = "file_date string, hour_bucket string, event_id string"
    out = spark.createDataFrame([], schema)
    new = _stored(new.withColumn("part", F.pmod(F.xxhash64("h"), F.lit(parts))), "part") if parts > 1 else new.withColumn("part", F.lit(0))
    for k in range(parts):
        got = new.filter(F.col("part") == k).toArrow().sort_by("h")
        sent = spark.sparkContext.broadcast((
            (got["h"].to_numpy() >> 32) + (1 << 31), got["p"].to_numpy().astype(np.int32), got["q"].to_numpy().astype(np.int32),
            got["number"].to_pandas().to_numpy(float), got["_key"].combine_chunks()))

        def over(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            place, first, step, number, keys = sent.value
            for batch in batches:
                days, hours, at = [], [], []
                for date, hour, low, high, blocks, block, bits in zip(*(batch.column(c).to_pylist() for c in (
                        "file_date", "hour_bucket", "low", "high", "blocks", "block", "bits")), strict=True):
                    # Ids of the block: floor(place * blocks / 2^32) = block.
                    begin, end = np.searchsorted(place, [-(-(block << 32) // blocks), -(-((block + 1) << 32) // blocks)])
                    some = np.arange(begin, end)
                    if low is not None:
                        some = some[(number[some] >= low) & (number[some] <= high)]
                    held = np.frombuffer(bits, np.uint8)
                    for probe in range(PROBES):
                        bit = (first[some] + probe * step[some]) % BLOCK_BITS
                        some = some[(held[bit >> 3] >> (bit & 7)) & 1 == 1]
                        if not len(some):
                            break
                    days += [date] * len(some)
                    hours += [hour] * len(some)
                    at += some.tolist()
                yield pa.RecordBatch.from_arrays([pa.array(days, pa.string()), pa.array(hours, pa.string()), keys.take(pa.array(at, pa.int64()))],
                                                 names=["file_date", "hour_bucket", "event_id"])

        found = filters.select("file_date", "hour_bucket", "low", "high", "blocks", "block", "bits").mapInArrow(over, schema)
        out = found if parts == 1 else out.union(found)
    return out


def hours_to_search(filters: DataFrame, ids: DataFrame, key: str = "event_id") -> DataFrame:
    """The hours that may hold one of the new ids."""
    return hits(filters, ids, key).select("file_date", "hour_bucket").distinct()


def in_hours(events: DataFrame, hours: DataFrame, most: int = 1000, hour: list[str] = HOUR) -> DataFrame:
    """Events of some hours. Up to `most` hours are literals of the partition filter; more are joined."""
    date, bucket = hour
    known = hours.limit(most + 1).collect()
    if len(known) > most:
        return events.join(hours.select(F.col("file_date").alias(date), F.col("hour_bucket").alias(bucket)), [date, bucket], "left_semi")
    by_date: dict[str, list[str]] = {}
    for row in known:
        by_date.setdefault(row.file_date, []).append(row.hour_bucket)
    wanted = F.lit(False)
    for day, found in sorted(by_date.items()):
        wanted = wanted | (F.col(date) == day) & F.col(bucket).isin(sorted(found))
    return events.filter(wanted)
