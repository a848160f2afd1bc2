"""Distinct counts that can be merged: bitmaps for exact counts, sketches for approximate ones, stored by hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOUR = "hour_bucket"
#: Size of a sketch: 2^12 registers, a standard error of 1.6 %.
SKETCH_BITS = 12


def _measures(events: DataFrame, measures: dict[str, str], hour: str | Column) -> DataFrame:
    """One row for each event and measure that has an id: hour, measure, id."""
    ids = F.array(*[F.struct(F.lit(n).alias("measure"), F.col(c).cast("bigint").alias("id")) for n, c in measures.items()])
    hour = F.col(hour) if isinstance(hour, str) else hour
    return events.select(F.date_trunc("hour", hour).cast("timestamp_ntz").alias(HOUR), F.explode(ids).alias("m")).select(HOUR, "m.*").filter("id IS NOT NULL")


def hourly_bitmaps(events: DataFrame, measures: dict[str, str], hour: str | Column = "created_at") -> DataFrame:
    """Which ids each hour holds: hour_bucket, measure, bucket, bits.

    `measures` maps the name of a count to its id column (whole numbers). A row's bitmap stands for 32,768 consecutive
    ids, so a busy hour or a common id is spread over many rows, and bits are set before rows are shuffled. Rows are
    stored as they are and merged with those of other hours, runs or late events by `merged_bitmaps`.
    """
    return _measures(events, measures, hour).groupBy(HOUR, "measure", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def merged_bitmaps(bitmaps: DataFrame, period: str | None = None) -> DataFrame:
    """The bitmaps of longer periods ('day', 'month', ...), or of all rows of an hour (None): the same columns."""
    hour = F.col(HOUR) if period is None else F.date_trunc(period, HOUR).cast("timestamp_ntz")
    return bitmaps.groupBy(hour.alias(HOUR), "measure", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts_of(bitmaps: DataFrame, period: str | None = None) -> DataFrame:
    """Exact distinct ids for each period and measure, from stored hours: hour_bucket, measure, distinct_ids."""
    counted = merged_bitmaps(bitmaps, period).select(HOUR, "measure", F.bitmap_count("bits").alias("n"))
    return counted.groupBy(HOUR, "measure").agg(F.sum("n").alias("distinct_ids"))


def hourly_sketches(events: DataFrame, measures: dict[str, str], hour: str | Column = "created_at") -> DataFrame:
    """As `hourly_bitmaps`, one sketch of bounded size for each hour and measure: hour_bucket, measure, sketch."""
    return _measures(events, measures, hour).groupBy(HOUR, "measure").agg(F.hll_sketch_agg("id", F.lit(SKETCH_BITS)).alias("sketch"))


def merged_sketches(sketches: DataFrame, period: str | None = None) -> DataFrame:
    hour = F.col(HOUR) if period is None else F.date_trunc(period, HOUR).cast("timestamp_ntz")
    return sketches.groupBy(hour.alias(HOUR), "measure").agg(F.hll_union_agg("sketch", F.lit(True)).alias("sketch"))


def approximate_counts_of(sketches: DataFrame, period: str | None = None) -> DataFrame:
    """Approximate distinct ids for each period and measure: hour_bucket, measure, approx_ids."""
    return merged_sketches(sketches, period).select(HOUR, "measure", F.hll_sketch_estimate("sketch").alias("approx_ids"))


def wide_counts(counts: DataFrame, measures: list[str], value: str = "distinct_ids") -> DataFrame:
    """One row for each period, a column for each measure; 0 where a period has no id of it."""
    return counts.groupBy(HOUR).agg(*[F.coalesce(F.max(F.when(F.col("measure") == m, F.col(value))), F.lit(0).cast("bigint")).alias(m) for m in measures])
