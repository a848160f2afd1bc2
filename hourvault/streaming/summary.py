"""Hourly summary over a stream of silver events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hourvault.operators.distincts import distinct_counts_of, wide_counts

# Distinct counts of the summary and their id columns.
MEASURES = {"unique_actors": "actor_id", "unique_repos": "repo_id"}
STATE = "hour_bucket timestamp_ntz, measure string, bucket bigint, bits binary, events bigint, batch_id bigint"


def hourly_summary_stream(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Events and approximate distinct actors and repositories per hour.

    The sketch keeps the state per hour at a fixed size; hours come out when the watermark has passed them.
    """
    hour = F.window("created_at", "1 hour")
    return events.withWatermark("created_at", delay).groupBy(hour.alias("w")).agg(
        F.count("*").alias("total_events"),
        F.approx_count_distinct("actor_id").alias("approx_actors"),
        F.approx_count_distinct("repo_id").alias("approx_repos"),
    ).select(F.col("w.start").cast("timestamp_ntz").alias("hour_bucket"), "total_events", "approx_actors", "approx_repos")


def hourly_bitmap_stream(events: DataFrame, delay: str = "1 hour", measures: dict[str, str] | None = None) -> DataFrame:
    """Event totals and id bitmaps of each hour, as a stream: hour_bucket, measure, bucket, bits, events.

    State is a bitmap for each hour, measure and 32,768 ids, and goes when the watermark has passed the hour. The event
    total is a measure without ids (`total_events`, bucket 0).
    """
    measures = MEASURES if measures is None else measures
    none = F.lit(None).cast("bigint")
    ids = F.array(F.struct(F.lit("total_events").alias("measure"), none.alias("id")),
                  *[F.struct(F.lit(n).alias("measure"), F.col(c).cast("bigint").alias("id")) for n, c in measures.items()])
    rows = (events.withWatermark("created_at", delay).select("created_at", F.explode(ids).alias("m"))
            .filter("m.id IS NOT NULL OR m.measure = 'total_events'").select("created_at", "m.measure", "m.id"))
    bucket = F.coalesce(F.bitmap_bucket_number("id"), F.lit(0).cast("bigint"))
    return rows.groupBy(F.window("created_at", "1 hour").alias("w"), "measure", bucket.alias("bucket")).agg(
        F.bitmap_construct_agg(F.coalesce(F.bitmap_bit_position("id"), F.lit(0).cast("bigint"))).alias("bits"), F.count(F.lit(1)).alias("events"),
    ).select(F.col("w.start").cast("timestamp_ntz").alias("hour_bucket"), "measure", "bucket", "bits", "events")


def store_summary(events: DataFrame, path: str, checkpoint: str, delay: str = "1 hour") -> StreamingQuery:
    """Append the bitmaps of finished hours below `path`; each batch has a folder of its own, which a repeated batch replaces."""
    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (hourly_bitmap_stream(events, delay).writeStream.outputMode("append").foreachBatch(put)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_summary(spark: SparkSession, path: str, period: str | None = None) -> DataFrame:
    """Events and exact distinct actors and repositories for each hour, or longer period, of the stored stream."""
    rows = spark.read.schema(STATE).option("basePath", path).parquet(path)
    hour = F.col("hour_bucket") if period is None else F.date_trunc(period, "hour_bucket").cast("timestamp_ntz")
    totals = rows.filter("measure = 'total_events'").groupBy(hour.alias("hour_bucket")).agg(F.sum("events").alias("total_events"))
    counts = wide_counts(distinct_counts_of(rows.filter("measure <> 'total_events'").select("hour_bucket", "measure", "bucket", "bits"), period), list(MEASURES))
    return totals.join(counts, "hour_bucket", "left").na.fill(0, list(MEASURES))
