"""Incremental file ingest: the stream checkpoint remembers which files are done."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hourvault.functions.names import plain_path
from hourvault.operators.bronze import bronze_columns, bronze_events, parse_lines, quarantine
from hourvault.operators.upsert import new_rows, one_per_key
from hourvault.schemas import BRONZE_EVENTS, ddl
from hourvault.sources.archive import ARCHIVE_GLOB


def stream_lines(spark: SparkSession, path: str, files_per_batch: int | None = None,
                 glob: str = ARCHIVE_GLOB) -> DataFrame:
    """Lines of files that arrive below `path`."""
    reader = spark.readStream.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path).select(
        plain_path(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))).alias("file_path"),
        "value")


@dataclass(frozen=True)
class BatchTables:
    """Where the batches of an archive stream are kept: their lines, a manifest of their files, and the ledger of finished batches."""

    lines: str
    manifest: str
    ledger: str


def all_lines(parsed: DataFrame) -> DataFrame:
    """Bronze rows and broken lines in one frame, from one parse: a broken line has its text as `value` and no other content."""
    good = F.col("event").isNotNull()
    columns = bronze_columns()
    always = ("file_name", "file_date", "file_hour", "processed_at")
    return parsed.select(*[c.alias(n) if n in always else F.when(good, c).alias(n) for n, c in columns.items()],
                         F.when(~good, F.col("value")).alias("value"), good.alias("is_good"))


def store_batch(batch: DataFrame, batch_id: int, tables: BatchTables) -> None:
    """Store one micro-batch of lines: good and bad rows in one write, then the manifest of its files, then its ledger row.

    All three go to folders of the batch and replace what a run that broke off left there; only batches in the ledger
    count. So whatever a crash leaves behind, a repeated batch ends in the same state.
    """
    spark, counted = batch.sparkSession, Observation()
    rows = all_lines(parse_lines(batch)).observe(counted, F.count(F.lit(1)).alias("lines"), F.count_if(~F.col("is_good")).alias("bad_lines"))
    path = f"{tables.lines}/batch_id={batch_id}"
    rows.write.mode("overwrite").partitionBy("is_good", "file_date", "file_hour").option("compression", "snappy").parquet(path)
    found = counted.get
    if found["lines"]:  # the manifest reads names only
        files = spark.read.schema("file_name string, is_good boolean, file_date string, file_hour string").parquet(path)
        files.groupBy("file_name", "file_date", "file_hour").agg(
            F.count(F.lit(1)).alias("lines"), F.count_if("is_good").alias("events"), F.count_if(~F.col("is_good")).alias("bad_lines"),
        ).withColumn("success", F.col("bad_lines") == 0).withColumn("loaded_at", F.current_timestamp()).write.mode("overwrite").parquet(
            f"{tables.manifest}/batch_id={batch_id}")
    spark.createDataFrame([(found["lines"], found["bad_lines"])], "lines bigint, bad_lines bigint").withColumn(
        "committed_at", F.current_timestamp()).coalesce(1).write.mode("overwrite").parquet(f"{tables.ledger}/batch_id={batch_id}")


def ingest_archive(lines: DataFrame, tables: BatchTables, checkpoint: str) -> StreamingQuery:
    """Load every file once, its good and its broken lines, and stop when all present files are done."""
    return (lines.writeStream.foreachBatch(lambda batch, batch_id: store_batch(batch, batch_id, tables))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


MANIFEST = ("file_name string, file_date string, file_hour string, lines bigint, events bigint, bad_lines bigint, success boolean, "
            "loaded_at timestamp, batch_id bigint")
LEDGER = "lines bigint, bad_lines bigint, committed_at timestamp, batch_id bigint"


def committed(spark: SparkSession, tables: BatchTables) -> list[int]:
    """Finished batches; a run adds one or a few."""
    return sorted(r[0] for r in spark.read.schema(LEDGER).parquet(tables.ledger).select("batch_id").distinct().collect())


def batch_rows(spark: SparkSession, tables: BatchTables, batches: list[int], good: bool = True) -> DataFrame:
    """Good rows (bronze columns) or broken lines of some batches: batch and kind are partition filters."""
    columns = {**BRONZE_EVENTS, "value": "string", "batch_id": "bigint", "is_good": "boolean"}
    rows = spark.read.schema(ddl(columns)).parquet(tables.lines).filter(F.col("batch_id").isin(batches) & (F.col("is_good") == good))
    return rows.select(*(BRONZE_EVENTS if good else [F.col("file_name").alias("file_path"), "value"]))


def ingest_bronze(lines: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Load every file once into the bronze table and stop when all present files are done.

    The file sink commits batch by batch, so a restart neither loses nor
    repeats rows.
    """
    return (bronze_events(parse_lines(lines)).writeStream.format("parquet").partitionBy("file_date", "file_hour")
            .option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def ingest_quarantine(lines: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """The lines that do not parse, kept in a table of their own."""
    return (quarantine(parse_lines(lines)).writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def without_repeats(events: DataFrame, delay: str = "2 hours", key: str = "event_hash") -> DataFrame:
    """Drop events seen before within the watermark delay; state is bounded by the delay."""
    return events.withWatermark("created_at", delay).dropDuplicatesWithinWatermark([key])


def merge_batches(events: DataFrame, read_target, write_target, key: str, checkpoint: str) -> StreamingQuery:
    """Upsert every micro-batch by key.

    `read_target()` gives the stored rows (or None at first), `write_target(df,
    batch_id)` stores the merged content as a new version. Repeating a batch
    after a failure gives the same content.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        rows, target = one_per_key(batch, key), read_target()
        # Keys for the target are taken as they come, so that the batch's copies are told apart once only.
        write_target(rows if target is None else new_rows(target, batch, key).unionByName(rows), batch_id)

    return events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
