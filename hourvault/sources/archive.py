"""The raw archive: gzip files of JSON lines, one file per hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourvault.functions.names import plain_path

ARCHIVE_GLOB = "*.json.gz"


def read_lines(spark: SparkSession, path: str | list[str], skip_corrupt: bool = False,
               partitions: int | None = None, glob: str = ARCHIVE_GLOB) -> DataFrame:
    """Every line below `path` with its file.

    A gzip file is one task, so an archive of many hourly files is already
    spread; `partitions` re-spreads the lines when there are fewer files than
    cores. `skip_corrupt` leaves unreadable files out; compare with
    `storage.list_files` to find them.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    if skip_corrupt:
        reader = reader.option("ignoreCorruptFiles", True)
    lines = reader.text(path).select(
        plain_path(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))).alias("file_path"),
        F.col("_metadata.file_size").alias("size_bytes"), "value")
    return lines.repartition(partitions) if partitions else lines


def ingest_manifest(parsed: DataFrame) -> DataFrame:
    """Per file: lines read, events, broken lines and whether all went well."""
    size = [F.max("size_bytes").alias("size_bytes")] if "size_bytes" in parsed.columns else []
    per_file = parsed.groupBy("file_path").agg(
        F.count("*").alias("lines"), F.count("event").alias("events"),
        F.count_if(F.col("event").isNull()).alias("bad_lines"), *size)
    return per_file.withColumn("success", F.col("bad_lines") == 0)


def pending_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Listed files that the manifest does not name yet."""
    return files.join(manifest.select("file_path").distinct(), "file_path", "left_anti")


def run_statistics(files: DataFrame, manifest: DataFrame, report: DataFrame) -> DataFrame:
    """One row per run: files found, skipped because done before, loaded and failed.

    `manifest` names the files of earlier runs, `report` holds file_path and
    success of this one.
    """
    known = manifest.select("file_path").distinct().withColumn("_done", F.lit(True))
    state = files.select("file_path").join(known, "file_path", "left").join(
        report.select("file_path", "success"), "file_path", "left")
    fresh = F.col("_done").isNull()
    return state.agg(
        F.count("*").alias("found"), F.count_if(~fresh).alias("skipped"), F.count_if(fresh).alias("processed"),
        F.count_if(fresh & F.coalesce("success", F.lit(False))).alias("successful"),
        F.count_if(fresh & ~F.coalesce("success", F.lit(False))).alias("failed"))
