"""Files as rows: listing, totals, content hashes and what is left to copy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourvault.functions.names import object_key, plain_path


def list_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Path, size and change time of every file below `path`; file contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(plain_path("path").alias("file_path"), F.col("length").alias("size_bytes"),
                                    F.col("modificationTime").alias("modified_at"))


def list_all_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """As `list_files`, with the files without a byte too, which a scan leaves out; their change time is not known."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    names = spark.createDataFrame([(p,) for p in reader.load(path).inputFiles()], "path string")
    every = names.select(plain_path(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))).alias("file_path"))
    found = list_files(spark, path, glob)
    empty = every.join(found.select("file_path"), "file_path", "left_anti")
    return found.union(empty.select("file_path", F.lit(0).cast("bigint"), F.lit(None).cast("timestamp")))


def read_contents(spark: SparkSession, path: str | list[str], glob: str | None = None, largest: int | None = None) -> DataFrame:
    """As `list_files`, with the bytes of each file; those beyond `largest` bytes are listed with a null content."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path)
    found = files if largest is None else files.filter(F.col("length") <= largest)
    columns = [plain_path("path").alias("file_path"), F.col("length").alias("size_bytes")]
    found = found.select(*columns, "content")
    if largest is None:
        return found
    return found.union(files.filter(F.col("length") > largest).select(*columns, F.lit(None).cast("binary")))


def storage_stats(files: DataFrame) -> DataFrame:
    """One row: number of files, bytes and megabytes."""
    return files.agg(F.count("*").alias("total_files"),
                     F.coalesce(F.sum("size_bytes"), F.lit(0).cast("bigint")).alias("total_bytes")).withColumn(
        "total_mb", F.round(F.col("total_bytes") / 1048576, 4))


def content_hashes(contents: DataFrame) -> DataFrame:
    """MD5 of each file's bytes."""
    return contents.select("file_path", "size_bytes", F.md5("content").alias("md5_hash"))


def small_files(files: DataFrame, min_bytes: int) -> DataFrame:
    """Files below the expected size."""
    return files.filter(F.col("size_bytes") < min_bytes)


def sync_plan(local: DataFrame, stored_keys: DataFrame, base: str, prefix: str = "") -> DataFrame:
    """Local files not yet stored, with the key each would get."""
    keyed = local.withColumn("object_key", object_key("file_path", base, prefix))
    return keyed.join(stored_keys.select("object_key").distinct(), "object_key", "left_anti")
