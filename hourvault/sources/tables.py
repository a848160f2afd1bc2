"""Readers of stored tables: bronze by date, layer tables and model inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourvault.operators.bronze import in_date_pattern
from hourvault.operators.silver import union_all


def has_files(spark: SparkSession, path: str) -> bool:
    """True when the path (or pattern) matches something."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(hadoop_path)
    return found is not None and len(found) > 0


def read_bronze(spark: SparkSession, parquet: str | None = None, csv: str | None = None,
                schema: str | None = None, date_pattern: str | None = None) -> DataFrame:
    """Bronze rows from Parquet and CSV together, optionally of one date pattern."""
    frames = []
    if parquet:
        frames.append(spark.read.parquet(parquet))
    if csv:
        reader = spark.read.option("header", True).option("multiLine", False).option("escape", '"')
        frames.append((reader.schema(schema) if schema else reader).csv(csv))
    if not frames:
        raise ValueError("give a Parquet or a CSV location")
    bronze = union_all(frames)
    bronze = bronze.withColumn("file_date", F.date_format(F.col("file_date").try_cast("date"), "yyyy-MM-dd")) \
        if dict(bronze.dtypes)["file_date"] != "string" else bronze
    return in_date_pattern(bronze, date_pattern) if date_pattern else bronze


def read_layer_table(spark: SparkSession, paths: list[str], skip_corrupt: bool = True) -> DataFrame:
    """One table from several locations, those that exist; unreadable files are left out."""
    reader = spark.read.option("ignoreCorruptFiles", skip_corrupt).option("recursiveFileLookup", False)
    frames = [reader.parquet(p) for p in dict.fromkeys(paths) if has_files(spark, p)]
    if not frames:
        raise FileNotFoundError(f"none of {paths} exists")
    return union_all(frames)


def read_dataset(spark: SparkSession, path: str) -> DataFrame | None:
    """Model input by suffix, Parquet or CSV; None for a missing path, an error for another format."""
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix not in ("parquet", "csv"):
        raise ValueError(f"unsupported format: {path}")
    if not has_files(spark, path):
        return None
    if suffix == "parquet":
        return spark.read.parquet(path)
    return spark.read.option("header", True).option("inferSchema", True).csv(path)
