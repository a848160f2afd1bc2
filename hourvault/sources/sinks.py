"""Writers of the layers and the bulk load into fixed-schema tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hourvault.functions.names import plain_path
from hourvault.operators.bronze import upper_case_columns
from hourvault.operators.silver import enforce_schema
from hourvault.schemas import GOLD, ddl
from hourvault.sources.storage import list_files
from hourvault.sources.tables import has_files

CSV_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_bronze(bronze: DataFrame, path: str, mode: str = "append", rebalance: bool = False) -> None:
    """Parquet by date and hour. A task reads whole hourly files, so rows are already grouped by
    partition; `rebalance` regroups them when they are not, and adaptive execution splits large hours."""
    rows = bronze.hint("rebalance", "file_date", "file_hour") if rebalance else bronze
    rows.write.mode(mode).partitionBy("file_date", "file_hour").option("compression", "snappy").parquet(path)


def write_silver(table: DataFrame, path: str, columns: dict[str, str], fmt: str = "parquet", mode: str = "append",
                 partition_by: list[str] | None = None) -> None:
    """The schema columns of one silver table as Parquet or CSV with header."""
    extra = {c: "string" for c in partition_by or [] if c not in columns}
    rows = enforce_schema(table, {**columns, **extra})
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    writer = rows.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).option("timestampNTZFormat", CSV_TIME).csv(path)
    elif fmt == "parquet":
        writer.option("compression", "snappy").parquet(path)
    else:
        raise ValueError(f"unsupported format: {fmt}")


def write_gold(table: DataFrame, path: str, run_date: str, fmt: str = "parquet") -> None:
    """A gold table under its run date; a rerun of the same date replaces that date only."""
    writer = table.withColumn("run_date", F.lit(run_date)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("run_date")
    if fmt == "csv":
        writer.option("header", True).option("timestampNTZFormat", CSV_TIME).csv(path)
    else:
        writer.parquet(path)


def append_warehouse_rows(df: DataFrame, path: str) -> None:
    """Append in warehouse form, upper-case names and JSON as text; the location is created when absent."""
    upper_case_columns(df).write.mode("append").parquet(path)


def append_warehouse_table(df: DataFrame, table: str) -> None:
    """As `append_warehouse_rows`, into a catalogue table."""
    upper_case_columns(df).write.mode("append").saveAsTable(table)


def load_table(spark: SparkSession, source: str, target: str, columns: dict[str, str]) -> int:
    """Append the Parquet files below `source` to `target` with the given schema; returns the rows loaded.

    The count rides on the write itself, so the source is read once.
    """
    found = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").option(
        "ignoreCorruptFiles", True).parquet(source)
    loaded = Observation()
    enforce_schema(found, columns, strict=True).observe(loaded, F.count("*").alias("rows")).write.mode("append").parquet(target)
    return loaded.get["rows"]


LOADS = ("target string, file_path string, size_bytes bigint, modified_at timestamp, status string, rows bigint, rejects map<string,bigint>, "
         "loaded_at timestamp")


def load_once(spark: SparkSession, source: str, target: str, columns: dict[str, str], ledger: str) -> DataFrame:
    """Append the files below `source` that the ledger does not name yet for `target`, and report each of them (LOADS).

    A file is known by path, size and time. Its rows, and for each column the values that do not fit the type and
    become NULL, are counted in the pass that loads them. Files that cannot be read are `skipped`, with no rows, and
    are tried again once they have changed. Loaded rows lie in a folder of their own for each load and the ledger is
    written last: a load that broke off leaves a folder that no ledger row names, which the next load replaces.
    """
    files = list_files(spark, source, "*.parquet")
    known = spark.read.schema(LOADS).option("recursiveFileLookup", True).parquet(ledger).filter(F.col("target") == target) if has_files(spark, ledger) else spark.createDataFrame([], LOADS)
    pending = files.join(known, ["file_path", "size_bytes", "modified_at"], "left_anti").select("file_path", "size_bytes", "modified_at")
    paths = sorted(r.file_path for r in pending.collect())
    if not paths:
        return spark.createDataFrame([], LOADS)
    number = known.select("loaded_at").distinct().count()
    found = spark.read.option("ignoreCorruptFiles", True).schema(_schema_of(spark, paths)).parquet(*paths).withColumn("_file", plain_path("_metadata.file_path"))
    typed = enforce_schema(found, columns, strict=True).columns
    present = [c for c in typed if c in found.columns]
    loaded = found.select(*[(F.col(f"`{c}`").try_cast(kind) if c in found.columns else F.lit(None).cast(kind)).alias(c) for c, kind in columns.items()],
                          F.array(*[F.when(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(columns[c]).isNull(), F.lit(c)) for c in present]).cast(
                              "array<string>").alias("_rejected"), F.col("_file"))
    path = f"{target}/load={number}"
    loaded.withColumn("_rejected", F.array_compact("_rejected")).write.mode("overwrite").parquet(path)
    written = spark.read.parquet(path)
    rejects = (written.select("_file", F.explode("_rejected").alias("column")).groupBy("_file", "column").agg(F.count(F.lit(1)).alias("n"))
               .groupBy("_file").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("column", "n")))).alias("rejects")))
    counts = written.groupBy("_file").agg(F.count(F.lit(1)).alias("rows")).join(rejects, "_file", "left").withColumnRenamed("_file", "file_path")
    report = pending.join(counts, "file_path", "left").select(
        F.lit(target).alias("target"), "file_path", "size_bytes", "modified_at",
        F.when(F.col("rows").isNull(), "skipped").otherwise("loaded").alias("status"), F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce("rejects", F.expr("map()").cast("map<string,bigint>")).alias("rejects"), F.current_timestamp().alias("loaded_at"))
    folder = f"{ledger}/{uuid.uuid4().hex}"
    report.coalesce(1).write.parquet(folder)
    return spark.read.schema(LOADS).parquet(folder)


def _schema_of(spark: SparkSession, paths: list[str]):
    """The columns of the first file that can be read; files of one source are alike."""
    for path in paths:
        try:
            return spark.read.parquet(path).schema
        except PySparkException:
            continue
    return "`_none` string"


def read_loaded(spark: SparkSession, target: str, columns: dict[str, str]) -> DataFrame:
    """The rows of all loads."""
    return spark.read.option("basePath", target).schema(ddl(columns)).parquet(target)


def load_gold_tables(spark: SparkSession, source_of: Callable[[str], str], target_of: Callable[[str], str],
                     tables: list[str] | None = None) -> DataFrame:
    """Load each gold table and go on after a failure: one row per table with success, rows and error."""
    results = []
    for name in tables or list(GOLD):
        source, rows, error = source_of(name), 0, None
        try:
            if has_files(spark, source):
                rows = load_table(spark, source, target_of(name), GOLD[name])
            else:
                error = "PATH_NOT_FOUND"
        except PySparkException as problem:
            error = problem.getCondition() or type(problem).__name__
        results.append((name, error is None, rows, error))
    return spark.createDataFrame(results, "table_name string, success boolean, rows bigint, error string")


def pending_dates(bronze: DataFrame, silver: list[DataFrame]) -> DataFrame:
    """Bronze dates that at least one silver table does not hold yet.

    Each frame needs its `file_date` partition column only, so with
    partitioned tables this reads no data columns.
    """
    dates = bronze.select("file_date").distinct()
    done = silver[0].select("file_date").distinct()
    for table in silver[1:]:
        done = done.join(table.select("file_date").distinct(), "file_date", "left_semi")
    return dates.join(done, "file_date", "left_anti")


def write_report(frames: dict[str, DataFrame], path: str, fmt: str = "json") -> None:
    """The frames of a validation report, one folder each."""
    for name, df in frames.items():
        df.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/{name}")


def write_centroids(centroids: DataFrame, path: str) -> None:
    """Cluster centres as CSV with header; one row per cluster, so one file."""
    centroids.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
