"""Where the layers live, and the registry that names the current version of each table."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourvault.operators.registry import dataset_record, get_dataset, null_shares
from hourvault.schemas import SILVER, ddl
from hourvault.sources.storage import list_files
from hourvault.sources.tables import has_files
from hourvault.streaming.ingest import BatchTables


@dataclass(frozen=True)
class Store:
    """Folder layout below one root."""

    root: str

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def batches(self) -> BatchTables:
        """Lines of every loaded batch, the manifest of their files and the ledger of finished batches."""
        return BatchTables(self.path("bronze", "lines"), self.path("bronze", "manifest"), self.path("bronze", "ledger"))

    @property
    def quarantine(self) -> str:
        """The broken lines of all batches, as a path pattern."""
        return self.path("bronze", "lines", "batch_id=*", "is_good=false")

    @property
    def event_filters(self) -> str:
        """Bloom filters of the event ids of every silver hour."""
        return self.path("silver", "event_filters")

    @property
    def runs(self) -> str:
        """Statistics of every run."""
        return self.path("runs")

    @property
    def registry(self) -> str:
        return self.path("registry")

    @property
    def load_log(self) -> str:
        """Files that silver holds, a row for each file and run."""
        return self.path("silver", "load_log")

    def checkpoint(self, name: str) -> str:
        return self.path("checkpoints", name)

    def fact(self, name: str) -> str:
        return self.path("silver", name)

    def gold(self, name: str) -> str:
        return self.path("gold", name)

    def read_fact(self, spark: SparkSession, name: str) -> DataFrame | None:
        path = self.fact(name)
        if not has_files(spark, path):
            return None
        return spark.read.option("basePath", path).schema(fact_schema(name)).parquet(path)

    def current(self, spark: SparkSession, name: str) -> DataFrame | None:
        """The version of a table that was registered last; None before the first."""
        if not has_files(spark, self.registry):
            return None
        row = get_dataset(spark.read.parquet(self.registry), name).select("dataset_path").first()
        return spark.read.parquet(row[0]) if row else None

    def publish(self, df: DataFrame, name: str, layer: str, time_column: str | None = None) -> None:
        """Write a new version beside the old one, then make it current by a registry row, with its size and NULL shares."""
        spark = df.sparkSession
        path = self.path(layer, name, uuid.uuid4().hex)
        df.write.parquet(path)
        known = None
        if has_files(spark, self.registry):
            known = spark.read.parquet(self.registry).filter(F.col("dataset_name") == name).agg(F.min("created_at")).first()[0]
        written = spark.read.parquet(path)
        size = list_files(spark, path).agg(F.sum("size_bytes")).first()[0]
        shares = {f"null_share.{r.column_name}": str(r.null_share) for r in null_shares(written, name).collect()}
        record = dataset_record(written, name, path, tags={"layer": layer}, time_column=time_column, size_bytes=size or 0, first_created=known,
                                extra=shares)
        record.write.mode("append").parquet(self.registry)


def fact_schema(name: str) -> str:
    """Columns of a stored fact with its partition columns kept as text (an hour is '09', not 9)."""
    return ddl({**SILVER[name], "file_date": "string", "hour_bucket": "string"})


def partition_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in columns]).distinct()
