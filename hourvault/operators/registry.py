"""Dataset registry: records computed from the tables and kept in an append-only table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourvault.functions.types import spark_type


def null_shares(df: DataFrame, name: str) -> DataFrame:
    """Rows, NULLs and NULL share of each column of a table, from one aggregate."""
    total = F.count("*").alias("_rows")
    counted = df.agg(total, *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}") for i, c in enumerate(df.columns)])
    entries = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("nulls")) for i, c in enumerate(df.columns)]))
    return counted.select("_rows", entries.alias("e")).select(
        F.lit(name).alias("dataset_name"), "e.column_name", F.col("_rows").alias("rows"), "e.nulls",
        F.when(F.col("_rows") > 0, F.round(F.col("e.nulls") / F.col("_rows"), 6)).alias("null_share"))


def dataset_record(
    df: DataFrame,
    name: str,
    path: str,
    description: str = "",
    partitions: list[dict[str, str]] | None = None,
    tags: dict[str, str] | None = None,
    source_info: dict[str, str] | None = None,
    extra: dict[str, str] | None = None,
    time_column: str | None = None,
    size_bytes: int | None = None,
    first_created: dt.datetime | None = None,
) -> DataFrame:
    """One registry row: what the caller states about a dataset plus what the data says.

    `first_created` is the creation time of the dataset's first record, where there is one.
    """
    def text_map(values: dict[str, str] | None):
        pairs = [F.lit(x) for item in (values or {}).items() for x in item]
        return (F.create_map(*pairs) if pairs else F.expr("map()")).cast("map<string,string>")

    def entries(items: list[dict[str, str]]):
        kind = "array<struct<name:string,type:string>>"
        return F.array(*[F.struct(F.lit(i["name"]).alias("name"), F.lit(i["type"]).alias("type")) for i in items]).cast(kind)

    stated = [{"name": p["name"], "type": spark_type(p.get("type", "string"))} for p in partitions or []]
    fields = [{"name": f.name, "type": f.dataType.simpleString()} for f in df.schema]
    span = [F.min(time_column), F.max(time_column)] if time_column else [F.lit(None), F.lit(None)]
    low, high = (c.cast("timestamp_ntz").alias(n) for c, n in zip(span, ("min_time", "max_time")))
    return df.agg(F.count("*").alias("rows"), low, high).select(
        F.lit(name).alias("dataset_name"), F.lit(path).alias("dataset_path"), F.lit(description).alias("description"),
        entries(fields).alias("schema"), entries(stated).alias("partitions"),
        text_map(tags).alias("tags"), text_map(source_info).alias("source_info"),
        text_map(extra).alias("additional_metadata"), "rows", "min_time", "max_time",
        F.lit(size_bytes).cast("bigint").alias("size_bytes"),
        F.coalesce(F.lit(first_created).cast("timestamp"), F.current_timestamp()).alias("created_at"), F.current_timestamp().alias("updated_at"))


def latest_records(registry: DataFrame) -> DataFrame:
    """The newest record of each dataset."""
    newest = registry.groupBy("dataset_name").agg(F.max_by(F.struct(*registry.columns), "updated_at").alias("r"))
    return newest.select("r.*")


def get_dataset(registry: DataFrame, name: str) -> DataFrame:
    """Newest record of one dataset, no row for an unknown name."""
    return latest_records(registry.filter(F.col("dataset_name") == name))


def list_datasets(registry: DataFrame) -> DataFrame:
    """Name, description, tags and last update of every dataset."""
    return latest_records(registry).select(F.col("dataset_name").alias("name"), "description", "tags", "updated_at")


def partition_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per partition."""
    return df.groupBy(*columns).agg(F.count("*").alias("rows"))
