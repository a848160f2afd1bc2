"""Bronze: raw lines to typed event rows, with broken lines kept apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourvault.functions.json_fields import canonical_hash, leaf, leaf_json, parse_once
from hourvault.functions.times import file_date, file_hour


def parse_lines(lines: DataFrame) -> DataFrame:
    """Add `event`, the VARIANT of each line; NULL where the line is no JSON object."""
    return parse_once(lines, "value", "event", objects_only=True)


def valid_lines(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("event").isNotNull())


def quarantine(parsed: DataFrame) -> DataFrame:
    """The lines that did not parse, with the file they came from."""
    return parsed.filter(F.col("event").isNull()).select("file_path", "value")


def bronze_columns() -> dict[str, Column]:
    """The columns of the bronze table as expressions on a parsed line, in the table's order."""
    return {
        "event_hash": canonical_hash("event"),
        "file_name": F.col("file_path"),
        "file_date": file_date("file_path"),
        "file_hour": file_hour("file_path"),
        "processed_at": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        "raw_data": F.col("value"),
        "event_id": leaf("event", "$.id", "string"),
        "event_type": leaf("event", "$.type", "string"),
        "created_at": leaf("event", "$.created_at", "string"),
        "actor_id": leaf("event", "$.actor.id", "bigint"),
        "actor_login": leaf("event", "$.actor.login", "string"),
        "repo_id": leaf("event", "$.repo.id", "bigint"),
        "repo_name": leaf("event", "$.repo.name", "string"),
        "payload": leaf_json("event", "$.payload"),
    }


def bronze_events(parsed: DataFrame) -> DataFrame:
    """One typed row per parsed line, in the column order of the bronze table."""
    return valid_lines(parsed).select(*[c.alias(n) for n, c in bronze_columns().items()])


def upper_case_columns(df: DataFrame) -> DataFrame:
    """Warehouse form: upper-case names, nested and VARIANT values as JSON text."""
    def text(field):
        kind = field.dataType.typeName()
        column = F.col(f"`{field.name}`")
        return (F.to_json(column) if kind in ("variant", "struct", "array", "map") else column).alias(field.name.upper())

    return df.select(*[text(f) for f in df.schema])


def only_event_types(events: DataFrame, types: list[str] | None) -> DataFrame:
    """Keep the listed event types; an empty list keeps all."""
    return events.filter(F.col("event_type").isin(list(types))) if types else events


def in_date_pattern(bronze: DataFrame, pattern: str) -> DataFrame:
    """Rows of a yyyy, yyyy/MM or yyyy/MM/dd pattern, as a range on the partition column.

    Parts are whole years, months and days, with or without leading zeros.
    """
    parts = [int(p) for p in pattern.strip("/").split("/")]
    if not 1 <= len(parts) <= 3:
        raise ValueError(f"{pattern!r} is no year, month or day")
    year, month, day = (*parts, None, None)[:3]
    first = f"{year:04d}-{month or 1:02d}-{day or 1:02d}"
    last = f"{year:04d}-{month or 12:02d}-{day or 31:02d}"
    return bronze.filter(F.col("file_date").between(first, last))


def in_hour_range(bronze: DataFrame, start: str, end: str) -> DataFrame:
    """Rows of archive hours in [start, end), bounds as 'yyyy-MM-dd HH'.

    The plain date bounds reach the partition filter of the scan; the hour
    comparison then trims the first and last day.
    """
    first, last = start[:10], end[:10]
    hour = F.concat_ws(" ", "file_date", "file_hour")
    return bronze.filter(F.col("file_date").between(first, last) & (hour >= start) & (hour < end))
