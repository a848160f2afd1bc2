"""Validation of a raw archive: files, field rules, time coverage and an overall status."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from hourvault.operators.bronze import parse_lines
from hourvault.operators.quality import (
    capped_errors, checked_lines, field_errors, file_event_types, file_status, file_uniques, first_lines, found_hours,
    missing_hours, overall_status, quality_totals, temporal_coverage, with_line_numbers)
from hourvault.session import shared_dir
from hourvault.sources.archive import ARCHIVE_GLOB, read_lines
from hourvault.sources.damage import HEALTH, LARGEST, file_health
from hourvault.sources.sinks import write_report
from hourvault.sources.storage import list_all_files, read_contents


def read_rules(spark: SparkSession, path: str) -> tuple[list[str], dict[str, str]]:
    """Required fields and field types of a rules file."""
    text = spark.read.option("wholetext", True).text(path).first()[0]
    rules = json.loads(text)
    return rules.get("required_fields", []), rules.get("field_types", {})


def validate(spark: SparkSession, source: str, required: list[str] | None = None, types: dict[str, str] | None = None,
             sample: int | None = None) -> dict[str, DataFrame]:
    """Frames of the report. All lines are checked unless `sample` limits each file to its first lines.

    The archive is parsed once; the frames come from the stored checks. Every file's members are checked besides, so
    that a damaged file is an error and shows what could be read of it. All field errors are stored, `errors` shows the
    first of each file.
    """
    files = list_all_files(spark, source, ARCHIVE_GLOB)
    damage = shared_dir(spark, "damage")
    file_health(read_contents(spark, source, ARCHIVE_GLOB, LARGEST)).write.parquet(damage)
    lines = with_line_numbers(read_lines(spark, source, skip_corrupt=True))
    stored = shared_dir(spark, "checked")
    checked_lines(parse_lines(first_lines(lines, sample) if sample else lines), required, types).write.parquet(stored)
    checked = spark.read.parquet(stored)
    report = file_status(checked, files, health=spark.read.schema(HEALTH).parquet(damage))
    frames = {
        "files": report.join(file_uniques(checked), "file_path", "left"),
        "event_types": file_event_types(checked),
        "coverage": temporal_coverage(found_hours(files)),
        "missing_hours": missing_hours(found_hours(files)),
        "summary": overall_status(report),
        "metrics": quality_totals(report, file_event_types(checked)),
    }
    if required or types:
        frames["all_errors"] = field_errors(checked)
        frames["errors"] = capped_errors(checked)
    return frames


def run(spark: SparkSession, source: str, report_path: str, rules_path: str | None = None, sample: int | None = None) -> None:
    """Validate and store the report."""
    required, types = read_rules(spark, rules_path) if rules_path else ([], {})
    write_report(validate(spark, source, required, types, sample), report_path)
