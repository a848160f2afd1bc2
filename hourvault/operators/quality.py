"""Data quality: file checks, field rules, column tests and time coverage."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hourvault.functions.json_fields import is_object, json_type, leaf
from hourvault.functions.times import file_time, hours_between

# Limits of the validation.
MIN_FILE_BYTES = 1000
MAX_ERRORS_SHOWN = 20
SAMPLE_EVENTS = 100
MAX_ERROR_RATE = 0.05

# Column tests declared for the silver and gold tables.
UNIQUE_TESTS = {
    "events": ["event_id", "event_hash"],
    "actors": ["actor_id"],
    "repositories": ["repo_id"],
    "organizations": ["org_id"],
    "payload_details": ["event_id"],
}
NOT_NULL_TESTS = {
    "events": ["event_id", "event_hash", "event_type", "created_at"],
    "actors": ["actor_id", "actor_login", "first_seen_at", "last_seen_at"],
    "repositories": ["repo_id", "repo_name", "first_seen_at", "last_seen_at"],
    "organizations": ["org_id", "org_login", "first_seen_at", "last_seen_at"],
    "payload_details": ["event_id", "event_type"],
    "actor_metrics": ["actor_id"],
    "repo_metrics": ["repo_id"],
    "owner_metrics": ["org_name"],
    "event_type_metrics": ["event_type"],
    "daily_summary": ["hour_bucket"],
}


def with_line_numbers(lines: DataFrame) -> DataFrame:
    """Add `line_id`, increasing in reading order within a file (a gzip file is read by one task)."""
    return lines.withColumn("line_id", F.monotonically_increasing_id())


def first_lines(lines: DataFrame, n: int = SAMPLE_EVENTS, order: str = "line_id") -> DataFrame:
    """The first n lines of each file. The rank limit is applied before the shuffle too."""
    ranked = lines.withColumn("_n", F.row_number().over(W.partitionBy("file_path").orderBy(order)))
    return ranked.filter(F.col("_n") <= n).drop("_n")


RULE = "array<struct<field:string,problem:string,expected:string>>"


def field_rules(required: list[str] | None = None, types: dict[str, str] | None = None) -> Column:
    """Rules as one array of data: a field that must be there (`missing`), or must have a JSON type (`type`)."""
    rules = [(n, "missing", None) for n in required or []] + [(n, "type", kind) for n, kind in (types or {}).items()]
    return F.from_json(F.lit(json.dumps([dict(zip(("field", "problem", "expected"), r, strict=True)) for r in rules])), RULE)


def broken_rules(event: str, rules: Column) -> Column:
    """The rules that a document breaks, with the type found: array of (field, problem, expected, found).

    The document's top level becomes a map once, and each rule looks its field up in it: the plan is the same for any
    number of rules.
    """
    fields = F.try_variant_get(event, "$", "map<string,variant>")
    looked_up = F.transform(rules, lambda r: F.struct(r["field"].alias("field"), r["problem"].alias("problem"), r["expected"].alias("expected"),
                                                      json_type(F.try_element_at(fields, r["field"])).alias("found")))
    return F.filter(looked_up, lambda r: F.when(r["problem"] == "missing", r["found"].isNull()).otherwise(
        F.coalesce(r["found"] != r["expected"], F.lit(False))))


def checked_lines(parsed: DataFrame, required: list[str] | None = None, types: dict[str, str] | None = None) -> DataFrame:
    """One narrow row per line with all that the file checks need.

    The raw text is read and parsed for this frame alone: store it once and
    every check below is a scan of a few small columns. `errors` holds the
    rules that the line breaks, and is NULL for a line without errors.
    """
    def entity(name: str) -> Column:
        return F.when(is_object(F.try_variant_get("event", f"$.{name}", "variant")), leaf("event", f"$.{name}.id", "bigint"))

    is_broken = F.col("event").isNull()
    rows = parsed.select(
        *[c for c in ("file_path", "line_id") if c in parsed.columns], is_broken.alias("is_broken"),
        leaf("event", "$.type", "string").alias("event_type"), entity("actor").alias("actor_id"), entity("repo").alias("repo_id"),
        (F.when(~is_broken, broken_rules("event", field_rules(required, types))) if required or types else F.lit(None).cast(
            "array<struct<field:string,problem:string,expected:string,found:string>>")).alias("errors"))
    count = F.coalesce(F.size("errors"), F.lit(0)) if required or types else F.lit(0)
    return rows.withColumn("error_count", F.greatest(count, F.lit(0))).withColumn("errors", F.when(F.col("error_count") > 0, F.col("errors")))


def field_errors(checked: DataFrame) -> DataFrame:
    """One row per broken field rule: a required field that is absent or a value of another JSON type."""
    kept = [c for c in ("file_path", "line_id") if c in checked.columns]
    return checked.select(*kept, F.explode("errors").alias("e")).filter(
        F.col("e").isNotNull()).select(*kept, "e.*")


def capped_errors(checked: DataFrame, n: int = MAX_ERRORS_SHOWN) -> DataFrame:
    """The first n errors of each file with the number that the report leaves out.

    Totals come from a counting aggregate and the shown rows from a rank limit,
    so a file with very many errors never gathers in one task.
    """
    totals = checked.groupBy("file_path").agg(F.sum("error_count").alias("_total"))
    order = W.partitionBy("file_path").orderBy("line_id", "field", "problem")
    shown = field_errors(checked).withColumn("error_number", F.row_number().over(order)).filter(F.col("error_number") <= n)
    omitted = F.greatest(F.col("_total") - F.lit(n), F.lit(0)).cast("bigint")
    return shown.join(totals, "file_path").withColumn("omitted", omitted).drop("_total")


def file_uniques(checked: DataFrame) -> DataFrame:
    """Events and distinct actors, repositories and types per file.

    Reduced to one row per (file, type, actor, repository) first, so the
    distinct counts neither multiply the input nor gather a large file.
    """
    groups = checked.filter("NOT is_broken").groupBy("file_path", "event_type", "actor_id", "repo_id").agg(F.count("*").alias("n"))
    return groups.groupBy("file_path").agg(
        F.sum("n").alias("events"), F.countDistinct("actor_id").alias("unique_actors"),
        F.countDistinct("repo_id").alias("unique_repos"), F.countDistinct("event_type").alias("unique_types"))


def file_event_types(checked: DataFrame) -> DataFrame:
    """Events per file and type."""
    return checked.filter("NOT is_broken").groupBy("file_path", "event_type").agg(F.count("*").alias("event_count"))


def file_status(checked: DataFrame, files: DataFrame, min_bytes: int = MIN_FILE_BYTES, health: DataFrame | None = None) -> DataFrame:
    """Status of every listed file: error for unreadable, damaged, broken or rule-breaking content, warning for a small file.

    `files` lists file_path and size_bytes of everything present. With `health` (of `damage.file_health`) a file is
    readable if it is sound or empty, and its damage is shown; an empty file is only small. Without it, a file
    without a single line read counts as one that could not be opened.
    """
    lines = checked.groupBy("file_path").agg(
        F.count("*").alias("lines"), F.count_if("is_broken").alias("bad_lines"), F.sum("error_count").alias("field_errors"))
    zero = F.lit(0).cast("bigint")
    listed = files.select("file_path", "size_bytes").join(lines, "file_path", "left")
    readable, shown = F.col("lines").isNotNull(), []
    if health is not None:
        listed = listed.join(health.select("file_path", "health", "readable_bytes", "damaged_at"), "file_path", "left")
        # A scan leaves files without a byte out: what is listed with none needs no look.
        listed = listed.withColumn("health", F.when(F.col("size_bytes") == 0, "empty").otherwise(F.col("health")))
        readable, shown = F.coalesce(F.col("health").isin("sound", "empty"), F.lit(False)), ["health", "readable_bytes", "damaged_at"]
    report = listed.select(
        "file_path", "size_bytes", F.coalesce("lines", zero).alias("lines"),
        F.coalesce("bad_lines", zero).alias("bad_lines"), F.coalesce("field_errors", zero).alias("field_errors"),
        readable.alias("readable"), (F.col("size_bytes") < min_bytes).alias("is_small"), *shown)
    return report.withColumn(
        "status",
        F.when(~F.col("readable") | (F.col("bad_lines") > 0) | (F.col("field_errors") > 0), "error")
        .when(F.col("is_small"), "warning").otherwise("valid"))


def overall_status(report: DataFrame) -> DataFrame:
    """One row: files per status and the status of the whole set; no files at all is an error."""
    counts = report.agg(
        F.count("*").alias("total_files"), F.count_if(F.col("status") == "valid").alias("valid_files"),
        F.count_if(F.col("status") != "valid").alias("invalid_files"),
        F.count_if("is_small").alias("warnings"),
        F.coalesce(F.sum(F.col("bad_lines") + F.col("field_errors") + (~F.col("readable")).cast("bigint")),
                   F.lit(0).cast("bigint")).alias("errors"))
    return counts.withColumn(
        "status", F.when((F.col("errors") > 0) | (F.col("total_files") == 0), "error")
        .when(F.col("warnings") > 0, "warning").otherwise("success"))


def quality_metrics(report: DataFrame) -> DataFrame:
    """One row: smallest, largest and mean file size and the share of valid files in percent."""
    return report.agg(
        F.min("size_bytes").alias("min_bytes"), F.max("size_bytes").alias("max_bytes"),
        F.round(F.avg("size_bytes"), 4).alias("avg_bytes"),
        F.round(F.avg((F.col("status") == "valid").cast("double")) * 100, 4).alias("validation_rate"))


def quality_totals(report: DataFrame, event_types: DataFrame, uniques: DataFrame | None = None) -> DataFrame:
    """One row for the whole archive: sizes and validation rate, error and warning totals, and events per type.

    `event_types` is that of `file_event_types`. The types are a map with as many entries as there are types; their
    counts are summed before they are gathered.
    """
    kinds = event_types.groupBy("event_type").agg(F.sum("event_count").alias("events"))
    kinds = kinds.agg(F.sum("events").alias("total_events"), F.count(F.lit(1)).alias("distinct_types"),
                      F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.coalesce("event_type", F.lit("unknown")), "events")))).alias("events_by_type"))
    return side_by_side(quality_metrics(report), overall_status(report), kinds)


def side_by_side(*frames: DataFrame) -> DataFrame:
    """Frames of one row each as one row, without a join."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return rows.agg(*[F.first(c, ignorenulls=True).alias(c) for c in rows.columns])


def error_rate_gate(checked: DataFrame, threshold: float = MAX_ERROR_RATE) -> DataFrame:
    """One row: lines, broken lines, their share and whether it stays within the threshold."""
    counted = checked.agg(F.count("*").alias("lines"), F.count_if("is_broken").alias("bad_lines"))
    rate = F.when(F.col("lines") > 0, F.col("bad_lines") / F.col("lines")).otherwise(F.lit(0.0))
    return counted.select("lines", "bad_lines", F.round(rate, 6).alias("error_rate"), (rate <= threshold).alias("passed"))


def found_hours(files: DataFrame) -> DataFrame:
    """Distinct archive hours among the file names; names without one are left out."""
    return files.select(file_time("file_path").alias("hour")).filter(F.col("hour").isNotNull()).distinct()


def missing_hours(found: DataFrame) -> DataFrame:
    """Hours between the first and last found hour that are not there, in order."""
    bounds = found.agg(F.min("hour").alias("start"), F.max("hour").alias("end"))
    return hours_between(bounds, "start", "end", inclusive=True).join(found, "hour", "left_anti").orderBy("hour")


def temporal_coverage(found: DataFrame) -> DataFrame:
    """One row: first and last hour, expected, found and missing hours and the coverage in percent.

    Every found hour lies between the first and the last, so the expected
    number follows from these two and no hour list has to be built.
    """
    one = found.agg(F.min("hour").alias("start_time"), F.max("hour").alias("end_time"), F.count("*").alias("found_hours"))
    expected = F.coalesce(F.timestamp_diff("HOUR", "start_time", "end_time") + 1, F.lit(0).cast("bigint"))
    return one.select(
        "start_time", "end_time", expected.alias("expected_hours"), "found_hours",
        (expected - F.col("found_hours")).alias("missing_hours"),
        F.when(expected > 0, F.round(F.col("found_hours") * 100 / expected, 4)).otherwise(F.lit(0.0)).alias("coverage_percentage"))


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are ignored."""
    return df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count("*").alias("occurrences")).filter("occurrences > 1")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per column, from one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns])).alias("e")).select("e.*")


def column_test_results(tables: dict[str, DataFrame], unique: dict[str, list[str]] | None = None,
                        not_null: dict[str, list[str]] | None = None) -> DataFrame:
    """Failures of every unique and not_null test of the given tables; zero means passed."""
    unique = UNIQUE_TESTS if unique is None else unique
    not_null = NOT_NULL_TESTS if not_null is None else not_null
    results = []
    for name, df in tables.items():
        for column in unique.get(name, []):
            results.append(duplicate_values(df, column).agg(F.count("*").alias("failures")).select(
                F.lit(name).alias("table_name"), F.lit(column).alias("column_name"),
                F.lit("unique").alias("test"), "failures"))
        if not_null.get(name):
            results.append(null_counts(df, not_null[name]).select(
                F.lit(name).alias("table_name"), "column_name", F.lit("not_null").alias("test"),
                F.col("nulls").alias("failures")))
    return reduce(DataFrame.unionByName, results)
