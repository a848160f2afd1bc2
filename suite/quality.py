"""Data quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourvault.functions.times import archive_path
from hourvault.operators import quality as q
from hourvault.operators.bronze import parse_lines
from hourvault.operators.gold import gold_tables
from hourvault.operators.silver import silver_tables
from hourvault.sources import damage
from hourvault.sources.archive import ingest_manifest
from hourvault.session import shared_dir
from hourvault.sources.sinks import write_report
from hourvault.sources.storage import read_contents
from suite.base import archive_lines, bronze, events, flat, query, written_archive

# Rules that hold for part of the documents only, so that every kind of error occurs.
REQUIRED = ["id", "actor", "org", "public"]
TYPES = {"id": "string", "public": "boolean", "repo": "array", "payload": "object", "created_at": "number"}


def _parsed(spark, sf_dir, variant="plain"):
    return parse_lines(archive_lines(spark, sf_dir, variant))


def _checked(spark, sf_dir, variant="plain", required=None, types=None):
    return q.checked_lines(_parsed(spark, sf_dir, variant), required, types)


def _files(spark, sf_dir, variant="plain"):
    """Listing of the archive files with a size that stands for the stored bytes."""
    lines = archive_lines(spark, sf_dir, variant)
    return lines.groupBy("file_path").agg((F.count("*") * 100).alias("size_bytes"))


ERRORS_SQL = """
, errors AS (
  SELECT file_path, event_id AS line_id, 'actor' AS field, 'missing' AS problem, NULL AS expected, NULL AS found FROM ev WHERE event_id % 50 = 0
  UNION ALL SELECT file_path, event_id, 'org', 'missing', NULL, NULL FROM ev WHERE org IS NULL
  UNION ALL SELECT file_path, event_id, 'public', 'missing', NULL, NULL FROM ev WHERE event_id % 10 = 0
  UNION ALL SELECT file_path, event_id, 'repo', 'type', 'array', 'object' FROM ev
  UNION ALL SELECT file_path, event_id, 'created_at', 'type', 'number', 'string' FROM ev)
"""


@query("field_errors", ERRORS_SQL + "SELECT * FROM errors")
def field_errors(spark, sf_dir):
    return q.field_errors(_checked(spark, sf_dir, "no_actor", REQUIRED, TYPES))


@query("required_fields", ERRORS_SQL + "SELECT field, count(*) AS events FROM errors WHERE problem = 'missing' GROUP BY 1")
def required_fields(spark, sf_dir):
    return q.field_errors(_checked(spark, sf_dir, "no_actor", REQUIRED)).groupBy("field").agg(F.count("*").alias("events"))


@query("capped_errors", ERRORS_SQL + """
SELECT file_path, line_id, field, problem, expected, found, CAST(error_number AS INTEGER) AS error_number, greatest(total - 20, 0) AS omitted FROM (
  SELECT *, row_number() OVER (PARTITION BY file_path ORDER BY line_id, field, problem) AS error_number,
         count(*) OVER (PARTITION BY file_path) AS total FROM errors) WHERE error_number <= 20""")
def capped_errors(spark, sf_dir):
    return q.capped_errors(_checked(spark, sf_dir, "no_actor", REQUIRED, TYPES))


@query("file_uniques", """
SELECT file_path, count(*) AS events, count(DISTINCT CASE WHEN event_id % 50 <> 0 THEN user_id END) AS unique_actors,
       count(DISTINCT k) AS unique_repos, count(DISTINCT kind) AS unique_types FROM ev GROUP BY 1""")
def file_uniques(spark, sf_dir):
    return q.file_uniques(_checked(spark, sf_dir, "no_actor"))


@query("file_event_types", """
SELECT file_path, kind AS event_type, count(*) AS event_count FROM ev GROUP BY 1, 2""")
def file_event_types(spark, sf_dir):
    return q.file_event_types(_checked(spark, sf_dir))


STATUS_SQL = """
, files AS (
  SELECT file_path, count(*) * 100 AS size_bytes, max(hour) AS hour, count(*) AS n, count(*) FILTER (event_id % 97 = 0) AS bad FROM ev GROUP BY 1),
report AS (
  SELECT file_path, size_bytes, CASE WHEN readable THEN n ELSE 0 END AS lines, CASE WHEN readable THEN bad ELSE 0 END AS bad_lines,
         CAST(0 AS BIGINT) AS field_errors, readable, size_bytes < 1000 AS is_small,
         CASE WHEN NOT readable OR bad > 0 THEN 'error' WHEN size_bytes < 1000 THEN 'warning' ELSE 'valid' END AS status
  FROM (SELECT *, hour(hour) <> 23 AS readable FROM files))
"""


def _report(spark, sf_dir):
    """Status of all files when the files of hour 23 cannot be opened."""
    lines = archive_lines(spark, sf_dir, "corrupt").filter(~F.col("file_path").endswith("-23.json.gz"))
    return q.file_status(q.checked_lines(parse_lines(lines)), _files(spark, sf_dir))


@query("file_status", STATUS_SQL + "SELECT * FROM report")
def file_status(spark, sf_dir):
    return _report(spark, sf_dir)


# A damaged copy of every file of some hours: hour 3 is cut, 9 has a wrong checksum, 15 is no gzip, 21 has no byte.
DAMAGE_SQL = """
, files AS (SELECT file_path, hour(hour) AS h, n FROM (SELECT file_path, max(hour) AS hour, count(*) AS n FROM ev GROUP BY 1)),
state AS (SELECT *, CASE h WHEN 3 THEN 'cut' WHEN 9 THEN 'broken' WHEN 15 THEN 'foreign' WHEN 21 THEN 'empty' ELSE 'sound' END AS health FROM files)
"""


def _damaged(spark, sf_dir):
    """Contents of the stored archive with damage by hour, under the archive's own file names."""
    hour = F.to_timestamp(F.regexp_extract("file_path", r"hour=([0-9-]+)", 1), "yyyy-MM-dd-HH").cast("timestamp_ntz")
    rows = read_contents(spark, written_archive(spark, sf_dir), "*.gz").withColumn("hour", hour)
    h, n = F.hour("hour"), F.length("content")
    content = (F.when(h == 3, F.substring("content", F.lit(1), n - 12)).when(h == 9, F.concat(F.substring("content", F.lit(1), n - 8), F.unhex(F.lit("0000000000000000"))))
               .when(h == 15, F.encode(F.lit("no gzip"), "utf-8")).when(h == 21, F.unhex(F.lit(""))).otherwise(F.col("content")))
    return rows.select(F.concat(F.lit("archive/"), archive_path("hour")).alias("file_path"), F.lit(5000).cast("bigint").alias("size_bytes"), content.alias("content"))


@query("file_health", DAMAGE_SQL + """
SELECT file_path, health, CASE WHEN health IN ('sound', 'broken') THEN n WHEN health <> 'cut' THEN 0 END AS lines,
       CASE health WHEN 'sound' THEN 1 ELSE 0 END AS members, CASE WHEN health NOT IN ('sound', 'empty') THEN 0::BIGINT END AS damaged_at FROM state""")
def file_health(spark, sf_dir):
    found = damage.file_health(_damaged(spark, sf_dir))
    return found.select("file_path", "health", F.when(F.col("health") != "cut", F.col("readable_lines")).alias("lines"), "members", "damaged_at")


@query("file_status_of_damaged_files", DAMAGE_SQL + """
SELECT file_path, health, CASE health WHEN 'sound' THEN n END AS lines, health IN ('sound', 'empty') AS readable,
       CASE WHEN health = 'empty' THEN 'warning' WHEN health = 'sound' THEN 'valid' ELSE 'error' END AS status FROM state""")
def file_status_of_damaged_files(spark, sf_dir):
    """Lines are those in front of the damage; how many these are depends on the packing, so only sound files show it here."""
    contents = _damaged(spark, sf_dir).withColumn("size_bytes", F.when(F.length("content") == 0, 0).otherwise(F.col("size_bytes")))
    checked = q.checked_lines(parse_lines(damage.salvaged_lines(contents)))
    # The last line in front of the damage can be cut too; that is the damage's error, not the line's.
    report = q.file_status(checked.filter("NOT is_broken"), contents, health=damage.file_health(contents))
    return report.select("file_path", "health", F.when(F.col("health") == "sound", F.col("lines")).alias("lines"), "readable", "status")


@query("quality_totals", STATUS_SQL + """
, kinds AS (SELECT kind, count(*) AS n FROM ev WHERE hour(ts) <> 23 AND event_id % 97 <> 0 GROUP BY 1)
SELECT min(size_bytes) AS min_bytes, max(size_bytes) AS max_bytes, round(avg(size_bytes), 4) AS avg_bytes,
       round(avg(CASE WHEN status = 'valid' THEN 1.0::DOUBLE ELSE 0 END) * 100, 4) AS validation_rate,
       count(*) AS total_files, count(*) FILTER (status = 'valid') AS valid_files, count(*) FILTER (status <> 'valid') AS invalid_files,
       count(*) FILTER (is_small) AS warnings, CAST(sum(bad_lines) + count(*) FILTER (NOT readable) AS BIGINT) AS errors,
       CASE WHEN sum(bad_lines) + count(*) FILTER (NOT readable) > 0 THEN 'error' WHEN bool_or(is_small) THEN 'warning' ELSE 'success' END AS status,
       (SELECT CAST(sum(n) AS BIGINT) FROM kinds) AS total_events, (SELECT count(*) FROM kinds) AS distinct_types,
       (SELECT string_agg(kind || '=' || n, ',' ORDER BY kind) FROM kinds) AS events_by_type
FROM report""")
def quality_totals(spark, sf_dir):
    lines = archive_lines(spark, sf_dir, "corrupt").filter(~F.col("file_path").endswith("-23.json.gz"))
    kinds = q.file_event_types(q.checked_lines(parse_lines(lines)))
    pairs = F.transform(F.array_sort(F.map_entries("events_by_type")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return q.quality_totals(_report(spark, sf_dir), kinds).withColumn("events_by_type", F.array_join(pairs, ","))


@query("stored_report", ERRORS_SQL + """
SELECT 'errors' AS frame, field AS name, count(*) AS n FROM errors GROUP BY field
UNION ALL SELECT 'shown', 'most in a file', max(n) FROM (SELECT least(count(*), 20) AS n FROM errors GROUP BY file_path)
UNION ALL SELECT 'event_types', kind, count(*) FROM ev GROUP BY kind UNION ALL SELECT 'files', 'error', count(DISTINCT file_path) FROM errors""")
def stored_report(spark, sf_dir):
    """A report with all field errors beside the shown ones, written and read back."""
    path = shared_dir(spark, "report")
    _checked(spark, sf_dir, "no_actor", REQUIRED, TYPES).write.parquet(f"{path}/checked")
    checked = spark.read.parquet(f"{path}/checked")
    write_report({"files": q.file_status(checked, _files(spark, sf_dir)), "event_types": q.file_event_types(checked), "all_errors": q.field_errors(checked),
                  "errors": q.capped_errors(checked)}, f"{path}/report")
    frame = lambda name: spark.read.json(f"{path}/report/{name}")
    return (frame("all_errors").groupBy(F.lit("errors").alias("frame"), F.col("field").alias("name")).agg(F.count("*").alias("n"))
            .union(frame("errors").groupBy("file_path").count().agg(F.max("count").alias("n")).select(F.lit("shown"), F.lit("most in a file"), "n"))
            .union(frame("event_types").groupBy("event_type").agg(F.sum("event_count").alias("n")).select(F.lit("event_types"), "event_type", "n"))
            .union(frame("files").groupBy("status").agg(F.count("*").alias("n")).select(F.lit("files"), "status", "n")))


@query("file_status_with_rules", """
SELECT file_path, count(*) FILTER (event_id % 10 = 0) AS field_errors, CASE WHEN count(*) FILTER (event_id % 10 = 0) > 0 THEN 'error'
       WHEN count(*) < 10 THEN 'warning' ELSE 'valid' END AS status FROM ev GROUP BY 1""")
def file_status_with_rules(spark, sf_dir):
    checked = _checked(spark, sf_dir, required=["public"], types={"id": "string"})
    return q.file_status(checked, _files(spark, sf_dir)).select("file_path", "field_errors", "status")


@query("overall_status", STATUS_SQL + """
SELECT count(*) AS total_files, count(*) FILTER (status = 'valid') AS valid_files, count(*) FILTER (status <> 'valid') AS invalid_files,
       count(*) FILTER (is_small) AS warnings, CAST(sum(bad_lines) + count(*) FILTER (NOT readable) AS BIGINT) AS errors,
       CASE WHEN sum(bad_lines) + count(*) FILTER (NOT readable) > 0 THEN 'error' WHEN bool_or(is_small) THEN 'warning' ELSE 'success' END AS status
FROM report""")
def overall_status(spark, sf_dir):
    return q.overall_status(_report(spark, sf_dir))


@query("quality_metrics", STATUS_SQL + """
SELECT min(size_bytes) AS min_bytes, max(size_bytes) AS max_bytes, round(avg(size_bytes), 4) AS avg_bytes,
       round(avg(CASE WHEN status = 'valid' THEN 1.0::DOUBLE ELSE 0 END) * 100, 4) AS validation_rate FROM report""")
def quality_metrics(spark, sf_dir):
    return q.quality_metrics(_report(spark, sf_dir))


@query("error_rate_gate", """
SELECT count(*) AS lines, count(*) FILTER (event_id % 97 = 0) AS bad_lines, round(count(*) FILTER (event_id % 97 = 0) / count(*), 6) AS error_rate,
       count(*) FILTER (event_id % 97 = 0) / count(*) <= 0.05 AS passed FROM ev""")
def error_rate_gate(spark, sf_dir):
    return q.error_rate_gate(_checked(spark, sf_dir, "corrupt"))


@query("first_lines", """
SELECT file_path, event_id AS line_id FROM ev QUALIFY row_number() OVER (PARTITION BY file_path ORDER BY event_id) <= 5""")
def first_lines(spark, sf_dir):
    return q.first_lines(archive_lines(spark, sf_dir), 5).select("file_path", "line_id")


@query("found_hours", """
SELECT DISTINCT hour FROM ev WHERE hour(ts) % 6 <> 0""")
def found_hours(spark, sf_dir):
    return q.found_hours(archive_lines(spark, sf_dir, "gaps"))


COVERAGE_SQL = """
, found AS (SELECT DISTINCT hour FROM ev WHERE hour(ts) % 6 <> 0),
expected AS (SELECT unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour FROM found)
"""


@query("missing_hours", COVERAGE_SQL + "SELECT hour FROM expected EXCEPT SELECT hour FROM found")
def missing_hours(spark, sf_dir):
    return q.missing_hours(q.found_hours(archive_lines(spark, sf_dir, "gaps")))


@query("temporal_coverage", COVERAGE_SQL + """
SELECT min(f.hour) AS start_time, max(f.hour) AS end_time, count(*) AS expected_hours, count(f.hour) AS found_hours,
       count(*) - count(f.hour) AS missing_hours, round(count(f.hour) * 100 / count(*), 4) AS coverage_percentage
FROM expected e LEFT JOIN found f ON e.hour = f.hour""")
def temporal_coverage(spark, sf_dir):
    return q.temporal_coverage(q.found_hours(archive_lines(spark, sf_dir, "gaps")))


@query("duplicate_ids", """
SELECT id AS value, CAST(2 AS BIGINT) AS occurrences FROM ev WHERE event_id % 20 = 0""")
def duplicate_ids(spark, sf_dir):
    return q.duplicate_values(bronze(spark, sf_dir, "repeated"), "event_id")


@query("null_counts", """
SELECT 'event_id' AS column_name, 0 AS nulls FROM ev UNION SELECT 'actor_id', count(*) FILTER (event_id % 50 = 0) FROM ev
UNION SELECT 'org_id', count(*) FILTER (org IS NULL) FROM ev""")
def null_counts(spark, sf_dir):
    return q.null_counts(events(spark, sf_dir, "no_actor"), ["event_id", "actor_id", "org_id"])


@query("column_tests_pass", """
SELECT count(*) * 0 + 29 AS tests, CAST(0 AS BIGINT) AS failures FROM ev""")
def column_tests_pass(spark, sf_dir):
    path = shared_dir(spark, "flat")
    flat(spark, sf_dir).write.parquet(path)
    silver = silver_tables(spark.read.parquet(path))
    gold = gold_tables(silver["events"], silver["actors"], silver["repositories"], silver["organizations"])
    results = q.column_test_results({**silver, **gold})
    return results.agg(F.count("*").alias("tests"), F.sum("failures").alias("failures"))


@query("column_tests_fail", """
SELECT 'events' AS table_name, 'event_id' AS column_name, 'unique' AS test, count(*) FILTER (event_id % 20 = 0) AS failures FROM ev
UNION ALL SELECT 'events', 'actor_id', 'not_null', 0 FROM ev WHERE false
UNION ALL SELECT 'events', 'event_id', 'not_null', 0 FROM (SELECT 1)
UNION ALL SELECT 'events', 'repo_id', 'not_null', 0 FROM (SELECT 1)
UNION ALL SELECT 'raw', 'actor_id', 'not_null', count(*) FILTER (event_id % 50 = 0) FROM ev""")
def column_tests_fail(spark, sf_dir):
    return q.column_test_results(
        {"events": bronze(spark, sf_dir, "repeated"), "raw": events(spark, sf_dir, "no_actor")},
        {"events": ["event_id"]}, {"events": ["event_id", "repo_id"], "raw": ["actor_id"]})


@query("load_statistics", """
SELECT kind AS event_type, count(*) AS files, CAST(sum(n) AS BIGINT) AS events, max(n) AS most_per_file FROM (
  SELECT kind, file_path, count(*) AS n FROM ev GROUP BY 1, 2) GROUP BY 1""")
def load_statistics(spark, sf_dir):
    per_file = q.file_event_types(_checked(spark, sf_dir))
    return per_file.groupBy("event_type").agg(F.count("*").alias("files"), F.sum("event_count").alias("events"), F.max("event_count").alias("most_per_file"))


@query("file_sizes", """
SELECT file_path, CAST(count(*) * 100 AS BIGINT) AS size_bytes, count(*) AS events FROM ev GROUP BY 1 HAVING count(*) * 100 < 1000""")
def file_sizes(spark, sf_dir):
    manifest = ingest_manifest(_parsed(spark, sf_dir)).select("file_path", "events")
    small = _files(spark, sf_dir).filter(F.col("size_bytes") < q.MIN_FILE_BYTES)
    return small.join(manifest, "file_path")
