"""Raw archive and bronze: scans, file names, quarantine, manifests, storage and sinks."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourvault.functions.json_fields import canonical_hash
from hourvault.functions.names import object_key
from hourvault.functions.times import archive_name, file_date, file_hour, hours_between, parse_time, with_archive_paths
from hourvault.operators.bronze import (
    in_date_pattern, in_hour_range, only_event_types, parse_lines, quarantine, upper_case_columns, valid_lines)
from hourvault.operators.gold import actor_metrics, event_type_metrics, hourly_summary
from hourvault.operators.silver import silver_actors
from hourvault.schemas import BRONZE_EVENTS, GOLD, SILVER, ddl
from hourvault.session import shared_dir
from hourvault.sources.archive import ingest_manifest, pending_files, read_lines, run_statistics
from hourvault.sources.sinks import (
    append_warehouse_rows, load_gold_tables, load_once, pending_dates, read_loaded, write_bronze, write_gold, write_silver)
from hourvault.sources.storage import content_hashes, small_files, storage_stats, sync_plan
from hourvault.sources.tables import read_bronze, read_layer_table
from suite.base import archive_lines, bronze, events, flat, query, table, written_archive


@query("archive_scan", """
SELECT file_date || '-' || file_hour AS hour, count(*) AS lines FROM ev GROUP BY 1""")
def archive_scan(spark, sf_dir):
    lines = read_lines(spark, written_archive(spark, sf_dir), glob="*.gz")
    return lines.groupBy(F.regexp_extract("file_path", r"hour=([0-9-]+)", 1).alias("hour")).agg(F.count("*").alias("lines"))


@query("tolerant_parse", """
SELECT file_path, count(*) FILTER (event_id % 97 <> 0) AS good, count(*) FILTER (event_id % 97 = 0) AS bad
FROM ev GROUP BY 1""")
def tolerant_parse(spark, sf_dir):
    parsed = parse_lines(archive_lines(spark, sf_dir, "corrupt"))
    return parsed.groupBy("file_path").agg(F.count("event").alias("good"), F.count_if(F.col("event").isNull()).alias("bad"))


@query("quarantined_lines", """
SELECT file_path, '{"id":"' || substr(id || '","type"', 1, 3) AS value FROM ev WHERE event_id % 97 = 0""")
def quarantined_lines(spark, sf_dir):
    return quarantine(parse_lines(archive_lines(spark, sf_dir, "corrupt"))).select(
        "file_path", F.col("value").alias("value"))


@query("valid_line_hashes", """
SELECT count(*) AS events, count(DISTINCT event_id) AS hashes FROM ev WHERE event_id % 97 <> 0""")
def valid_line_hashes(spark, sf_dir):
    good = valid_lines(parse_lines(archive_lines(spark, sf_dir, "corrupt")))
    return good.agg(F.count("*").alias("events"), F.countDistinct(canonical_hash("event")).alias("hashes"))


@query("pending_files", """
SELECT DISTINCT file_path FROM ev WHERE ts >= TIMESTAMP '2024-01-16'""")
def pending(spark, sf_dir):
    files = archive_lines(spark, sf_dir).select("file_path").distinct()
    return pending_files(files, ingest_manifest(parse_lines(archive_lines(spark, sf_dir, "early"))))


@query("run_statistics", """
SELECT count(*) AS found, count(*) FILTER (early) AS skipped, count(*) FILTER (NOT early) AS processed,
       count(*) FILTER (NOT early AND bad = 0) AS successful, count(*) FILTER (NOT early AND bad > 0) AS failed
FROM (SELECT file_path, min(ts) < TIMESTAMP '2024-01-16' AS early, count(*) FILTER (event_id % 97 = 0) AS bad
      FROM ev GROUP BY 1)""")
def statistics(spark, sf_dir):
    manifest = ingest_manifest(parse_lines(archive_lines(spark, sf_dir, "corrupt")))
    files = manifest.select("file_path")
    early = archive_lines(spark, sf_dir, "early").select("file_path").distinct()
    return run_statistics(files, early, pending_files(manifest, early))


@query("file_name_dates", """
SELECT name, file_date, file_hour FROM (
  SELECT DISTINCT 'in/' || strftime(ts, '%Y-%m-%d-%H') || '.json.gz' AS name, file_date, file_hour FROM ev
  UNION SELECT DISTINCT 'in/' || strftime(ts, '%Y') || '-' || month(ts) || '-' || day(ts) || '-' || hour(ts) || '.json.gz', file_date, file_hour FROM ev
  UNION SELECT DISTINCT 'in/' || strftime(ts, '%Y/') || month(ts) || '/' || day(ts) || '/part.json.gz', file_date, '00' FROM ev
  UNION SELECT DISTINCT 'in/' || strftime(ts, '%Y-%m-%d') || '.json.gz', file_date, '00' FROM ev)""")
def file_name_dates(spark, sf_dir):
    ts = table(spark, sf_dir, "events").select("ts")
    shapes = ["yyyy-MM-dd-HH", "yyyy-M-d-H", "yyyy/M/d/'part'", "yyyy-MM-dd"]
    names = ts.select(F.explode(F.array(*[
        F.concat(F.lit("in/"), F.date_format("ts", s), F.lit(".json.gz")) for s in shapes])).alias("name")).distinct()
    return names.select("name", file_date("name").alias("file_date"), file_hour("name").alias("file_hour"))


@query("bronze_events", """
SELECT file_path AS file_name, file_date, file_hour, id AS event_id, kind AS event_type,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS created_at, user_id AS actor_id, login AS actor_login, k AS repo_id, repo AS repo_name
FROM ev""")
def bronze_projection(spark, sf_dir):
    return bronze(spark, sf_dir).drop("event_hash", "processed_at", "raw_data", "payload")


@query("bronze_partitions", """
SELECT file_date, file_hour, count(*) AS rows, count(DISTINCT id) AS ids FROM ev GROUP BY 1, 2""")
def bronze_partitions(spark, sf_dir):
    path = shared_dir(spark, "bronze")
    write_bronze(bronze(spark, sf_dir), path, rebalance=True)
    stored = spark.read.schema(ddl(BRONZE_EVENTS)).parquet(path)
    return stored.groupBy("file_date", "file_hour").agg(F.count("*").alias("rows"), F.countDistinct("event_id").alias("ids"))


@query("bronze_mixed_formats", """
SELECT kind AS event_type, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS id_sum FROM ev
GROUP BY 1""")
def bronze_mixed_formats(spark, sf_dir):
    parquet, csv = shared_dir(spark, "bronze-parquet"), shared_dir(spark, "bronze-csv")
    bronze(spark, sf_dir, "early").write.parquet(parquet)
    bronze(spark, sf_dir, "late").write.option("header", True).option("escape", '"').csv(csv)
    rows = read_bronze(spark, parquet, csv, ddl(BRONZE_EVENTS), "2024/1")
    return rows.groupBy("event_type").agg(F.count("*").alias("rows"), F.sum(F.col("event_id").cast("bigint")).alias("id_sum"))


@query("date_pattern", """
SELECT file_date, count(*) AS rows FROM ev WHERE file_date = '2024-01-05' GROUP BY 1""")
def date_pattern(spark, sf_dir):
    return in_date_pattern(bronze(spark, sf_dir), "2024/01/05").groupBy("file_date").agg(F.count("*").alias("rows"))


@query("unpadded_date_pattern", """
SELECT file_date, count(*) AS rows FROM ev WHERE file_date = '2024-01-01' GROUP BY 1""")
def unpadded_date_pattern(spark, sf_dir):
    return in_date_pattern(bronze(spark, sf_dir), "2024/1/1").groupBy("file_date").agg(F.count("*").alias("rows"))


@query("hour_range", """
SELECT file_date, file_hour, count(*) AS rows FROM ev
WHERE hour >= TIMESTAMP '2024-01-05 06:00:00' AND hour < TIMESTAMP '2024-01-07 18:00:00' GROUP BY 1, 2""")
def hour_range(spark, sf_dir):
    rows = in_hour_range(bronze(spark, sf_dir), "2024-01-05 06", "2024-01-07 18")
    return rows.groupBy("file_date", "file_hour").agg(F.count("*").alias("rows"))


@query("event_type_filter", """
SELECT kind AS event_type, count(*) AS rows FROM ev WHERE kind IN ('PushEvent', 'IssuesEvent') GROUP BY 1""")
def event_type_filter(spark, sf_dir):
    rows = only_event_types(bronze(spark, sf_dir), ["PushEvent", "IssuesEvent"])
    return rows.groupBy("event_type").agg(F.count("*").alias("rows"))


@query("layer_table_union", """
SELECT kind AS event_type, count(*) AS rows, count(DISTINCT user_id) AS actors FROM ev GROUP BY 1""")
def layer_table_union(spark, sf_dir):
    old, new = shared_dir(spark, "events-old"), shared_dir(spark, "events-new")
    events(spark, sf_dir, "early").drop("org_id").write.parquet(old)
    events(spark, sf_dir, "late").write.parquet(new)
    rows = read_layer_table(spark, [old, new, old, f"{new}-absent"])
    return rows.groupBy("event_type").agg(F.count("*").alias("rows"), F.countDistinct("actor_id").alias("actors"))


@query("silver_csv_sink", """
SELECT user_id AS actor_id, max(login) AS actor_login, min(ts) AS first_seen_at FROM ev GROUP BY 1""")
def silver_csv_sink(spark, sf_dir):
    path = shared_dir(spark, "actors-csv")
    write_silver(silver_actors(flat(spark, sf_dir)).withColumn("extra", F.lit(1)), path, SILVER["actors"], fmt="csv")
    stored = spark.read.option("header", True).csv(path)
    return stored.select(F.col("actor_id").cast("bigint").alias("actor_id"), "actor_login",
                         F.col("first_seen_at").cast("timestamp_ntz").alias("first_seen_at"))


@query("pending_dates", """
SELECT DISTINCT file_date FROM ev WHERE ts >= TIMESTAMP '2024-01-16'""")
def dates_left(spark, sf_dir):
    done = bronze(spark, sf_dir, "early").select("file_date")
    return pending_dates(bronze(spark, sf_dir), [done, bronze(spark, sf_dir).select("file_date"), done, done, done])


@query("gold_dated_sink", """
SELECT run_date, event_type, c AS count FROM (
  SELECT '2024-01-31' AS run_date, kind AS event_type, count(*) AS c FROM ev GROUP BY 2
  UNION ALL SELECT '2024-02-01', kind, count(*) FROM ev WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 2)""")
def gold_dated_sink(spark, sf_dir):
    path = shared_dir(spark, "event-types")
    early = event_type_metrics(events(spark, sf_dir, "early"))
    write_gold(early, path, "2024-01-31")
    write_gold(early, path, "2024-02-01")
    write_gold(event_type_metrics(events(spark, sf_dir)), path, "2024-01-31")
    return spark.read.parquet(path).select(F.date_format("run_date", "yyyy-MM-dd").alias("run_date"), "event_type", "count")


@query("warehouse_append", """
SELECT kind AS "EVENT_TYPE", count(*) AS "ROWS", count(DISTINCT user_id) AS "ACTORS" FROM ev GROUP BY 1""")
def warehouse_append(spark, sf_dir):
    path = shared_dir(spark, "warehouse")
    for part in ("early", "late"):
        append_warehouse_rows(bronze(spark, sf_dir, part), path)
    return spark.read.parquet(path).groupBy("EVENT_TYPE").agg(F.count("*").alias("ROWS"), F.countDistinct("ACTOR_ID").alias("ACTORS"))


@query("gold_bulk_load", """
SELECT 'actor_metrics' AS table_name, true AS success, count(DISTINCT user_id) AS rows, NULL AS error FROM ev
UNION ALL SELECT 'daily_summary', true, count(DISTINCT hour), NULL FROM ev
UNION ALL SELECT 'org_metrics', false, 0, 'PATH_NOT_FOUND' FROM (SELECT 1)""")
def gold_bulk_load(spark, sf_dir):
    source, target = shared_dir(spark, "stage"), shared_dir(spark, "loaded")
    silver = events(spark, sf_dir)
    actor_metrics(silver).write.parquet(f"{source}/actor_metrics")
    hourly_summary(silver).write.parquet(f"{source}/daily_summary")
    return load_gold_tables(spark, lambda n: f"{source}/{n}", lambda n: f"{target}/{n}",
                            ["actor_metrics", "daily_summary", "org_metrics"])


def _page_files(spark, sf_dir):
    """The pages as stored objects: path, size and content."""
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit("/data/raw/pages/"), F.col("page_id").cast("string"), F.lit(".html")).alias("file_path"),
        F.octet_length("html").cast("bigint").alias("size_bytes"), F.encode("html", "UTF-8").alias("content"))


@query("storage_stats", """
SELECT count(*) AS total_files, CAST(sum(strlen(html)) AS BIGINT) AS total_bytes, round(sum(strlen(html)) / 1048576, 4) AS total_mb FROM pages""")
def stats_of_files(spark, sf_dir):
    return storage_stats(_page_files(spark, sf_dir))


@query("content_hashes", """
SELECT '/data/raw/pages/' || page_id || '.html' AS file_path, CAST(strlen(html) AS BIGINT) AS size_bytes, md5(html) AS md5_hash FROM pages""")
def hashes_of_files(spark, sf_dir):
    return content_hashes(_page_files(spark, sf_dir))


@query("small_files", """
SELECT '/data/raw/pages/' || page_id || '.html' AS file_path, CAST(strlen(html) AS BIGINT) AS size_bytes FROM pages WHERE strlen(html) < 1000""")
def files_too_small(spark, sf_dir):
    return small_files(_page_files(spark, sf_dir), 1000).select("file_path", "size_bytes")


@query("sync_plan", """
SELECT 'raw/pages/' || page_id || '.html' AS object_key, CAST(strlen(html) AS BIGINT) AS size_bytes FROM pages
WHERE page_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')""")
def files_to_copy(spark, sf_dir):
    stored = table(spark, sf_dir, "documents").filter("lang = 'en'").select(
        F.concat(F.lit("raw/pages/"), F.col("doc_id").cast("string"), F.lit(".html")).alias("object_key"))
    return sync_plan(_page_files(spark, sf_dir), stored, "/data/raw/pages", "raw/pages").select("object_key", "size_bytes")


@query("object_keys", """
SELECT page_id, 'raw/pages/' || page_id || '.html' AS key_below_prefix, 'pages/' || page_id || '.html' AS key_below_base FROM pages""")
def keys_of_files(spark, sf_dir):
    path = F.concat(F.lit("/data\\raw/pages/"), F.col("page_id").cast("string"), F.lit(".html"))
    return table(spark, sf_dir, "pages").select(
        "page_id", object_key(path, "/data/raw/pages", "raw/pages").alias("key_below_prefix"),
        object_key(path, "/data/raw").alias("key_below_base"))


@query("ingest_manifest", """
SELECT file_path, count(*) AS lines, count(*) FILTER (event_id % 97 <> 0) AS events, count(*) FILTER (event_id % 97 = 0) AS bad_lines,
       count(*) FILTER (event_id % 97 = 0) = 0 AS success FROM ev GROUP BY 1""")
def manifest_of_files(spark, sf_dir):
    return ingest_manifest(parse_lines(archive_lines(spark, sf_dir, "corrupt")))


@query("expected_archive_hours", """
SELECT h AS hour, strftime(h, '%Y-%m-%d-%H') || '.json.gz' AS file_name, strftime(h, '%Y/%m/%d/%Y-%m-%d-%H') || '.json.gz' AS file_path
FROM (SELECT unnest(generate_series(lo, hi - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS h
      FROM (SELECT date_trunc('hour', min(ts)) AS lo, date_trunc('hour', max(ts)) AS hi FROM events))""")
def hours_expected(spark, sf_dir):
    bounds = table(spark, sf_dir, "events").agg(
        F.date_trunc("hour", F.min("ts")).cast("timestamp_ntz").alias("lo"),
        F.date_trunc("hour", F.max("ts")).cast("timestamp_ntz").alias("hi"))
    return with_archive_paths(hours_between(bounds, "lo", "hi"))


@query("upper_case_columns", """
SELECT id AS "EVENT_ID", kind AS "EVENT_TYPE", user_id AS "ACTOR_ID",
       CASE WHEN kind = 'WatchEvent' THEN '{"action":"started"}' END AS "PAYLOAD" FROM ev""")
def upper_case(spark, sf_dir):
    parsed = parse_lines(archive_lines(spark, sf_dir)).select(
        F.try_variant_get("event", "$.id", "string").alias("event_id"),
        F.try_variant_get("event", "$.type", "string").alias("event_type"),
        F.try_variant_get("event", "$.actor.id", "bigint").alias("actor_id"),
        F.try_variant_get("event", "$.payload", "variant").alias("payload"))
    return upper_case_columns(parsed.withColumn("payload", F.when(F.col("event_type") == "WatchEvent", F.col("payload"))))


@query("bulk_load_once", """
, r AS (SELECT 'first' AS load, count(*) AS n, count(*) FILTER (event_id % 10 = 0) AS bad FROM ev WHERE ts < TIMESTAMP '2024-01-16'
        UNION ALL SELECT 'second', count(*), count(*) FILTER (event_id % 10 = 0) FROM ev WHERE ts >= TIMESTAMP '2024-01-16')
SELECT load, n AS rows, bad AS rejected_actors, 'loaded' AS status FROM r UNION ALL SELECT 'third', 0, 0, NULL
UNION ALL SELECT 'table', count(*), count(*) FILTER (event_id % 10 = 0), NULL FROM ev""")
def bulk_load_once(spark, sf_dir):
    """Three loads of a folder: all its files, those that came since, and none; and what the table holds then."""
    root = shared_dir(spark, "loads")
    columns = {"event_id": "bigint", "actor_id": "bigint", "event_type": "string", "absent": "int"}
    parts = []
    for load, variant in (("first", "early"), ("second", "late"), ("third", None)):
        if variant:
            rows = events(spark, sf_dir, variant)
            bad = F.col("event_id").cast("bigint") % 10 == 0
            rows.select("event_id", F.when(bad, "no number").otherwise(F.col("actor_id").cast("string")).alias("actor_id"), "event_type").write.parquet(f"{root}/in/{variant}")
        report = load_once(spark, f"{root}/in", f"{root}/table", columns, f"{root}/ledger")
        rejected = F.coalesce(F.try_element_at("rejects", F.lit("actor_id")), F.lit(0))
        parts.append(report.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"), F.coalesce(F.sum(rejected), F.lit(0)).cast("bigint").alias("rejected_actors"),
                                F.max("status").alias("status")).select(F.lit(load).alias("load"), "*"))
    table = read_loaded(spark, f"{root}/table", columns).agg(F.count("*").alias("rows"), F.count_if(F.col("actor_id").isNull()).alias("rejected_actors"))
    parts.append(table.select(F.lit("table").alias("load"), "*", F.lit(None).cast("string").alias("status")))
    return reduce(DataFrame.unionByName, parts)
