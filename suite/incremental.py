"""Incremental loads: new rows, fact merges, dimension upserts and file streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourvault.operators.silver import payload_details, silver_actors, silver_events, readable_repositories, repository_increment, silver_organizations
from hourvault.operators.upsert import carry_first_seen, merge_facts, new_rows, one_per_key, upsert_dimension, within_span
from hourvault.operators import distincts
from hourvault.operators.repeats import hits, id_filters
from hourvault.plans import medallion
from hourvault.plans.store import Store
from hourvault.session import shared_dir
from hourvault.sources.tables import has_files
from hourvault.streaming.ingest import ingest_bronze, ingest_quarantine, merge_batches, stream_lines, without_repeats
from hourvault.streaming.summary import MEASURES, hourly_summary_stream, read_summary, store_summary
from hourvault.schemas import SILVER, ddl
from suite.base import archive_lines, bronze, events, flat, query, table, written_archive
from suite.silver import PAYLOAD_SQL, REPOSITORIES_SQL


@query("new_events_only", """
SELECT id AS event_id, ts AS created_at FROM ev WHERE ts >= TIMESTAMP '2024-01-16'""")
def new_events_only(spark, sf_dir):
    return new_rows(events(spark, sf_dir), events(spark, sf_dir, "early"), "event_id").select("event_id", "created_at")


@query("new_rows_with_null_keys", """
SELECT count(*) AS rows, count(*) FILTER (event_id % 50 = 0) AS null_keys FROM ev
WHERE event_id % 50 = 0 OR user_id NOT IN (SELECT user_id FROM ev WHERE ts < TIMESTAMP '2024-01-16')""")
def new_rows_with_null_keys(spark, sf_dir):
    known = events(spark, sf_dir, "early").select("actor_id").unionByName(events(spark, sf_dir, "no_actor").filter("actor_id IS NULL").select("actor_id"))
    fresh = new_rows(events(spark, sf_dir, "no_actor"), known, "actor_id")
    return fresh.agg(F.count("*").alias("rows"), F.count_if(F.col("actor_id").isNull()).alias("null_keys"))


@query("span_pruning", """
SELECT count(*) AS rows, min(ts) AS first_event FROM ev WHERE ts >= (SELECT min(ts) FROM ev WHERE ts >= TIMESTAMP '2024-01-16')""")
def span_pruning(spark, sf_dir):
    kept = within_span(events(spark, sf_dir), events(spark, sf_dir, "late"), "created_at")
    return kept.agg(F.count("*").alias("rows"), F.min("created_at").alias("first_event"))


@query("merged_facts", """
SELECT id AS event_id, CASE WHEN ts >= TIMESTAMP '2024-01-10' THEN 'new' ELSE 'old' END AS source FROM ev""")
def merged_facts(spark, sf_dir):
    target = events(spark, sf_dir, "early").select("event_id", F.lit("old").alias("source"))
    source = events(spark, sf_dir).filter(F.col("created_at") >= F.lit("2024-01-10").cast("timestamp_ntz")).select("event_id", F.lit("new").alias("source"))
    return merge_facts(target, source, "event_id")


@query("merged_payloads", PAYLOAD_SQL)
def merged_payloads(spark, sf_dir):
    return merge_facts(payload_details(flat(spark, sf_dir, "early")), payload_details(flat(spark, sf_dir, "late")), "event_id")


@query("one_per_key", """
SELECT id AS event_id, kind AS event_type FROM ev""")
def single_copies(spark, sf_dir):
    return one_per_key(bronze(spark, sf_dir, "repeated").select("event_hash", "event_id", "event_type"), "event_hash").drop("event_hash")


@query("upsert_actors", """
SELECT user_id AS actor_id, max(login) AS actor_login, min(ts) AS first_seen_at, max(ts) AS last_seen_at FROM ev GROUP BY 1""")
def upsert_actors(spark, sf_dir):
    merged = upsert_dimension(silver_actors(flat(spark, sf_dir, "early")), silver_actors(flat(spark, sf_dir, "late")), "actor_id")
    return merged.select("actor_id", "actor_login", "first_seen_at", "last_seen_at")


@query("upsert_repositories", REPOSITORIES_SQL)
def upsert_repositories(spark, sf_dir):
    merged = upsert_dimension(repository_increment(flat(spark, sf_dir, "early")), repository_increment(flat(spark, sf_dir, "late")), "repo_id", prefer="max")
    return readable_repositories(merged).drop("repo_url", "owner_id", "created_at", "updated_at")


@query("upsert_repositories_new_wins", """
SELECT k AS repo_id, coalesce(max(pr_id % 1000) FILTER (ts >= TIMESTAMP '2024-01-16'), max(pr_id % 1000)) AS stars_count, max(language) AS language, coalesce(max(pr_id IS NOT NULL AND k % 5 = 0), false) AS is_fork FROM ev GROUP BY 1""")
def upsert_repositories_new_wins(spark, sf_dir):
    merged = upsert_dimension(repository_increment(flat(spark, sf_dir, "early")), repository_increment(flat(spark, sf_dir, "late")), "repo_id")
    return readable_repositories(merged).select("repo_id", "stars_count", "language", "is_fork")


@query("upsert_organizations", """
SELECT org AS org_id, max(org_name) AS org_login, min(ts) AS first_seen_at, max(ts) AS last_seen_at FROM ev WHERE org IS NOT NULL GROUP BY 1""")
def upsert_organizations(spark, sf_dir):
    merged = upsert_dimension(silver_organizations(flat(spark, sf_dir, "early")), silver_organizations(flat(spark, sf_dir, "late")), "org_id")
    return merged.select("org_id", "org_login", "first_seen_at", "last_seen_at")


@query("carried_first_seen", """
SELECT user_id AS actor_id, min(ts) AS first_seen_at FROM ev GROUP BY 1 HAVING max(ts) >= TIMESTAMP '2024-01-16'""")
def carried_first_seen(spark, sf_dir):
    late = silver_actors(flat(spark, sf_dir, "late"))
    return carry_first_seen(late, silver_actors(flat(spark, sf_dir, "early")), "actor_id").select("actor_id", "first_seen_at")


@query("stream_ingest", """
SELECT kind AS event_type, count(*) AS events, CAST(sum(event_id) AS BIGINT) AS id_sum FROM ev GROUP BY 1""")
def stream_ingest(spark, sf_dir):
    """Two runs over the same files: the second finds nothing new."""
    source, root = written_archive(spark, sf_dir), shared_dir(spark, "stream")
    for _ in range(2):
        ingest_bronze(stream_lines(spark, source, glob="*.gz"), f"{root}/bronze", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/bronze").groupBy("event_type").agg(
        F.count("*").alias("events"), F.sum(F.col("event_id").cast("bigint")).alias("id_sum"))


@query("stream_quarantine", """
SELECT '{"id":"' || substr(id || '","type"', 1, 3) AS value FROM ev WHERE event_id % 97 = 0""")
def stream_quarantine(spark, sf_dir):
    source, root = written_archive(spark, sf_dir, "corrupt"), shared_dir(spark, "stream")
    ingest_quarantine(stream_lines(spark, source, glob="*.gz"), f"{root}/bad", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/bad").select("value")


def _event_stream(spark, sf_dir, variant):
    """Silver events of a variant, stored once and read as a stream."""
    path = shared_dir(spark, "events")
    events(spark, sf_dir, variant).write.parquet(path)
    return spark.readStream.schema(ddl(SILVER["events"])).parquet(path)


@query("stream_without_repeats", """
SELECT kind AS event_type, count(*) AS events, count(DISTINCT event_id) AS ids FROM ev GROUP BY 1""")
def stream_without_repeats(spark, sf_dir):
    root = shared_dir(spark, "stream")
    rows = _event_stream(spark, sf_dir, "repeated").withColumn("created_at", F.col("created_at").cast("timestamp"))
    (without_repeats(rows, "40 days").writeStream.format("parquet").option("path", f"{root}/out")
     .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{root}/out").groupBy("event_type").agg(F.count("*").alias("events"), F.countDistinct("event_id").alias("ids"))


@query("stream_merge", """
SELECT id AS event_id, kind AS event_type FROM ev""")
def stream_merge(spark, sf_dir):
    """Micro-batches merged by key into a table of numbered versions, over rows that were partly there."""
    root = shared_dir(spark, "merge")
    events(spark, sf_dir, "early").write.parquet(f"{root}/v-first")
    current = {"path": f"{root}/v-first"}

    def read():
        return spark.read.parquet(current["path"]) if has_files(spark, current["path"]) else None

    def write(df, batch_id):
        path = f"{root}/v-{batch_id}"
        df.write.mode("overwrite").parquet(path)
        current["path"] = path

    merge_batches(_event_stream(spark, sf_dir, "repeated"), read, write, "event_id", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(current["path"]).select("event_id", "event_type")


@query("stream_hourly_summary", """
SELECT hour AS hour_bucket, count(*) AS total_events FROM ev GROUP BY 1""")
def stream_hourly_summary(spark, sf_dir):
    """The event totals of the streamed summary; its distinct counts are sketches."""
    root = shared_dir(spark, "stream")
    rows = _event_stream(spark, sf_dir, "plain").withColumn("created_at", F.col("created_at").cast("timestamp"))
    summary = hourly_summary_stream(rows)
    name = f"hours_{root[-12:]}"
    summary.writeStream.outputMode("complete").format("memory").queryName(name).option(
        "checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.table(name).select("hour_bucket", "total_events")


_STORES: dict[tuple[str, str], Store] = {}


def loaded_store(spark, sf_dir):
    """Bronze and silver after two loads of one folder, made once per application.

    The second load brings another file of every hour, repeats of loaded events and broken lines.
    """
    place = (spark.sparkContext.applicationId, sf_dir)
    if place not in _STORES:
        root = shared_dir(spark, "two-loads")
        store, source = Store(f"{root}/store"), f"{root}/raw"
        for part in ("first_half", "second_half"):
            hour = F.regexp_extract("file_path", r"(\d{4}-\d{2}-\d{2}-\d{2})", 1)
            (archive_lines(spark, sf_dir, part).select("value", hour.alias("hour")).repartition("hour").write.partitionBy("hour")
             .option("compression", "gzip").text(f"{source}/{part}"))
            before = medallion.loaded_batches(spark, store)
            medallion.load_bronze(spark, source, store, glob="*.gz")
            medallion.load_silver(spark, store, part)
            medallion.record_run(spark, source, store, part, before, glob="*.gz")
        _STORES[place] = store
    return _STORES[place]


# Events of the two loads: odd ones are cut where 97 divides them, even ones come whole with the first load.
HALVES_SQL = ", kept AS (SELECT * FROM ev WHERE event_id % 2 = 0 OR event_id % 97 <> 0) "


@query("late_file_of_loaded_hour", HALVES_SQL + """
SELECT id AS event_id, kind AS event_type, ts AS created_at, file_date, file_hour AS hour_bucket FROM kept""")
def late_file_of_loaded_hour(spark, sf_dir):
    return loaded_store(spark, sf_dir).read_fact(spark, "events").select("event_id", "event_type", "created_at", "file_date", "hour_bucket")


@query("stored_manifest", """
, second AS (SELECT * FROM ev WHERE event_id % 2 = 1 OR event_id % 50 = 0)
SELECT 'first_half' AS part, file_date, file_hour, count(*) AS lines, count(*) AS events, CAST(0 AS BIGINT) AS bad_lines, true AS success FROM ev WHERE event_id % 2 = 0 GROUP BY ALL
UNION ALL SELECT 'second_half', file_date, file_hour, count(*), count(*) FILTER (event_id % 97 <> 0), count(*) FILTER (event_id % 97 = 0),
  count(*) FILTER (event_id % 97 = 0) = 0 FROM second GROUP BY ALL""")
def stored_manifest(spark, sf_dir):
    store = loaded_store(spark, sf_dir)
    rows = medallion.read_manifest(spark, store, medallion.loaded_batches(spark, store))
    return rows.select(F.regexp_extract("file_name", "(first|second)_half", 0).alias("part"), "file_date", "file_hour", "lines", "events", "bad_lines", "success")


@query("stored_run_statistics", HALVES_SQL + """
, h AS (SELECT count(DISTINCT file_path) FILTER (event_id % 2 = 0) AS f1, count(DISTINCT file_path) FILTER (event_id % 2 = 1 OR event_id % 50 = 0) AS f2,
  count(DISTINCT file_path) FILTER (event_id % 97 = 0 AND (event_id % 2 = 1 OR event_id % 50 = 0)) AS bad, count(*) FILTER (event_id % 2 = 0) AS n1,
  count(*) FILTER (event_id % 2 = 1 OR event_id % 50 = 0) AS n2, count(*) FILTER (event_id % 97 = 0 AND (event_id % 2 = 1 OR event_id % 50 = 0)) AS b2 FROM ev),
t AS (SELECT count(*) AS n, count(DISTINCT user_id) AS a, count(DISTINCT k) AS r, count(DISTINCT org) AS o FROM kept),
e AS (SELECT count(*) AS n, count(DISTINCT user_id) AS a, count(DISTINCT k) AS r, count(DISTINCT org) AS o FROM ev WHERE event_id % 2 = 0)
SELECT 'first_half' AS run_date, f1 AS found, 0::BIGINT AS skipped, f1 AS processed, f1 AS successful, 0::BIGINT AS failed, n1 AS lines, 0::BIGINT AS bad_lines,
  'actors=' || e.a || ',events=' || e.n || ',organizations=' || e.o || ',payload_details=' || e.n || ',repositories=' || e.r AS table_rows FROM h, e
UNION ALL SELECT 'second_half', f1 + f2, f1, f2, f2 - bad, bad, n2, b2,
  'actors=' || t.a || ',events=' || t.n || ',organizations=' || t.o || ',payload_details=' || t.n || ',repositories=' || t.r FROM h, t""")
def stored_run_statistics(spark, sf_dir):
    rows = spark.read.schema(medallion.RUNS).parquet(loaded_store(spark, sf_dir).runs).drop("recorded_at")
    pairs = F.transform(F.array_sort(F.map_entries("table_rows")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return rows.withColumn("table_rows", F.array_join(pairs, ","))


@query("hours_of_repeats", """
SELECT file_date, file_hour AS hour_bucket, count(*) AS repeats FROM ev WHERE ts < TIMESTAMP '2024-01-16' AND event_id % 250 = 0 GROUP BY ALL""")
def hours_of_repeats(spark, sf_dir):
    """Hours whose filters pass some of the new events; the repeats come at another time than their first copies."""
    hour = [F.date_format("created_at", "yyyy-MM-dd").alias("file_date"), F.col("hour_bucket")]
    early, late = (events(spark, sf_dir, v).select("event_id", *hour) for v in ("early", "late"))
    new = late.select("event_id").union(early.filter(F.col("event_id").cast("bigint") % 250 == 0).select("event_id"))
    path = shared_dir(spark, "filters")
    id_filters(early).write.parquet(path)
    return hits(spark.read.parquet(path), new).groupBy("file_date", "hour_bucket").agg(F.count("*").alias("repeats"))


def _stored_hours(spark, sf_dir, made):
    """Bitmaps or sketches of two runs, one after the other, in one folder."""
    path = shared_dir(spark, "hours")
    for part in ("first_half", "second_half"):
        made(events(spark, sf_dir, part), MEASURES).write.mode("append").parquet(path)
    return spark.read.parquet(path)


@query("distinct_days_from_hours", HALVES_SQL + """
SELECT date_trunc('day', ts)::TIMESTAMP AS hour_bucket, count(DISTINCT user_id) AS unique_actors, count(DISTINCT k) AS unique_repos FROM kept GROUP BY 1""")
def distinct_days_from_hours(spark, sf_dir):
    return distincts.wide_counts(distincts.distinct_counts_of(_stored_hours(spark, sf_dir, distincts.hourly_bitmaps), "day"), list(MEASURES))


@query("distinct_months_from_hours", HALVES_SQL + """
SELECT 'month' AS period, date_trunc('month', ts)::TIMESTAMP AS hour_bucket, count(DISTINCT user_id) AS unique_actors, count(DISTINCT k) AS unique_repos FROM kept GROUP BY ALL
UNION ALL SELECT 'hour', hour, count(DISTINCT user_id), count(DISTINCT k) FROM kept GROUP BY ALL""")
def distinct_months_from_hours(spark, sf_dir):
    """Months and single hours from the same stored bitmaps."""
    stored = _stored_hours(spark, sf_dir, distincts.hourly_bitmaps)
    counts = {name: distincts.wide_counts(distincts.distinct_counts_of(stored, period), list(MEASURES)) for name, period in (("month", "month"), ("hour", None))}
    return counts["month"].select(F.lit("month").alias("period"), "*").union(counts["hour"].select(F.lit("hour").alias("period"), "*"))


@query("approximate_days_from_hours", HALVES_SQL + """
SELECT date_trunc('day', ts)::TIMESTAMP AS hour_bucket, m.measure, true AS within_5_percent FROM kept, (VALUES ('unique_actors'), ('unique_repos')) m(measure) GROUP BY ALL""")
def approximate_days_from_hours(spark, sf_dir):
    """Whether merged sketches lie within 5 % (three standard errors) of the exact counts."""
    approx = distincts.approximate_counts_of(_stored_hours(spark, sf_dir, distincts.hourly_sketches), "day")
    exact = distincts.distinct_counts_of(_stored_hours(spark, sf_dir, distincts.hourly_bitmaps), "day")
    near = F.abs(F.col("approx_ids") - F.col("distinct_ids")) <= 0.05 * F.col("distinct_ids")
    return approx.join(exact, ["hour_bucket", "measure"]).select("hour_bucket", "measure", near.alias("within_5_percent"))


@query("stream_distinct_summary", """
SELECT hour AS hour_bucket, count(*) AS total_events, count(DISTINCT user_id) AS unique_actors, count(DISTINCT k) AS unique_repos FROM ev
WHERE hour + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM ev) GROUP BY 1""")
def stream_distinct_summary(spark, sf_dir):
    """Hours that the watermark has passed, appended with exact distinct counts."""
    root = shared_dir(spark, "stream")
    rows = _event_stream(spark, sf_dir, "plain").withColumn("created_at", F.col("created_at").cast("timestamp"))
    store_summary(rows, f"{root}/summary", f"{root}/checkpoint").awaitTermination()
    return read_summary(spark, f"{root}/summary")
