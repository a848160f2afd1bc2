"""Gold metrics, reports and the dataset registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourvault.operators import gold, reports
from hourvault.operators.registry import (
    dataset_record, get_dataset, latest_records, list_datasets, null_shares, partition_counts)
from hourvault.operators.silver import repository_sightings, silver_tables, union_all
from hourvault.session import shared_dir
from suite.base import events, flat, query, table


def silver(spark, sf_dir, variant="plain"):
    return silver_tables(flat(spark, sf_dir, variant))


@query("actor_metrics", """
SELECT user_id AS actor_id, count(*) AS total_events, count(DISTINCT k) AS unique_repos, min(ts) AS first_event, max(ts) AS last_event,
       max(login) AS actor_login, bool_or(bot) AS is_bot FROM ev GROUP BY 1""")
def actor_metrics(spark, sf_dir):
    t = silver(spark, sf_dir)
    return gold.actor_metrics(t["events"], t["actors"]).select(
        "actor_id", "total_events", "unique_repos", "first_event", "last_event", "actor_login", "is_bot")


@query("actor_metrics_without_null_keys", """
SELECT user_id AS actor_id, count(*) AS total_events, count(DISTINCT k) AS unique_repos, min(ts) AS first_event, max(ts) AS last_event
FROM ev WHERE event_id % 50 <> 0 GROUP BY 1""")
def actor_metrics_no_null(spark, sf_dir):
    return gold.actor_metrics(events(spark, sf_dir, "no_actor"))


@query("repo_metrics", """
SELECT k AS repo_id, count(*) AS total_events, count(DISTINCT user_id) AS unique_actors, min(ts) AS first_event, max(ts) AS last_event,
       max(repo) AS repo_name, max(language) AS language FROM ev GROUP BY 1""")
def repo_metrics(spark, sf_dir):
    t = silver(spark, sf_dir)
    return gold.repo_metrics(t["events"], t["repositories"]).select(
        "repo_id", "total_events", "unique_actors", "first_event", "last_event", "repo_name", "language")


@query("org_metrics", """
SELECT org AS org_id, count(*) AS total_events, count(DISTINCT user_id) AS unique_actors, min(ts) AS first_event, max(ts) AS last_event,
       max(org_name) AS org_login FROM ev WHERE org IS NOT NULL GROUP BY 1""")
def org_metrics(spark, sf_dir):
    t = silver(spark, sf_dir)
    return gold.org_metrics(t["events"], t["organizations"]).select(
        "org_id", "total_events", "unique_actors", "first_event", "last_event", "org_login")


@query("owner_metrics", """
SELECT owner AS org_name, count(*) AS total_events, count(DISTINCT user_id) AS unique_actors, count(DISTINCT k) AS unique_repos,
       min(ts) AS first_event, max(ts) AS last_event FROM ev WHERE owner IS NOT NULL GROUP BY 1""")
def owner_metrics(spark, sf_dir):
    return gold.owner_metrics(events(spark, sf_dir))


@query("event_type_metrics", """
SELECT kind AS event_type, count(*) AS count FROM ev GROUP BY 1""")
def event_type_metrics(spark, sf_dir):
    return gold.event_type_metrics(events(spark, sf_dir))


@query("event_types_ordered", """
SELECT kind AS event_type, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, kind) AS position FROM ev GROUP BY 1""")
def event_types_ordered(spark, sf_dir):
    ordered = gold.event_type_metrics(events(spark, sf_dir)).orderBy(F.col("count").desc(), "event_type")
    # There are as many rows as event types, so the positions can be numbered in one partition.
    return ordered.coalesce(1).withColumn("position", F.monotonically_increasing_id() + 1)


@query("hourly_summary", """
SELECT hour AS hour_bucket, count(*) AS total_events, count(DISTINCT user_id) AS unique_actors, count(DISTINCT k) AS unique_repos FROM ev GROUP BY 1""")
def hourly_summary(spark, sf_dir):
    return gold.hourly_summary(events(spark, sf_dir))


@query("hourly_summary_approx", None)
def hourly_summary_approx(spark, sf_dir):
    return gold.hourly_summary(events(spark, sf_dir), approximate=True)


@query("distinct_counts", """
SELECT kind AS event_type, count(DISTINCT user_id) AS actors FROM ev GROUP BY 1""")
def distinct_counts(spark, sf_dir):
    return events(spark, sf_dir).groupBy("event_type").agg(gold.distinct_count("actor_id").alias("actors"))


@query("latest_per_key", """
SELECT k AS repo_id, event_id, ts AS last_seen_at FROM ev QUALIFY row_number() OVER (PARTITION BY k ORDER BY ts DESC, event_id) = 1""")
def latest_per_key(spark, sf_dir):
    rows = repository_sightings(flat(spark, sf_dir)).select(
        "repo_id", F.col("event_id").cast("bigint").alias("event_id"), F.col("event_time").alias("last_seen_at"))
    return gold.latest_per_key(rows, "repo_id")


@query("metric_with_dimension", """
SELECT user_id AS actor_id, count(*) AS total_events, CASE WHEN min(ts) < TIMESTAMP '2024-01-16' THEN max(login) END AS actor_login FROM ev GROUP BY 1""")
def metric_with_dimension(spark, sf_dir):
    actors = silver(spark, sf_dir, "early")["actors"]
    return gold.with_dimension(gold.actor_metrics(events(spark, sf_dir)), actors, "actor_id").select("actor_id", "total_events", "actor_login")


@query("row_counts", """
SELECT 'events' AS table_name, count(*) AS rows FROM ev UNION ALL SELECT 'actors', count(DISTINCT user_id) FROM ev
UNION ALL SELECT 'repositories', count(DISTINCT k) FROM ev UNION ALL SELECT 'organizations', count(DISTINCT org) FROM ev
UNION ALL SELECT 'payload_details', count(*) FROM ev""")
def row_counts(spark, sf_dir):
    return gold.row_counts(silver(spark, sf_dir))


@query("count_invariants", """
SELECT count(*) AS events, count(*) AS by_type, count(*) AS by_hour, count(*) AS by_actor FROM ev""")
def count_invariants(spark, sf_dir):
    e = events(spark, sf_dir)
    sums = [e.agg(F.count("*").alias("n")), gold.event_type_metrics(e).agg(F.sum("count").alias("n")),
            gold.hourly_summary(e).agg(F.sum("total_events").alias("n")), gold.actor_metrics(e).agg(F.sum("total_events").alias("n"))]
    names = ["events", "by_type", "by_hour", "by_actor"]
    rows = union_all([s.select(F.lit(n).alias("name"), "n") for n, s in zip(names, sums)])
    return rows.agg(*[F.max(F.when(F.col("name") == n, F.col("n"))).alias(n) for n in names])


@query("events_preview", """
SELECT id AS event_id, kind AS event_type, ts AS created_at, user_id AS actor_id, login AS actor_login, k AS repo_id,
       repo AS repo_name, org AS org_id, bot AS is_bot, is_public AS public, file_hour AS hour_bucket
FROM ev ORDER BY ts DESC NULLS LAST, id LIMIT 10""")
def events_preview(spark, sf_dir):
    newest = events(spark, sf_dir).orderBy(F.desc_nulls_last("created_at"), "event_id").limit(10)
    return newest.drop("event_hash", "processed_at")


@query("empty_inputs", """
SELECT CAST(NULL AS BIGINT) AS actor_id, CAST(0 AS BIGINT) AS total_events, CAST(0 AS BIGINT) AS unique_repos FROM ev WHERE false""")
def empty_inputs(spark, sf_dir):
    none = events(spark, sf_dir).filter("event_type = 'NoSuchEvent'")
    return gold.actor_metrics(none).select("actor_id", "total_events", "unique_repos")


@query("daily_activity", """
SELECT CAST(ts AS DATE) AS day, kind AS event_type, count(*) AS event_count, count(DISTINCT user_id) AS user_count FROM ev GROUP BY 1, 2""")
def daily_activity(spark, sf_dir):
    return reports.daily_activity(events(spark, sf_dir))


@query("top_repositories", """
SELECT k AS repo_id, max(repo) AS repo_name, max(owner) AS owner, max(CASE WHEN owner IS NULL THEN repo ELSE split_part(repo, '/', 2) END) AS repo_short_name,
       count(*) AS event_count, count(DISTINCT user_id) AS unique_contributors, max(ts) AS last_activity FROM ev GROUP BY 1
ORDER BY event_count DESC, repo_id LIMIT 10""")
def top_repositories(spark, sf_dir):
    t = silver(spark, sf_dir)
    return reports.top_repositories(t["events"], t["repositories"], 10)


@query("repository_summary", """
SELECT k AS repo_id, max(repo) AS repo_name, max(owner) AS owner, max(CASE WHEN owner IS NULL THEN repo ELSE split_part(repo, '/', 2) END) AS repo_short_name,
       min(ts) AS first_seen_at, max(ts) AS last_seen_at, count(*) AS event_count FROM ev GROUP BY 1""")
def repository_summary(spark, sf_dir):
    t = silver(spark, sf_dir)
    return reports.repository_summary(t["events"], t["repositories"])


@query("repository_popularity", """
SELECT k AS repo_id, CAST(ts AS DATE) AS date, max(repo) AS repo_name, max(pr_id % 1000) AS stars_count, max(pr_id % 100) AS forks_count,
       max(pr_id % 500) AS watchers_count FROM ev WHERE pr_id IS NOT NULL GROUP BY 1, 2""")
def repository_popularity(spark, sf_dir):
    return reports.repository_popularity(repository_sightings(flat(spark, sf_dir)))


@query("time_based_activity", """
SELECT CAST(hour(ts) AS INTEGER) AS hour_of_day, CAST(ts AS DATE) AS date, count(*) AS event_count FROM ev GROUP BY 1, 2""")
def time_based_activity(spark, sf_dir):
    return reports.time_based_activity(events(spark, sf_dir))


@query("busy_hours", """
SELECT CAST(hour(ts) AS INTEGER) AS hour_of_day, count(*) AS event_count FROM ev GROUP BY 1""")
def busy_hours(spark, sf_dir):
    return reports.busy_hours(events(spark, sf_dir))


@query("influential_users", """
SELECT user_id AS actor_id, max(login) AS actor_login, count(*) AS total_events, count(DISTINCT k) AS unique_repos FROM ev WHERE NOT bot
GROUP BY 1 ORDER BY total_events DESC, actor_id LIMIT 10""")
def influential_users(spark, sf_dir):
    t = silver(spark, sf_dir)
    return reports.influential_users(t["events"], t["actors"], 10)


@query("contribution_by_type", """
SELECT user_id AS actor_id, kind AS event_type, count(*) AS event_count,
       round(count(*) / sum(count(*)) OVER (PARTITION BY user_id), 6) AS share FROM ev WHERE NOT bot GROUP BY 1, 2""")
def contribution_by_type(spark, sf_dir):
    return reports.contribution_by_type(events(spark, sf_dir))


@query("language_activity", """
SELECT r.language, CAST(e.ts AS DATE) AS date, CAST(count(*) AS BIGINT) AS event_count FROM ev e
JOIN (SELECT k, max(language) AS language FROM ev GROUP BY 1) r USING (k) GROUP BY 1, 2""")
def language_activity(spark, sf_dir):
    t = silver(spark, sf_dir)
    return reports.language_activity(t["events"], t["repositories"])


@query("unusual_hours", """
SELECT event_type, hour, n AS event_count, z AS z_score, abs(z) >= 3 AS is_unusual FROM (
  SELECT kind AS event_type, hour, count(*) AS n,
    round(CASE WHEN stddev_pop(count(*)) OVER w > 0 THEN (count(*) - avg(count(*)) OVER w) / (stddev_pop(count(*)) OVER w) ELSE 0 END, 6) AS z
  FROM ev GROUP BY 1, 2 WINDOW w AS (PARTITION BY kind))""")
def unusual_hours(spark, sf_dir):
    return reports.unusual_hours(events(spark, sf_dir))


# Holt-Winters one hour at a time for each event type, with the forecast made before the hour.
SEASONAL_SQL = """
, c AS (SELECT kind AS event_type, hour, count(*) AS n FROM ev GROUP BY 1, 2),
span AS (SELECT event_type, min(hour) AS f, max(hour) AS l FROM c GROUP BY 1),
h AS (SELECT event_type, unnest(generate_series(f, l, INTERVAL 1 HOUR)) AS hour FROM span),
y AS (SELECT event_type, hour, coalesce(n, 0)::DOUBLE AS y, row_number() OVER o - 1 AS i, count(*) OVER (PARTITION BY event_type) AS hours, max(hour) OVER (PARTITION BY event_type) AS last_hour
      FROM h LEFT JOIN c USING (event_type, hour) WINDOW o AS (PARTITION BY event_type ORDER BY hour)),
init AS (SELECT event_type, list(y ORDER BY i) AS ys FROM y WHERE i < 24 GROUP BY 1),
f AS (SELECT event_type, 0 AS t, list_sum(ys) / len(ys) AS level, 0::DOUBLE AS trend, list_transform(ys, lambda v: v - list_sum(ys) / len(ys)) AS s, 0::DOUBLE AS q,
        NULL::TIMESTAMP AS hour, 0::DOUBLE AS y, 0::DOUBLE AS forecast, false AS alarm FROM init
  UNION ALL
  SELECT event_type, t + 1, new_level, 0.05::DOUBLE * (new_level - level) + 0.95::DOUBLE * trend,
    list_transform(s, lambda v, k: CASE WHEN k = t % 24 + 1 THEN 0.2::DOUBLE * (seen - new_level) + 0.8::DOUBLE * old ELSE v END), q + (seen - guess) * (seen - guess), seen_at, seen, guess,
    t >= 24 AND abs(seen - guess) > 3 * sqrt(q / greatest(t, 1))
  FROM (SELECT f.*, y.y AS seen, y.hour AS seen_at, f.s[t % 24 + 1] AS old, level + trend + f.s[t % 24 + 1] AS guess, 0.3::DOUBLE * (y.y - f.s[t % 24 + 1]) + 0.7::DOUBLE * (level + trend) AS new_level
        FROM f JOIN y ON y.event_type = f.event_type AND y.i = 24 + t))
"""


def _folded(spark, sf_dir):
    return reports.seasonal_fold(reports.hourly_series(events(spark, sf_dir), ["event_type"]), ["event_type"])


@query("seasonal_alarms", SEASONAL_SQL + """
SELECT event_type, hour, CAST(y AS BIGINT) AS event_count, round(forecast, 4) AS forecast FROM f WHERE alarm""", recursive=True)
def seasonal_alarms(spark, sf_dir):
    return reports.seasonal_alarms(_folded(spark, sf_dir), ["event_type"])


@query("seasonal_forecast", SEASONAL_SQL + """
SELECT f.event_type, last_hour + to_hours(step) AS hour, round(level + step * trend + s[(t + step - 1) % 24 + 1], 4) AS forecast,
       round(level + step * trend + s[(t + step - 1) % 24 + 1] - 3 * sqrt(q / t), 4) AS low, round(level + step * trend + s[(t + step - 1) % 24 + 1] + 3 * sqrt(q / t), 4) AS high
FROM f JOIN (SELECT DISTINCT event_type, hours, last_hour FROM y) d ON d.event_type = f.event_type AND t = hours - 24 AND t > 0, range(1, 25) r(step)""", recursive=True)
def seasonal_forecast(spark, sf_dir):
    return reports.seasonal_forecast(_folded(spark, sf_dir), ["event_type"])


@query("activity_forecast", """
SELECT event_type, last_day + CAST(step AS INTEGER) AS day, round(slope, 6) AS slope,
       round(intercept + slope * ((last_day + CAST(step AS INTEGER)) - DATE '1970-01-01'), 4) AS forecast
FROM (SELECT event_type, max(day) AS last_day, regr_slope(n, day - DATE '1970-01-01') AS slope, regr_intercept(n, day - DATE '1970-01-01') AS intercept
      FROM (SELECT kind AS event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM ev GROUP BY 1, 2) GROUP BY 1), range(1, 8) t(step)""")
def activity_forecast(spark, sf_dir):
    return reports.activity_forecast(events(spark, sf_dir), 7)


@query("dataset_record", """
SELECT 'events' AS dataset_name, 'archive' AS description, 2 AS partition_columns, 'test' AS environment, count(*) AS rows, min(ts) AS min_time, max(ts) AS max_time FROM ev""")
def record_of_dataset(spark, sf_dir):
    record = dataset_record(
        events(spark, sf_dir), "events", "silver/events", "archive", partitions=[{"name": "year"}, {"name": "month", "type": "int"}],
        tags={"environment": "test"}, time_column="created_at")
    return record.select("dataset_name", "description", F.size("partitions").alias("partition_columns"),
                         F.col("tags")["environment"].alias("environment"), "rows", "min_time", "max_time")


@query("dataset_null_shares", """
SELECT 'events' AS dataset_name, c AS column_name, n AS rows, nulls, round(nulls / n, 6) AS null_share FROM (
  SELECT 'actor_id' AS c, count(*) AS n, count(*) FILTER (event_id % 50 = 0) AS nulls FROM ev
  UNION ALL SELECT 'org_id', count(*), count(*) - count(org) FROM ev UNION ALL SELECT 'repo_id', count(*), 0 FROM ev)""")
def shares_of_nulls(spark, sf_dir):
    return null_shares(events(spark, sf_dir, "no_actor").select("actor_id", "org_id", "repo_id"), "events")


def _registry(spark, sf_dir):
    """A stored registry with two records of `events` and one of `actors`; the later record holds all events."""
    path = shared_dir(spark, "registry")
    t = silver(spark, sf_dir)
    versions = [(events(spark, sf_dir, "early"), "events"), (t["actors"], "actors"), (t["events"], "events")]
    for df, name in versions:
        dataset_record(df, name, f"silver/{name}", f"silver {name}", tags={"layer": "silver"}).write.mode("append").parquet(path)
    return spark.read.parquet(path)


@query("registry_latest", """
SELECT 'events' AS dataset_name, 'silver/events' AS dataset_path, count(*) AS rows FROM ev
UNION ALL SELECT 'actors', 'silver/actors', count(DISTINCT user_id) FROM ev""")
def registry_latest(spark, sf_dir):
    return latest_records(_registry(spark, sf_dir)).select("dataset_name", "dataset_path", "rows")


@query("registry_lookup", """
SELECT 'events' AS dataset_name, count(*) AS rows, 'silver events' AS description FROM ev""")
def registry_lookup(spark, sf_dir):
    registry = _registry(spark, sf_dir)
    found = get_dataset(registry, "events").unionByName(get_dataset(registry, "unknown"))
    return found.select("dataset_name", "rows", "description")


@query("registry_list", """
SELECT n AS name, 'silver ' || n AS description, 'silver' AS layer FROM (SELECT DISTINCT CASE WHEN event_id >= 0 THEN 'events' END AS n FROM ev UNION ALL SELECT 'actors')""")
def registry_list(spark, sf_dir):
    return list_datasets(_registry(spark, sf_dir)).select("name", "description", F.col("tags")["layer"].alias("layer"))


@query("partition_counts", """
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day, count(*) AS rows FROM ev GROUP BY ALL""")
def counts_of_partitions(spark, sf_dir):
    dated = events(spark, sf_dir).select(F.year("created_at").alias("year"), F.month("created_at").alias("month"), F.day("created_at").alias("day"))
    return partition_counts(dated, ["year", "month", "day"])


@query("document_languages", """
SELECT lang AS language, count(*) AS documents, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY 1""")
def document_languages(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("language")).agg(
        F.count("*").alias("documents"), F.sum("n_chars").alias("chars"))
