"""Silver: facts, dimensions, payload details and their scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourvault.functions.json_fields import canonical_hash, is_object, json_type, leaf
from hourvault.functions.names import has_owner, is_bot, owner_of, short_name_of
from hourvault.functions.times import hour_of, parse_time
from hourvault.functions.types import cast_schema
from hourvault.operators.bronze import parse_lines
from hourvault.operators.features import numeric_columns
from hourvault.operators.gold import resolve_aliases
from hourvault.operators.silver import (
    actor_sightings, enforce_schema, flatten, organization_sightings, payload_details, repository_sightings,
    silver_actors, silver_organizations, silver_repositories, union_all)
from hourvault.schemas import SILVER
from suite.base import archive_lines, bronze, events, flat, query, table


@query("reparsed_events", """
SELECT id AS event_id, user_id AS actor_id, org AS org_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE is_public END AS public FROM ev""")
def reparsed_events(spark, sf_dir):
    return flat(spark, sf_dir).select("event_id", "actor_id", "org_id", "public")


@query("events_without_raw", """
SELECT id AS event_id, user_id AS actor_id, CASE WHEN kind = 'PushEvent' THEN event_id % 20 END AS push_size, CAST(NULL AS VARCHAR) AS org_login FROM ev""")
def events_without_raw(spark, sf_dir):
    rows = flatten(bronze(spark, sf_dir).drop("raw_data"))
    return rows.select("event_id", "actor_id", F.when(F.col("event_type") == "PushEvent", F.col("p_size")).alias("push_size"), "org_login")


@query("silver_events", """
SELECT id AS event_id, kind AS event_type, ts AS created_at, user_id AS actor_id, login AS actor_login, k AS repo_id,
       repo AS repo_name, org AS org_id, bot AS is_bot, is_public AS public, file_hour AS hour_bucket FROM ev""")
def event_fact(spark, sf_dir):
    return events(spark, sf_dir).drop("event_hash", "processed_at")


@query("actor_sightings", """
SELECT id AS event_id, user_id AS actor_id, login AS actor_login, ts AS event_time FROM ev WHERE event_id % 50 <> 0""")
def actors_seen(spark, sf_dir):
    return actor_sightings(flat(spark, sf_dir, "no_actor")).select("event_id", "actor_id", "actor_login", "event_time")


@query("repository_sightings", """
SELECT id AS event_id, k AS repo_id, repo AS repo_name, owner AS owner_login, CASE WHEN pr_id IS NOT NULL THEN k % 5 = 0 END AS is_fork,
       language, pr_id % 1000 AS stars_count, pr_id % 100 AS forks_count, pr_id % 50 AS issues_count,
       pr_id % 500 AS watchers_count, pr_id % 2000 AS size FROM ev""")
def repositories_seen(spark, sf_dir):
    return repository_sightings(flat(spark, sf_dir)).drop("repo_url", "owner_id", "created_at", "updated_at", "event_time")


@query("organization_sightings", """
SELECT id AS event_id, org AS org_id, org_name AS org_login, ts AS event_time FROM ev WHERE org IS NOT NULL""")
def organizations_seen(spark, sf_dir):
    return organization_sightings(flat(spark, sf_dir)).select("event_id", "org_id", "org_login", "event_time")


PAYLOAD_SQL = """
SELECT id AS event_id, kind AS event_type,
  CASE kind WHEN 'PullRequestEvent' THEN CASE WHEN k % 2 = 0 THEN 'opened' ELSE 'closed' END WHEN 'IssuesEvent' THEN 'opened'
    WHEN 'IssueCommentEvent' THEN 'created' WHEN 'WatchEvent' THEN 'started' END AS payload_action,
  CASE WHEN kind = 'IssuesEvent' THEN event_id + 2000000 END AS payload_issue_id,
  CASE WHEN kind = 'PullRequestEvent' THEN event_id + 1000000 END AS payload_pull_request_id,
  CASE WHEN kind = 'IssueCommentEvent' THEN event_id + 3000000 END AS payload_comment_id,
  CASE WHEN kind = 'PushEvent' THEN event_id % 20 END AS payload_push_size,
  CASE WHEN kind IN ('PushEvent', 'CreateEvent', 'DeleteEvent') THEN 'refs/heads/b' || (k % 4) END AS payload_ref,
  CASE WHEN kind IN ('CreateEvent', 'DeleteEvent') THEN CASE WHEN k % 4 < 2 THEN 'branch' ELSE 'tag' END END AS payload_ref_type,
  CASE WHEN kind = 'PushEvent' THEN md5(id) END AS payload_head,
  CASE WHEN kind = 'PushEvent' THEN md5(CAST(event_id - 1 AS VARCHAR)) END AS payload_before,
  CASE WHEN kind = 'PushEvent' THEN event_id % 20 END AS payload_size,
  CASE WHEN kind = 'PushEvent' THEN event_id % 10 END AS payload_distinct_size
FROM ev"""


@query("payload_details", PAYLOAD_SQL)
def payload_columns(spark, sf_dir):
    return payload_details(flat(spark, sf_dir))


@query("silver_actors", """
SELECT user_id AS actor_id, max(login) AS actor_login, min(ts) AS first_seen_at, max(ts) AS last_seen_at FROM ev GROUP BY 1""")
def actor_dimension(spark, sf_dir):
    return silver_actors(flat(spark, sf_dir)).select("actor_id", "actor_login", "first_seen_at", "last_seen_at")


REPOSITORIES_SQL = """
SELECT k AS repo_id, max(repo) AS repo_name, max(owner) AS owner_login, coalesce(max(pr_id IS NOT NULL AND k % 5 = 0), false) AS is_fork,
  max(language) AS language, min(ts) AS first_seen_at, max(ts) AS last_seen_at, max(pr_id % 1000) AS stars_count,
  max(pr_id % 100) AS forks_count, max(pr_id % 50) AS issues_count, max(pr_id % 500) AS watchers_count, max(pr_id % 2000) AS size
FROM ev GROUP BY 1"""


@query("silver_repositories", REPOSITORIES_SQL)
def repository_dimension(spark, sf_dir):
    return silver_repositories(flat(spark, sf_dir)).drop("repo_url", "owner_id", "created_at", "updated_at")


@query("silver_repositories_latest", """
SELECT k AS repo_id, arg_max(repo, event_id) AS repo_name, arg_max(language, event_id) FILTER (language IS NOT NULL) AS language,
  arg_max(pr_id % 1000, event_id) FILTER (pr_id IS NOT NULL) AS stars_count, arg_max(pr_id % 2000, event_id) FILTER (pr_id IS NOT NULL) AS size,
  coalesce(max(pr_id IS NOT NULL AND k % 5 = 0), false) AS is_fork, min(ts) AS first_seen_at, max(ts) AS last_seen_at FROM ev GROUP BY 1""")
def repository_dimension_latest(spark, sf_dir):
    return silver_repositories(flat(spark, sf_dir), "latest").select(
        "repo_id", "repo_name", "language", "stars_count", "size", "is_fork", "first_seen_at", "last_seen_at")


@query("silver_organizations", """
SELECT org AS org_id, max(org_name) AS org_login, CAST(NULL AS VARCHAR) AS org_url, CAST(NULL AS VARCHAR) AS avatar_url, CAST(NULL AS VARCHAR) AS description,
       min(ts) AS first_seen_at, max(ts) AS last_seen_at FROM ev WHERE org IS NOT NULL GROUP BY 1""")
def organization_dimension(spark, sf_dir):
    return silver_organizations(flat(spark, sf_dir))


@query("enforced_schema", """
SELECT id AS event_id, kind AS event_type, k AS repo_id FROM ev""")
def enforced_schema(spark, sf_dir):
    return enforce_schema(bronze(spark, sf_dir), {"event_id": "string", "event_type": "string", "absent": "int", "repo_id": "bigint"})


@query("enforced_schema_strict", """
SELECT id AS event_id, CAST(NULL AS BIGINT) AS org_id, TRY_CAST(login AS BIGINT) AS actor_login FROM ev""")
def enforced_schema_strict(spark, sf_dir):
    return enforce_schema(bronze(spark, sf_dir), {"event_id": "string", "org_id": "bigint", "actor_login": "bigint"}, strict=True)


@query("resolved_aliases", """
SELECT user_id AS actor_id, count(*) AS n FROM ev GROUP BY 1""")
def resolved_aliases(spark, sf_dir):
    renamed = events(spark, sf_dir).withColumnsRenamed({"actor_id": "actorid", "created_at": "timestamp"})
    return resolve_aliases(renamed, ["actor_id", "created_at"]).groupBy("actor_id").agg(F.count("created_at").alias("n"))


@query("numeric_columns", """
SELECT o_orderkey, o_totalprice FROM orders""")
def numeric_part(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select(*numeric_columns(orders, drop=("o_custkey",)))


@query("union_by_name", """
SELECT kind AS event_type, count(*) AS n, count(org) FILTER (ts >= TIMESTAMP '2024-01-16') AS with_org FROM ev GROUP BY 1""")
def union_by_name(spark, sf_dir):
    rows = union_all([events(spark, sf_dir, "early").drop("org_id"), events(spark, sf_dir, "late")])
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.count("org_id").alias("with_org"))


@query("distinct_ids", """
SELECT DISTINCT user_id AS actor_id, org AS org_id FROM ev""")
def distinct_ids(spark, sf_dir):
    return events(spark, sf_dir).select("actor_id", "org_id").distinct()


@query("set_difference", """
SELECT k AS repo_id, user_id AS actor_id FROM ev WHERE kind = 'PushEvent' EXCEPT SELECT k, user_id FROM ev WHERE kind = 'WatchEvent'""")
def set_difference(spark, sf_dir):
    rows = events(spark, sf_dir)
    pushed = rows.filter("event_type = 'PushEvent'").select("repo_id", "actor_id").distinct()
    watched = rows.filter("event_type = 'WatchEvent'").select("repo_id", "actor_id")
    return pushed.join(watched, ["repo_id", "actor_id"], "left_anti")


@query("key_order_hashes", """
SELECT id AS event_id, true AS same_hash FROM ev""")
def key_order_hashes(spark, sf_dir):
    plain = parse_lines(archive_lines(spark, sf_dir)).select("line_id", canonical_hash("event").alias("h"))
    other = parse_lines(archive_lines(spark, sf_dir, "reordered")).select("line_id", canonical_hash("event").alias("g"))
    return plain.join(other, "line_id").select(F.col("line_id").cast("string").alias("event_id"), (F.col("h") == F.col("g")).alias("same_hash"))


@query("hash_equality_classes", """
SELECT count(*) AS events, count(DISTINCT event_id) AS hashes FROM (
  SELECT event_id FROM ev UNION ALL SELECT event_id FROM ev WHERE event_id % 20 = 0)""")
def hash_equality_classes(spark, sf_dir):
    return bronze(spark, sf_dir, "repeated").agg(F.count("*").alias("events"), F.countDistinct("event_hash").alias("hashes"))


@query("bot_flags", """
SELECT login, count(*) AS n, bool_or(bot) AS is_bot FROM ev GROUP BY 1""")
def bot_flags(spark, sf_dir):
    rows = events(spark, sf_dir).groupBy(F.col("actor_login").alias("login")).agg(F.count("*").alias("n"))
    return rows.withColumn("is_bot", is_bot("login"))


@query("bot_pattern_on_names", """
SELECT c_custkey, name, regexp_matches(name, '(-bot|[._]bot|bot[._]|^bot-|^bot$|\\[bot\\]$)', 'i') AS is_bot FROM (
  SELECT c_custkey, CASE c_custkey % 9 WHEN 0 THEN c_name || '[BOT]' WHEN 1 THEN 'Bot-' || c_name WHEN 2 THEN 'bot' WHEN 3 THEN 'robot'
    WHEN 4 THEN c_name || '_Bot' WHEN 5 THEN 'botany' || c_name WHEN 6 THEN 'x.bot' WHEN 7 THEN 'bot_' || c_custkey ELSE c_name END AS name FROM customer)""")
def bot_pattern_on_names(spark, sf_dir):
    key, name = F.col("c_custkey"), F.col("c_name")
    shapes = [F.concat(name, F.lit("[BOT]")), F.concat(F.lit("Bot-"), name), F.lit("bot"), F.lit("robot"), F.concat(name, F.lit("_Bot")),
              F.concat(F.lit("botany"), name), F.lit("x.bot"), F.concat(F.lit("bot_"), key.cast("string")), name]
    picked = F.element_at(F.array(*shapes), (key % 9 + 1).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", picked.alias("name")).withColumn("is_bot", is_bot("name"))


@query("owner_split", """
SELECT DISTINCT repo AS repo_name, owner, CASE WHEN owner IS NULL THEN repo ELSE split_part(repo, '/', 2) END AS short_name, owner IS NOT NULL AS has_owner FROM ev""")
def owner_split(spark, sf_dir):
    return events(spark, sf_dir).select("repo_name").distinct().select(
        "repo_name", owner_of("repo_name").alias("owner"), short_name_of("repo_name").alias("short_name"), has_owner("repo_name").alias("has_owner"))


@query("safe_parse", """
SELECT event_id, event_id % 97 <> 0 AS parsed, CASE WHEN event_id % 97 <> 0 THEN kind END AS event_type FROM ev""")
def safe_parse(spark, sf_dir):
    parsed = parse_lines(archive_lines(spark, sf_dir, "corrupt"))
    return parsed.select(F.col("line_id").alias("event_id"), F.col("event").isNotNull().alias("parsed"), leaf("event", "$.type", "string").alias("event_type"))


@query("typed_leaves", """
SELECT event_id, k AS repo_id, CAST(NULL AS BIGINT) AS repo_name_as_number, CAST(k AS VARCHAR) AS repo_id_as_text,
       CASE WHEN event_id % 10 = 0 THEN NULL ELSE is_public END AS public, CAST(NULL AS VARCHAR) AS absent FROM ev""")
def typed_leaves(spark, sf_dir):
    return parse_lines(archive_lines(spark, sf_dir)).select(
        F.col("line_id").alias("event_id"), leaf("event", "$.repo.id", "bigint").alias("repo_id"),
        leaf("event", "$.repo.name", "bigint").alias("repo_name_as_number"), leaf("event", "$.repo.id", "string").alias("repo_id_as_text"),
        leaf("event", "$.public", "boolean").alias("public"), leaf("event", "$.repo.no.such", "string").alias("absent"))


@query("json_types", """
SELECT id_type, public_type, actor_type, repo_id_type, count(*) AS n FROM (
  SELECT 'string' AS id_type, CASE WHEN event_id % 10 <> 0 THEN 'boolean' END AS public_type,
         CASE WHEN event_id % 50 <> 0 THEN 'object' END AS actor_type, 'number' AS repo_id_type FROM ev) GROUP BY ALL""")
def json_types(spark, sf_dir):
    def kind(path):
        return json_type(F.try_variant_get("event", path, "variant"))

    return parse_lines(archive_lines(spark, sf_dir, "no_actor")).groupBy(
        kind("$.id").alias("id_type"), kind("$.public").alias("public_type"), kind("$.actor").alias("actor_type"),
        kind("$.repo.id").alias("repo_id_type")).agg(F.count("*").alias("n"))


@query("object_guard", """
SELECT count(*) FILTER (event_id % 50 <> 0) AS actor_objects, count(org) AS org_objects, CAST(0 AS BIGINT) AS id_objects FROM ev""")
def object_guard(spark, sf_dir):
    def objects(path):
        return F.count_if(is_object(F.try_variant_get("event", path, "variant")))

    return parse_lines(archive_lines(spark, sf_dir, "no_actor")).agg(
        objects("$.actor").alias("actor_objects"), objects("$.org").alias("org_objects"), objects("$.id").alias("id_objects"))


@query("payload_json", """
SELECT event_id, '{"action":"started"}' AS payload FROM ev WHERE kind = 'WatchEvent'""")
def payload_json(spark, sf_dir):
    return bronze(spark, sf_dir).filter("event_type = 'WatchEvent'").select(F.col("event_id").cast("bigint").alias("event_id"), "payload")


@query("parsed_times", """
SELECT event_id, CASE WHEN event_id % 10 <> 3 THEN ts END AS parsed, CASE WHEN event_id % 10 <> 3 THEN hour END AS hour FROM ev""")
def parsed_times(spark, sf_dir):
    text = F.when(F.col("event_id").cast("bigint") % 10 == 3, "no time").otherwise(F.col("created_at"))
    rows = bronze(spark, sf_dir).select(F.col("event_id").cast("bigint").alias("event_id"), parse_time(text).alias("parsed"))
    return rows.withColumn("hour", hour_of("parsed"))


@query("cast_schema", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       TRY_CAST(o_orderstatus AS BIGINT) AS o_orderstatus, o_custkey FROM orders""")
def cast_by_alias(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus", "o_custkey")
    return cast_schema(orders, {"o_orderkey": "text", "o_totalprice": "double", "o_orderdate": "date", "o_orderstatus": "long"})


@query("schema_columns_only", """
SELECT 'actors' AS table_name, 10 AS columns, count(DISTINCT user_id) AS rows FROM ev
UNION ALL SELECT 'organizations', 7, count(DISTINCT org) FROM ev""")
def schema_columns_only(spark, sf_dir):
    rows = flat(spark, sf_dir)
    parts = [(n, enforce_schema(df.withColumn("extra", F.lit(0)), SILVER[n])) for n, df in
             (("actors", silver_actors(rows)), ("organizations", silver_organizations(rows)))]
    return union_all([df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table_name"), F.lit(len(df.columns)).alias("columns"), "rows")
                      for n, df in parts])
