"""Gold: metrics per actor, repository, organisation, owner, event type and hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hourvault.functions.names import has_owner, is_bot, owner_of
from hourvault.functions.times import hour_of

# Names under which a column may arrive.
COLUMN_ALIASES = {
    "actor_id": ["actorid", "actor"],
    "event_id": ["id", "eventid"],
    "repo_id": ["repoid", "repository_id"],
    "created_at": ["createdat", "date", "timestamp", "created_at_ts"],
    "org_id": ["orgid", "organization_id", "org"],
    "event_type": ["type", "eventtype", "event"],
}


def resolve_aliases(df: DataFrame, needed: list[str], aliases: dict[str, list[str]] = COLUMN_ALIASES) -> DataFrame:
    """Rename known aliases of the needed columns; raise when one is still missing."""
    renames = {}
    for name in needed:
        if name not in df.columns:
            found = [a for a in aliases.get(name, []) if a in df.columns]
            if not found:
                raise ValueError(f"no column {name!r} and none of its aliases in {df.columns}")
            renames[found[0]] = name
    return df.withColumnsRenamed(renames) if renames else df


def distinct_count(column: str, approximate: bool = False) -> Column:
    return F.approx_count_distinct(column) if approximate else F.countDistinct(column)


def entity_metrics(events: DataFrame, key: str, other: str, name: str, approximate: bool = False) -> DataFrame:
    """Events, distinct partners and first and last time per key; rows without a key are left out.

    The exact distinct count shuffles on (key, partner) before it shuffles on
    the key alone, so a key that owns a large share of the rows is spread over
    all tasks.
    """
    events = resolve_aliases(events, [key, other, "created_at"])
    return events.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count("*").alias("total_events"),
        distinct_count(other, approximate).alias(name),
        F.min("created_at").alias("first_event"),
        F.max("created_at").alias("last_event"),
    )


def latest_per_key(dimension: DataFrame, key: str) -> DataFrame:
    """One row per key: the last seen, ties broken by all columns.

    The rank filter lets Spark cut each key to one row per map task before the
    shuffle, so many copies of one key stay small.
    """
    order = [F.col("last_seen_at").desc_nulls_last()] if "last_seen_at" in dimension.columns else []
    order += [F.col(c).asc_nulls_last() for c in dimension.columns if c not in (key, "last_seen_at")]
    ranked = dimension.withColumn("_rank", F.row_number().over(W.partitionBy(key).orderBy(*(order or [F.col(key)]))))
    return ranked.filter("_rank = 1").drop("_rank")


def with_dimension(metrics: DataFrame, dimension: DataFrame | None, key: str) -> DataFrame:
    """Left join of aggregated metrics to a deduplicated dimension, both one row per key."""
    if dimension is None:
        return metrics
    clash = [c for c in dimension.columns if c != key and c in metrics.columns]
    return metrics.join(latest_per_key(dimension.drop(*clash), key), key, "left")


def actor_metrics(events: DataFrame, actors: DataFrame | None = None, approximate: bool = False) -> DataFrame:
    """Per actor; with the actor dimension also its attributes and the bot flag."""
    metrics = with_dimension(entity_metrics(events, "actor_id", "repo_id", "unique_repos", approximate), actors, "actor_id")
    return metrics.withColumn("is_bot", is_bot("actor_login")) if "actor_login" in metrics.columns else metrics


def repo_metrics(events: DataFrame, repositories: DataFrame | None = None, approximate: bool = False) -> DataFrame:
    """Per repository, with the repository attributes when that dimension is given."""
    return with_dimension(entity_metrics(events, "repo_id", "actor_id", "unique_actors", approximate), repositories, "repo_id")


def org_metrics(events: DataFrame, organizations: DataFrame | None = None, approximate: bool = False) -> DataFrame:
    """Per organisation id; events outside an organisation are left out."""
    return with_dimension(entity_metrics(events, "org_id", "actor_id", "unique_actors", approximate), organizations, "org_id")


def _two_distincts(events: DataFrame, key: str, approximate: bool, with_times: bool) -> DataFrame:
    """Totals and both distinct counts per key.

    Two exact distinct counts make Spark expand its input threefold, so the
    input is first reduced to one row per (key, actor, repository): a shuffle
    whose key no single hour or owner can dominate.
    """
    times = [F.min("created_at").alias("first_event"), F.max("created_at").alias("last_event")] if with_times else []
    if approximate:
        return events.groupBy(key).agg(F.count("*").alias("total_events"),
                                       F.approx_count_distinct("actor_id").alias("unique_actors"),
                                       F.approx_count_distinct("repo_id").alias("unique_repos"), *times)
    pairs = events.groupBy(key, "actor_id", "repo_id").agg(F.count("*").alias("n"), *times)
    again = [F.min("first_event").alias("first_event"), F.max("last_event").alias("last_event")] if with_times else []
    return pairs.groupBy(key).agg(F.sum("n").alias("total_events"),
                                  F.countDistinct("actor_id").alias("unique_actors"),
                                  F.countDistinct("repo_id").alias("unique_repos"), *again)


def owner_metrics(events: DataFrame, approximate: bool = False) -> DataFrame:
    """Per owner name, the part of the repository name before the slash; other names are left out."""
    owned = events.filter(has_owner("repo_name")).select(
        owner_of("repo_name").alias("org_name"), "actor_id", "repo_id", "created_at")
    return _two_distincts(owned, "org_name", approximate, with_times=True)


def event_type_metrics(events: DataFrame) -> DataFrame:
    """Events per type."""
    events = resolve_aliases(events, ["event_type"])
    return events.filter(F.col("event_type").isNotNull()).groupBy("event_type").agg(F.count("*").alias("count"))


def hourly_summary(events: DataFrame, approximate: bool = False) -> DataFrame:
    """Events, actors and repositories per hour; rows without a time are left out."""
    events = resolve_aliases(events, ["created_at", "actor_id", "repo_id"])
    hours = events.filter(F.col("created_at").isNotNull()).select(
        hour_of("created_at").alias("hour_bucket"), "actor_id", "repo_id")
    return _two_distincts(hours, "hour_bucket", approximate, with_times=False)


def gold_tables(events: DataFrame, actors: DataFrame, repositories: DataFrame, organizations: DataFrame) -> dict[str, DataFrame]:
    """All gold tables of the silver tables."""
    return {
        "actor_metrics": actor_metrics(events, actors),
        "repo_metrics": repo_metrics(events, repositories),
        "org_metrics": org_metrics(events, organizations),
        "owner_metrics": owner_metrics(events),
        "event_type_metrics": event_type_metrics(events),
        "daily_summary": hourly_summary(events),
    }


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
