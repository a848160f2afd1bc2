"""Silver: one wide parse of the raw events, then facts, dimensions and payload details."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourvault.functions.json_fields import leaf, parse_once
from hourvault.functions.names import is_bot, owner_of
from hourvault.functions.times import parse_time
from hourvault.schemas import SILVER

# Path and type of each leaf of the raw document.
DOCUMENT_LEAVES = {
    "public": ("$.public", "boolean"),
    "actor_display_login": ("$.actor.display_login", "string"),
    "actor_url": ("$.actor.url", "string"),
    "actor_type": ("$.actor.type", "string"),
    "actor_site_admin": ("$.actor.site_admin", "boolean"),
    "actor_avatar_url": ("$.actor.avatar_url", "string"),
    "actor_gravatar_id": ("$.actor.gravatar_id", "string"),
    "repo_url": ("$.repo.url", "string"),
    "repo_owner_id": ("$.repo.owner.id", "bigint"),
    "org_id": ("$.org.id", "bigint"),
    "org_login": ("$.org.login", "string"),
    "org_url": ("$.org.url", "string"),
    "org_avatar_url": ("$.org.avatar_url", "string"),
    "org_description": ("$.org.description", "string"),
    "repo_is_fork": ("$.payload.repository.fork", "boolean"),
    "repo_language": ("$.payload.repository.language", "string"),
    "repo_created_at": ("$.payload.repository.created_at", "string"),
    "repo_updated_at": ("$.payload.repository.updated_at", "string"),
    "repo_stars_count": ("$.payload.repository.stargazers_count", "bigint"),
    "repo_forks_count": ("$.payload.repository.forks_count", "bigint"),
    "repo_issues_count": ("$.payload.repository.open_issues_count", "bigint"),
    "repo_watchers_count": ("$.payload.repository.watchers_count", "bigint"),
    "repo_size": ("$.payload.repository.size", "bigint"),
}

PAYLOAD_LEAVES = {
    "action": ("action", "string"),
    "issue_id": ("issue.id", "bigint"),
    "pull_request_id": ("pull_request.id", "bigint"),
    "comment_id": ("comment.id", "bigint"),
    "size": ("size", "bigint"),
    "distinct_size": ("distinct_size", "bigint"),
    "ref": ("ref", "string"),
    "ref_type": ("ref_type", "string"),
    "head": ("head", "string"),
    "before": ("before", "string"),
}

# Event types that carry each payload column; None means all of them.
PAYLOAD_RULES = {
    "payload_action": ("action", None),
    "payload_issue_id": ("issue_id", ["IssuesEvent"]),
    "payload_pull_request_id": ("pull_request_id", ["PullRequestEvent"]),
    "payload_comment_id": (
        "comment_id",
        ["IssueCommentEvent", "CommitCommentEvent", "PullRequestReviewCommentEvent"],
    ),
    "payload_push_size": ("size", ["PushEvent"]),
    "payload_ref": ("ref", ["PushEvent", "CreateEvent", "DeleteEvent"]),
    "payload_ref_type": ("ref_type", ["CreateEvent", "DeleteEvent"]),
    "payload_head": ("head", ["PushEvent"]),
    "payload_before": ("before", ["PushEvent"]),
    "payload_size": ("size", ["PushEvent"]),
    "payload_distinct_size": ("distinct_size", ["PushEvent"]),
}


def flatten(bronze: DataFrame) -> DataFrame:
    """Every leaf the silver tables need, from one parse per event.

    All five silver tables are column subsets of this frame: store it once and
    each of them becomes a pruned scan. Event, actor and repository ids come
    from the typed bronze columns, so filters on them reach the bronze files.
    Input without `raw_data` keeps the columns it has; a `payload` text column
    alone still yields the payload leaves.
    """
    document = payload_root = None
    if "raw_data" in bronze.columns:
        document, payload_root = "raw_data", "$.payload."
    elif "payload" in bronze.columns:
        document, payload_root = "payload", "$."
    leaves: dict[str, Column] = {}
    rows = bronze
    if document:
        rows = parse_once(bronze, document, "doc")
        if document == "raw_data":
            leaves.update({n: leaf("doc", path, kind) for n, (path, kind) in DOCUMENT_LEAVES.items()})
        leaves.update({f"p_{n}": leaf("doc", payload_root + path, kind) for n, (path, kind) in PAYLOAD_LEAVES.items()})
    kept = [F.col(c) for c in bronze.columns if c not in ("raw_data", "payload", "created_at") and c not in leaves]
    flat = rows.select(*kept, parse_time("created_at").alias("event_time"),
                       *[column.alias(name) for name, column in leaves.items()])
    wanted = list(DOCUMENT_LEAVES.items()) + [(f"p_{n}", spec) for n, spec in PAYLOAD_LEAVES.items()]
    missing = {n: F.lit(None).cast(kind) for n, (_, kind) in wanted if n not in flat.columns}
    return flat.withColumns(missing) if missing else flat


def silver_events(flat: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Event fact: one row per event; `keep` adds expressions such as partition columns."""
    return flat.select(
        "event_id",
        "event_hash",
        "event_type",
        F.col("event_time").alias("created_at"),
        "actor_id",
        "actor_login",
        "repo_id",
        "repo_name",
        "org_id",
        is_bot("actor_login").alias("is_bot"),
        F.coalesce("public", F.lit(True)).alias("public"),
        F.col("file_hour").alias("hour_bucket"),
        "processed_at",
        *[F.expr(k) for k in keep or []],
    )


def payload_details(flat: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Payload columns, each filled only for the event types that define it."""
    def rule(name: str) -> Column:
        source, types = PAYLOAD_RULES[name]
        value = F.col(f"p_{source}")
        return (value if types is None else F.when(F.col("event_type").isin(types), value)).alias(name)

    return flat.select("event_id", "event_type", *[rule(n) for n in PAYLOAD_RULES], *[F.expr(k) for k in keep or []])


def actor_sightings(flat: DataFrame) -> DataFrame:
    """Actor attributes as seen on each event; events without an actor id are left out."""
    return flat.filter(F.col("actor_id").isNotNull()).select(
        "actor_id", "actor_login", "actor_display_login", "actor_url", "actor_type", "actor_site_admin",
        F.col("actor_avatar_url").alias("avatar_url"), F.col("actor_gravatar_id").alias("gravatar_id"),
        "event_time", "event_id",
    )


def repository_sightings(flat: DataFrame) -> DataFrame:
    """Repository attributes as seen on each event."""
    return flat.filter(F.col("repo_id").isNotNull()).select(
        "repo_id", "repo_name", "repo_url",
        F.col("repo_owner_id").alias("owner_id"),
        owner_of("repo_name").alias("owner_login"),
        F.col("repo_is_fork").alias("is_fork"),
        F.col("repo_language").alias("language"),
        parse_time("repo_created_at").alias("created_at"),
        parse_time("repo_updated_at").alias("updated_at"),
        F.col("repo_stars_count").alias("stars_count"),
        F.col("repo_forks_count").alias("forks_count"),
        F.col("repo_issues_count").alias("issues_count"),
        F.col("repo_watchers_count").alias("watchers_count"),
        F.col("repo_size").alias("size"),
        "event_time", "event_id",
    )


def organization_sightings(flat: DataFrame) -> DataFrame:
    """Organisation attributes as seen on each event."""
    return flat.filter(F.col("org_id").isNotNull()).select(
        "org_id", "org_login", "org_url", F.col("org_avatar_url").alias("avatar_url"),
        F.col("org_description").alias("description"), "event_time", "event_id",
    )


def roll_up(sightings: DataFrame, key: str, policy: str = "max") -> DataFrame:
    """One row per key with its attributes and first and last event time.

    `max` takes the greatest value of each attribute. It runs in two steps:
    text attributes first become grouping keys, which keeps the pass over all
    events in a hash aggregate with map-side combining (a text maximum forces a
    sort aggregate), and only the few distinct variants per key go on to the
    second step. `latest` takes the value of the newest event that has one.
    """
    attributes = [f for f in sightings.schema if f.name not in (key, "event_time", "event_id")]
    names = [f.name for f in attributes]
    if policy == "latest":
        def newest(name: str) -> Column:
            order = F.when(F.col(name).isNotNull(), F.struct("event_time", "event_id"))
            return F.max_by(name, order).alias(name)

        rolled = sightings.groupBy(key).agg(
            *[newest(n) for n in names],
            F.min("event_time").alias("first_seen_at"), F.max("event_time").alias("last_seen_at"))
    elif policy == "max":
        texts = [f.name for f in attributes if f.dataType.typeName() == "string"]
        others = [n for n in names if n not in texts]
        variants = sightings.groupBy(key, *texts).agg(
            *[F.max(n).alias(n) for n in others],
            F.min("event_time").alias("first_seen_at"), F.max("event_time").alias("last_seen_at"))
        rolled = variants.groupBy(key).agg(
            *[F.max(n).alias(n) for n in names],
            F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at"))
    else:
        raise ValueError(f"unknown policy {policy!r}, use 'max' or 'latest'")
    return rolled


def silver_actors(flat: DataFrame, policy: str = "max") -> DataFrame:
    return roll_up(actor_sightings(flat), "actor_id", policy).select(*SILVER["actors"])


def repository_increment(flat: DataFrame, policy: str = "max") -> DataFrame:
    """Repositories of some events as an upsert takes them: is_fork stays NULL where no event tells it."""
    return roll_up(repository_sightings(flat), "repo_id", policy).select(*SILVER["repositories"])


def readable_repositories(dimension: DataFrame) -> DataFrame:
    """The dimension as readers see it: a repository that no event calls a fork is none."""
    return dimension.withColumn("is_fork", F.coalesce("is_fork", F.lit(False)))


def silver_repositories(flat: DataFrame, policy: str = "max") -> DataFrame:
    return readable_repositories(repository_increment(flat, policy))


def silver_organizations(flat: DataFrame, policy: str = "max") -> DataFrame:
    return roll_up(organization_sightings(flat), "org_id", policy).select(*SILVER["organizations"])


def silver_tables(flat: DataFrame, policy: str = "max") -> dict[str, DataFrame]:
    """All silver tables of one wide frame."""
    return {
        "events": silver_events(flat),
        "actors": silver_actors(flat, policy),
        "repositories": silver_repositories(flat, policy),
        "organizations": silver_organizations(flat, policy),
        "payload_details": payload_details(flat),
    }


def enforce_schema(df: DataFrame, columns: dict[str, str], strict: bool = False) -> DataFrame:
    """Keep only the listed columns, in order; strict also adds the missing ones as NULL and casts all."""
    if strict:
        return df.select(*[(F.col(n).try_cast(kind) if n in df.columns else F.lit(None).cast(kind)).alias(n)
                           for n, kind in columns.items()])
    return df.select(*[n for n in columns if n in df.columns])


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Concatenate by name, columns missing on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
