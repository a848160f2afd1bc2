"""Column lists and types of every layer."""

from __future__ import annotations

BRONZE_EVENTS = {
    "event_hash": "string",
    "file_name": "string",
    "file_date": "string",
    "file_hour": "string",
    "processed_at": "string",
    "raw_data": "string",
    "event_id": "string",
    "event_type": "string",
    "created_at": "string",
    "actor_id": "bigint",
    "actor_login": "string",
    "repo_id": "bigint",
    "repo_name": "string",
    "payload": "string",
}

SILVER = {
    "events": {
        "event_id": "string",
        "event_hash": "string",
        "event_type": "string",
        "created_at": "timestamp_ntz",
        "actor_id": "bigint",
        "actor_login": "string",
        "repo_id": "bigint",
        "repo_name": "string",
        "org_id": "bigint",
        "is_bot": "boolean",
        "public": "boolean",
        "hour_bucket": "string",
        "processed_at": "string",
    },
    "actors": {
        "actor_id": "bigint",
        "actor_login": "string",
        "actor_display_login": "string",
        "actor_url": "string",
        "actor_type": "string",
        "actor_site_admin": "boolean",
        "avatar_url": "string",
        "gravatar_id": "string",
        "first_seen_at": "timestamp_ntz",
        "last_seen_at": "timestamp_ntz",
    },
    "repositories": {
        "repo_id": "bigint",
        "repo_name": "string",
        "repo_url": "string",
        "owner_id": "bigint",
        "owner_login": "string",
        "is_fork": "boolean",
        "language": "string",
        "created_at": "timestamp_ntz",
        "updated_at": "timestamp_ntz",
        "first_seen_at": "timestamp_ntz",
        "last_seen_at": "timestamp_ntz",
        "stars_count": "bigint",
        "forks_count": "bigint",
        "issues_count": "bigint",
        "watchers_count": "bigint",
        "size": "bigint",
    },
    "organizations": {
        "org_id": "bigint",
        "org_login": "string",
        "org_url": "string",
        "avatar_url": "string",
        "description": "string",
        "first_seen_at": "timestamp_ntz",
        "last_seen_at": "timestamp_ntz",
    },
    "payload_details": {
        "event_id": "string",
        "event_type": "string",
        "payload_action": "string",
        "payload_issue_id": "bigint",
        "payload_pull_request_id": "bigint",
        "payload_comment_id": "bigint",
        "payload_push_size": "bigint",
        "payload_ref": "string",
        "payload_ref_type": "string",
        "payload_head": "string",
        "payload_before": "string",
        "payload_size": "bigint",
        "payload_distinct_size": "bigint",
    },
}

# Schemas of the tables that a bulk load fills.
GOLD = {
    "actor_metrics": {
        "actor_id": "bigint",
        "total_events": "bigint",
        "unique_repos": "bigint",
        "first_event": "timestamp_ntz",
        "last_event": "timestamp_ntz",
        "actor_login": "string",
        "is_bot": "boolean",
    },
    "repo_metrics": {
        "repo_id": "bigint",
        "total_events": "bigint",
        "unique_actors": "bigint",
        "first_event": "timestamp_ntz",
        "last_event": "timestamp_ntz",
        "repo_name": "string",
        "language": "string",
    },
    "org_metrics": {
        "org_id": "bigint",
        "total_events": "bigint",
        "unique_actors": "bigint",
        "first_event": "timestamp_ntz",
        "last_event": "timestamp_ntz",
        "org_login": "string",
    },
    "event_type_metrics": {"event_type": "string", "count": "bigint"},
    "daily_summary": {
        "hour_bucket": "timestamp_ntz",
        "total_events": "bigint",
        "unique_actors": "bigint",
        "unique_repos": "bigint",
    },
    "geographical_activity": {"country": "string", "event_count": "bigint", "actor_count": "bigint", "date": "date"},
    "repository_popularity": {
        "repo_id": "bigint",
        "repo_name": "string",
        "stars_count": "bigint",
        "forks_count": "bigint",
        "watchers_count": "bigint",
        "date": "date",
    },
    "time_based_activity": {"hour_of_day": "int", "event_count": "bigint", "date": "date"},
}

SILVER_KEYS = {
    "events": "event_id",
    "actors": "actor_id",
    "repositories": "repo_id",
    "organizations": "org_id",
    "payload_details": "event_id",
}


def ddl(columns: dict[str, str]) -> str:
    """DDL text of a column list, for readers with a fixed schema."""
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())
