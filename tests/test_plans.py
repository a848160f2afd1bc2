"""Physical plans: one parse, pruned scans, early limits, hashing in the large passes."""

import pytest

from hourvault.operators import gold, quality, silver
from hourvault.operators.bronze import bronze_events, parse_lines
from hourvault.operators.gold import latest_per_key
from suite.base import archive_lines, flat

SF_DIR = "/root/testdata/sf0.001"

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stored")
    archive_lines(spark, SF_DIR).write.parquet(str(root / "lines"))
    bronze_events(parse_lines(spark.read.parquet(str(root / "lines")))).write.parquet(str(root / "bronze"))
    flat(spark, SF_DIR).write.parquet(str(root / "flat"))
    return {n: spark.read.parquet(str(root / n)) for n in ("lines", "bronze", "flat")}


def test_lines_are_parsed_once(stored):
    bronze = bronze_events(parse_lines(stored["lines"])).filter("actor_id IS NOT NULL AND event_type = 'PushEvent'")
    assert plan(bronze).count("parseJson") == 1
    actors = silver.silver_actors(silver.flatten(stored["bronze"]))
    assert plan(actors).count("parseJson") == 1
    assert "IsNotNull(actor_id)" in plan(actors)


def test_metrics_read_only_their_columns(stored):
    text = plan(gold.actor_metrics(silver.silver_events(stored["flat"])))
    assert "ReadSchema: struct<actor_id:bigint,repo_id:bigint,event_time:timestamp_ntz>" in text.replace("actor_login:string,", "")
    assert "parseJson" not in text and "PushedFilters: [IsNotNull(actor_id)]" in text


def test_distinct_counts_spread_a_hot_key(stored):
    text = plan(gold.actor_metrics(silver.silver_events(stored["flat"])))
    assert text.count("Exchange hashpartitioning(actor_id") == 2 and "repo_id" in text.split("Exchange")[2]


def test_rank_limits_reach_the_map_side(stored):
    sightings = silver.actor_sightings(stored["flat"]).withColumnRenamed("event_time", "last_seen_at")
    assert "WindowGroupLimit" in plan(latest_per_key(sightings, "actor_id"))
    assert "WindowGroupLimit" in plan(quality.first_lines(stored["lines"], 5))


def test_large_passes_of_the_roll_up_hash(stored):
    text = plan(silver.silver_repositories(stored["flat"]))
    below = text[text.index("HashAggregate"):]
    assert "SortAggregate" not in below
