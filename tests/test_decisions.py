"""Hand-made rows for the points where the meaning had to be fixed."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from hourvault.functions.json_fields import canonical_hash, json_type, parse_once
from hourvault.functions.names import is_bot, object_key, owner_of
from hourvault.functions.times import expected_hours, file_date, file_hour, file_time, parse_time
from hourvault.functions.types import cast_schema, spark_type
from hourvault.operators.bronze import bronze_events, in_hour_range, only_event_types, parse_lines, quarantine
from hourvault.operators.features import feature_table, join_datasets, merged_features, scaled
from hourvault.operators.gold import actor_metrics, hourly_summary, latest_per_key, org_metrics, resolve_aliases
from hourvault.operators.quality import checked_lines, column_test_results, field_errors, temporal_coverage, found_hours, missing_hours
from hourvault.operators.silver import enforce_schema, flatten, payload_details, silver_actors, silver_events, silver_repositories
from hourvault.operators.upsert import new_rows, one_per_key, upsert_dimension


def lines(spark, *texts):
    return spark.createDataFrame([("in/2024-05-01-9.json.gz", t, i) for i, t in enumerate(texts)],
                                 "file_path string, value string, line_id bigint")


def event(eid, kind="PushEvent", actor=1, login="ann", repo=7, name="o/r", at="2024-05-01T09:00:00Z", extra=""):
    return (f'{{"id":"{eid}","type":"{kind}","actor":{{"id":{actor},"login":"{login}"}},"repo":{{"id":{repo},"name":"{name}"}},'
            f'"created_at":"{at}"{extra}}}')


def silver(spark, *texts):
    return flatten(bronze_events(parse_lines(lines(spark, *texts))))


@pytest.mark.parametrize("login, expected", [
    ("dependabot[bot]", True), ("my-bot", True), ("bot", True), ("bot-x", True), ("a_bot", True), ("x.bot", True),
    ("bot_1", True), ("MyBOT_x", True), ("robot", False), ("botany", False), (None, False)])
def test_bot_pattern(spark, login, expected):
    row = spark.createDataFrame([(login,)], "login string").select(is_bot("login").alias("b")).first()
    assert row.b is expected


def test_hash_ignores_key_order_and_refuses_broken_text(spark):
    df = parse_once(lines(spark, '{"b":1,"a":2}', '{"a":2,"b":1}', "bad{", '{"a":1,"a":2}', '{"a":2,"b":3}'), "value", "v")
    h = [r.h for r in df.orderBy("line_id").select(canonical_hash("v").alias("h")).collect()]
    assert h[0] == h[1] and h[2] is None and h[3] == hashlib.md5(b'{"a":2}').hexdigest() and h[4] not in (h[0], None)


def test_broken_lines_are_kept_apart(spark):
    parsed = parse_lines(lines(spark, event(1), "bad{", "", "123", "[1]", "null"))
    assert [r.value for r in quarantine(parsed).orderBy("value").collect()] == ["", "123", "[1]", "bad{", "null"]
    assert bronze_events(parsed).count() == 1


@pytest.mark.parametrize("value, expected", [
    ("null", "null"), ("1", "number"), ("1.5", "number"), ("1e300", "number"), ("true", "boolean"), ("{}", "object"),
    ('{"x":1}', "object"), ("[1]", "array"), ('"x"', "string")])
def test_json_types(spark, value, expected):
    df = parse_once(lines(spark, f'{{"f":{value}}}'), "value", "v")
    row = df.select(json_type(F.try_variant_get("v", "$.f", "variant")).alias("t"),
                    json_type(F.try_variant_get("v", "$.g", "variant")).alias("absent")).first()
    assert row.t == expected and row.absent is None


def test_null_is_present_but_absent_is_missing(spark):
    parsed = parse_lines(lines(spark, '{"a":null}', "{}", '{"a":true}', "broken"))
    errors = field_errors(checked_lines(parsed, ["a"], {"a": "number"})).orderBy("line_id", "problem").collect()
    assert [(e.line_id, e.problem, e.found) for e in errors] == [(0, "type", "null"), (1, "missing", None), (2, "type", "boolean")]


def test_file_names(spark):
    names = ["/d/2024-05-01-9.json.gz", "/d/2024-05-01-09.json.gz", "/d/2024/5/1/x.json.gz", "/d/2024-05-01.json.gz", "/d/x.json.gz"]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, p string").orderBy("i").select(
        file_date("p").alias("d"), file_hour("p").alias("h"), file_time("p").alias("t")).collect()
    today = spark.sql("SELECT string(current_date())").first()[0]
    assert [(r.d, r.h) for r in rows] == [("2024-05-01", "09"), ("2024-05-01", "09"), ("2024-05-01", "00"), ("2024-05-01", "00"), (today, "00")]
    assert rows[0].t == rows[1].t == dt.datetime(2024, 5, 1, 9) and rows[2].t is None


def test_missing_hour_between_found_ones(spark):
    files = spark.createDataFrame([("a/2024-05-01-9.json.gz",), ("a/2024-05-01-11.json.gz",), ("a/readme.json.gz",)], "file_path string")
    found = found_hours(files)
    assert [r.hour for r in missing_hours(found).collect()] == [dt.datetime(2024, 5, 1, 10)]
    row = temporal_coverage(found).first()
    assert (row.expected_hours, row.found_hours, row.missing_hours, row.coverage_percentage) == (3, 2, 1, 66.6667)
    empty = temporal_coverage(found.limit(0)).first()
    assert (empty.expected_hours, empty.found_hours, empty.coverage_percentage) == (0, 0, 0.0)


def test_expected_hours_guards(spark):
    start = dt.datetime(2024, 5, 1)
    hours = expected_hours(spark, start, start + dt.timedelta(hours=3)).orderBy("hour").collect()
    assert [r.file_path for r in hours] == [f"2024/05/01/2024-05-01-0{h}.json.gz" for h in range(3)]
    with pytest.raises(ValueError):
        expected_hours(spark, start, start)
    with pytest.raises(ValueError):
        expected_hours(spark, start, start + dt.timedelta(days=8), max_days=7)


def test_times_outside_utc_and_bad_text(spark):
    df = spark.createDataFrame([("2024-05-01T09:00:00+02:00",), ("bad",)], "t string")
    assert [r[0] for r in df.select(parse_time("t")).collect()] == [dt.datetime(2024, 5, 1, 7), None]


def test_owner_and_keys(spark):
    df = spark.createDataFrame([("a/b",), ("solo",), (None,)], "n string")
    assert [r[0] for r in df.select(owner_of("n")).collect()] == ["a", None, None]
    row = spark.createDataFrame([("/base/x\\y.json",)], "p string").select(object_key("p", "/base/", "pre/")).first()
    assert row[0] == "pre/x/y.json"


def test_payload_columns_follow_the_type(spark):
    flat = silver(spark, event(1, "IssuesEvent", extra=',"payload":{"action":"opened","issue":{"id":5},"comment":{"id":6},"size":3}'),
                  event(2, "PullRequestReviewCommentEvent", extra=',"payload":{"comment":{"id":8}}'), event(3, "WatchEvent"))
    rows = {r.event_id: r for r in payload_details(flat).collect()}
    assert (rows["1"].payload_issue_id, rows["1"].payload_comment_id, rows["1"].payload_size) == (5, None, None)
    assert rows["2"].payload_comment_id == 8 and rows["3"].payload_action is None


def test_zero_ids_stay_and_null_ids_go(spark):
    flat = silver(spark, event(1, actor=0), event(2, actor="null"), '{"id":"3","type":"WatchEvent"}')
    assert [r.actor_id for r in silver_actors(flat).collect()] == [0]
    assert [r.actor_id for r in actor_metrics(silver_events(flat)).collect()] == [0]
    assert silver_events(flat).filter("public").count() == 3


def test_roll_up_policies(spark):
    flat = silver(spark, event(1, login="zed", at="2024-05-01T09:00:00Z"), event(2, login="amy", at="2024-05-02T09:00:00Z"))
    assert silver_actors(flat).first().actor_login == "zed"
    latest = silver_actors(flat, "latest").first()
    assert latest.actor_login == "amy" and latest.first_seen_at == dt.datetime(2024, 5, 1, 9)
    with pytest.raises(ValueError):
        silver_actors(flat, "first")


def test_latest_skips_missing_values(spark):
    pull = ',"payload":{"repository":{"language":"Go","stargazers_count":5}}'
    flat = silver(spark, event(1, "PullRequestEvent", extra=pull), event(2, at="2024-05-03T00:00:00Z"))
    row = silver_repositories(flat, "latest").first()
    assert (row.language, row.stars_count, row.is_fork, row.owner_login) == ("Go", 5, False, "o")


def test_upsert_equals_rebuild_and_repeats_do_nothing(spark):
    texts = [event(i, actor=i % 3, login=f"u{i % 3}", at=f"2024-05-0{1 + i % 5}T0{i % 9}:00:00Z") for i in range(12)]
    full = silver_actors(silver(spark, *texts))
    once = upsert_dimension(silver_actors(silver(spark, *texts[:7])), silver_actors(silver(spark, *texts[5:])), "actor_id", "max")
    twice = upsert_dimension(once, silver_actors(silver(spark, *texts[5:])), "actor_id", "max")
    for merged in (once, twice):
        assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, full.collect()))
    assert once.filter("actor_id IS NULL").count() == 0


def test_null_in_target_does_not_empty_the_anti_join(spark):
    source = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    target = spark.createDataFrame([(1,), (None,)], "k int")
    assert sorted(str(r.k) for r in new_rows(source, target, "k").collect()) == ["2", "None"]


def test_one_per_key_with_a_dominant_key(spark):
    rows = spark.range(900).select(F.when(F.col("id") < 300, 0).otherwise(F.col("id")).alias("k"))
    assert one_per_key(rows, "k").count() == 601


def test_latest_per_key_is_deterministic(spark):
    rows = spark.createDataFrame([(1, "b", 5), (1, "a", 5), (1, "c", 4)], "k int, v string, last_seen_at int")
    assert latest_per_key(rows, "k").first().v == "a"


def test_aliases(spark):
    df = spark.createDataFrame([(1, "x")], "actorid int, id string")
    assert resolve_aliases(df, ["actor_id", "event_id"]).columns == ["actor_id", "event_id"]
    with pytest.raises(ValueError):
        resolve_aliases(df, ["repo_id"])


def test_empty_inputs_keep_their_columns(spark):
    none = silver_events(silver(spark, event(1))).limit(0)
    assert actor_metrics(none).columns[:2] == ["actor_id", "total_events"] and org_metrics(none).count() == 0
    assert hourly_summary(none).count() == 0


def test_type_aliases(spark):
    assert [spark_type(t) for t in ("Str", "integer", "long", "datetime", "array", "map", "odd")] == [
        "string", "int", "bigint", "timestamp", "array<string>", "map<string,string>", "string"]
    with pytest.raises(ValueError):
        spark_type("struct")
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    assert cast_schema(df, {"a": "integer", "b": "double"}).first() == (1, None)


def test_schema_modes(spark):
    df = spark.createDataFrame([("x", 1)], "a string, b int")
    assert enforce_schema(df, {"b": "bigint", "c": "string"}).columns == ["b"]
    strict = enforce_schema(df, {"a": "bigint", "c": "string"}, strict=True)
    assert strict.first() == (None, None) and strict.columns == ["a", "c"]


def test_filters(spark):
    bronze = bronze_events(parse_lines(lines(spark, event(1), event(2, "WatchEvent"))))
    assert only_event_types(bronze, ["WatchEvent"]).count() == 1 and only_event_types(bronze, []).count() == 2
    assert in_hour_range(bronze, "2024-05-01 09", "2024-05-01 10").count() == 2
    assert in_hour_range(bronze, "2024-05-01 08", "2024-05-01 09").count() == 0


def test_scaling(spark):
    df = spark.createDataFrame([(1, 1.0, 4), (2, 2.0, 4), (3, 3.0, 4)], "repo_id int, x double, c int")
    rows = scaled(df, ["x", "c"], ["repo_id"]).orderBy("repo_id").collect()
    assert [round(r.x, 6) for r in rows] == [-1.224745, 0.0, 1.224745] and {r.c for r in rows} == {0.0}
    assert feature_table(df, percent=None).columns == ["repo_id", "x", "c"]
    assert feature_table(df, percent=None, keep_id=True).columns == ["repo_id", "repo_id_feature", "x", "c"]


def test_merging_feature_tables(spark):
    a = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 1.0)], "repo_id int, v double")
    b = spark.createDataFrame([(1, 5.0), (3, 1.0)], "repo_id int, v double")
    joined = join_datasets([a, b], "repo_id")
    assert joined.columns == ["repo_id", "v_x", "v_y"] and joined.count() == 2
    assert merged_features([a, None, b], percent=None).count() == 1
    with pytest.raises(ValueError):
        merged_features([None, spark.createDataFrame([("x",)], "name string")])


def test_column_tests_find_seeded_faults(spark):
    events = spark.createDataFrame([("1", None), ("1", "h"), (None, "h2")], "event_id string, event_type string")
    found = {(r.column_name, r.test): r.failures for r in column_test_results(
        {"payload_details": events}).collect()}
    assert found == {("event_id", "unique"): 1, ("event_id", "not_null"): 1, ("event_type", "not_null"): 1}
