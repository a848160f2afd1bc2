"""Ledger of batches, pruned increments, repeats in other hours, and distinct counts that are merged."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from hourvault.operators import distincts, repeats
from hourvault.plans import medallion
from hourvault.plans.store import Store
from hourvault.streaming import ingest
from hourvault.streaming.summary import read_summary, store_summary


def line(i, at, **more):
    return json.dumps({"id": str(i), "type": "PushEvent", "created_at": at, "actor": {"id": i % 7, "login": "a"}, "repo": {"id": i % 5, "name": "o/r"}} | more)


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    with gzip.open(folder / f"{name}.json.gz", "wt") as out:
        out.write("\n".join(lines) + "\n")


def load(spark, source, store):
    medallion.load_bronze(spark, str(source), store)
    return medallion.load_silver(spark, store, "2024-02-01")


def snapshot(spark, store):
    good, bad = (ingest.batch_rows(spark, store.batches, medallion.loaded_batches(spark, store), g) for g in (True, False))
    return (sorted(r.event_id for r in good.collect()), sorted(r.value for r in bad.collect()),
            sorted((r.file_name, r.lines, r.events, r.bad_lines) for r in medallion.read_manifest(spark, store, medallion.loaded_batches(spark, store)).collect()))


@pytest.mark.parametrize("crash", ["manifest", "ledger"])
def test_batch_repeated_after_a_crash(spark, tmp_path, monkeypatch, crash):
    """A batch that breaks off between its tables is done again and leaves no row twice."""
    for k in range(3):
        put(tmp_path / "raw", f"2024-01-0{k + 1}-05", [line(10 * k + j, f"2024-01-0{k + 1}T05:00:00Z") for j in range(5)] + ["broken", "{"])
    store = Store(str(tmp_path / "store"))
    whole = ingest.store_batch

    def breaks(batch, batch_id, tables):
        # The part that comes after the crash is written elsewhere, then the run ends.
        whole(batch, batch_id, ingest.BatchTables(tables.lines, f"{tables.manifest}-lost" if crash == "manifest" else tables.manifest, f"{tables.ledger}-lost"))
        raise RuntimeError("crash")

    monkeypatch.setattr(ingest, "store_batch", breaks)
    with pytest.raises(Exception, match="crash"):
        medallion.load_bronze(spark, str(tmp_path / "raw"), store)
    assert medallion.loaded_batches(spark, store) == [] and medallion.pending_batches(spark, store) == []
    monkeypatch.setattr(ingest, "store_batch", whole)
    medallion.load_bronze(spark, str(tmp_path / "raw"), store)
    ids, bad, files = snapshot(spark, store)
    assert ids == sorted(str(10 * k + j) for k in range(3) for j in range(5)) and bad == ["broken"] * 3 + ["{"] * 3
    assert [f[1:] for f in files] == [(7, 5, 2)] * 3
    medallion.load_bronze(spark, str(tmp_path / "raw"), store)
    assert snapshot(spark, store) == (ids, bad, files)


def test_increment_reads_its_batches_only(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    put(tmp_path / "raw", "2024-01-01-05", [line(j, "2024-01-01T05:00:00Z") for j in range(5)])
    assert load(spark, tmp_path / "raw", store)
    put(tmp_path / "raw", "2024-01-01-06", [line(9, "2024-01-01T06:00:00Z")])
    medallion.load_bronze(spark, str(tmp_path / "raw"), store)
    pending = medallion.pending_batches(spark, store)
    assert len(pending) == 1
    rows = medallion.increment(spark, store, pending)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "batch_id" in filters and "is_good" in filters and "Join" not in plan
    assert len(rows.inputFiles()) >= 1 and [r.event_id for r in rows.collect()] == ["9"]
    assert plan.count("parse_json") + plan.count("variant") == 0  # the raw text is not parsed to find the increment


def test_one_parse_for_good_and_broken_lines(spark, tmp_path):
    spark.createDataFrame([("f", "x"), ("f", line(1, "2024-01-01T05:00:00Z"))], "file_path string, value string").write.parquet(str(tmp_path / "lines"))
    rows = ingest.all_lines(ingest.parse_lines(spark.read.parquet(str(tmp_path / "lines"))))
    assert rows._jdf.queryExecution().executedPlan().toString().count("parseJson") == 1
    assert sorted((r.is_good, r.value, r.event_id) for r in rows.collect()) == [(False, "x", None), (True, None, "1")]


def test_repeat_with_another_time_in_another_hour(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    for h in range(6):
        put(tmp_path / "raw", f"2024-01-01-{h:02d}", [line(100 * h + j, f"2024-01-01T{h:02d}:00:00Z") for j in range(20)])
    load(spark, tmp_path / "raw", store)
    # Event 205 again, in a later file and with another time.
    put(tmp_path / "raw", "2024-01-02-09", [line(205, "2024-01-02T09:30:00Z"), line(5000, "2024-01-02T09:31:00Z")])
    medallion.load_bronze(spark, str(tmp_path / "raw"), store)
    flat = medallion.flatten(medallion.increment(spark, store, medallion.pending_batches(spark, store)))
    searched = medallion.possible_repeats(spark, store, store.read_fact(spark, "events"), flat)
    plan = searched._jdf.queryExecution().executedPlan().toString()
    assert "file_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {(r.file_date, r.hour_bucket) for r in searched.select("file_date", "hour_bucket").distinct().collect()} == {("2024-01-01", "02")}
    assert medallion.load_silver(spark, store, "2024-02-02")
    record = spark.read.parquet(store.registry).filter("dataset_name = 'actors'").orderBy("updated_at").collect()[-1]
    assert record.size_bytes > 0 and record.rows == 7 and record.additional_metadata["null_share.actor_id"] == "0.0"
    events = store.read_fact(spark, "events")
    assert events.count() == 121 and events.filter("event_id = '205'").first().hour_bucket == "02"
    assert events.filter("file_date = '2024-01-02'").count() == 1


def test_filters_lose_no_id(spark):
    r = random.Random(4)
    hours = [("2024-01-01", f"{h:02d}") for h in range(5)]
    rows = [(str(r.randrange(10**12)), *hours[k % 5]) for k in range(9000)] + [(f"text-{k}", "2024-01-02", "00") for k in range(50)] + [(None, "2024-01-02", "00")]
    events = spark.createDataFrame(rows, "event_id string, file_date string, hour_bucket string").repartition(4)
    filters = repeats.id_filters(events).cache()
    assert filters.filter("hour_bucket = '01'").count() == 2 and filters.filter("file_date = '2024-01-02'").first().low is None
    found = repeats.hits(filters, events).collect()
    assert {(x.event_id, x.file_date, x.hour_bucket) for x in found} >= {x for x in rows if x[0]}
    assert len(found) <= len(rows) + 2
    other = spark.createDataFrame([(str(10**12 + k),) for k in range(9000)] + [(None,)], "event_id string")
    assert repeats.hits(filters, other).count() == 0
    assert repeats.hits(filters.limit(0), events).count() == 0 and repeats.hits(filters, events.limit(0)).count() == 0


def test_new_ids_go_out_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(repeats, "IDS_AT_A_TIME", 100)
    events = spark.range(950).selectExpr("CAST(id AS STRING) AS event_id", "'2024-01-01' AS file_date", "CAST(id % 3 AS STRING) AS hour_bucket")
    assert repeats.hits(repeats.id_filters(events).cache(), events).count() == 950
    hours = spark.createDataFrame([("2024-01-01", "1"), ("2024-01-01", "2")], "file_date string, hour_bucket string")
    assert repeats.in_hours(events, hours).count() == repeats.in_hours(events, hours, most=1).count() == 633


def test_late_row_in_the_streamed_summary(spark, tmp_path):
    """A row within the delay joins its hour, a later one is left out; hours come out once, and days are merged from them."""
    schema = "created_at timestamp, actor_id bigint, repo_id bigint"

    def put_rows(name, rows):
        spark.createDataFrame([(F_time(t), a, r) for t, a, r in rows], schema).coalesce(1).write.parquet(str(tmp_path / "in" / name))

    def F_time(t):
        import datetime

        return datetime.datetime.fromisoformat(t)

    def step():
        rows = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
        store_summary(rows, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
        return {str(r.hour_bucket)[11:13]: (r.total_events, r.unique_actors, r.unique_repos) for r in read_summary(spark, str(tmp_path / "out")).collect()}

    put_rows("a", [("2024-01-01T01:10:00", 1, 1), ("2024-01-01T01:20:00", 2, 1), ("2024-01-01T02:10:00", 1, None)])
    step()
    put_rows("b", [("2024-01-01T01:50:00", 3, 40000), ("2024-01-01T04:30:00", 1, 1)])
    assert step() == {"01": (3, 3, 2), "02": (1, 1, 0)}
    put_rows("c", [("2024-01-01T01:55:00", 9, 9), ("2024-01-01T07:00:00", 5, 5)])
    assert step() == {"01": (3, 3, 2), "02": (1, 1, 0), "04": (1, 1, 1)}
    day = read_summary(spark, str(tmp_path / "out"), "day").collect()
    assert [(r.total_events, r.unique_actors, r.unique_repos) for r in day] == [(5, 3, 2)]


def test_bitmaps_of_any_ids(spark):
    rows = [("2024-01-01 01:00:00", 1), ("2024-01-01 01:30:00", 1), ("2024-01-01 02:00:00", 1), ("2024-01-01 02:00:00", 2**40), ("2024-01-02 00:00:00", -5),
            ("2024-01-02 00:00:00", None), (None, 3)]
    events = spark.createDataFrame(rows, "t string, id bigint").withColumn("created_at", F.col("t").cast("timestamp_ntz"))
    stored = distincts.hourly_bitmaps(events, {"ids": "id"})
    got = {str(r.hour_bucket)[:10]: r.distinct_ids for r in distincts.distinct_counts_of(stored.union(stored), "day").collect()}
    assert got == {"2024-01-01": 2, "2024-01-02": 1, "None": 1}
    sketches = distincts.hourly_sketches(events, {"ids": "id"})
    assert {str(r.hour_bucket)[:10]: r.approx_ids for r in distincts.approximate_counts_of(sketches, "day").collect()} == got
    assert distincts.distinct_counts_of(distincts.hourly_bitmaps(events.limit(0), {"ids": "id"})).count() == 0
