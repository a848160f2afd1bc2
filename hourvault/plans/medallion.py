"""Raw files to bronze, silver and gold, one increment at a time.

A run loads the files that are new, carries them to the archive hours of
silver and rebuilds gold. Repeating a run, or resuming one that broke off,
ends in the same state: bronze keeps a stream checkpoint and a ledger of whole
batches, facts are merged by event into the hours that new files touch, the
dimension merge does not change under repetition, and the load log, which
marks a batch as done, is written last. Every run leaves its statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourvault.operators.gold import gold_tables, row_counts
from hourvault.operators.quality import side_by_side
from hourvault.operators.repeats import FILTER, hours_to_search, id_filters, in_hours
from hourvault.operators.silver import (
    actor_sightings, flatten, organization_sightings, payload_details, readable_repositories, repository_sightings,
    roll_up, silver_events)
from hourvault.operators.upsert import new_rows, one_version, upsert_dimension
from hourvault.plans.store import Store, partition_values
from hourvault.schemas import SILVER, SILVER_KEYS
from hourvault.session import shared_dir
from hourvault.sources.archive import ARCHIVE_GLOB, run_statistics
from hourvault.sources.sinks import write_gold
from hourvault.sources.storage import list_files
from hourvault.sources.tables import has_files
from hourvault.streaming.ingest import MANIFEST, batch_rows, committed, ingest_archive, stream_lines

LOAD_LOG = "file_name string, events bigint, run_date string, loaded_at timestamp, batch_id bigint"
RUNS = ("run_date string, found bigint, skipped bigint, processed bigint, successful bigint, failed bigint, lines bigint, bad_lines bigint, "
        "table_rows map<string,bigint>, recorded_at timestamp")
HOUR = ["file_date", "file_hour AS hour_bucket"]

SIGHTINGS = {
    "actors": actor_sightings,
    "repositories": repository_sightings,
    "organizations": organization_sightings,
}


def load_bronze(spark: SparkSession, source: str, store: Store, glob: str = ARCHIVE_GLOB) -> None:
    """Load files not loaded before, each line parsed once; broken lines are kept beside the good ones."""
    ingest_archive(stream_lines(spark, source, glob=glob), store.batches, store.checkpoint("bronze")).awaitTermination()


def loaded_batches(spark: SparkSession, store: Store) -> list[int]:
    return committed(spark, store.batches) if has_files(spark, store.batches.ledger) else []


def read_manifest(spark: SparkSession, store: Store, batches: list[int]) -> DataFrame:
    """Files of some batches with their lines, events and broken lines."""
    if not has_files(spark, store.batches.manifest):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(store.batches.manifest).filter(F.col("batch_id").isin(batches))


def read_bronze_table(spark: SparkSession, store: Store) -> DataFrame:
    """All bronze events of finished batches."""
    return batch_rows(spark, store.batches, loaded_batches(spark, store))


def pending_batches(spark: SparkSession, store: Store) -> list[int]:
    """Batches in bronze that no earlier silver run has carried on: by ledger and load log, without a look at bronze."""
    found = set(loaded_batches(spark, store))
    if has_files(spark, store.load_log):
        found -= {r[0] for r in spark.read.schema(LOAD_LOG).parquet(store.load_log).select("batch_id").distinct().collect()}
    return sorted(found)


def increment(spark: SparkSession, store: Store, batches: list[int]) -> DataFrame:
    """Bronze events of some batches; other batches' files are not opened."""
    return batch_rows(spark, store.batches, batches)


def load_silver(spark: SparkSession, store: Store, run_date: str | None = None) -> bool:
    """Carry batches that are new in bronze to silver; False when there are none.

    Events of a file join the archive hours that they belong to, whether or not an earlier file of the hour is loaded:
    the hours they touch are written anew with old and new rows. An event that silver holds already, in whatever hour,
    is left out; the Bloom filters of the hours tell which of them must be searched. The load log is written last, so
    that a run that broke off is done again.
    """
    batches = pending_batches(spark, store)
    if not batches:
        return False
    events = store.read_fact(spark, "events")
    # One parse of the increment, stored once; all five tables read their columns from it.
    flat = _scratch(flatten(increment(spark, store, batches)), "flat")
    known = flat if events is None else new_rows(flat, possible_repeats(spark, store, events, flat), "event_id")
    flat = _scratch(one_version(known, "event_id"), "increment")
    _write_hours(spark, payload_details(flat, keep=HOUR), store, "payload_details")
    for name, sightings in SIGHTINGS.items():
        rolled = roll_up(sightings(flat), SILVER_KEYS[name]).select(*SILVER[name])
        stored = store.current(spark, name)
        merged = rolled if stored is None else upsert_dimension(stored, rolled, SILVER_KEYS[name], prefer="max")
        store.publish(merged, name, "silver", "last_seen_at")
    _write_hours(spark, silver_events(flat, keep=["file_date"]), store, "events")
    update_filters(spark, store, flat)
    log = read_manifest(spark, store, batches).select("file_name", "batch_id").join(
        flat.groupBy("file_name").agg(F.count(F.lit(1)).alias("events")), "file_name", "left")
    log.select("file_name", F.coalesce("events", F.lit(0)).cast("bigint").alias("events"), F.lit(run_date).alias("run_date"),
               F.current_timestamp().alias("loaded_at"), "batch_id").write.mode("append").parquet(store.load_log)
    return True


def possible_repeats(spark: SparkSession, store: Store, events: DataFrame, flat: DataFrame) -> DataFrame:
    """The stored events of the hours that may hold one of the new events."""
    if not has_files(spark, store.event_filters):
        return events
    filters = spark.read.schema(FILTER).parquet(store.event_filters)
    return in_hours(events, hours_to_search(filters, flat.select("event_id")))


def update_filters(spark: SparkSession, store: Store, flat: DataFrame) -> None:
    """Make the filters of the hours that new events have joined, from all ids of these hours."""
    hours = flat.select(F.col("file_date").cast("string").alias("file_date"), F.col("file_hour").cast("string").alias("hour_bucket")).distinct()
    touched = store.read_fact(spark, "events").join(F.broadcast(hours), ["file_date", "hour_bucket"], "left_semi")
    id_filters(touched).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file_date", "hour_bucket").parquet(store.event_filters)


def _scratch(df: DataFrame, label: str) -> DataFrame:
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _write_hours(spark: SparkSession, new: DataFrame, store: Store, name: str) -> None:
    """Write the archive hours of the new rows with their old rows; other hours are neither read nor written.

    Old rows of the same events give way, so a repeated run ends in the same state. The rows are stored apart before
    they replace the partitions that they come from.
    """
    rows, hours = new, ["file_date", "hour_bucket"]
    old = store.read_fact(spark, name)
    if old is not None:
        touched = old.join(F.broadcast(partition_values(new, *hours)), hours, "left_semi")
        rows = touched.join(new.select("event_id"), "event_id", "left_anti").unionByName(new)
        rows = _scratch(rows, "hours")
    rows.hint("rebalance", *hours).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(*hours).parquet(store.fact(name))


def load_gold(spark: SparkSession, store: Store, run_date: str) -> None:
    """Rebuild the gold tables from silver under a run date."""
    dims = {n: store.current(spark, n) for n in SIGHTINGS}
    tables = gold_tables(store.read_fact(spark, "events"), dims["actors"], readable_repositories(dims["repositories"]), dims["organizations"])
    for name, table in tables.items():
        write_gold(table, store.gold(name), run_date)


def record_run(spark: SparkSession, source: str, store: Store, run_date: str, before: list[int], glob: str = ARCHIVE_GLOB) -> None:
    """Append the statistics of a run: files found, loaded and failed, lines, and the rows that each table holds now."""
    after = loaded_batches(spark, store)
    fresh = [b for b in after if b not in set(before)]
    counts = run_statistics(list_files(spark, source, glob), read_manifest(spark, store, before).select(F.col("file_name").alias("file_path")),
                            read_manifest(spark, store, fresh).select(F.col("file_name").alias("file_path"), "success"))
    lines = read_manifest(spark, store, fresh).agg(F.coalesce(F.sum("lines"), F.lit(0)).cast("bigint").alias("lines"),
                                                   F.coalesce(F.sum("bad_lines"), F.lit(0)).cast("bigint").alias("bad_lines"))
    tables = {n: store.read_fact(spark, n) for n in ("events", "payload_details")} | {n: store.current(spark, n) for n in SIGHTINGS}
    rows = row_counts({n: t for n, t in tables.items() if t is not None}).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("table_name", "rows")))).alias("table_rows"))
    record = side_by_side(counts, lines, rows).select(
        F.lit(run_date).alias("run_date"), "found", "skipped", "processed", "successful", "failed", "lines", "bad_lines", "table_rows",
        F.current_timestamp().alias("recorded_at"))
    record.coalesce(1).write.mode("append").parquet(store.runs)


def run(spark: SparkSession, source: str, root: str, run_date: str) -> Store:
    """All three layers, and the statistics of the run."""
    store = Store(root)
    before = loaded_batches(spark, store)
    load_bronze(spark, source, store)
    if load_silver(spark, store, run_date) or not has_files(spark, f"{store.gold('actor_metrics')}/run_date={run_date}"):
        load_gold(spark, store, run_date)
    record_run(spark, source, store, run_date, before)
    return store
