"""Files on disk through all layers, in one run and in two."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from hourvault.operators.gold import row_counts
from hourvault.plans import medallion, modelling, validation
from hourvault.sources.archive import read_lines
from hourvault.sources.sinks import write_report
from hourvault.sources.storage import content_hashes, list_files, read_contents, storage_stats
from hourvault.sources.tables import read_dataset, read_layer_table
from suite.base import archive_lines

SF_DIR = "/root/testdata/sf0.001"


def write_archive(spark, folder, variant, hours=None):
    """Hourly gzip files of a variant below `folder`, written by hand as an archive would hold them."""
    files = {}
    for row in archive_lines(spark, SF_DIR, variant).orderBy("line_id").collect():
        files.setdefault(row.file_path, []).append(row.value)
    for path in sorted(files)[:hours]:
        target = os.path.join(folder, path)
        os.makedirs(os.path.dirname(target), exist_ok=True)
        with gzip.open(target, "wt") as out:
            out.write("\n".join(files[path]) + "\n")
    return str(folder)


def snapshot(spark, store):
    """Content of all tables without run-dependent columns."""
    tables = {n: store.read_fact(spark, n).drop("processed_at") for n in ("events", "payload_details")}
    tables |= {n: store.current(spark, n) for n in medallion.SIGHTINGS}
    tables |= {n: spark.read.parquet(store.gold(n)).drop("run_date")
               for n in ("actor_metrics", "repo_metrics", "org_metrics", "owner_metrics", "event_type_metrics", "daily_summary")}
    return {n: sorted(map(str, df.select(*sorted(df.columns)).collect())) for n, df in tables.items()}


def test_two_increments_equal_one_build(spark, tmp_path):
    source = write_archive(spark, tmp_path / "raw", "early", hours=15)
    store = medallion.run(spark, source, str(tmp_path / "two"), "2024-02-01")
    first = spark.read.parquet(store.gold("event_type_metrics")).agg(F.sum("count")).first()[0]
    write_archive(spark, tmp_path / "raw", "late", hours=15)
    medallion.run(spark, source, str(tmp_path / "two"), "2024-02-01")
    whole = medallion.run(spark, source, str(tmp_path / "one"), "2024-02-01")
    two, one = snapshot(spark, store), snapshot(spark, whole)
    assert 0 < first < len(one["events"])
    for name in one:
        assert two[name] == one[name], name
    assert medallion.load_silver(spark, store) is False
    medallion.run(spark, source, str(tmp_path / "two"), "2024-02-01")
    assert snapshot(spark, store) == one


def test_second_file_of_a_loaded_hour(spark, tmp_path):
    """Files of hours that silver holds already, then a run without news; gold for a new date without new data."""
    whole = write_archive(spark, tmp_path / "whole", "early", hours=6)
    for folder, _, names in os.walk(whole):
        for name in names:
            with gzip.open(os.path.join(folder, name), "rt") as lines:
                rows = lines.read().splitlines()
            for half in (0, 1):
                target = os.path.join(folder.replace(str(tmp_path / "whole"), str(tmp_path / f"half{half}")), name)
                os.makedirs(os.path.dirname(target), exist_ok=True)
                with gzip.open(target, "wt") as out:
                    out.write("\n".join(rows[half::2] + rows[:1]) + "\n")
    source = tmp_path / "raw"
    source.mkdir()
    (tmp_path / "half0").rename(source / "a")
    store = medallion.run(spark, str(source), str(tmp_path / "store"), "2024-02-01")
    first = store.read_fact(spark, "events").count()
    (tmp_path / "half1").rename(source / "b")
    medallion.run(spark, str(source), str(tmp_path / "store"), "2024-02-01")
    one = snapshot(spark, medallion.run(spark, whole, str(tmp_path / "one"), "2024-02-01"))
    assert 0 < first < len(one["events"])
    assert snapshot(spark, store) == one
    medallion.run(spark, str(source), str(tmp_path / "store"), "2024-02-02")
    assert {r.run_date for r in spark.read.schema("run_date string").parquet(store.gold("actor_metrics")).select("run_date").distinct().collect()} == {"2024-02-01", "2024-02-02"}
    log = spark.read.parquet(store.load_log)
    assert log.count() == 12 and log.agg(F.sum("events")).first()[0] == len(one["events"])


def test_repeated_and_broken_lines(spark, tmp_path):
    source = write_archive(spark, tmp_path / "raw", "repeated", hours=12)
    write_archive(spark, tmp_path / "raw2", "corrupt", hours=12)
    store = medallion.run(spark, source, str(tmp_path / "store"), "2024-02-01")
    events = store.read_fact(spark, "events")
    assert events.count() == events.select("event_id").distinct().count()
    broken = medallion.run(spark, str(tmp_path / "raw2"), str(tmp_path / "store2"), "2024-02-01")
    assert spark.read.parquet(broken.quarantine).filter("length(value) = 10").count() > 0
    counts = {r.table_name: r.rows for r in row_counts({"e": broken.read_fact(spark, "events"), "p": broken.read_fact(spark, "payload_details")}).collect()}
    assert counts["e"] == counts["p"] > 0


def test_validation_report(spark, tmp_path):
    source = write_archive(spark, tmp_path / "raw", "plain", hours=12)
    victim = sorted(os.path.join(d, f) for d, _, fs in os.walk(source) for f in fs)[3]
    with open(victim, "wb") as out:
        out.write(b"this is no gzip file")
    rules = tmp_path / "rules.json"
    rules.write_text(json.dumps({"required_fields": ["id", "org"], "field_types": {"id": "string", "repo": "object"}}))
    validation.run(spark, source, str(tmp_path / "report"), str(rules))
    files = {r.file_path: r for r in spark.read.json(str(tmp_path / "report" / "files")).collect()}
    assert len(files) == 12
    bad = [r for p, r in files.items() if p.endswith(victim)][0]
    assert bad.status == "error" and bad.readable is False
    assert spark.read.json(str(tmp_path / "report" / "summary")).first().status == "error"
    errors = spark.read.json(str(tmp_path / "report" / "errors"))
    assert {(r.field, r.problem) for r in errors.select("field", "problem").distinct().collect()} == {("org", "missing")}
    assert errors.groupBy("file_path").count().agg(F.max("count")).first()[0] <= 20
    sampled = validation.validate(spark, source, sample=1)
    assert sampled["files"].agg(F.max("lines")).first()[0] == 1
    write_report({"summary": sampled["summary"]}, str(tmp_path / "report2"), "parquet")


def test_file_listing(spark, tmp_path):
    source = write_archive(spark, tmp_path / "raw", "plain", hours=3)
    listed = list_files(spark, source, "*.json.gz")
    row = storage_stats(listed).first()
    sizes = [os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(source) for f in fs]
    assert (row.total_files, row.total_bytes) == (3, sum(sizes))
    assert content_hashes(read_contents(spark, source)).filter("length(md5_hash) = 32").count() == 3
    read = read_lines(spark, source, partitions=4)
    assert {r.file_path for r in read.select("file_path").distinct().collect()} == {r.file_path for r in listed.collect()}


def test_readers(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a.parquet"))
    spark.range(2).write.option("header", True).csv(str(tmp_path / "b.csv"))
    assert read_dataset(spark, str(tmp_path / "a.parquet")).count() == 3
    assert read_dataset(spark, str(tmp_path / "b.csv")).dtypes == [("id", "int")]
    assert read_dataset(spark, str(tmp_path / "none.csv")) is None
    with pytest.raises(ValueError):
        read_dataset(spark, "x.json")
    with pytest.raises(FileNotFoundError):
        read_layer_table(spark, [str(tmp_path / "none")])


def test_model_run(spark, tmp_path):
    rows = [(i, float(i % 3 * 10 + i % 2), float(i % 3)) for i in range(60)]
    spark.createDataFrame(rows, "repo_id bigint, total_events double, unique_actors double").write.parquet(str(tmp_path / "m.parquet"))
    out = str(tmp_path / "models")
    scores = modelling.run(spark, [str(tmp_path / "m.parquet"), str(tmp_path / "absent.parquet")], out, k=3, percent=None).first()
    assert scores.n_clusters == 3 and scores.silhouette > 0.9
    assert spark.read.parquet(f"{out}/model_runs").count() == 1
    assert spark.read.option("header", True).csv(f"{out}/cluster_centroids").columns == ["cluster", "total_events", "unique_actors"]
