"""Damaged gzip files: what is wrong with them, and what can still be read."""

import gzip
import zlib

import pytest
from pyspark.sql import functions as F

from hourvault.plans import validation
from hourvault.sources import damage
from hourvault.sources.sinks import load_once, read_loaded
from hourvault.sources.storage import read_contents

TEXT = "".join(f'{{"id": "{k}", "type": "PushEvent"}}\n' for k in range(3000)).encode()
WHOLE = gzip.compress(TEXT, mtime=0)
FILES = {
    "sound": (WHOLE, "sound"),
    "two-members": (WHOLE + gzip.compress(b"tail without line feed"), "sound"),
    "padded": (WHOLE + b"\0" * 100, "sound"),
    "nothing-inside": (gzip.compress(b""), "sound"),
    "empty": (b"", "empty"),
    "cut": (WHOLE[:len(WHOLE) // 2], "cut"),
    "cut-in-trailer": (WHOLE[:-3], "cut"),
    "cut-in-second": (WHOLE + WHOLE[:200], "cut"),
    "cut-in-header": (WHOLE[:2], "cut"),
    "checksum": (WHOLE[:-8] + bytes([WHOLE[-8] ^ 1]) + WHOLE[-7:], "broken"),
    "length": (WHOLE[:-1] + bytes([WHOLE[-1] ^ 1]), "broken"),
    "data": (WHOLE[:100] + b"\xff\xff\xff\xff" + WHOLE[104:], "broken"),
    "foreign": (b"this is no gzip file", "foreign"),
    "trailing": (WHOLE + b"junk", "trailing"),
}


@pytest.fixture(scope="module")
def contents(spark):
    rows = [(name, len(data), data) for name, (data, _) in FILES.items()] + [("large", 1 << 40, None)]
    return spark.createDataFrame(rows, "file_path string, size_bytes bigint, content binary").repartition(3)


def test_health(contents):
    found = {r.file_path: r for r in damage.file_health(contents).collect()}
    assert {n: r.health for n, r in found.items()} == {n: h for n, (_, h) in FILES.items()} | {"large": "too large"}
    assert found["sound"].readable_bytes == len(TEXT) and found["sound"].readable_lines == 3000
    assert (found["two-members"].members, found["two-members"].readable_lines) == (2, 3001)
    assert found["cut-in-second"].damaged_at == len(WHOLE) and found["cut-in-second"].members == 1
    assert found["trailing"].damaged_at == len(WHOLE) and found["trailing"].readable_lines == 3000
    for name in ("cut", "checksum", "length", "cut-in-trailer"):
        assert found[name].damaged_at == 0 and found[name].problem and 0 < found[name].readable_bytes <= len(TEXT)
    assert found["empty"].readable_lines == found["nothing-inside"].readable_lines == found["foreign"].readable_lines == 0
    assert damage.file_health(contents.limit(0)).collect() == []


def test_pieces_are_bounded_and_agree(monkeypatch):
    bomb = gzip.compress(b"0" * (64 << 20))
    assert max(len(p) for p in damage.unpacked(bomb)) <= 4 * damage.STEP
    for step in (7, 1000, 1 << 18):
        monkeypatch.setattr(damage, "STEP", step)
        got = b"".join(damage.unpacked(WHOLE[:500] if step < 8 else WHOLE))
        assert got == TEXT or step < 8 and TEXT.startswith(got) and len(got) >= len(zlib.decompressobj(31).decompress(WHOLE[:500]))
        assert b"\n".join(x for lines in damage.whole_lines(WHOLE) for x in lines) + b"\n" == TEXT


def test_salvaged_lines(contents):
    lines = damage.salvaged_lines(contents)
    counts = {r.file_path: r["count"] for r in lines.groupBy("file_path").count().collect()}
    assert counts["sound"] == counts["checksum"] == counts["trailing"] == 3000 and counts["two-members"] == 3001
    assert 0 < counts["cut"] < 3000 and not {"empty", "foreign", "large", "nothing-inside"} & set(counts)
    want = TEXT.decode().splitlines()
    got = sorted((r.line_id, r.value) for r in lines.filter("file_path = 'cut'").collect())
    assert got == list(enumerate(want[:len(got)]))


def test_validation_of_damaged_files(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for k, name in enumerate(("sound", "cut", "checksum", "foreign", "empty")):
        (folder / f"2024-01-01-{k}.json.gz").write_bytes(FILES[name][0])
    validation.run(spark, str(folder), str(tmp_path / "report"))
    files = {r.file_path[-9]: r for r in spark.read.json(str(tmp_path / "report" / "files")).collect()}
    assert [files[k].status for k in "01234"] == ["valid", "error", "error", "error", "warning"]
    assert [files[k].health for k in "01234"] == ["sound", "cut", "broken", "foreign", "empty"]
    totals = spark.read.json(str(tmp_path / "report" / "metrics")).first()
    assert (totals.total_files, totals.valid_files, totals.errors, totals.status) == (5, 1, 3, "error")
    assert totals.events_by_type.asDict()["PushEvent"] == totals.total_events >= 3000


def test_files_too_large_are_listed(spark, tmp_path):
    (tmp_path / "a.gz").write_bytes(WHOLE)
    (tmp_path / "b.gz").write_bytes(b"x")
    got = read_contents(spark, str(tmp_path), largest=10).select("file_path", F.col("content").isNull().alias("left_out")).collect()
    assert sorted((r.file_path[-4:], r.left_out) for r in got) == [("a.gz", True), ("b.gz", False)]


def test_bulk_load_reports_skipped_files_and_rejects(spark, tmp_path):
    source, target, ledger = (str(tmp_path / x) for x in ("in", "table", "ledger"))
    columns = {"id": "bigint", "n": "int"}
    spark.createDataFrame([("1", "5"), ("x", "6"), (None, "y")], "id string, n string").coalesce(1).write.parquet(f"{source}/a")
    (tmp_path / "in" / "broken.parquet").write_bytes(b"no parquet at all")
    first = {r.status: r for r in load_once(spark, source, target, columns, ledger).collect()}
    assert first["skipped"].rows == 0 and first["skipped"].file_path.endswith("broken.parquet")
    assert first["loaded"].rows == 3 and first["loaded"].rejects == {"id": 1, "n": 1}
    assert load_once(spark, source, target, columns, ledger).collect() == []
    assert sorted(map(str, read_loaded(spark, target, columns).select("id", "n").collect())) == sorted(
        map(str, spark.createDataFrame([(1, 5), (None, 6), (None, None)], "id bigint, n int").collect()))
    # A file that has changed is another file; a load that broke off before its ledger row is done again, once.
    spark.createDataFrame([("7", "8")], "id string, n string").coalesce(1).write.parquet(f"{source}/b")
    spark.createDataFrame([("7", "8")], "id string, n string").write.parquet(f"{target}/load=1")
    assert [r.rows for r in load_once(spark, source, target, columns, ledger).collect()] == [1]
    assert read_loaded(spark, target, columns).count() == 4
