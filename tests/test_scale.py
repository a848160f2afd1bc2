"""Plans and shares of work that must hold on larger tables, shown on small ones."""

from collections import Counter

from pyspark.sql import functions as F

from hourvault.functions.json_fields import canonical_hash
from hourvault.operators import repeats
from hourvault.operators.bronze import parse_lines
from hourvault.operators.features import merged_features
from hourvault.operators.upsert import one_per_key
from suite import base


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_parsed_rows_are_not_broadcast(spark):
    """Few bytes of Parquet are many documents; their estimated size is far too small."""
    lines = spark.range(50).select(F.lit("f").alias("file_path"), F.format_string('{"a":%d,"b":1}', "id").alias("value"), F.col("id").alias("line_id"))
    other = lines.withColumn("value", F.format_string('{"b":1,"a":%d}', "line_id"))
    left, right = (parse_lines(x).select("line_id", canonical_hash("event").alias(n)) for x, n in ((lines, "h"), (other, "g")))
    joined = left.join(right, "line_id")
    assert "BroadcastHashJoin" not in plan(joined) and "SortMergeJoin" in plan(joined)
    assert joined.filter("h = g").count() == 50


def test_rows_of_one_row_group_are_dealt_out(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(base, "ROWS_PER_TASK", 50)
    path = str(tmp_path / "rows")
    rows = spark.range(2000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("event_id"), F.col("id").alias("ts"))
    rows.coalesce(1).write.parquet(path)
    dealt = base.spread(spark.read.parquet(path), "event_id", path)
    shares = Counter(r.p for r in dealt.select(F.spark_partition_id().alias("p")).collect())
    assert sum(shares.values()) == 2000 and len(shares) >= 35 and max(shares.values()) < 120
    assert dealt.filter("event_id IS NULL").count() == 1000


def counted(spark, rows):
    """The rows, and a counter of how often each was made."""
    made = spark.sparkContext.accumulator(0)

    def over(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    return rows.mapInArrow(over, rows.schema), made


def test_new_ids_are_made_once_for_all_parts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "IDS_AT_A_TIME", 100)
    rows = spark.range(950).selectExpr("CAST(id AS STRING) AS event_id", "'2024-01-01' AS file_date", "CAST(id % 3 AS STRING) AS hour_bucket")
    ids, made = counted(spark, rows.select("event_id"))
    assert repeats.hits(repeats.id_filters(rows).cache(), ids).count() == 950
    assert made.value == 950


def test_filters_hold_a_row_per_id_not_per_bit(spark):
    """Bits of repeated ids, in blocks that span batches, are those of all ids; the sort holds an id once."""
    rows = spark.range(6000).selectExpr("CAST(id % 3000 AS STRING) AS event_id", "'2024-01-01' AS file_date", "'05' AS hour_bucket")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        made = repeats.id_filters(rows)
        filters = made.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "explode" not in plan(made) and len(filters) == 6 and {r.n for r in filters} == {6000}
    assert {len(r.bits) for r in filters} == {repeats.BLOCK_BITS // 8} and sorted(r.block for r in filters) == list(range(6))
    assert repeats.hits(spark.createDataFrame(filters, repeats.FILTER), rows).count() == 3000


def test_single_copies_from_one_pass(spark):
    """A dominant key, rows without a key, which all stay, and a source that is read once."""
    rows = spark.range(900).selectExpr("CASE WHEN id < 300 THEN 0 WHEN id % 9 > 0 THEN id END AS k", "'x' AS v").repartition(5)
    source, made = counted(spark, rows)
    found = one_per_key(source, "k")
    missing = rows.filter("k IS NULL").count()
    assert found.columns == ["k", "v"] and missing > 60
    assert Counter(r.k is None for r in found.collect()) == {True: missing, False: 601 - missing}
    assert made.value == 900


def test_merged_features_read_their_tables_once(spark):
    source, made = counted(spark, spark.range(300).selectExpr("id % 20 AS repo_id", "CAST(id AS DOUBLE) AS x"))
    features = merged_features([source], "repo_id")
    assert features.count() == 20 and abs(features.agg(F.sum("x")).first()[0]) < 1e-9
    assert made.value == 300
