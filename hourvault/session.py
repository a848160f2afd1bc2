"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
PARTITIONS_PER_CORE = 4
CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "hourvault", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC time, adaptive plans and dynamic partition overwrite."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = use_utc(builder.getOrCreate())
    # Adaptive execution can merge shuffle partitions but not add any: start with enough for large shuffles.
    cores = spark.sparkContext.defaultParallelism
    if not spark.sparkContext.master.startswith("local") and spark.conf.get(INITIAL_PARTITIONS, None) is None:
        spark.conf.set(INITIAL_PARTITIONS, str(max(200, PARTITIONS_PER_CORE * cores)))
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Archive times end in Z and are stored without zone, so the session must be in UTC.

    JSON objects may repeat a key; the last value counts.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the cluster's checkpoint folder, visible to every executor.

    Only a local master may fall back to a temporary folder, and then the
    setting is filled in so that later calls agree on one place.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="hourvault-")
        spark.conf.set(CHECKPOINT_KEY, root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def enable_checkpoints(spark: SparkSession) -> None:
    """Point DataFrame.checkpoint() at the shared folder unless one is set already."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark, "checkpoints"))
