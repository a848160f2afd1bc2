"""Feature tables for clustering: sample, numeric columns, merge by key and z-scores."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from hourvault.session import enable_checkpoints


def numeric_columns(df: DataFrame, drop: tuple[str, ...] = ()) -> list[str]:
    """Names of the numeric columns without the dropped ones."""
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType) and f.name not in drop]


def in_sample(key: str, percent: int = 15) -> Column:
    """True for about `percent` of the keys, the same ones on every run and engine."""
    head = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    return head % 100 < percent


def sample_rows(df: DataFrame, key: str, percent: int = 15) -> DataFrame:
    return df.filter(in_sample(key, percent))


def scaled(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """Z-scores with the population deviation; a constant column becomes 0.

    The means and deviations are one row, fetched once and used as literals.
    """
    stats = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
                   *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()

    def z(i: int, name: str) -> Column:
        mean, deviation = stats[f"m{i}"], stats[f"s{i}"]
        if mean is None or not deviation:
            return F.when(F.col(name).isNotNull(), F.lit(0.0)).alias(name)
        return ((F.col(name).cast("double") - F.lit(float(mean))) / F.lit(float(deviation))).alias(name)

    return df.select(*keep, *[z(i, c) for i, c in enumerate(columns)])


def feature_table(df: DataFrame, key: str = "repo_id", percent: int | None = None, keep_id: bool = False) -> DataFrame:
    """Key plus scaled numeric columns of one metric table; `keep_id` also scales the key as a feature."""
    rows = sample_rows(df, key, percent) if percent is not None else df
    columns = numeric_columns(df, drop=(key,))
    if keep_id:
        rows, columns = rows.withColumn(f"{key}_feature", F.col(key)), [f"{key}_feature", *columns]
    return scaled(rows, columns, keep=[key])


def mean_per_key(df: DataFrame, key: str = "repo_id") -> DataFrame:
    """One row per key with the mean of every other numeric column."""
    return df.groupBy(key).agg(*[F.avg(c).alias(c) for c in numeric_columns(df, drop=(key,))])


def join_datasets(frames: list[DataFrame], key: str = "repo_id") -> DataFrame:
    """Inner join of all frames on the key; a name on both sides gets the suffixes _x and _y."""
    def join(left: DataFrame, right: DataFrame) -> DataFrame:
        clash = [c for c in left.columns if c != key and c in right.columns]
        return left.withColumnsRenamed({c: f"{c}_x" for c in clash}).join(
            right.withColumnsRenamed({c: f"{c}_y" for c in clash}), key, "inner")

    return reduce(join, frames)


def merged_features(frames: list[DataFrame | None], key: str = "repo_id", percent: int | None = None,
                    keep_id: bool = False) -> DataFrame:
    """Feature table of several metric tables: those with the key and numeric columns, averaged per key and joined.

    Averaging and joining use the same key, so each table is shuffled once. The joined rows, one per key, are
    checkpointed: scaling, models and scores read them again and again, the tables are read once.
    """
    usable = [f for f in frames if f is not None and key in f.columns and numeric_columns(f, drop=(key,))]
    if not usable:
        raise ValueError("no table with the key and numeric columns")
    joined = join_datasets([mean_per_key(f, key) for f in usable], key)
    enable_checkpoints(joined.sparkSession)
    return feature_table(joined.checkpoint(), key, percent, keep_id)


def as_points(features: DataFrame, key: str = "repo_id") -> DataFrame:
    """Key and one vector column `features`."""
    columns = [c for c in features.columns if c != key]
    return VectorAssembler(inputCols=columns, outputCol="features").transform(features).select(key, "features")
