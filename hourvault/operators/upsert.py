"""Incremental maintenance: new rows only, fact merge and dimension upsert.

Plain Parquet has no MERGE, so each operator returns the new content; the
store writes it beside the old version and switches the pointer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def new_rows(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Source rows whose key the target does not hold. NULL keys count as new and never empty the result."""
    return source.join(target.select(key), key, "left_anti")


def within_span(target: DataFrame, source: DataFrame, column: str) -> DataFrame:
    """Target rows inside the value span of the source, and those without a value.

    A repeated event carries the same time as its first copy, so only rows in
    the span need to be compared; a copy without a time matches rows without
    one. The span is one row of two values, read on the driver, and reaches
    the scan's row group filters as literals.
    """
    low, high = source.agg(F.min(column), F.max(column)).first()
    without = F.col(column).isNull()
    return target.filter(without if low is None else without | F.col(column).between(low, high))


def one_per_key(source: DataFrame, key: str) -> DataFrame:
    """Drop repeated copies of a row; copies of one key are equal, so any of them serves.

    The rows are read once: copies go within each task before the shuffle, so
    that a key with very many of them stays small. Rows without a key are all
    kept; each gets a number of its own for that.
    """
    own = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    return source.withColumn("_own", own).dropDuplicates([key, "_own"]).drop("_own")


def one_version(rows: DataFrame, key: str) -> DataFrame:
    """One row per key of flat events: the newest by event_time, of equal times the one with the greatest hash.

    Rows with a key of their own, and rows without one, stay out of the shuffle of whole rows.
    """
    repeated = rows.groupBy(key).agg(F.count("*").alias("_copies")).filter("_copies > 1").select(key)
    once = rows.join(repeated, key, "left_anti")
    best = rows.join(repeated, key, "left_semi").groupBy(key).agg(
        F.max_by(F.struct(*rows.columns), F.struct("event_time", "event_hash")).alias("_row"))
    return once.unionByName(best.select("_row.*"))


def merge_facts(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Content after an upsert by key: source rows replace target rows of the same key."""
    return target.join(source.select(key), key, "left_anti").unionByName(source)


def upsert_dimension(target: DataFrame, increment: DataFrame, key: str, prefer: str = "new") -> DataFrame:
    """Full-outer merge of a rolled-up increment into a dimension.

    Times take the least and greatest of both sides. Attributes take the new
    non-NULL value (`prefer='new'`) or the greater value (`prefer='max'`,
    equal to a rebuild under the max roll-up policy). Both sides hold one row
    per key, so no key can be hot.
    """
    new, old = increment.alias("n"), target.alias("o")

    def merged(name: str) -> Column:
        pair = (F.col(f"n.{name}"), F.col(f"o.{name}"))
        if name == "first_seen_at":
            value = F.least(*pair)
        elif name == "last_seen_at":
            value = F.greatest(*pair)
        elif name == key or prefer == "new":
            value = F.coalesce(*pair)
        elif prefer == "max":
            value = F.greatest(*pair)
        else:
            raise ValueError(f"unknown preference {prefer!r}, use 'new' or 'max'")
        return value.alias(name)

    return new.join(old, F.col(f"n.{key}") == F.col(f"o.{key}"), "full_outer").select(*[merged(c) for c in target.columns])


def carry_first_seen(increment: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Increment rows with `first_seen_at` taken from the stored dimension when the key is known."""
    known = dimension.select(key, F.col("first_seen_at").alias("_known"))
    rest = [c for c in increment.columns if c != "first_seen_at"]
    return increment.join(known, key, "left").select(
        *rest, F.least("first_seen_at", "_known").alias("first_seen_at")).select(*increment.columns)
