"""Event times, hours and the date parts of archive file names."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DATED_NAME = r"^\d{4}-\d{1,2}-\d{1,2}(-\d{1,2})?\."
FOLDER_HOUR = r"/hour=(\d{4})-(\d{1,2})-(\d{1,2})-(\d{1,2})/"
PATH_DATE = r"/(\d{4})/(\d{1,2})/(\d{1,2})(?:/|$)"


def parse_time(text: str | Column) -> Column:
    """ISO-8601 text to a zone-free UTC timestamp, NULL for anything else."""
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def hour_of(ts: str | Column) -> Column:
    """Floor to the hour, still zone-free."""
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def _name_parts(path: str | Column) -> list[Column]:
    """Year, month, day and hour of the file name; empty text where there are fewer."""
    stem = F.split_part(F.substring_index(path, "/", -1), F.lit("."), F.lit(1))
    return [F.split_part(stem, F.lit("-"), F.lit(i)) for i in range(1, 5)]


def _has_date(path: str | Column) -> Column:
    return F.substring_index(path, "/", -1).rlike(DATED_NAME)


def _iso_date(year: Column, month: Column, day: Column) -> Column:
    return F.concat(year, F.lit("-"), F.lpad(month, 2, "0"), F.lit("-"), F.lpad(day, 2, "0"))


def file_date(path: str | Column) -> Column:
    """yyyy-MM-dd from the file name, else from an hour=yyyy-MM-dd-HH folder or year/month/day folders, else today."""
    hour = [F.regexp_extract(path, FOLDER_HOUR, i) for i in (1, 2, 3)]
    folders = [F.regexp_extract(path, PATH_DATE, i) for i in (1, 2, 3)]
    return F.coalesce(F.when(_has_date(path), _iso_date(*_name_parts(path)[:3])),
                      F.when(hour[0] != "", _iso_date(*hour)), F.when(folders[0] != "", _iso_date(*folders)), F.current_date().cast("string"))


def file_hour(path: str | Column) -> Column:
    """Two-digit hour from the file name or an hour=yyyy-MM-dd-HH folder, 00 when there is none."""
    hour, folder = _name_parts(path)[3], F.regexp_extract(path, FOLDER_HOUR, 4)
    return (F.when(_has_date(path) & (hour != ""), F.lpad(hour, 2, "0")).when(~_has_date(path) & (folder != ""), F.lpad(folder, 2, "0"))
            .otherwise("00"))


def file_time(path: str | Column) -> Column:
    """The archive hour of a file name as a timestamp; NULL when the name holds no valid hour."""
    *date, hour = _name_parts(path)
    text = F.concat(_iso_date(*date), F.lit(" "), F.lpad(hour, 2, "0"), F.lit(":00:00"))
    return F.when(_has_date(path) & (hour != ""), F.try_to_timestamp(text).cast("timestamp_ntz"))


def archive_name(hour: str | Column) -> Column:
    return F.concat(F.date_format(hour, "yyyy-MM-dd-HH"), F.lit(".json.gz"))


def archive_path(hour: str | Column) -> Column:
    """Date folders plus file name of an archive hour."""
    return F.concat(F.date_format(hour, "yyyy/MM/dd"), F.lit("/"), archive_name(hour))


def hours_between(bounds: DataFrame, start: str, end: str, inclusive: bool = False) -> DataFrame:
    """One row `hour` per hour of [start, end) of each input row, or [start, end] when inclusive."""
    last = F.col(end) if inclusive else F.col(end) - F.expr("interval 1 hour")
    hours = F.sequence(F.col(start), last, F.expr("interval 1 hour"))
    return bounds.filter(F.col(start) <= last).select(F.explode(hours).alias("hour"))


def expected_hours(spark: SparkSession, start: dt.datetime, end: dt.datetime, max_days: int | None = None) -> DataFrame:
    """Archive hours of [start, end) with file name and path; a longer range than `max_days` is refused."""
    if end <= start:
        raise ValueError("the end must lie after the start")
    if max_days is not None and (end - start).days > max_days:
        raise ValueError(f"the range may hold at most {max_days} days")
    bounds = spark.range(1).select(F.lit(start).cast("timestamp_ntz").alias("start"),
                                   F.lit(end).cast("timestamp_ntz").alias("end"))
    return with_archive_paths(hours_between(bounds, "start", "end"))


def with_archive_paths(hours: DataFrame) -> DataFrame:
    return hours.select("hour", archive_name("hour").alias("file_name"), archive_path("hour").alias("file_path"))
