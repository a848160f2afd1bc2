"""Reports on the silver tables: trends, rankings, unusual hours and a simple forecast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hourvault.functions.names import is_bot, owner_of, short_name_of
from hourvault.functions.times import hour_of
from hourvault.operators.gold import actor_metrics, entity_metrics


#: Hours of a season, weights of the newest hour in level, trend and season, and deviations to each side of a band.
SEASON = 24
ALPHA, BETA, GAMMA = 0.3, 0.05, 0.2
BAND = 3.0


def daily_activity(events: DataFrame) -> DataFrame:
    """Events and users per day and type."""
    return events.groupBy(F.to_date("created_at").alias("day"), "event_type").agg(
        F.count("*").alias("event_count"), F.countDistinct("actor_id").alias("user_count"))


def winners(ranked: DataFrame) -> DataFrame:
    """The n rows of a top-n report as rows of their own: what they were counted from is not read again."""
    return ranked.sparkSession.createDataFrame(ranked.toArrow(), ranked.schema)


def rows_of(dimension: DataFrame, top: DataFrame, key: str) -> DataFrame:
    """Dimension rows of the winners. A short list of keys is sent to the scan, so the dimension is not shuffled."""
    return dimension.join(top.select(key), key, "left_semi")


def top_repositories(events: DataFrame, repositories: DataFrame, n: int = 10) -> DataFrame:
    """The n busiest repositories; equal counts are ranked by id. Names are looked up for the winners only."""
    top = winners(entity_metrics(events, "repo_id", "actor_id", "unique_contributors")
                  .orderBy(F.col("total_events").desc(), F.col("repo_id")).limit(n))
    return top.join(rows_of(repositories, top, "repo_id"), "repo_id", "left").select(
        "repo_id", "repo_name", owner_of("repo_name").alias("owner"),
        short_name_of("repo_name").alias("repo_short_name"),
        F.col("total_events").alias("event_count"), "unique_contributors",
        F.col("last_event").alias("last_activity")).orderBy(F.col("event_count").desc(), "repo_id")


def repository_summary(events: DataFrame, repositories: DataFrame) -> DataFrame:
    """Repository names, first and last time and number of events."""
    counts = events.filter(F.col("repo_id").isNotNull()).groupBy("repo_id").agg(F.count("*").alias("event_count"))
    return repositories.join(counts, "repo_id", "left").select(
        "repo_id", "repo_name", owner_of("repo_name").alias("owner"),
        short_name_of("repo_name").alias("repo_short_name"), "first_seen_at", "last_seen_at", "event_count")


def repository_popularity(sightings: DataFrame) -> DataFrame:
    """Highest stars, forks and watchers per repository and day, from events that carry them.

    The name joins the grouping so that the large pass stays a hash aggregate.
    """
    seen = sightings.filter(F.col("stars_count").isNotNull() | F.col("forks_count").isNotNull()
                            | F.col("watchers_count").isNotNull())
    measures = ["stars_count", "forks_count", "watchers_count"]
    by_name = seen.groupBy("repo_id", F.to_date("event_time").alias("date"), "repo_name").agg(
        *[F.max(m).alias(m) for m in measures])
    return by_name.groupBy("repo_id", "date").agg(F.max("repo_name").alias("repo_name"),
                                                  *[F.max(m).alias(m) for m in measures])


def time_based_activity(events: DataFrame) -> DataFrame:
    """Events per hour of day and date."""
    return events.filter(F.col("created_at").isNotNull()).groupBy(
        F.hour("created_at").alias("hour_of_day"), F.to_date("created_at").alias("date")).agg(
        F.count("*").alias("event_count"))


def busy_hours(events: DataFrame) -> DataFrame:
    """Events per hour of day over the whole period, busiest first."""
    return events.filter(F.col("created_at").isNotNull()).groupBy(F.hour("created_at").alias("hour_of_day")).agg(
        F.count("*").alias("event_count")).orderBy(F.col("event_count").desc(), "hour_of_day")


def influential_users(events: DataFrame, actors: DataFrame, n: int = 10) -> DataFrame:
    """The n most active accounts that are no bots; bots are dropped before counting."""
    people = events.filter(~is_bot("actor_login"))
    top = winners(actor_metrics(people).orderBy(F.col("total_events").desc(), F.col("actor_id")).limit(n))
    return top.join(rows_of(actors.select("actor_id", "actor_login"), top, "actor_id"), "actor_id", "left").select(
        "actor_id", "actor_login", "total_events", "unique_repos").orderBy(F.col("total_events").desc(), "actor_id")


def contribution_by_type(events: DataFrame) -> DataFrame:
    """Events per account and type, with the share in the account's total. Bots are left out."""
    per_type = events.filter(F.col("actor_id").isNotNull() & ~is_bot("actor_login")).groupBy("actor_id", "event_type").agg(
        F.count("*").alias("event_count"))
    # After counting, an account has at most one row per event type, so its window stays small.
    total = F.sum("event_count").over(W.partitionBy("actor_id"))
    return per_type.select("actor_id", "event_type", "event_count", F.round(F.col("event_count") / total, 6).alias("share"))


def language_activity(events: DataFrame, repositories: DataFrame) -> DataFrame:
    """Events per repository language and day.

    Events are counted per repository and day before the join, so the join
    sees one row per repository and day and no repository is hot.
    """
    counts = events.filter(F.col("repo_id").isNotNull()).groupBy(
        "repo_id", F.to_date("created_at").alias("date")).agg(F.count("*").alias("n"))
    return counts.join(repositories.select("repo_id", "language"), "repo_id", "left").groupBy("language", "date").agg(
        F.sum("n").alias("event_count"))


def hourly_counts_by_type(events: DataFrame) -> DataFrame:
    return events.filter(F.col("created_at").isNotNull()).groupBy("event_type", hour_of("created_at").alias("hour")).agg(
        F.count("*").alias("event_count"))


def unusual_hours(events: DataFrame, threshold: float = 3.0) -> DataFrame:
    """Hourly counts per type with their z-score and a flag beyond the threshold.

    Mean and deviation come from an aggregate joined back, not from a window
    that would hold all hours of a type in one task.
    """
    hourly = hourly_counts_by_type(events)
    stats = hourly.groupBy("event_type").agg(F.avg("event_count").alias("mean"), F.stddev_pop("event_count").alias("deviation"))
    z = F.when(F.col("deviation") > 0, (F.col("event_count") - F.col("mean")) / F.col("deviation")).otherwise(F.lit(0.0))
    return hourly.join(stats, "event_type").select(
        "event_type", "hour", "event_count", F.round(z, 6).alias("z_score"),
        (F.abs(F.round(z, 6)) >= threshold).alias("is_unusual"))


def activity_forecast(events: DataFrame, days: int = 7) -> DataFrame:
    """Linear trend of daily counts per type, carried `days` days past the last day of the data."""
    daily = events.filter(F.col("created_at").isNotNull()).groupBy("event_type", F.to_date("created_at").alias("day")).agg(
        F.count("*").alias("n"))
    number = F.unix_date("day")
    trend = daily.groupBy("event_type").agg(
        F.regr_slope(F.col("n"), number).alias("slope"),
        F.regr_intercept(F.col("n"), number).alias("intercept"),
        F.max("day").alias("last_day"))
    ahead = trend.select("*", F.explode(F.sequence(F.lit(1), F.lit(days))).alias("step")).select(
        "event_type", F.date_add("last_day", F.col("step")).alias("day"), "slope", "intercept")
    return ahead.select("event_type", "day", F.round("slope", 6).alias("slope"),
                        F.round(F.col("intercept") + F.col("slope") * F.unix_date("day"), 4).alias("forecast"))


def hourly_series(events: DataFrame, keys: list[str]) -> DataFrame:
    """Events of each series and hour, from the series' first to its last hour; hours without an event count 0."""
    counts = events.filter(F.col("created_at").isNotNull()).groupBy(*keys, hour_of("created_at").alias("hour")).agg(F.count("*").alias("n"))
    span = counts.groupBy(*keys).agg(F.min("hour").alias("_first"), F.max("hour").alias("_last"))
    hours = span.select(*keys, F.explode(F.sequence("_first", "_last", F.expr("interval 1 hour"))).alias("hour"))
    same = [hours[k].eqNullSafe(counts[k]) for k in keys] + [hours["hour"] == counts["hour"]]
    return hours.join(counts, same, "left").select(*[hours[k] for k in keys], hours["hour"], F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def seasonal_fold(series: DataFrame, keys: list[str], season: int = SEASON, alpha: float = ALPHA, beta: float = BETA, gamma: float = GAMMA,
                  width: float = BAND) -> DataFrame:
    """Additive Holt-Winters smoothing of each series: keys, first hour, number of hours, level, trend, seasonal, deviation and alarms.

    The first `season` hours set the level (their mean) and the seasonal differences; every later hour is forecast from
    those before it, then smoothed in. An hour is an alarm if it lies further from its forecast than `width` deviations
    of the forecasts so far, once a whole season has been forecast. One ordered fold for each series, over its hours:
    their number is the length of the history, not of the events. Shorter series have a level and no forecast.
    """
    ordered = series.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("hour", F.col("n").cast("double").alias("n")))).alias("_hours"))
    first = F.slice("_hours", 1, season)
    level = F.aggregate(first, F.lit(0.0), lambda s, h: s + h["n"]) / F.size(first)
    m = F.lit(season)
    alarm = "array<struct<hour:timestamp_ntz,n:double,forecast:double>>"
    start = F.struct(F.lit(0).alias("t"), F.col("_level").alias("level"), F.lit(0.0).alias("trend"), F.col("_seasonal").alias("seasonal"),
                     F.lit(0.0).alias("squares"), F.array().cast(alarm).alias("alarms"))

    def step(state: Column, hour: Column) -> Column:
        # The parts of a step are named in turn, so that each is worked out once.
        old = F.element_at(state["seasonal"], (state["t"] % m + 1).cast("int"))
        named = F.struct(state.alias("s"), hour.alias("h"), old.alias("old"), (state["level"] + state["trend"]).alias("base"))
        return F.transform(F.array(named), lambda x: F.struct(
            x["s"].alias("s"), x["h"].alias("h"), x["old"].alias("old"), (x["base"] + x["old"]).alias("forecast"),
            (F.lit(alpha) * (x["h"]["n"] - x["old"]) + F.lit(1 - alpha) * x["base"]).alias("level")))[0]

    def merged(state: Column, hour: Column) -> Column:
        return F.transform(F.array(step(state, hour)), lambda x: F.struct(
            (x["s"]["t"] + 1).alias("t"), x["level"].alias("level"),
            (F.lit(beta) * (x["level"] - x["s"]["level"]) + F.lit(1 - beta) * x["s"]["trend"]).alias("trend"),
            F.transform(x["s"]["seasonal"], lambda v, k: F.when(
                k == x["s"]["t"] % m, F.lit(gamma) * (x["h"]["n"] - x["level"]) + F.lit(1 - gamma) * x["old"]).otherwise(v)).alias("seasonal"),
            (x["s"]["squares"] + (x["h"]["n"] - x["forecast"]) * (x["h"]["n"] - x["forecast"])).alias("squares"),
            F.when((x["s"]["t"] >= m) & (F.abs(x["h"]["n"] - x["forecast"]) > F.lit(width) * F.sqrt(x["s"]["squares"] / x["s"]["t"])),
                   F.concat(x["s"]["alarms"], F.array(F.struct(x["h"]["hour"].alias("hour"), x["h"]["n"].alias("n"), x["forecast"].alias("forecast")))))
            .otherwise(x["s"]["alarms"]).alias("alarms")))[0]

    folded = ordered.withColumn("_level", level).withColumn("_seasonal", F.transform(first, lambda h: h["n"] - F.col("_level"))).withColumn(
        "_state", F.aggregate(F.slice("_hours", season + 1, F.greatest(F.size("_hours") - season, F.lit(0))), start, merged))
    return folded.select(
        *keys, F.element_at("_hours", -1)["hour"].alias("last_hour"), F.size("_hours").alias("hours"), F.col("_state.level").alias("level"),
        F.col("_state.trend").alias("trend"), F.col("_state.seasonal").alias("seasonal"),
        F.when(F.col("_state.t") > 0, F.sqrt(F.col("_state.squares") / F.col("_state.t"))).alias("deviation"), F.col("_state.alarms").alias("alarms"))


def seasonal_forecast(folded: DataFrame, keys: list[str], ahead: int = SEASON, season: int = SEASON, width: float = BAND) -> DataFrame:
    """The next hours of each series with a whole season behind it, and the band that holds them."""
    steps = folded.filter(F.col("hours") > season).select("*", F.explode(F.sequence(F.lit(1), F.lit(ahead))).alias("step"))
    place = ((F.col("hours") - season + F.col("step") - 1) % season + 1).cast("int")
    forecast = F.col("level") + F.col("step") * F.col("trend") + F.element_at("seasonal", place)
    return steps.select(*keys, (F.col("last_hour") + F.make_dt_interval(hours="step")).alias("hour"), F.round(forecast, 4).alias("forecast"),
                        F.round(forecast - width * F.col("deviation"), 4).alias("low"), F.round(forecast + width * F.col("deviation"), 4).alias("high"))


def seasonal_alarms(folded: DataFrame, keys: list[str]) -> DataFrame:
    """Hours outside the band that the hours before them promised."""
    return folded.select(*keys, F.explode("alarms").alias("a")).select(
        *keys, "a.hour", F.col("a.n").cast("bigint").alias("event_count"), F.round("a.forecast", 4).alias("forecast"))
