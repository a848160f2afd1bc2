"""Query registry, archive-shaped input built from the given tables, and shared SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourvault.functions.times import archive_path
from hourvault.operators.bronze import bronze_events, parse_lines
from hourvault.operators.silver import flatten, silver_events
from hourvault.session import shared_dir, use_utc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, recursive: bool = False):
    """Register a query; `sql` may use the views of EVENTS_SQL, also in recursive ones."""
    def add(run: Query) -> Query:
        def with_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(use_utc(spark), sf_dir)

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = with_utc
        if sql is not None:
            whole = EVENTS_SQL + sql if " ev" in sql else sql
            ORACLES[name] = whole.replace("WITH base", "WITH RECURSIVE base", 1) if recursive else whole
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows that one task turns into archive documents.
ROWS_PER_TASK = 50_000


def spread(df: DataFrame, key: str, name: str) -> DataFrame:
    """Deal rows out over all cores, or over more tasks where these would hold more than ROWS_PER_TASK rows each.

    Few rows of Parquet become many bytes of documents, and a row group is one task's, however large it is. Rows are
    dealt by the key, those without one by their other columns. They are counted once per application.
    """
    context = df.sparkSession.sparkContext
    place = (context.applicationId, name)
    if place not in _TASKS:
        _TASKS[place] = max(context.defaultParallelism, -(-df.count() // ROWS_PER_TASK))
    others = [F.when(F.col(key).isNull(), F.col(c)) for c in df.columns if c != key]
    return df.repartition(_TASKS[place], key, *others)


_TASKS: dict[tuple[str, str], int] = {}


def _text(value) -> Column:
    return F.lit(value) if isinstance(value, str) else value


def archive_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table with the number in `props` as `k` and the archive event type as `kind`."""
    events = spread(table(spark, sf_dir, "events"), "event_id", sf_dir).withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    odd = F.col("k") % 2 == 1
    kind = (F.when(F.col("event_type") == "click", "PushEvent").when(F.col("event_type") == "view", "WatchEvent")
            .when(F.col("event_type") == "purchase", "PullRequestEvent")
            .when(F.col("event_type") == "signup", F.when(odd, "DeleteEvent").otherwise("CreateEvent"))
            .otherwise(F.when(odd, "IssueCommentEvent").otherwise("IssuesEvent")))
    return events.withColumn("kind", kind)


def document(no_actor: Column | None = None, reverse: bool = False) -> Column:
    """An archive document of one event as JSON text; `reverse` writes the keys in the opposite order."""
    eid, k, kind, user = (F.col(c) for c in ("event_id", "k", "kind", "user_id"))

    def only(condition: Column, value: Column | str) -> Column:
        return F.when(condition, _text(value))

    def struct(**fields: Column) -> Column:
        items = list(fields.items())
        return F.struct(*[c.alias(n) for n, c in (reversed(items) if reverse else items)])

    push, pull = kind == "PushEvent", kind == "PullRequestEvent"
    suffix = F.when(user % 5 == 0, "[bot]").when(user % 7 == 0, "-bot").otherwise("")
    owner = F.concat(F.lit("owner"), k % 10)
    branch = F.concat(F.lit("refs/heads/b"), k % 4)
    action = (F.when(pull, F.when(k % 2 == 0, "opened").otherwise("closed")).when(kind == "IssuesEvent", "opened")
              .when(kind == "IssueCommentEvent", "created").when(kind == "WatchEvent", "started"))
    actor = struct(id=user, login=F.concat(F.lit("user_"), user, suffix))
    payload = struct(
        action=action,
        pull_request=only(pull, F.struct((eid + 1_000_000).alias("id"))),
        issue=only(kind == "IssuesEvent", F.struct((eid + 2_000_000).alias("id"))),
        comment=only(kind == "IssueCommentEvent", F.struct((eid + 3_000_000).alias("id"))),
        size=only(push, eid % 20),
        distinct_size=only(push, eid % 10),
        head=only(push, F.md5(eid.cast("string"))),
        before=only(push, F.md5((eid - 1).cast("string"))),
        ref=only(kind.isin("PushEvent", "CreateEvent", "DeleteEvent"), branch),
        ref_type=only(kind.isin("CreateEvent", "DeleteEvent"), F.when(k % 4 < 2, "branch").otherwise("tag")),
        repository=only(pull, struct(
            language=F.when(k % 4 == 1, "Python").when(k % 4 == 2, "Go").when(k % 4 == 3, "Rust"),
            fork=k % 5 == 0, stargazers_count=eid % 1000, forks_count=eid % 100, open_issues_count=eid % 50,
            watchers_count=eid % 500, size=eid % 2000)),
    )
    return F.to_json(struct(
        id=eid.cast("string"),
        type=kind,
        actor=actor if no_actor is None else F.when(~no_actor, actor),
        repo=struct(id=k, name=F.when(k % 25 == 0, F.concat(F.lit("repo"), k)).otherwise(F.concat(owner, F.lit("/repo"), k))),
        org=only(k % 3 == 0, struct(id=k % 10, login=owner)),
        public=F.when(eid % 10 == 0, F.lit(None)).otherwise(eid % 10 != 1),
        created_at=F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        payload=payload,
    ))


def archive_lines(spark: SparkSession, sf_dir: str, variant: str = "plain") -> DataFrame:
    """Lines of the raw archive with their file: file_path, value and the event number.

    Variants: `corrupt` cuts every 97th line, `no_actor` leaves the actor out
    of every 50th event, `repeated` holds every 20th event twice, `gaps` lacks
    every 6th hour, `reordered` writes keys in another order, `early` and
    `late` are the two halves of an incremental load, `first_half` and
    `second_half` split every hour; the second also repeats every 50th event
    of the first and cuts every 97th line.
    """
    events = archive_events(spark, sf_dir)
    eid = F.col("event_id")
    if variant == "repeated":
        copies = F.when(eid % 20 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        events = events.withColumn("_copy", F.explode(copies))
    elif variant == "gaps":
        events = events.filter(F.hour("ts") % 6 != 0)
    elif variant == "early":
        events = events.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    elif variant == "late":
        events = events.filter(F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz"))
    elif variant == "first_half":
        events = events.filter(eid % 2 == 0)
    elif variant == "second_half":
        events = events.filter((eid % 2 == 1) | (eid % 50 == 0))
    text = document(no_actor=eid % 50 == 0 if variant == "no_actor" else None, reverse=variant == "reordered")
    if variant in ("corrupt", "second_half"):
        text = F.when(eid % 97 == 0, F.substring(text, 1, 10)).otherwise(text)
    return events.select(F.concat(F.lit("archive/"), archive_path("ts")).alias("file_path"), text.alias("value"),
                         eid.alias("line_id"))


def bronze(spark: SparkSession, sf_dir: str, variant: str = "plain") -> DataFrame:
    return bronze_events(parse_lines(archive_lines(spark, sf_dir, variant)))


def flat(spark: SparkSession, sf_dir: str, variant: str = "plain") -> DataFrame:
    return flatten(bronze(spark, sf_dir, variant))


def events(spark: SparkSession, sf_dir: str, variant: str = "plain") -> DataFrame:
    return silver_events(flat(spark, sf_dir, variant))


_WRITTEN: dict[tuple[str, str, str], str] = {}


def written_archive(spark: SparkSession, sf_dir: str, variant: str = "plain") -> str:
    """Folder of hourly gzip files holding the lines of a variant, written once per application.

    Files lie in file_date/file_hour folders; each file is one task's share of an hour.
    """
    place = (spark.sparkContext.applicationId, sf_dir, variant)
    if place not in _WRITTEN:
        path = shared_dir(spark, f"archive-{variant}")
        lines = archive_lines(spark, sf_dir, variant)
        hour = F.regexp_extract("file_path", r"(\d{4}-\d{2}-\d{2}-\d{2})", 1)
        (lines.select("value", hour.alias("hour")).repartition("hour").write.partitionBy("hour")
         .option("compression", "gzip").text(path))
        _WRITTEN[place] = path
    return _WRITTEN[place]


EVENTS_SQL = """
WITH base AS (
  SELECT event_id, ts, user_id, event_type AS src,
         CAST(regexp_extract(props, '(-?[0-9]+)', 1) AS BIGINT) AS k
  FROM events
), ev AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS id, ts, user_id, k,
         CASE src WHEN 'click' THEN 'PushEvent' WHEN 'view' THEN 'WatchEvent' WHEN 'purchase' THEN 'PullRequestEvent'
           WHEN 'signup' THEN CASE WHEN k % 2 = 1 THEN 'DeleteEvent' ELSE 'CreateEvent' END
           ELSE CASE WHEN k % 2 = 1 THEN 'IssueCommentEvent' ELSE 'IssuesEvent' END END AS kind,
         'user_' || user_id || CASE WHEN user_id % 5 = 0 THEN '[bot]' WHEN user_id % 7 = 0 THEN '-bot' ELSE '' END AS login,
         (user_id % 5 = 0 OR user_id % 7 = 0) AS bot,
         CASE WHEN k % 25 = 0 THEN 'repo' || k ELSE 'owner' || (k % 10) || '/repo' || k END AS repo,
         CASE WHEN k % 25 <> 0 THEN 'owner' || (k % 10) END AS owner,
         CASE WHEN k % 3 = 0 THEN k % 10 END AS org,
         CASE WHEN k % 3 = 0 THEN 'owner' || (k % 10) END AS org_name,
         (event_id % 10 <> 1) AS is_public,
         date_trunc('hour', ts) AS hour,
         'archive/' || strftime(ts, '%Y/%m/%d/%Y-%m-%d-%H') || '.json.gz' AS file_path,
         strftime(ts, '%Y-%m-%d') AS file_date, strftime(ts, '%H') AS file_hour,
         CASE WHEN src = 'purchase' THEN CASE k % 4 WHEN 1 THEN 'Python' WHEN 2 THEN 'Go' WHEN 3 THEN 'Rust' END END AS language,
         CASE WHEN src = 'purchase' THEN event_id END AS pr_id
  FROM base
)
"""
