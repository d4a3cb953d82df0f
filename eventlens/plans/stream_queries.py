"""The event operators on a stream, run until all stored events are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.operators.filters import is_error
from eventlens.plans.aggregate_queries import ERRORS
from eventlens.plans.change_queries import rule_sql
from eventlens.plans.dataset import log_columns, rules, table, with_tables
from eventlens.plans.redaction_queries import MAIL_SQL, mail, mark_sql
from eventlens.plans.registry import naive, query, rounded
from eventlens.session import scratch_dir, state_on_disk
from eventlens.sources.tables import stream_events
from eventlens.streaming.alerts import current_alerts, live_alerts, live_transitions
from eventlens.streaming.live import (
    append_to,
    closed_slices,
    dedup,
    live_percentiles,
    live_redaction,
    live_slices,
)

E = with_tables("log_events")


def live_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table (a file, or a folder of files) as a stream, mapped to log events."""
    schema = table(spark, sf_dir, "events").schema
    # A stream source takes a folder or a pattern; a pattern fits both a file and a folder.
    raw = stream_events(spark, f"{sf_dir}/event[s].parquet", schema=schema)
    columns = [c.alias(name) for name, c in log_columns().items()]
    return raw.select("event_id", "ts", "user_id", "event_type", "props", *columns)


def drained(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """Run a stream to the end of its input and read what it wrote."""
    path = scratch_dir(spark)
    running = append_to(stream, path, scratch_dir(spark))
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


CLOSED = "slice_end <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'"


@query(
    f"""{E} SELECT * FROM (SELECT time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') AS slice_start,
        time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') + INTERVAL '1 hour' AS slice_end, application, count(*) AS n,
        count(*) FILTER (level IN ('Error', 'Fatal')) AS errors
      FROM log_events GROUP BY 1, 2, 3) WHERE {CLOSED}"""
)
def stream_slices(spark, sf_dir):
    """Slices the watermark has closed."""
    aggs = [F.count("*").alias("n"), F.count_if(is_error()).alias("errors")]
    found = drained(spark, live_slices(live_events(spark, sf_dir), "1h", "10m", ["application"], aggs))
    return found.select(naive("slice_start"), naive("slice_end"), "application", "n", "errors")


@query(
    f"""{E} SELECT slice_start, slice_start + INTERVAL '1 hour' AS slice_end, count(*) AS n, round(quantile_cont(elapsed, 0.95), 6) AS p95
    FROM (SELECT *, unnest([time_bucket(INTERVAL '30 minutes', ts, TIMESTAMP '1970-01-01'),
      time_bucket(INTERVAL '30 minutes', ts, TIMESTAMP '1970-01-01') - INTERVAL '30 minutes']) AS slice_start FROM log_events)
    WHERE slice_start + INTERVAL '1 hour' <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes' GROUP BY 1"""
)
def stream_sliding_latency(spark, sf_dir):
    """Overlapping slices with an exact percentile."""
    path = scratch_dir(spark)
    points = {"p95": 95}
    live_percentiles(
        live_events(spark, sf_dir), "1h", "10m", "elapsed", points, path, scratch_dir(spark), slide="30m"
    ).awaitTermination()
    found = closed_slices(spark, path, list(points))
    return rounded(found.select(naive("slice_start"), naive("slice_end"), "n", "p95"), "p95")


@query(
    f"""{E} SELECT time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01') AS slice_start, application, count(*) AS n,
      round(quantile_cont(elapsed, 0.5), 6) AS p50, round(quantile_cont(elapsed, 0.99), 6) AS p99
    FROM log_events GROUP BY 1, 2
    HAVING slice_start + INTERVAL '6 hours' <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'"""
)
def stream_service_latency(spark, sf_dir):
    """Exact percentiles per slice and service."""
    path, points = scratch_dir(spark), {"p50": 50, "p99": 99}
    live_percentiles(
        live_events(spark, sf_dir), "6h", "10m", "elapsed", points, path, scratch_dir(spark), ["application"]
    ).awaitTermination()
    found = closed_slices(spark, path, list(points), {"application": "string"})
    return rounded(found.select(naive("slice_start"), "application", "n", "p50", "p99"), "p50", "p99")


@query(f"{E} SELECT event_id, level, 'sent to ' || {mark_sql('EMAIL', MAIL_SQL)} AS message FROM log_events")
def stream_redaction(spark, sf_dir):
    messages = live_events(spark, sf_dir).select("event_id", "level", F.concat(F.lit("sent to "), mail()).alias("message"))
    return drained(spark, live_redaction(messages))


@query(f"{E} SELECT event_id, level FROM log_events")
def stream_dedup(spark, sf_dir):
    """Every event delivered twice, kept once."""
    twice = live_events(spark, sf_dir).unionByName(live_events(spark, sf_dir))
    return drained(spark, dedup(twice.select("event_id", "level", "ts"), "10m")).select("event_id", "level")


# Off every minute, so the first and the last minute of a window count in part.
MOMENT = "2024-01-27 17:43:21"


def _moment_sql(rule_id: str, predicate: str, hours: int, threshold: int, until: str | None) -> str:
    start = f"(TIMESTAMP '{MOMENT}' - INTERVAL '{hours} hours')"
    return rule_sql(rule_id, predicate, start, threshold, until, MOMENT)


@query(
    E
    + " UNION ALL ".join(
        [
            _moment_sql("many-errors", ERRORS, 24, 40, None),
            _moment_sql("fatal", "level = 'Fatal'", 6, 1_000_000, None),
            _moment_sql("slow", "elapsed > 30", 12, 1, "2024-02-01"),
            _moment_sql("timeouts", "message LIKE '%timeout%'", 168, 5, "2024-01-30"),
            _moment_sql("client-errors", "status_code BETWEEN 400 AND 499", 2, 1_000_000, "2024-03-01"),
            _moment_sql("never", "exception = 'none'", 720, 1, None),
        ]
    )
)
def stream_alerts(spark, sf_dir):
    """The state of all rules at a moment inside a minute, from the counts a stream keeps."""
    path, known = scratch_dir(spark), rules(spark)
    live_alerts(live_events(spark, sf_dir), known, path, scratch_dir(spark)).awaitTermination()
    found = current_alerts(spark, path, known, MOMENT.replace(" ", "T") + "Z")
    return found.withColumn("as_of", F.col("as_of").cast("timestamp_ntz"))


WATCHED = [
    ("errors", "level in ('Error', 'Fatal')", "6h", 20, None),
    ("timeouts", "message like '%timeout%'", "2h", 2, "2024-01-12 06:30:00"),
    ("fatal", "level = 'Fatal'", "15m", 1, None),
]
SECOND = "time_bucket(INTERVAL '1 second', ts, TIMESTAMP '1970-01-01')"


def _steps_sql(rule_id: str, predicate: str, hours: float, threshold: int, until: str | None) -> str:
    """A rule's count after every second in which it changes."""
    over = "" if until is None else f" UNION ALL SELECT TIMESTAMP '{until}', 0"
    suppressed = "false" if until is None else f"TIMESTAMP '{until}' > since"
    first = "ok" if until is None else "suppressed"
    return f"""SELECT '{rule_id}' AS rule_id, since, state, observed, CAST({threshold} AS BIGINT) AS threshold FROM (
      SELECT *, lag(state, 1, '{first}') OVER (ORDER BY since) AS before FROM (
        SELECT since, CAST(observed AS BIGINT) AS observed,
          CASE WHEN {suppressed} THEN 'suppressed' WHEN observed >= {threshold} THEN 'firing' ELSE 'ok' END AS state
        FROM (SELECT since, sum(sum(n)) OVER (ORDER BY since) AS observed FROM (
            SELECT {SECOND} + INTERVAL '1 second' AS since, 1 AS n FROM log_events WHERE {predicate}
            UNION ALL SELECT {SECOND} + INTERVAL '{int(hours * 3600) + 1} seconds', -1 FROM log_events WHERE {predicate}{over}) GROUP BY since)))
      WHERE state <> before AND since <= (SELECT max({SECOND}) FROM log_events WHERE {WATCHED_SQL}) - INTERVAL '10 minutes'"""


WATCHED_SQL = f"{ERRORS} OR message LIKE '%timeout%'"


@query(
    E
    + " UNION ALL ".join(
        [
            _steps_sql("errors", ERRORS, 6, 20, None),
            _steps_sql("timeouts", "message LIKE '%timeout%'", 2, 2, "2024-01-12 06:30:00"),
            _steps_sql("fatal", "level = 'Fatal'", 0.25, 1, None),
        ]
    )
)
def stream_transitions(spark, sf_dir):
    """When each rule fired, was over, and stopped being suppressed."""
    known = spark.createDataFrame(
        WATCHED, "rule_id string, predicate string, window string, threshold bigint, suppress_until string"
    ).withColumn("suppress_until", F.col("suppress_until").cast("timestamp_ntz"))
    with state_on_disk(spark):
        found = drained(spark, live_transitions(live_events(spark, sf_dir), known))
    return found.select("rule_id", naive("since"), "state", "observed", "threshold")
