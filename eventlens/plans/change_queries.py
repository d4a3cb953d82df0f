"""Deployments, trends, baselines, incidents, severity, reports and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlens.functions.timerange import query_window, within
from eventlens.operators import changes
from eventlens.operators.aggregates import by_slice, dense_slices
from eventlens.operators.alerts import alert_state as state_of_rules
from eventlens.operators.filters import is_error
from eventlens.operators.severity import SECTIONS, Thresholds, classify_severity, service_metrics
from eventlens.operators.severity import health_report as report
from eventlens.plans.aggregate_queries import ERRORS, MONTH, bucket
from eventlens.plans.dataset import NOW, deployments, log_events, rules, with_tables
from eventlens.plans.registry import query, rounded
from eventlens.session import scratch_dir

E = with_tables("log_events")
DEPLOY = "2024-01-20T00:00:00Z"


@query(
    f"""{E} SELECT application, exception, min(ts) AS first_ts, arg_min(event_id, (ts, event_id)) AS first_event_id, count(*) AS n
    FROM log_events WHERE exception IS NOT NULL GROUP BY application, exception"""
)
def first_occurrence(spark, sf_dir):
    df = log_events(spark, sf_dir).filter(F.col("exception").isNotNull())
    return changes.first_occurrence(df, "application", "exception")


@query(
    f"""{E} SELECT slice_start, application, n, rank() OVER (PARTITION BY slice_start ORDER BY n DESC) AS rank
    FROM (SELECT {bucket('1 hour')} AS slice_start, application, count(*) AS n FROM log_events WHERE {ERRORS} GROUP BY 1, 2)"""
)
def rank_in_slice(spark, sf_dir):
    return changes.rank_in_slice(log_events(spark, sf_dir).filter(is_error()), "application", "1h")


DENSE_WEEK = f"""dense AS (SELECT application, slice_start, coalesce(n, 0) AS n
    FROM (SELECT DISTINCT application FROM log_events WHERE {ERRORS} AND ts >= TIMESTAMP '2024-01-24' AND ts < TIMESTAMP '2024-01-31') CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-24', TIMESTAMP '2024-01-30 21:00:00', INTERVAL '3 hours')) AS slice_start)
    LEFT JOIN (SELECT application, {bucket('3 hours')} AS slice_start, count(*) AS n FROM log_events
      WHERE {ERRORS} AND ts >= TIMESTAMP '2024-01-24' AND ts < TIMESTAMP '2024-01-31' GROUP BY 1, 2) USING (application, slice_start)),
  moved AS (SELECT application, slice_start, n, n - lag(n) OVER w AS delta,
      avg(n) OVER (PARTITION BY application ORDER BY slice_start ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS trailing_mean
    FROM dense WINDOW w AS (PARTITION BY application ORDER BY slice_start))"""


@query(f"{E}, {DENSE_WEEK} SELECT application, slice_start, n, delta, round(trailing_mean, 6) AS trailing_mean FROM moved")
def slice_deltas(spark, sf_dir):
    week = query_window(NOW, "7d")
    errors = within(log_events(spark, sf_dir).filter(is_error()), week)
    dense = dense_slices(by_slice(errors, "3h", ["application"]), week, "3h", ["application"])
    return rounded(changes.slice_deltas(dense, "3h", 4, ["application"]), "trailing_mean")


@query(
    f"""{E}, {DENSE_WEEK} SELECT application, slice_start, n, delta, round(trailing_mean, 6) AS trailing_mean,
      CASE WHEN n >= greatest(trailing_mean, 1) * 3 THEN 'spiking' WHEN n >= greatest(trailing_mean, 1) * 1.25 THEN 'increasing'
           ELSE 'stable' END AS trend
    FROM moved WHERE slice_start = TIMESTAMP '2024-01-30 21:00:00'"""
)
def trend_class(spark, sf_dir):
    week = query_window(NOW, "7d")
    return rounded(changes.trend_class(log_events(spark, sf_dir), week, "3h", ["application"], k=4), "trailing_mean")


@query(
    f"""{E} SELECT application, errors_before, errors_after, events_before, events_after,
      round(errors_before / 168, 6) AS per_hour_before, round(errors_after / 168, 6) AS per_hour_after,
      round(errors_after / nullif(errors_before, 0), 6) AS ratio
    FROM (SELECT application, count(*) FILTER ({ERRORS} AND ts < TIMESTAMP '2024-01-20') AS errors_before,
        count(*) FILTER ({ERRORS} AND ts >= TIMESTAMP '2024-01-20') AS errors_after,
        count(*) FILTER (ts < TIMESTAMP '2024-01-20') AS events_before, count(*) FILTER (ts >= TIMESTAMP '2024-01-20') AS events_after
      FROM log_events WHERE ts >= TIMESTAMP '2024-01-13' AND ts < TIMESTAMP '2024-01-27' GROUP BY application)"""
)
def before_after_deploy(spark, sf_dir):
    found = changes.before_after(log_events(spark, sf_dir), DEPLOY, "7d", "application")
    return rounded(found, "per_hour_before", "per_hour_after", "ratio")


NEW_TYPES_SQL = f"""{E} SELECT application, user_id, exception, min(ts) AS first_ts, count(*) AS n FROM log_events a
    WHERE exception IS NOT NULL AND NOT EXISTS (SELECT 1 FROM log_events b WHERE b.ts < TIMESTAMP '2024-01-20'
      AND b.application = a.application AND b.user_id = a.user_id AND b.exception = a.exception)
    GROUP BY application, user_id, exception"""


@query(NEW_TYPES_SQL)
def new_exception_types(spark, sf_dir):
    """Exceptions per service and user that did not exist before the deployment."""
    return changes.new_exception_types(log_events(spark, sf_dir), DEPLOY, "application", "user_id")


@query(NEW_TYPES_SQL)
def new_exception_types_kept(spark, sf_dir):
    """The same from a kept table of first sightings per day."""
    path = scratch_dir(spark)
    changes.roll_up_exceptions(log_events(spark, sf_dir), path, "application", "user_id")
    return changes.new_exception_types_kept(spark, path, DEPLOY, "application", "user_id").select(
        "application", "user_id", "exception", "first_ts", "n"
    )


@query(
    f"""{E}, {with_tables('deployments')[5:]}, unique_deployments AS (
      SELECT application, deploy_ts, max(version) AS version FROM deployments GROUP BY application, deploy_ts)
    SELECT e.event_id, e.application, e.ts, d.deploy_ts AS deployed_at, d.version AS deployed_version
    FROM log_events e ASOF LEFT JOIN unique_deployments d ON e.application = d.application AND e.ts >= d.deploy_ts"""
)
def asof_deployment(spark, sf_dir):
    events = log_events(spark, sf_dir).select("event_id", "application", "ts")
    return changes.asof_deployment(events, deployments(spark, sf_dir))


@query(
    f"""{E}, counts AS (
      SELECT application, CAST(floor((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(ts) - 1) / 86400000000) AS BIGINT) AS period, count(*) AS n
      FROM log_events WHERE {ERRORS} AND ts >= TIMESTAMP '2024-01-16' AND ts < TIMESTAMP '2024-01-31' GROUP BY 1, 2),
    filled AS (SELECT application, period, coalesce(n, 0) AS n
      FROM (SELECT DISTINCT application FROM counts) CROSS JOIN (SELECT unnest(range(15)) AS period) LEFT JOIN counts USING (application, period)),
    stats AS (SELECT application, CAST(sum(n) FILTER (period = 0) AS BIGINT) AS current, avg(n) FILTER (period > 0) AS mean,
        stddev_pop(n) FILTER (period > 0) AS stddev FROM filled GROUP BY application)
    SELECT application, current, round(mean, 6) AS mean, round(stddev, 6) AS stddev,
      round((current - mean) / nullif(stddev, 0), 6) AS z, coalesce((current - mean) / nullif(stddev, 0) > 1, current > mean) AS unusual
    FROM stats"""
)
def baseline_deviation(spark, sf_dir):
    found = changes.baseline_deviation(log_events(spark, sf_dir), NOW, "1d", 14, "application", z_limit=1)
    return rounded(found, "mean", "stddev", "z")


@query(
    f"""{E}, minutes AS (
      SELECT date_trunc('minute', ts) AS m, min(ts) AS first, max(ts) AS last FROM log_events WHERE {ERRORS} GROUP BY 1),
    marked AS (SELECT m, first, CASE WHEN lag(last) OVER (ORDER BY m) IS NULL OR first - lag(last) OVER (ORDER BY m) > INTERVAL '30 minutes'
        THEN 1 ELSE 0 END AS start FROM minutes),
    numbered AS (SELECT m, first, sum(start) OVER (ORDER BY m) AS i FROM marked),
    incidents AS (SELECT m, min(first) OVER (PARTITION BY i) AS incident_start FROM numbered),
    services AS (SELECT incident_start, application, min(ts) AS first_ts, count(*) AS errors
      FROM log_events JOIN incidents ON m = date_trunc('minute', ts) WHERE {ERRORS} GROUP BY 1, 2)
    SELECT *, row_number() OVER (PARTITION BY incident_start ORDER BY first_ts, application) AS position FROM services"""
)
def cascade_order(spark, sf_dir):
    found = changes.cascade_order(log_events(spark, sf_dir), "30m")
    return found.withColumn("position", F.col("position").cast("bigint"))


LIMITS = Thresholds(down_rate=0.22, degraded_rate=0.2, slow=39.0, min_events=20)
METRICS = """metrics AS (
    SELECT application, count(*) AS events, count(*) FILTER (level IN ('Error', 'Fatal')) AS errors,
      quantile_cont(elapsed, 0.95) AS p95, count(*) FILTER (level IN ('Error', 'Fatal')) / count(*) AS error_rate
    FROM log_events WHERE {where} GROUP BY application),
  rated AS (SELECT *, CASE WHEN down AND (SELECT count(*) FROM metrics WHERE events >= 20 AND error_rate >= {down}) > 1 THEN 'P0'
      WHEN down THEN 'P1' WHEN error_rate >= {degraded} OR p95 >= {slow} THEN 'P2' WHEN errors > 0 THEN 'P3' END AS severity
    FROM (SELECT *, events >= 20 AND error_rate >= {down} AS down FROM metrics))"""


@query(
    f"""{E}, {METRICS.format(where=MONTH, down=0.22, degraded=0.2, slow=39.0)}
    SELECT application, events, errors, round(p95, 6) AS p95, round(error_rate, 6) AS error_rate, severity FROM rated"""
)
def severity_by_service(spark, sf_dir):
    month = within(log_events(spark, sf_dir), query_window(NOW, "30d"))
    return rounded(classify_severity(service_metrics(month), LIMITS), "p95", "error_rate")


WEEK = "ts >= TIMESTAMP '2024-01-24' AND ts < TIMESTAMP '2024-01-31'"


def part_sql(section: int, subject: str, finding: str, value: str, source: str) -> str:
    return (
        f"SELECT {section + 1} AS position, '{SECTIONS[section]}' AS section, {subject} AS subject, "
        f"{finding} AS finding, round(CAST({value} AS DOUBLE), 6) AS value FROM {source}"
    )


@query(
    f"""{E}, {METRICS.format(where=WEEK, down=0.9, degraded=0.2, slow=39.0)}, {DENSE_WEEK},
    periods AS (SELECT application, CAST(floor((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(ts) - 1) / (7 * 86400000000)) AS BIGINT) AS period,
        count(*) AS n FROM log_events WHERE {ERRORS} AND ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-31' GROUP BY 1, 2),
    usual AS (SELECT application, coalesce(sum(n) FILTER (period = 0), 0) AS current,
        coalesce(sum(n) FILTER (period > 0), 0) / 3 AS mean,
        sqrt(greatest(coalesce(sum(n * n) FILTER (period > 0), 0) / 3 - (coalesce(sum(n) FILTER (period > 0), 0) / 3) ** 2, 0)) AS stddev
      FROM periods GROUP BY application),
    sides AS (SELECT application, count(*) FILTER (ts < TIMESTAMP '2024-01-20') AS before, count(*) FILTER (ts >= TIMESTAMP '2024-01-20') AS after
      FROM log_events WHERE {ERRORS} AND ts >= TIMESTAMP '2024-01-13' AND ts < TIMESTAMP '2024-01-27' GROUP BY application)
    {part_sql(0, 'application', "severity || ' error rate'", 'error_rate', "rated WHERE severity IN ('P0', 'P1')")}
    UNION ALL {part_sql(0, "'None'", "'None'", '0', "(SELECT 1) WHERE NOT EXISTS (SELECT 1 FROM rated WHERE severity IN ('P0', 'P1'))")}
    UNION ALL {part_sql(1, 'application', "CASE WHEN n >= greatest(trailing_mean, 1) * 3 THEN 'spiking' ELSE 'increasing' END || ' errors'", 'n',
        "moved WHERE slice_start = TIMESTAMP '2024-01-30 21:00:00' AND n >= greatest(trailing_mean, 1) * 1.25")}
    UNION ALL {part_sql(1, 'application', "'unusual error count'", 'current',
        'usual WHERE coalesce((current - mean) / nullif(stddev, 0) > 1, current > mean)')}
    UNION ALL {part_sql(2, 'application', "coalesce(severity, 'healthy')", 'error_rate', 'rated')}
    UNION ALL {part_sql(3, 'application', "'investigate partial failures or latency'", 'p95', "rated WHERE severity = 'P2'")}
    UNION ALL {part_sql(3, 'application', "'review the deployment'", 'after', 'sides WHERE after > 0 AND (before = 0 OR after / before >= 1.1)')}"""
)
def health_report(spark, sf_dir):
    found = report(
        log_events(spark, sf_dir),
        NOW,
        window="7d",
        slice="3h",
        periods=3,
        deploy_ts=DEPLOY,
        thresholds=Thresholds(down_rate=0.9, degraded_rate=0.2, slow=39.0),
        trailing=4,
        z_limit=1,
        worse=1.1,
    )
    return rounded(found, "value")


def rule_sql(
    rule_id: str, predicate: str, start: str, threshold: int, until: str | None, now: str = "2024-01-31"
) -> str:
    suppressed = "false" if until is None else f"TIMESTAMP '{until}' > TIMESTAMP '{now}'"
    return f"""SELECT '{rule_id}' AS rule_id, CASE WHEN {suppressed} THEN 'suppressed' WHEN count(*) >= {threshold} THEN 'firing' ELSE 'ok' END
      AS state, count(*) AS observed, CAST({threshold} AS BIGINT) AS threshold, TIMESTAMP '{now}' AS as_of
      FROM log_events WHERE ({predicate}) AND ts >= {start} AND ts < TIMESTAMP '{now}'"""


RULES_SQL = E + " UNION ALL ".join(
    [
        rule_sql("many-errors", ERRORS, "TIMESTAMP '2024-01-30'", 40, None),
        rule_sql("fatal", "level = 'Fatal'", "TIMESTAMP '2024-01-30 18:00:00'", 1_000_000, None),
        rule_sql("slow", "elapsed > 30", "TIMESTAMP '2024-01-30 12:00:00'", 1, "2024-02-01"),
        rule_sql("timeouts", "message LIKE '%timeout%'", "TIMESTAMP '2024-01-24'", 5, "2024-01-30"),
        rule_sql("client-errors", "status_code BETWEEN 400 AND 499", "TIMESTAMP '2024-01-30 22:00:00'", 1_000_000, "2024-03-01"),
        rule_sql("never", "exception = 'none'", "TIMESTAMP '2024-01-01'", 1, None),
    ]
)


@query(RULES_SQL)
def alert_state(spark, sf_dir):
    return state_of_rules(log_events(spark, sf_dir), rules(spark), NOW)
