"""Group-bys, time slices, percentiles and the investigation questions built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlens.functions.timerange import query_window, within
from eventlens.operators.aggregates import (
    by_slice,
    count_by,
    dense_slices,
    distinct_over,
    distinct_sketches,
    distinct_values,
    percentiles,
    top_k,
)
from eventlens.operators.filters import is_error
from eventlens.operators.investigate import (
    affected_users as affected,
    error_spread as spread,
    errors_by,
    errors_by_tenant,
    errors_per_slice as errors_sliced,
    path_latency as latency_by_path,
    percentile_per_slice,
    symptom_search,
    sweep,
    tenant_errors_per_slice as tenant_sliced,
    tenant_share as share_of_tenant,
    top_failing,
)
from eventlens.operators.tenants import with_tenant_name
from eventlens.plans.dataset import NOW, log_events, table, tenants, with_tables
from eventlens.plans.event_query import EventQuery
from eventlens.plans.registry import query, rounded
from eventlens.session import materialize

E = with_tables("log_events")
MONTH = "ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-31'"
ERRORS = "level IN ('Error', 'Fatal')"


def month(spark, sf_dir):
    return within(log_events(spark, sf_dir), query_window(NOW, "30d"))


def bucket(length: str) -> str:
    """Epoch-aligned slice in SQL."""
    return f"time_bucket(INTERVAL '{length}', ts, TIMESTAMP '1970-01-01')"


@query(f"{E} SELECT application, count(*) AS n FROM log_events WHERE {ERRORS} AND {MONTH} GROUP BY application")
def errors_by_service(spark, sf_dir):
    """Which services are erroring, worst first?"""
    return errors_by(month(spark, sf_dir), "application")


@query(f"{E} SELECT level, count(*) AS n FROM log_events WHERE {MONTH} GROUP BY level")
def events_by_level(spark, sf_dir):
    return count_by(month(spark, sf_dir), "level")


@query(
    f"""{E} SELECT request_path, count(*) AS n FROM log_events WHERE status_code >= 500 AND {MONTH}
    GROUP BY request_path ORDER BY n DESC, request_path LIMIT 20"""
)
def top_failing_endpoints(spark, sf_dir):
    return top_failing(month(spark, sf_dir), 500, 20)


@query(
    f"""{E} SELECT user_id, environment, count(*) AS n FROM log_events WHERE {MONTH}
    GROUP BY user_id, environment ORDER BY n DESC, user_id, environment LIMIT 10"""
)
def busiest_users(spark, sf_dir):
    """Top-k over a key with many values."""
    return top_k(count_by(month(spark, sf_dir), "user_id", "environment"), 10, "n", "user_id", "environment")


@query(
    f"""{E}, {with_tables('tenants')[5:]} SELECT environment, n, name AS tenant_name FROM (
      SELECT environment, count(*) AS n FROM log_events WHERE {ERRORS} AND {MONTH} GROUP BY environment)
    LEFT JOIN tenants ON slug = environment"""
)
def cross_tenant_triage(spark, sf_dir):
    return errors_by_tenant(month(spark, sf_dir), tenants(spark, sf_dir))


@query(
    f"""{E}, {with_tables('tenants')[5:]} SELECT environment, level, n, name AS tenant_name FROM (
      SELECT environment, level, count(*) AS n FROM log_events GROUP BY environment, level)
    LEFT JOIN tenants ON slug = environment"""
)
def tenant_names(spark, sf_dir):
    counts = count_by(log_events(spark, sf_dir), "environment", "level")
    return with_tenant_name(counts, tenants(spark, sf_dir))


# ------------------------------------------------------------------ slices
@query(f"{E} SELECT {bucket('5 minutes')} AS slice_start, count(*) AS n FROM log_events WHERE level = 'Error' AND {MONTH} GROUP BY 1")
def errors_per_slice(spark, sf_dir):
    return errors_sliced(month(spark, sf_dir), "5m")


@query(
    f"""{E} SELECT slice_start, coalesce(n, 0) AS n
    FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-24', TIMESTAMP '2024-01-30 23:55:00', INTERVAL '5 minutes')) AS slice_start)
    LEFT JOIN (SELECT {bucket('5 minutes')} AS slice_start, count(*) AS n FROM log_events
      WHERE level = 'Error' AND ts >= TIMESTAMP '2024-01-24' AND ts < TIMESTAMP '2024-01-31' GROUP BY 1) USING (slice_start)"""
)
def errors_per_slice_dense(spark, sf_dir):
    week = query_window(NOW, "7d")
    return dense_slices(errors_sliced(within(log_events(spark, sf_dir), week), "5m"), week, "5m")


@query(
    f"""{E} SELECT application, slice_start, coalesce(n, 0) AS n
    FROM (SELECT DISTINCT application FROM log_events WHERE ts >= TIMESTAMP '2024-01-30' AND ts < TIMESTAMP '2024-01-31' AND {ERRORS}) CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-30', TIMESTAMP '2024-01-30 23:30:00', INTERVAL '30 minutes')) AS slice_start)
    LEFT JOIN (SELECT application, {bucket('30 minutes')} AS slice_start, count(*) AS n FROM log_events
      WHERE {ERRORS} AND ts >= TIMESTAMP '2024-01-30' AND ts < TIMESTAMP '2024-01-31' GROUP BY 1, 2) USING (application, slice_start)"""
)
def dense_slices_by_service(spark, sf_dir):
    day = query_window(NOW)
    errors = within(log_events(spark, sf_dir).filter(is_error()), day)
    return dense_slices(by_slice(errors, "30m", ["application"]), day, "30m", ["application"])


@query(f"{E} SELECT {bucket('1 hour')} AS slice_start, application, level, count(*) AS n FROM log_events GROUP BY 1, 2, 3")
def slice_by_service(spark, sf_dir):
    chain = EventQuery.on(log_events(spark, sf_dir), NOW).group("application", "level", slice="1h")
    return chain.agg(F.count("*").alias("n")).dataframe()


@query(f"{E} SELECT {bucket('7 days')} AS slice_start, count(*) AS n FROM log_events GROUP BY 1")
def weekly_slices(spark, sf_dir):
    return by_slice(log_events(spark, sf_dir), "7d")


@query(f"{E} SELECT {bucket('250 milliseconds')} AS slice_start, count(*) AS n FROM log_events GROUP BY 1")
def millisecond_slices(spark, sf_dir):
    return by_slice(log_events(spark, sf_dir), "250ms")


@query(
    f"""{E} SELECT {bucket('1 hour')} AS slice_start, count(*) AS n FROM log_events
    WHERE level = 'Error' AND environment = 'tenant-3' AND {MONTH} GROUP BY 1"""
)
def tenant_errors_per_slice(spark, sf_dir):
    return tenant_sliced(month(spark, sf_dir), "tenant-3", "1h")


@query(
    f"""{E} SELECT {bucket('6 hours')} AS slice_start, count(*) FILTER (environment = 'tenant-3') AS tenant_errors,
      count(*) AS fleet_errors, round(count(*) FILTER (environment = 'tenant-3') / count(*), 6) AS share
    FROM log_events WHERE {ERRORS} GROUP BY 1"""
)
def tenant_share(spark, sf_dir):
    return rounded(share_of_tenant(log_events(spark, sf_dir), "tenant-3", "6h"), "share")


@query(f"{E} SELECT {bucket('1 hour')} AS slice_start, count(DISTINCT application) AS services, count(*) AS n FROM log_events WHERE {ERRORS} GROUP BY 1")
def error_spread(spark, sf_dir):
    return spread(log_events(spark, sf_dir), "1h")


# ------------------------------------------------------------- percentiles
@query(
    f"""{E} SELECT {bucket('1 hour')} AS slice_start, count(*) AS n, round(quantile_cont(elapsed, 0.95), 6) AS value
    FROM log_events WHERE request_path LIKE '/api/purchase%' GROUP BY 1"""
)
def latency_tail(spark, sf_dir):
    return rounded(percentile_per_slice(log_events(spark, sf_dir), "elapsed", 95, "/api/purchase", "1h"), "value")


@query(
    f"""{E} SELECT request_path, round(avg(elapsed), 6) AS mean, round(quantile_cont(elapsed, 0.95), 6) AS p95
    FROM log_events WHERE request_path LIKE '/api/%' GROUP BY request_path"""
)
def path_latency(spark, sf_dir):
    return rounded(latency_by_path(log_events(spark, sf_dir), "/api/"), "mean", "p95")


@query(
    f"""{E} SELECT environment, count(*) AS n, round(quantile_cont(elapsed, 0.5), 6) AS p50,
      round(quantile_cont(elapsed, 0.999), 6) AS p999, round(quantile_cont(elapsed, 0), 6) AS least
    FROM log_events GROUP BY environment"""
)
def percentiles_of_large_groups(spark, sf_dir):
    """The exact method for groups that no single task could hold."""
    points = {"p50": 50, "p999": 99.9, "least": 0}
    found = percentiles(
        log_events(spark, sf_dir), ["environment"], "elapsed", points, [F.count("*").alias("n")], "narrowed"
    )
    return rounded(found, *points)


@query(
    f"""{E} SELECT event_type, count(*) AS n, round(sum(elapsed), 6) AS total, round(avg(elapsed), 6) AS mean,
      round(quantile_cont(elapsed, 0.5), 6) AS p50, round(quantile_cont(elapsed, 0.95), 6) AS p95,
      round(min(elapsed), 6) AS least, round(max(elapsed), 6) AS most
    FROM log_events WHERE {MONTH} GROUP BY event_type"""
)
def multi_aggregate(spark, sf_dir):
    measures = [
        F.count("*").alias("n"),
        # Sums of doubles differ in the last places with the order of the rows.
        F.round(F.sum(F.col("elapsed").cast("decimal(30,6)")).cast("double"), 6).alias("total"),
        F.avg("elapsed").alias("mean"),
        F.min("elapsed").alias("least"),
        F.max("elapsed").alias("most"),
    ]
    found = percentiles(month(spark, sf_dir), ["event_type"], "elapsed", {"p50": 50, "p95": 95}, measures)
    return rounded(found, "mean", "p50", "p95", "least", "most")


@query(
    """SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity,
      round(avg(l_discount), 6) AS mean_discount, round(quantile_cont(l_extendedprice, 0.95), 6) AS p95,
      count(DISTINCT l_suppkey) AS suppliers
    FROM lineitem GROUP BY l_returnflag, l_linestatus"""
)
def line_item_profile(spark, sf_dir):
    """The same aggregates over another wide table."""
    measures = [
        F.count("*").alias("n"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
        F.avg("l_discount").alias("mean_discount"),
        F.countDistinct("l_suppkey").alias("suppliers"),
    ]
    keys = ["l_returnflag", "l_linestatus"]
    found = percentiles(table(spark, sf_dir, "lineitem"), keys, "l_extendedprice", {"p95": 95}, measures)
    return rounded(found, "mean_discount", "p95")


# ---------------------------------------------------------------- distinct
@query(f"{E} SELECT count(DISTINCT user_id) AS users FROM log_events WHERE status_code >= 500")
def affected_users(spark, sf_dir):
    return affected(log_events(spark, sf_dir))


@query(
    f"""{E} SELECT days, o.environment, true AS close FROM (SELECT DISTINCT environment FROM log_events) o
    CROSS JOIN (VALUES (7), (14), (30)) t(days)
    WHERE EXISTS (SELECT 1 FROM log_events e WHERE e.environment = o.environment
      AND e.ts >= TIMESTAMP '2024-01-31' - to_days(days) AND e.ts < TIMESTAMP '2024-01-31')"""
)
def users_of_any_range(spark, sf_dir):
    """Distinct users per tenant over several ranges from one stored table of sketches, against exact counts."""
    events = log_events(spark, sf_dir)
    stored = materialize(distinct_sketches(events, "1d", "user_id", ["environment"]))
    found = None
    for days in (7, 14, 30):
        span = query_window(NOW, f"{days}d")
        exact = within(events, span).groupBy("environment").agg(F.countDistinct("user_id").alias("exact"))
        near = distinct_over(stored, span, ["environment"]).join(exact, "environment")
        close = F.abs(F.col("distinct") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * 0.025)
        part = near.select(F.lit(days).alias("days"), "environment", close.alias("close"))
        found = part if found is None else found.unionByName(part)
    return found


@query(f"{E} SELECT DISTINCT application, exception FROM log_events WHERE exception IS NOT NULL")
def distinct_exceptions(spark, sf_dir):
    return distinct_values(log_events(spark, sf_dir), "exception", ["application"])


# ------------------------------------------------------------------ sweeps
@query(
    f"""{E} SELECT event_id, level, application, 'symptom' AS scope FROM log_events
      WHERE {MONTH} AND (message LIKE '%timeout%' OR exception LIKE '%Exception3%')
    UNION ALL SELECT event_id, level, application, 'broad' FROM log_events WHERE {MONTH} AND {ERRORS}"""
)
def symptom_sweep(spark, sf_dir):
    found = symptom_search(month(spark, sf_dir), "timeout", "Exception3")
    return found.select("event_id", "level", "application", "scope")


@query(
    f"""{E} SELECT scope, application, count(*) AS n FROM (
      SELECT 'targeted' AS scope, application FROM log_events WHERE {ERRORS} AND application = 'svc-5'
      UNION ALL SELECT 'broad', application FROM log_events WHERE {ERRORS}) GROUP BY scope, application"""
)
def targeted_and_broad(spark, sf_dir):
    targeted = is_error() & (F.col("application") == "svc-5")
    return count_by(sweep(log_events(spark, sf_dir), targeted=targeted, broad=is_error()), "scope", "application")
