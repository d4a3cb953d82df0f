"""Severity per service and the four-part health report."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.functions.timerange import TimeWindow, instant, slice_length, within
from eventlens.operators.aggregates import percentiles
from eventlens.operators.changes import (
    Measures,
    baseline_counts,
    baseline_of,
    before_after_counts,
    before_after_of,
    between,
    counted,
    trend_counts,
    trend_of,
)
from eventlens.operators.filters import is_error
from eventlens.session import materialize

# The sections of a report, in order.
SECTIONS = ("IMMEDIATE ACTIONS REQUIRED", "TRENDING CONCERNS", "SYSTEM HEALTH", "RECOMMENDATIONS")


@dataclass(frozen=True)
class Thresholds:
    """When a service counts as down or degraded."""

    down_rate: float = 0.5
    degraded_rate: float = 0.05
    slow: float = 5000.0
    min_events: int = 20
    critical: tuple[str, ...] | None = None  # None: every service is critical


def service_metrics(df: DataFrame, by: str = "application", elapsed: str = "elapsed", method: str = "narrowed") -> DataFrame:
    """Events, errors, error rate and p95 latency per service."""
    counted = [F.count("*").alias("events"), F.count_if(is_error()).alias("errors")]
    found = percentiles(df, [by], elapsed, {"p95": 95}, counted, method)
    return found.withColumn("error_rate", F.col("errors") / F.col("events"))


def classify_severity(metrics: DataFrame, thresholds: Thresholds = Thresholds(), by: str = "application") -> DataFrame:
    """P0 several services down, P1 one critical service down, P2 degraded, P3 some errors.

    The metrics are written to the scratch folder once: the number of services
    down is a scalar subquery over that small table, not a second scan of the
    events.
    """
    t = thresholds
    metrics = materialize(metrics)
    down = (F.col("events") >= t.min_events) & (F.col("error_rate") >= t.down_rate)
    critical = F.lit(True) if t.critical is None else F.col(by).isin(*t.critical)
    many = metrics.select(F.count_if(down).alias("n")).scalar()
    degraded = (F.col("error_rate") >= t.degraded_rate) | F.coalesce(F.col("p95") >= t.slow, F.lit(False))
    return metrics.withColumn(
        "severity",
        F.when(down & (many > 1), "P0")
        .when(down & critical, "P1")
        .when(degraded, "P2")
        .when(F.col("errors") > 0, "P3"),
    )


def health_report(
    df: DataFrame,
    now: str | datetime,
    window: str = "1d",
    slice: str = "1h",
    periods: int = 7,
    deploy_ts: str | datetime | None = None,
    by: str = "application",
    thresholds: Thresholds = Thresholds(),
    trailing: int = 6,
    z_limit: float = 3.0,
    worse: float = 1.5,
    method: str = "narrowed",
) -> DataFrame:
    """Findings as rows: section, position of the section, subject, finding, value.

    The counts of all parts (rates, trend, baseline, deployment) are conditional
    counts of one scan of the time they need together, kept as one row per
    service; only the percentile has scans of its own.
    """
    at = instant(now)
    length = slice_length(window)
    span = TimeWindow(at - length, at)
    recent = between(df, span)
    rates = [F.count_if(recent).alias("events"), F.count_if(recent & is_error()).alias("errors")]
    parts = [
        Measures(span, rates),
        trend_counts(df, span, slice, trailing),
        baseline_counts(df, at, window, periods),
    ]
    if deploy_ts is not None:
        parts.append(before_after_counts(df, deploy_ts, window))
    counts = materialize(counted(df, [by], parts))
    slowest = percentiles(within(df, span), [by], "elapsed", {"p95": 95}, method=method)
    rated = counts.filter(F.col("events") > 0).select(by, "events", "errors").alias("l")
    rated = rated.join(slowest.alias("r"), F.col(f"l.{by}").eqNullSafe(F.col(f"r.{by}")), "left").select("l.*", "r.p95")
    rated = rated.withColumn("error_rate", F.col("errors") / F.col("events"))
    metrics = classify_severity(rated, thresholds, by)

    def part(section: int, rows: DataFrame, subject: str, finding, value) -> DataFrame:
        return rows.select(
            F.lit(section + 1).alias("position"),
            F.lit(SECTIONS[section]).alias("section"),
            F.col(subject).alias("subject"),
            finding.alias("finding"),
            value.cast("double").alias("value"),
        )

    urgent = metrics.filter(F.col("severity").isin("P0", "P1"))
    immediate = part(0, urgent, by, F.concat(F.col("severity"), F.lit(" error rate")), F.col("error_rate"))
    calm = df.sparkSession.range(1).filter(urgent.select(F.count("*").alias("n")).scalar() == 0)
    none = part(0, calm.withColumn("_who", F.lit("None")), "_who", F.lit("None"), F.lit(0))
    trend = trend_of(df, counts, span, slice, [by], trailing)
    trending = part(
        1, trend.filter(F.col("trend") != "stable"), by, F.concat(F.col("trend"), F.lit(" errors")), F.col("n")
    )
    unusual = baseline_of(counts, periods, by, z_limit=z_limit).filter("unusual")
    trending = trending.unionByName(part(1, unusual, by, F.lit("unusual error count"), F.col("current")))
    health = part(2, metrics, by, F.coalesce(F.col("severity"), F.lit("healthy")), F.col("error_rate"))
    degraded = metrics.filter(F.col("severity") == "P2")
    advice = part(3, degraded, by, F.lit("investigate partial failures or latency"), F.col("p95"))
    if deploy_ts is not None:
        moved = before_after_of(counts, window, by)
        regressed = moved.filter((F.col("errors_after") > 0) & (F.coalesce(F.col("ratio"), F.lit(worse)) >= worse))
        advice = advice.unionByName(
            part(3, regressed, by, F.lit("review the deployment"), F.col("errors_after"))
        )
    report = immediate
    for rows in (none, trending, health, advice):
        report = report.unionByName(rows)
    return report
