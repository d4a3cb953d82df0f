"""What changed: first sightings, deployments, slices and baselines."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlens.functions.timerange import (
    MICROSECOND,
    TimeWindow,
    align_down,
    instant,
    slice_length,
    slice_number,
    ts_literal,
    within,
)
from eventlens.operators.aggregates import by_slice
from eventlens.operators.filters import is_error
from eventlens.session import materialize


def first_occurrence(df: DataFrame, *by: str) -> DataFrame:
    """When each key was first seen, and in which event."""
    return df.groupBy(*by).agg(
        F.min("ts").alias("first_ts"),
        F.min_by("event_id", F.struct("ts", "event_id")).alias("first_event_id"),
        F.count("*").alias("n"),
    )


def new_exception_types(df: DataFrame, deploy_ts: str | datetime, *by: str) -> DataFrame:
    """Exceptions never seen before ``deploy_ts``.

    One aggregation instead of an anti join: a type is new if its first
    sighting is not before the deployment.
    """
    at = ts_literal(df, instant(deploy_ts))
    seen = df.filter(F.col("exception").isNotNull()).groupBy(*by, "exception")
    return seen.agg(F.min("ts").alias("first_ts"), F.count("*").alias("n")).filter(F.col("first_ts") >= at)


def roll_up_exceptions(df: DataFrame, path: str, *by: str) -> None:
    """Keep the first sighting and the count of every exception per day in the table ``path``.

    Days that occur in ``df`` are replaced, so a day that is delivered again, or
    once more with late events, is right as long as it comes whole.
    """
    seen = df.filter(F.col("exception").isNotNull()).groupBy(F.to_date("ts").alias("day"), *by, "exception")
    rolled = seen.agg(F.min("ts").alias("first_ts"), F.count("*").alias("n"))
    writer = rolled.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("day").parquet(path)


def new_exception_types_kept(spark: SparkSession, path: str, deploy_ts: str | datetime, *by: str) -> DataFrame:
    """``new_exception_types`` from the table of ``roll_up_exceptions``: a row per type and day is read, no events."""
    rolled = spark.read.parquet(path)
    at = ts_literal(rolled, instant(deploy_ts), "first_ts")
    seen = rolled.groupBy(*by, "exception").agg(F.min("first_ts").alias("first_ts"), F.sum("n").alias("n"))
    return seen.filter(F.col("first_ts") >= at)


def asof_deployment(df: DataFrame, deployments: DataFrame, application: str = "application") -> DataFrame:
    """Add the latest deployment of the application at or before each event.

    Events and deployments are put in one order, by application and time, that
    is dealt out by range.  Inside a stretch of that order the last deployment is
    carried forward to the events behind it; the one that an earlier stretch ends
    with is handed on, one row per stretch.  No pairs of events and deployments
    arise, and a stretch has its share of the rows however many of them belong to
    one application or lie after the last deployment.  Among deployments at the
    same instant the greatest version wins; one at the instant of an event counts
    for it.  Events without an application have no deployment.
    """
    kind = df.schema["ts"].dataType
    event = F.struct(*df.columns)
    unique = deployments.groupBy("application", F.col("deploy_ts").cast(kind).alias("deploy_ts")).agg(
        F.max("version").alias("version")
    )
    made = unique.filter(F.col("application").isNotNull() & F.col("deploy_ts").isNotNull()).select(
        F.col("application").alias("_application"),
        F.col("deploy_ts").alias("_at"),
        F.lit(0).alias("_kind"),
        F.struct(F.col("deploy_ts").alias("at"), "version").alias("_made"),
        F.lit(None).cast(df.schema).alias("_event"),
    )
    happened = df.select(
        F.col(application).cast(unique.schema["application"].dataType).alias("_application"),
        F.col("ts").alias("_at"),
        F.lit(1).alias("_kind"),
        F.lit(None).cast(made.schema["_made"].dataType).alias("_made"),
        event.alias("_event"),
    )
    order = ["_application", "_at", "_kind"]
    # Equal events may be dealt to several stretches: the last key spreads them.
    spread = made.unionByName(happened).withColumn("_spread", F.when(F.col("_kind") == 1, F.xxhash64("_event")))
    dealt = spread.repartitionByRange(*order, "_spread").withColumn("_stretch", F.spark_partition_id())
    inside = Window.partitionBy("_stretch", "_application").orderBy("_at", "_kind")
    carried = materialize(dealt.withColumn("_made", F.last("_made", ignorenulls=True).over(inside)).drop("_spread"))
    # What each stretch ends with, and what the stretches before it do: one row per stretch and application there.
    ends = carried.groupBy("_application", "_stretch").agg(F.max("_made").alias("_end"))
    before = Window.partitionBy("_application").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.select("_application", "_stretch", F.max("_end").over(before).alias("_handed"))
    events = carried.filter(F.col("_kind") == 1)
    # Only events ahead of the first deployment of their stretch need it.
    told, open_ = events.filter(F.col("_made").isNotNull()), events.filter(F.col("_made").isNull())
    filled = open_.join(handed.filter(F.col("_handed").isNotNull()), ["_application", "_stretch"], "left")
    filled = filled.select("_event", F.col("_handed").alias("_made"))
    found = told.select("_event", "_made").unionByName(filled)
    return found.select(
        "_event.*", F.col("_made")["at"].alias("deployed_at"), F.col("_made")["version"].alias("deployed_version")
    )


class Measures:
    """Conditional counts of one analysis over its own stretch of time, and what is made of them.

    Several analyses share one aggregate of the events: each adds its counts, and
    ``union_of`` gives the time they need together.
    """

    def __init__(self, window: TimeWindow, counts: Sequence[Column]) -> None:
        self.window, self.counts = window, list(counts)


def between(df: DataFrame, window: TimeWindow) -> Column:
    """Events of ``window``, as a condition."""
    ts = F.col("ts")
    return (ts >= ts_literal(df, window.start)) & (ts < ts_literal(df, window.end))


def union_of(measures: Sequence[Measures]) -> TimeWindow:
    return TimeWindow(min(m.window.start for m in measures), max(m.window.end for m in measures))


def counted(df: DataFrame, by: Sequence[str], measures: Sequence[Measures]) -> DataFrame:
    """All counts of several analyses per key, in one scan of the time they need together."""
    return within(df, union_of(measures)).groupBy(*by).agg(*[c for m in measures for c in m.counts])


def before_after(df: DataFrame, deploy_ts: str | datetime, window: str, *by: str) -> DataFrame:
    """Errors per hour in equal windows before and after a deployment."""
    return before_after_of(counted(df, by, [before_after_counts(df, deploy_ts, window)]), window, *by)


def before_after_counts(df: DataFrame, deploy_ts: str | datetime, window: str) -> Measures:
    at, length = instant(deploy_ts), slice_length(window)
    old, new = between(df, TimeWindow(at - length, at)), between(df, TimeWindow(at, at + length))
    return Measures(
        TimeWindow(at - length, at + length),
        [
            F.count_if(is_error() & old).alias("errors_before"),
            F.count_if(is_error() & new).alias("errors_after"),
            F.count_if(old).alias("events_before"),
            F.count_if(new).alias("events_after"),
        ],
    )


def before_after_of(counts: DataFrame, window: str, *by: str) -> DataFrame:
    hours = slice_length(window) / timedelta(hours=1)
    names = ["errors_before", "errors_after", "events_before", "events_after"]
    return (
        counts.filter(F.col("events_before") + F.col("events_after") > 0)
        .select(*by, *names)
        .withColumn("per_hour_before", F.col("errors_before") / hours)
        .withColumn("per_hour_after", F.col("errors_after") / hours)
        .withColumn("ratio", F.try_divide("errors_after", "errors_before"))
    )


def baseline_deviation(
    df: DataFrame, now: str | datetime, window: str, periods: int, *by: str, z_limit: float = 3.0
) -> DataFrame:
    """Errors in the latest window against the mean of earlier equal windows.

    Periods without errors count as zero: mean and deviation come from the sum
    and the sum of squares over the fixed number of periods.
    """
    counts = counted(df.filter(is_error()), by, [baseline_counts(df, now, window, periods)])
    return baseline_of(counts, periods, *by, z_limit=z_limit)


def baseline_counts(df: DataFrame, now: str | datetime, window: str, periods: int) -> Measures:
    """One count per period, the latest first."""
    at, length = instant(now), slice_length(window)
    counts = [
        F.count_if(is_error() & between(df, TimeWindow(at - length * (i + 1), at - length * i))).alias(f"_period{i}")
        for i in range(periods + 1)
    ]
    return Measures(TimeWindow(at - length * (periods + 1), at), counts)


def baseline_of(counts: DataFrame, periods: int, *by: str, z_limit: float = 3.0) -> DataFrame:
    past = F.array(*[F.col(f"_period{i}") for i in range(1, periods + 1)])
    zero = F.lit(0).cast("bigint")
    sums = counts.select(
        *by,
        F.col("_period0").alias("current"),
        F.aggregate(past, zero, lambda s, n: s + n).alias("_s"),
        F.aggregate(past, zero, lambda s, n: s + n * n).alias("_ss"),
    ).filter(F.col("current") + F.col("_s") > 0)
    mean = F.col("_s") / periods
    deviation = F.sqrt(F.greatest(F.col("_ss") / periods - mean * mean, F.lit(0.0)))
    return (
        sums.select(*by, "current", mean.alias("mean"), deviation.alias("stddev"))
        .withColumn("z", F.try_divide(F.col("current") - F.col("mean"), F.col("stddev")))
        .withColumn(
            "unusual",
            F.coalesce(F.col("z") > z_limit, F.col("current") > F.col("mean")),
        )
    )


def rank_in_slice(df: DataFrame, by: str, slice: str) -> DataFrame:
    """Keys ranked by event count inside each slice.

    The rank follows from how many keys have which count: only the distinct
    counts of a slice are put in order, never all its keys.
    """
    counts = by_slice(df, slice, [by])
    larger = Window.partitionBy("slice_start").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (
        counts.groupBy("slice_start", "n")
        .agg(F.count("*").alias("_keys"))
        .select("slice_start", "n", (F.coalesce(F.sum("_keys").over(larger), F.lit(0)) + 1).alias("rank"))
    )
    return counts.join(ranks, ["slice_start", "n"]).select(*counts.columns, "rank")


# Slices of one key that are put in order by one task.
DELTA_BLOCK = 50_000


def slice_deltas(series: DataFrame, slice: str, k: int, by: Sequence[str] = (), measure: str = "n") -> DataFrame:
    """Change to the previous slice and mean of the ``k`` slices before.

    ``series`` is a dense slice series.  It is cut into blocks of slices, and
    the last ``k`` slices of a block are handed to the next one as well, so a
    long series of a single key is spread over tasks.
    """
    size = max(DELTA_BLOCK, 10 * k)
    number = slice_number("slice_start", slice_length(slice))
    block = F.floor(F.col("_number") / size)
    handed_on = F.when(F.col("_number") % size >= size - max(k, 1), block + 1)
    spread = (
        series.withColumn("_number", number)
        .withColumn("_home", block)
        .withColumn("_block", F.explode(F.array_compact(F.array(block, handed_on))))
    )
    order = Window.partitionBy(*by, "_block").orderBy("slice_start")
    return (
        spread.withColumn("delta", F.col(measure) - F.lag(measure).over(order))
        .withColumn("trailing_mean", F.avg(measure).over(order.rowsBetween(-k, -1)))
        .filter(F.col("_block") == F.col("_home"))
        .select(*series.columns, "delta", "trailing_mean")
    )


def trend_class(
    df: DataFrame,
    window: TimeWindow,
    slice: str,
    by: Sequence[str],
    k: int = 6,
    spike: float = 3.0,
    growth: float = 1.25,
    floor: float = 1.0,
) -> DataFrame:
    """Errors per key: spiking, increasing or stable in the last slice of ``window``.

    ``spike`` and ``growth`` are factors over the mean of the ``k`` slices
    before; ``floor`` is the smallest mean they are applied to.  Only those
    slices are counted, each key in one row; empty slices count as zero.
    """
    counts = counted(df.filter(is_error()), by, [trend_counts(df, window, slice, k)])
    return trend_of(df, counts, window, slice, by, k, spike, growth, floor)


def _last_slice(window: TimeWindow, slice: str) -> tuple[datetime, datetime, int]:
    """Start of the first and of the last slice of a window, and the number of slices before the last."""
    step = slice_length(slice)
    first = align_down(window.start, step)
    last = align_down(window.end - MICROSECOND, step)
    return first, last, (last - first) // step


def trend_counts(df: DataFrame, window: TimeWindow, slice: str, k: int) -> Measures:
    """Errors of the window, of its last slice, of the slice before and of the ``k`` slices before."""
    step = slice_length(slice)
    _, last, _ = _last_slice(window, slice)

    def errors(start: datetime, end: datetime, name: str) -> Column:
        start, end = max(start, instant(window.start)), min(end, instant(window.end))
        return F.count_if(is_error() & between(df, TimeWindow(start, max(start, end)))).alias(name)

    return Measures(
        window,
        [
            errors(window.start, window.end, "_errors"),
            errors(last, window.end, "_last"),
            errors(last - step, last, "_previous"),
            errors(last - step * k, last, "_trailing"),
        ],
    )


def trend_of(
    df: DataFrame,
    counts: DataFrame,
    window: TimeWindow,
    slice: str,
    by: Sequence[str],
    k: int = 6,
    spike: float = 3.0,
    growth: float = 1.25,
    floor: float = 1.0,
) -> DataFrame:
    _, last, before = _last_slice(window, slice)
    known = min(k, before)
    mean = F.col("_trailing") / known if known else F.lit(None).cast("double")
    n = F.col("_last")
    base = F.greatest(F.coalesce(mean, F.lit(0.0)), F.lit(floor))
    kind = F.when(n >= base * spike, "spiking").when(n >= base * growth, "increasing").otherwise("stable")
    return counts.filter(F.col("_errors") > 0).select(
        *by,
        ts_literal(df, last).alias("slice_start"),
        n.alias("n"),
        (n - F.col("_previous") if before else F.lit(None).cast("bigint")).alias("delta"),
        mean.alias("trailing_mean"),
        kind.alias("trend"),
    )


def cascade_order(df: DataFrame, gap: str = "10m") -> DataFrame:
    """Services in the order of their first error inside each incident.

    An incident ends when no service has an error for ``gap``.  Errors are first
    reduced to one row per service and minute.  Whether a minute opens an
    incident shows in the ``gap`` before it, and which incident a minute belongs
    to is found inside its day, given the last incident opened on earlier days:
    nothing longer than one row per day is put in order as a whole.
    """
    quiet = slice_length(gap)
    if quiet < timedelta(minutes=1):
        raise ValueError("gap must be one minute or more")
    kind = df.schema["ts"].dataType
    minutes = materialize(
        df.filter(is_error())
        .groupBy("application", F.date_trunc("minute", "ts").cast(kind).alias("_minute"))
        .agg(F.min("ts").alias("_first"), F.max("ts").alias("_last"), F.count("*").alias("_n"))
    )
    timeline = minutes.groupBy("_minute").agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"))
    # Each stretch of time also gets the minutes of the stretch before that end within ``gap`` of it.
    stretch = max(timedelta(days=1), 4 * quiet)
    home = slice_number("_minute", stretch)
    reached = F.floor((F.unix_micros(F.col("_last").cast("timestamp")) + quiet // MICROSECOND) / (stretch // MICROSECOND))
    spread = timeline.withColumn("_home", home).withColumn("_day", F.explode(F.array_distinct(F.array(home, reached))))
    order = Window.partitionBy("_day").orderBy("_minute")
    silence = F.timestamp_diff("MICROSECOND", F.lag("_last").over(order), F.col("_first"))
    opens = F.coalesce(silence > quiet // MICROSECOND, F.lit(True))
    marked = spread.withColumn("_start", F.when(opens, F.col("_first"))).filter(F.col("_day") == F.col("_home"))
    days = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carried = marked.groupBy("_day").agg(F.max("_start").alias("_opened"))
    carried = carried.select("_day", F.max("_opened").over(days).alias("_carried"))
    latest = F.coalesce(F.last("_start", ignorenulls=True).over(order), F.col("_carried"))
    incidents = marked.join(carried, "_day").select("_minute", latest.alias("incident_start"))
    services = (
        minutes.join(incidents, "_minute")
        .groupBy("incident_start", "application")
        .agg(F.min("_first").alias("first_ts"), F.sum("_n").alias("errors"))
    )
    place = Window.partitionBy("incident_start").orderBy("first_ts", "application")
    return services.withColumn("position", F.row_number().over(place))
