"""Alert state on a live stream: counts that give the state at any time, and its transitions as they happen."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from eventlens.functions.pii import Redactor
from eventlens.functions.timerange import (
    EPOCH,
    MICROSECOND,
    TimeWindow,
    instant,
    slice_length,
    slice_number,
    ts_literal,
    within,
)
from eventlens.operators.alerts import Rule, load_rules, state_of
from eventlens.operators.redact import redact
from eventlens.streaming.daily import DailyTable
from eventlens.streaming.live import live_slices, with_watermark

COUNTS = T.StructType(
    [
        T.StructField("rule_id", T.StringType()),
        T.StructField("tick", T.TimestampType()),
        T.StructField("n", T.LongType()),
    ]
)
MILLISECOND = timedelta(milliseconds=1)


def _hits(loaded: list[Rule]) -> Column:
    """The rules an event matches."""
    return F.array_compact(F.array(*[F.when(r.matches, F.lit(r.rule_id)) for r in loaded]))


def _counts(spark: SparkSession, path: str) -> DailyTable:
    return DailyTable(spark, path, "tick", ["rule_id", "tick"])


def live_alerts(
    stream: DataFrame,
    rules: DataFrame,
    path: str,
    checkpoint: str,
    tick: str = "1s",
    watermark: str = "10m",
    merge_after: int = 16,
    keep: str | None = None,
    **trigger,
) -> StreamingQuery:
    """Keep per-rule counts of ticks, the shortest times told apart, in the table ``path``.

    Counts are combined map-side; the state holds one row per rule and open tick.
    A micro-batch writes the ticks it changed under its own number, so a lost
    executor or a restart neither loses nor doubles a count.  A day of
    ``merge_after`` batches is merged into one, and days older than ``keep``
    (the longest rule window at least) are deleted, so the number of folders is
    bounded.  ``current_alerts`` reads the state at any tick.
    """
    loaded = load_rules(rules)
    kept = None if keep is None else slice_length(keep)
    if kept is not None and any(r.window > kept for r in loaded):
        raise ValueError("keep is shorter than the window of a rule")
    matched = stream.select("ts", F.explode(_hits(loaded)).alias("rule_id"))
    counts = live_slices(matched, tick, watermark, ["rule_id"])

    def save(batch: DataFrame, batch_id: int) -> None:
        changed = batch.select("rule_id", F.col("slice_start").alias("tick"), "n")
        _counts(batch.sparkSession, path).save(changed, batch_id, merge_after, kept)

    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def current_alerts(
    spark: SparkSession,
    path: str,
    rules: DataFrame,
    now: str | datetime,
    tick: str = "1s",
    redactor: Redactor = Redactor(),
) -> DataFrame:
    """Alert state from the counts of ``live_alerts``, the same as ``alert_state`` gives for these events.

    ``now`` and the rules' windows must be whole ticks, as a count says no more.
    Without rules the result is empty.  Personal data in names is masked.
    """
    at, length = instant(now), slice_length(tick)
    loaded = load_rules(rules)
    if not loaded:
        columns = "rule_id string, state string, observed bigint, threshold bigint, as_of timestamp"
        return spark.createDataFrame([], columns)
    for name, distance in [("now", at - EPOCH), *[(f"the window of {r.rule_id}", r.window) for r in loaded]]:
        if distance % length:
            raise ValueError(f"{name} is not a whole number of ticks of {tick}")
    longest = max(r.window for r in loaded)
    counts = _counts(spark, path).read(COUNTS, (at - longest).date(), at.date())
    scoped = within(counts, TimeWindow(at - longest, at), "tick")
    as_of = ts_literal(counts, at, "tick")
    starts = F.create_map(
        *[x for r in loaded for x in (F.lit(r.rule_id), ts_literal(counts, at - r.window, "tick"))]
    )
    sums = scoped.filter(F.col("tick") >= starts[F.col("rule_id")]).groupBy("rule_id")
    observed = sums.agg(F.sum("n").alias("observed"))
    known = rules.select("rule_id", "threshold", F.col("suppress_until").cast("timestamp").alias("_until"))
    total = F.coalesce("observed", F.lit(0)).cast("bigint")
    states = known.join(observed, "rule_id", "left").select(
        "rule_id",
        state_of(total, F.col("threshold"), F.col("_until"), as_of).alias("state"),
        total.alias("observed"),
        "threshold",
        as_of.alias("as_of"),
    )
    return redact(states, redactor, exclude=("state",), numeric=())


# Ticks that are kept in one piece of state.
BUCKET = 3_600


class AlertRing(StatefulProcessor):
    """State of one rule: the counts of the ticks in its window, and how far it has been followed.

    A tick enters the window one tick later and leaves it after the window.  What
    happens up to the watermark is final; the next thing to happen is a timer, so
    that an alert ends although no event arrives any more.  Ticks are kept in
    buckets, so a micro-batch reads those at both ends of the window only.
    """

    def __init__(self, rules: dict[str, tuple[int, int, int | None]], tick_ms: int, bucket: int) -> None:
        self.rules, self.tick_ms, self.bucket = rules, tick_ms, bucket

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ring = handle.getMapState("ring", "bucket bigint", "ticks array<bigint>, counts array<bigint>")
        self.place = handle.getValueState(
            "place", "upto bigint, observed bigint, state string, timer bigint, buckets array<bigint>"
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        added: Counter = Counter()
        for frame in rows:
            for tick, n in zip(frame["number"].tolist(), frame["n"].tolist(), strict=True):
                added[tick] += n
        yield self._follow(key[0], timerValues.getCurrentWatermarkInMs(), added)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._follow(key[0], timerValues.getCurrentWatermarkInMs(), Counter())

    def _stored(self, bucket: int) -> dict[int, int]:
        if not self.ring.containsKey((bucket,)):
            return {}
        ticks, counts = self.ring.getValue((bucket,))
        return dict(zip(map(int, ticks), map(int, counts), strict=True))

    def _add(self, added: Counter, buckets: set[int]) -> None:
        pieces: dict[int, Counter] = defaultdict(Counter)
        for tick, n in added.items():
            pieces[tick // self.bucket][tick] = n
        for bucket, some in pieces.items():
            ticks = sorted((some + Counter(self._stored(bucket))).items())
            self.ring.updateValue((bucket,), ([t for t, _ in ticks], [n for _, n in ticks]))
            buckets.add(bucket)

    def _between(self, first: int, last: int, buckets: set[int]) -> dict[int, int]:
        """The counts of the ticks from ``first`` to ``last``."""
        touched = [b for b in buckets if first // self.bucket <= b <= last // self.bucket]
        return {t: n for b in touched for t, n in self._stored(b).items() if first <= t <= last}

    def _first_from(self, tick: int, buckets: set[int]) -> int | None:
        for bucket in sorted(b for b in buckets if b >= tick // self.bucket):
            later = [t for t in self._stored(bucket) if t >= tick]
            if later:
                return min(later)
        return None

    def _follow(self, rule: str, watermark_ms: int, added: Counter) -> pd.DataFrame:
        window, threshold, until = self.rules[rule]
        now = watermark_ms // self.tick_ms
        if self.place.exists():
            upto, observed, state, timer, known = self.place.get()
        else:
            upto, observed, state, timer, known = 0, 0, "ok" if until is None else "suppressed", 0, []
        buckets = set(map(int, known))
        self._add(added, buckets)
        changes: dict[int, int] = defaultdict(int)
        if now > upto:
            for tick, n in self._between(upto, now - 1, buckets).items():
                changes[tick + 1] += n
            for tick, n in self._between(upto - window, now - window - 1, buckets).items():
                changes[tick + window + 1] -= n
            if until is not None and upto < until <= now:
                changes[until] += 0
        found = []
        for at in sorted(changes):
            observed += changes[at]
            after = "suppressed" if until is not None and until > at else "firing" if observed >= threshold else "ok"
            if after != state:
                state = after
                found.append((rule, at * self.tick_ms, state, observed, threshold))
        upto = max(upto, now)
        for bucket in [b for b in buckets if (b + 1) * self.bucket <= upto - window]:
            self.ring.removeKey((bucket,))
            buckets.remove(bucket)
        entering, leaving = self._first_from(upto, buckets), self._first_from(upto - window, buckets)
        ahead = [entering + 1] if entering is not None else []
        ahead += [leaving + window + 1] if leaving is not None else []
        ahead += [until] if until is not None and until > upto else []
        if timer > now:
            self.handle.deleteTimer(timer * self.tick_ms)
        timer = min(ahead, default=0)
        if timer:
            self.handle.registerTimer(timer * self.tick_ms)
        self.place.update((upto, observed, state, timer, sorted(buckets)))
        return pd.DataFrame(found, columns=["rule_id", "at_ms", "state", "observed", "threshold"])


def live_transitions(stream: DataFrame, rules: DataFrame, tick: str = "1s", watermark: str = "10m") -> DataFrame:
    """Every change of an alert's state: rule_id, since, state, observed, threshold.

    A streaming frame in append mode.  A change comes out once the watermark has
    passed it, in the order of event time, whatever order the events arrive in;
    later events are dropped.  A rule starts as ok, or as suppressed if it ever
    is, and is followed from its first matching event.  Events are counted per
    tick before they are brought together by rule, so a rule that matches a third
    of the stream sends a few rows per task; its state is one count per tick of
    its window that has events.  Keyed state needs RocksDB: start the stream in a
    session of ``build_session``, or inside ``state_on_disk``.
    """
    loaded, length = load_rules(rules), slice_length(tick)
    if length % MILLISECOND:
        raise ValueError("a tick is a whole number of milliseconds")
    if any(r.window % length for r in loaded):
        raise ValueError(f"the window of a rule is not a whole number of ticks of {tick}")

    def ticks_until(rule: Rule) -> int | None:
        if rule.suppress_until is None:
            return None
        until = rule.suppress_until
        until = until.replace(tzinfo=timezone.utc) if until.tzinfo is None else until
        return -((EPOCH - until) // length)  # the first tick at which it is over

    known = {r.rule_id: (r.window // length, r.threshold, ticks_until(r)) for r in loaded}
    matched = stream.select(slice_number("ts", length).alias("number"), F.explode(_hits(loaded)).alias("rule_id"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.groupby(["rule_id", "number"]).size().rename("n").reset_index()

    counted = matched.mapInPandas(count, "rule_id string, number long, n long")
    micros = F.col("number") * (length // MICROSECOND)
    timed = with_watermark(counted.withColumn("ts", F.timestamp_micros(micros)), watermark)
    followed = timed.groupBy("rule_id").transformWithStateInPandas(
        AlertRing(known, length // MILLISECOND, BUCKET),
        "rule_id string, at_ms long, state string, observed long, threshold long",
        "Append",
        "EventTime",
    )
    return followed.select(
        "rule_id", F.timestamp_millis("at_ms").alias("since"), "state", "observed", "threshold"
    )
