"""Streams: late rows, repeats, restarts; the final state equals the batch result."""

import os
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlens.operators.aggregates import by_slice
from eventlens.operators.alerts import alert_state
from eventlens.operators.redact import redact
from eventlens.plans.stream_queries import stream_transitions
from eventlens.session import STATE_PROVIDER, scratch_dir
from eventlens.sources.tables import stream_events
from eventlens.streaming import alerts
from eventlens.streaming.alerts import current_alerts, live_alerts, live_transitions
from eventlens.streaming.daily import DailyTable
from eventlens.streaming.live import (
    append_to,
    closed_slices,
    dedup,
    live_percentiles,
    live_redaction,
    live_slices,
)

START = datetime(2024, 1, 1)
SCHEMA = "event_id bigint, ts timestamp_ntz, level string, message string"


class Feed:
    """A folder of event files, one per delivery, and the stream over it."""

    def __init__(self, spark, tmp_path):
        self.spark, self.path = spark, tmp_path
        self.folder = str(tmp_path / "in")
        self.rows = []

    def deliver(self, rows):
        self.rows += rows
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.folder)

    def stream(self):
        schema = self.spark.createDataFrame([], SCHEMA).schema
        return stream_events(self.spark, self.folder, schema=schema, maxFilesPerTrigger="1", latestFirst="false")

    def run(self, stream):
        append_to(stream, str(self.path / "out"), str(self.path / "cp")).awaitTermination()
        return self.spark.read.schema(stream.schema).parquet(str(self.path / "out"))


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def event(i, minutes, level="Error", message="m"):
    return (i, START + timedelta(minutes=minutes), level, message)


def test_slices_drop_late_rows(spark, feed):
    feed.deliver([event(i, i) for i in range(30)])
    feed.run(live_slices(feed.stream(), "5m", "10m"))
    # The watermark stands at 00:19 now: minute 21 is in time, minute 2 is late.
    feed.deliver([event(100, 21), event(101, 2), event(102, 90)])
    feed.run(live_slices(feed.stream(), "5m", "10m"))
    found = feed.run(live_slices(feed.stream(), "5m", "10m"))
    counts = {r["slice_start"]: r["n"] for r in found.collect()}
    in_time = spark.createDataFrame([r for r in feed.rows if r[0] != 101], SCHEMA)
    expected = {r["slice_start"]: r["n"] for r in by_slice(in_time, "5m").collect()}
    del expected[START + timedelta(minutes=90)]
    assert counts == expected


def test_dedup(feed):
    feed.deliver([event(i, i) for i in range(20)])
    feed.deliver([event(i, i) for i in range(10, 25)])
    ids = [r["event_id"] for r in feed.run(dedup(feed.stream(), "30m")).collect()]
    assert sorted(ids) == list(range(25))


def test_redaction(spark, feed):
    feed.deliver([event(1, 1, message="job of Kari 13116900216"), event(2, 2, message="ok")])
    found = {r["event_id"]: r["message"] for r in feed.run(live_redaction(feed.stream())).collect()}
    batch = {r["event_id"]: r["message"] for r in redact(spark.createDataFrame(feed.rows, SCHEMA)).collect()}
    assert found == batch and "Kari" not in found[1]


def test_alerts_follow_the_stream(spark, feed, tmp_path):
    rules = spark.createDataFrame(
        [("errors", "level = 'Error'", "1h", 25, None), ("short", "level = 'Error'", "15m", 5, None), ("none", "level = 'x'", "1h", 1, None)],
        "rule_id string, predicate string, window string, threshold bigint, suppress_until timestamp_ntz",
    )
    path = str(tmp_path / "counts")

    def run():
        live_alerts(feed.stream(), rules, path, str(tmp_path / "alerts-cp")).awaitTermination()

    def states(now):
        return {r["rule_id"]: (r["state"], r["observed"]) for r in current_alerts(spark, path, rules, now).collect()}

    assert states("2024-01-01T01:00:00Z")["errors"] == ("ok", 0)
    feed.deliver([event(i, i) for i in range(20)])
    run()
    assert states("2024-01-01T00:20:00Z")["errors"] == ("ok", 20)
    # More rows for slices that were written before: the newest version counts.
    feed.deliver([event(100 + i, 19) for i in range(6)] + [event(200, 40), event(201, 50, "Warning")])
    run()
    for now in ("2024-01-01T00:20:00Z", "2024-01-01T00:41:00Z", "2024-01-01T03:00:00Z", "2024-01-01T00:33:07Z"):
        batch = alert_state(spark.createDataFrame(feed.rows, SCHEMA), rules, now)
        assert states(now) == {r["rule_id"]: (r["state"], r["observed"]) for r in batch.collect()}
    # A second run without new rows changes nothing.
    before = states("2024-01-01T00:20:00Z")
    run()
    assert states("2024-01-01T00:20:00Z") == before


def test_sliding_slices(feed):
    feed.deliver([event(i, i) for i in range(60)] + [event(99, 300)])
    found = feed.run(live_slices(feed.stream(), "20m", "1m", aggs=[F.count("*").alias("n")], slide="10m"))
    counts = {r["slice_start"]: r["n"] for r in found.collect()}
    assert counts[START] == 20 and counts[START + timedelta(minutes=10)] == 20
    assert counts[START - timedelta(minutes=10)] == 10


def test_no_rules(spark, tmp_path):
    rules = spark.createDataFrame(
        [], "rule_id string, predicate string, window string, threshold bigint, suppress_until timestamp_ntz"
    )
    assert current_alerts(spark, str(tmp_path / "none"), rules, "2024-01-01T00:00:00Z").count() == 0


ALERT_SCHEMA = "rule_id string, predicate string, window string, threshold bigint, suppress_until timestamp_ntz"


def test_alerts_inside_a_minute_and_folders(spark, feed, tmp_path):
    """Any second gives the batch state, and many batches leave few folders."""
    rules = spark.createDataFrame(
        [("long", "level = 'Error'", "2h", 50, None), ("odd", "level = 'Error'", "97s", 3, datetime(2024, 1, 1, 0, 40))],
        ALERT_SCHEMA,
    )
    rng = random.Random(3)
    path, checkpoint = str(tmp_path / "counts"), str(tmp_path / "cp")
    for i in range(7):
        feed.deliver([event(100 * i + j, 10 * i + rng.random() * 15) for j in range(30)])
        live_alerts(feed.stream(), rules, path, checkpoint, watermark="30m", merge_after=3).awaitTermination()
        kept = DailyTable(spark, path, "tick", ["rule_id", "tick"])
        assert len(kept.versions("recent", "2024-01-01")) <= 3 and len(kept.versions("merged", "2024-01-01")) <= 1
    batch = spark.createDataFrame(feed.rows, SCHEMA)
    for now in ("2024-01-01T00:39:59Z", "2024-01-01T00:40:01Z", "2024-01-01T01:03:17Z", "2024-01-01T02:30:45Z"):
        found = {r["rule_id"]: (r["state"], r["observed"]) for r in current_alerts(spark, path, rules, now).collect()}
        assert found == {r["rule_id"]: (r["state"], r["observed"]) for r in alert_state(batch, rules, now).collect()}
    with pytest.raises(ValueError, match="whole number of ticks"):
        current_alerts(spark, path, rules, "2024-01-01T00:40:00.5Z")
    with pytest.raises(ValueError, match="keep"):
        live_alerts(feed.stream(), rules, path, checkpoint, keep="1h")


def test_daily_table(spark, tmp_path):
    """Retried batches, merges that are repeated, and old days."""
    table = DailyTable(spark, str(tmp_path / "t"), "at", ["k", "at"])
    schema = "k string, at timestamp, n long"

    def rows(*found):
        return spark.createDataFrame([(k, datetime(2024, 1, day), n) for k, day, n in found], schema)

    empty = rows().schema
    assert table.read(empty).count() == 0
    table.save(rows(("a", 1, 1), ("b", 1, 1)), 0)
    table.save(rows(("a", 1, 2), ("a", 2, 5)), 1)
    table.save(rows(("a", 1, 2), ("a", 2, 5)), 1)
    assert sorted(r["n"] for r in table.read(empty).collect()) == [1, 2, 5]
    assert [r["n"] for r in table.read(empty, "2024-01-02", "2024-01-02").collect()] == [5]
    table.merge("2024-01-01", empty, 1)
    table.save(rows(("a", 1, 2), ("a", 2, 5)), 1)
    table.merge("2024-01-01", empty, 1)
    assert table.versions("recent", "2024-01-01") == [] and table.versions("merged", "2024-01-01") == [1]
    table.save(rows(("b", 1, 7), ("c", 9, 1)), 2, merge_after=1)
    assert table.versions("merged", "2024-01-01") == [2]
    assert sorted(r["n"] for r in table.read(empty).collect()) == [1, 2, 5, 7]
    # A merge that was cut off does not count.
    os.makedirs(tmp_path / "t" / "merged" / "day=2024-01-01" / "version=9")
    assert table.versions("merged", "2024-01-01") == [2]
    table.save(rows(("d", 9, 1)), 3, keep=timedelta(days=3))
    assert table.days("recent") == ["2024-01-09"] and table.days("merged") == ["2024-01-09"]


def steps(rows, window, threshold, until, upto):
    """Changes of one rule's state by following every second."""
    counts = {}
    for at in rows:
        counts[at] = counts.get(at, 0) + 1
    state, found = "ok" if until is None else "suppressed", []
    for now in range(min(rows) - 1 if until is None else min([*rows, until]) - 1, upto + 1):
        n = sum(c for at, c in counts.items() if now - window <= at < now)
        after = "suppressed" if until is not None and until > now else "firing" if n >= threshold else "ok"
        if after != state:
            state = after
            found.append((now, state, n))
    return found


def test_transitions(spark, feed, monkeypatch):
    """Events out of order, over several runs, against a look at every second."""
    rules = spark.createDataFrame(
        [("a", "level = 'Error'", "5m", 4, None), ("b", "level = 'Error'", "1m", 2, START + timedelta(minutes=9)), ("c", "level = 'x'", "1m", 1, None)],
        ALERT_SCHEMA,
    )
    monkeypatch.setattr(alerts, "BUCKET", 100)
    rng = random.Random(6)
    seconds = [int(rng.random() * 3000) for _ in range(120)]
    for i in range(3):
        part = [s for s in seconds if 1000 * i <= s < 1000 * (i + 1)]
        rng.shuffle(part)
        feed.deliver([event(1000 * i + j, (s + 0.4) / 60) for j, s in enumerate(part)])
        found = feed.run(live_transitions(feed.stream(), rules, watermark="2m"))
    feed.deliver([event(9000, 200), event(9001, 5)])  # the second one is late
    found = feed.run(live_transitions(feed.stream(), rules, watermark="2m"))
    zero = int((START - datetime(1970, 1, 1)).total_seconds())
    upto = 200 * 60 - 120
    for rule, window, threshold, until in (("a", 300, 4, None), ("b", 60, 2, 540)):
        mine = [r for r in found.collect() if r["rule_id"] == rule]
        got = sorted((int(r["since"].timestamp()) - zero, r["state"], r["observed"]) for r in mine)
        assert got == steps(seconds, window, threshold, until, upto)
        assert got[-1][1] == "ok"
    assert found.filter("rule_id = 'c'").count() == 0


def test_transitions_need_whole_ticks(spark, feed):
    rules = spark.createDataFrame([("a", "level = 'Error'", "90s", 4, None)], ALERT_SCHEMA)
    feed.deliver([event(1, 1)])
    with pytest.raises(ValueError, match="whole number of ticks"):
        live_transitions(feed.stream(), rules, tick="1m")


def test_transitions_in_a_session_of_another_state_store(spark, tmp_path):
    """The registered query in a session as Spark sets it up, which it leaves as it was."""
    rows = [(i, START + timedelta(seconds=at), 1, "error", 1.0, '{"k": 95}') for i, at in enumerate([5, 5, 400, 90_000])]
    raw = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    raw.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    plain = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    before = spark.conf.get(STATE_PROVIDER)
    spark.conf.set(STATE_PROVIDER, plain)
    try:
        found = stream_transitions(spark, str(tmp_path)).filter("rule_id = 'fatal'").collect()
        assert spark.conf.get(STATE_PROVIDER) == plain
    finally:
        spark.conf.set(STATE_PROVIDER, before)
    got = sorted(((r["since"] - START).total_seconds(), r["state"], r["observed"]) for r in found)
    assert got == [(6, "firing", 2), (1301, "ok", 0)]


def test_exact_percentiles_of_a_stream(spark, feed, tmp_path):
    rng = random.Random(2)
    rows = [event(i, rng.random() * 240, level=rng.choice("ab"), message=str(rng.randint(0, 40) / 4)) for i in range(600)]
    rows += [event(1000 + i, 7, "a", None) for i in range(5)] + [event(2000, 500, "a", "1")]
    rows.sort(key=lambda r: r[1])
    path, points = str(tmp_path / "p"), {"p0": 0, "p50": 50, "p95": 95}
    root = os.path.dirname(scratch_dir(spark))
    scratch = lambda: os.listdir(root) if os.path.exists(root) else []
    before = set(scratch())
    for part in (rows[:200], rows[200:]):
        feed.deliver(part)
        live_percentiles(
            feed.stream(), "1h", "10m", "message", points, path, str(tmp_path / "cp"), ["level"], slide="30m"
        ).awaitTermination()
    # Nothing that a micro-batch has kept for itself stays behind.
    assert set(scratch()) <= before
    found = closed_slices(spark, path, list(points), {"level": "string"}).collect()
    groups = {}
    for _, at, level, value in rows[:-1]:
        for start in range(-30, 240, 30):
            begin = START + timedelta(minutes=start)
            if begin <= at < begin + timedelta(hours=1):
                groups.setdefault((begin, level), []).append(value)
    assert {(r["slice_start"], r["level"]) for r in found} == set(groups) and len(found) == len(groups)
    for r in found:
        values = groups[(r["slice_start"], r["level"])]
        known = [float(v) for v in values if v is not None]
        assert r["n"] == len(values)
        assert [r[p] for p in points] == pytest.approx([np.percentile(known, q) for q in points.values()])
