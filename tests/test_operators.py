"""Operators against brute force on small tables, with block sizes made small."""

import math
import random
import struct
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlens.functions.timerange import TimeWindow, instant, query_window
from eventlens.operators import aggregates, changes
from eventlens.operators.aggregates import by_slice, dense_slices, distinct_values, percentiles
from eventlens.operators.alerts import alert_state
from eventlens.operators.filters import find_signals, prop, signal_predicate, signal_scope
from eventlens.operators.investigate import identifiers, sweep
from eventlens.operators.severity import Thresholds, classify_severity, health_report
from eventlens.operators.tenants import resolve_tenants

START = datetime(2024, 1, 1)
SCHEMA = (
    "event_id bigint, ts timestamp_ntz, level string, application string, exception string, user_id bigint, "
    "environment string, elapsed double, message string"
)


def make_events(spark, n=1500, seed=1, hours=72):
    """A third of all rows sits in one service."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        app = "hot" if rng.random() < 0.34 else f"svc-{rng.randint(0, 6)}"
        at = START + timedelta(microseconds=rng.randrange(hours * 3_600_000_000))
        level = rng.choice(["Error", "Fatal", "Information", "Information", None])
        thrown = f"E{rng.randint(0, 9)}" if level == "Error" else None
        rows.append((i, at, level, app, thrown, rng.randint(0, 30), f"t{i % 3}", float(rng.randint(0, 50)), f"m{i}"))
    return spark.createDataFrame(rows, SCHEMA), rows


@pytest.mark.parametrize("by", [[], ["application"]])
def test_percentiles_narrow_down(spark, monkeypatch, by):
    """Several narrowing rounds, with ties, extremes and NULLs."""
    monkeypatch.setattr(aggregates, "RANKED_ROWS", 3)
    rng = random.Random(5)
    rows = [("hot", rng.choice([rng.gauss(0, 1), float(rng.randint(0, 3))])) for _ in range(4000)]
    rows += [("b", float(i)) for i in range(700)] + [("one", 7.0), ("none", None), ("b", None)]
    df = spark.createDataFrame(rows, "application string, v double")
    points = {"p0": 0, "p1": 1, "p50": 50, "p95": 95, "p999": 99.9, "p100": 100}
    found = percentiles(df, by, "v", points, [F.count("*").alias("n")], "narrowed").collect()
    groups = defaultdict(list)
    for app, v in rows:
        groups[app if by else None].append(v)
    assert len(found) == len(groups)
    for row in found:
        values = groups[row["application"] if by else None]
        assert row["n"] == len(values)
        known = [v for v in values if v is not None]
        for name, p in points.items():
            if known:
                assert row[name] == pytest.approx(np.percentile(known, p), abs=1e-9)
            else:
                assert row[name] is None


def test_percentile_methods_agree(spark):
    df, _ = make_events(spark)
    exact = {r[0]: r[1] for r in percentiles(df, ["application"], "elapsed", {"p": 90}, method="exact").collect()}
    narrowed = {r[0]: r[1] for r in percentiles(df, ["application"], "elapsed", {"p": 90}, method="narrowed").collect()}
    approx = {r[0]: r[1] for r in percentiles(df, ["application"], "elapsed", {"p": 90}, method="approx").collect()}
    assert exact == pytest.approx(narrowed)
    assert all(abs(exact[k] - approx[k]) <= 1 for k in exact)
    with pytest.raises(ValueError):
        percentiles(df, [], "elapsed", {"p": 101})


@pytest.mark.parametrize("by", [[], ["application"]])
def test_dense_slices(spark, monkeypatch, by):
    monkeypatch.setattr(aggregates, "SLOT_BLOCK", 7)
    df, rows = make_events(spark, 300)
    window = TimeWindow(instant("2024-01-01T05:10:00Z"), instant("2024-01-03T00:00:00Z"))
    inside = [r for r in rows if datetime(2024, 1, 1, 5, 10) <= r[1] < datetime(2024, 1, 3)]
    scoped = df.filter(F.col("event_id").isin([r[0] for r in inside]))
    found = dense_slices(by_slice(scoped, "30m", by), window, "30m", by).collect()
    counts = Counter((r[1].replace(minute=r[1].minute // 30 * 30, second=0, microsecond=0), r[3] if by else None) for r in inside)
    slots = [datetime(2024, 1, 1, 5) + timedelta(minutes=30) * i for i in range(86)]
    keys = {r[3] for r in inside} if by else {None}
    expected = {(s, k): counts.get((s, k), 0) for s in slots for k in keys}
    assert {(r["slice_start"], r["application"] if by else None): r["n"] for r in found} == expected
    assert len(found) == len(expected)


def test_slice_deltas_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(changes, "DELTA_BLOCK", 10)
    rng = random.Random(2)
    series = {k: [rng.randint(0, 20) for _ in range(137)] for k in "ab"}
    rows = [(k, START + timedelta(minutes=5 * i), n) for k, ns in series.items() for i, n in enumerate(ns)]
    df = spark.createDataFrame(rows, "k string, slice_start timestamp_ntz, n int")
    for width in (1, 4):
        found = changes.slice_deltas(df, "5m", width, ["k"]).collect()
        assert len(found) == len(rows)
        for r in found:
            ns, i = series[r["k"]], (r["slice_start"] - START) // timedelta(minutes=5)
            assert r["delta"] == (ns[i] - ns[i - 1] if i else None)
            before = ns[max(0, i - width) : i]
            assert r["trailing_mean"] == (pytest.approx(sum(before) / len(before)) if before else None)


def test_rank_in_slice(spark):
    df, rows = make_events(spark, 400, hours=5)
    counts = Counter((r[1].replace(minute=0, second=0, microsecond=0), r[3]) for r in rows)
    found = changes.rank_in_slice(df, "application", "1h").collect()
    assert len(found) == len(counts)
    for r in found:
        same = [n for (s, _), n in counts.items() if s == r["slice_start"]]
        assert r["n"] == counts[(r["slice_start"], r["application"])]
        assert r["rank"] == 1 + sum(n > r["n"] for n in same)


@pytest.mark.parametrize("gap, n, hours", [("10m", 300, 72), ("2h", 60, 400), ("7h", 40, 800), ("1m", 500, 30)])
def test_cascade_order(spark, gap, n, hours):
    """Incidents that cross days, and quiet times longer than a day."""
    df, rows = make_events(spark, n, seed=n, hours=hours)
    length = {"10m": timedelta(minutes=10), "2h": timedelta(hours=2), "7h": timedelta(hours=7), "1m": timedelta(minutes=1)}[gap]
    errors = sorted((r[1], r[3]) for r in rows if r[2] in ("Error", "Fatal"))
    incidents, last, start = defaultdict(dict), None, None
    minutes = defaultdict(list)
    for at, app in errors:
        minutes[at.replace(second=0, microsecond=0)].append((at, app))
    for _, hits in sorted(minutes.items()):
        if last is None or hits[0][0] - last > length:
            start = hits[0][0]
        last = hits[-1][0]
        for at, app in hits:
            incidents[start].setdefault(app, [at, 0])[1] += 1
    expected = {}
    for begin, apps in incidents.items():
        for i, (app, (at, count)) in enumerate(sorted(apps.items(), key=lambda x: (x[1][0], x[0]))):
            expected[(begin, app)] = (at, count, i + 1)
    found = changes.cascade_order(df, gap).collect()
    assert {(r["incident_start"], r["application"]): (r["first_ts"], r["errors"], r["position"]) for r in found} == expected


def test_asof_deployment(spark):
    df, rows = make_events(spark, 500)
    rng = random.Random(9)
    deployed = [
        (f"svc-{rng.randint(0, 4)}" if i % 3 else "hot", START + timedelta(minutes=rng.randint(-3000, 4000)), f"v{i}") for i in range(40)
    ]
    deployed.append((deployed[0][0], deployed[0][1], "v99"))
    table = spark.createDataFrame(deployed, "application string, deploy_ts timestamp_ntz, version string")
    found = changes.asof_deployment(df, table).collect()
    assert len(found) == len(rows)
    for r in found:
        known = [(at, v) for app, at, v in deployed if app == r["application"] and at <= r["ts"]]
        assert (r["deployed_at"], r["deployed_version"]) == (max(known) if known else (None, None))


def test_new_exceptions_and_comparison(spark):
    df, rows = make_events(spark)
    deploy = datetime(2024, 1, 2, 12)
    old = {(r[3], r[5], r[4]) for r in rows if r[4] and r[1] < deploy}
    new = {(r[3], r[5], r[4]) for r in rows if r[4]} - old
    found = changes.new_exception_types(df, "2024-01-02T12:00:00Z", "application", "user_id").collect()
    assert {(r["application"], r["user_id"], r["exception"]) for r in found} == new
    compared = {r["application"]: r for r in changes.before_after(df, "2024-01-02T12:00:00Z", "12h", "application").collect()}
    for app, r in compared.items():
        errors = [x for x in rows if x[3] == app and x[2] in ("Error", "Fatal")]
        before = sum(deploy - timedelta(hours=12) <= x[1] < deploy for x in errors)
        after = sum(deploy <= x[1] < deploy + timedelta(hours=12) for x in errors)
        assert (r["errors_before"], r["errors_after"], r["per_hour_after"]) == (before, after, after / 12)
        assert r["ratio"] == (after / before if before else None)


def test_baseline(spark):
    df, rows = make_events(spark)
    found = {r["application"]: r for r in changes.baseline_deviation(df, "2024-01-04T00:00:00Z", "12h", 5, "application").collect()}
    end = datetime(2024, 1, 4)
    for app, r in found.items():
        per = [0] * 6
        for x in rows:
            if x[3] == app and x[2] in ("Error", "Fatal"):
                per[int((end - x[1]) / timedelta(hours=12) - 1e-12)] += 1
        assert r["current"] == per[0]
        assert r["mean"] == pytest.approx(np.mean(per[1:]))
        assert r["stddev"] == pytest.approx(np.std(per[1:]))


def test_trend_and_severity(spark):
    metrics = spark.createDataFrame(
        [("a", 100, 60, 0.6, 10.0), ("b", 100, 55, 0.55, 10.0), ("c", 100, 6, 0.06, 1.0), ("d", 100, 1, 0.01, 9e3), ("e", 100, 1, 0.01, 1.0), ("f", 9, 0, 0.0, None)],
        "application string, events bigint, errors bigint, error_rate double, p95 double",
    )
    rated = {r["application"]: r["severity"] for r in classify_severity(metrics).collect()}
    assert rated == {"a": "P0", "b": "P0", "c": "P2", "d": "P2", "e": "P3", "f": None}
    one = {r["application"]: r["severity"] for r in classify_severity(metrics, Thresholds(down_rate=0.6)).collect()}
    assert one["a"] == "P1" and one["b"] == "P2"
    other = classify_severity(metrics, Thresholds(down_rate=0.6, critical=("b",)))
    assert {r["application"]: r["severity"] for r in other.collect()}["a"] == "P2"
    rows = [(i, START + timedelta(minutes=10 * i), "Error", "up", None, 1, "t", 1.0, "m") for i in range(12)]
    rows += [(50 + i, START + timedelta(minutes=119, seconds=i), "Error", "up", None, 1, "t", 1.0, "m") for i in range(40)]
    rows += [(200 + i, START + timedelta(minutes=10 * i), "Error", "flat", None, 1, "t", 1.0, "m") for i in range(12)]
    events = spark.createDataFrame(rows, SCHEMA)
    trend = changes.trend_class(events, query_window("2024-01-01T02:00:00Z", "2h"), "20m", ["application"])
    assert {r["application"]: r["trend"] for r in trend.collect()} == {"up": "spiking", "flat": "stable"}
    report = health_report(events, "2024-01-01T02:00:00Z", "2h", "20m", periods=3).collect()
    sections = {r["section"] for r in report}
    assert "TRENDING CONCERNS" in sections and "SYSTEM HEALTH" in sections
    assert {r["subject"] for r in report if r["position"] == 1} == {"up"}


def test_report_says_none(spark):
    df, _ = make_events(spark, 300)
    report = health_report(df, "2024-01-04T00:00:00Z", "1d", "1h", 2, thresholds=Thresholds(down_rate=1.1)).collect()
    assert [(r["subject"], r["finding"]) for r in report if r["position"] == 1] == [("None", "None")]


RULE_SCHEMA = "rule_id string, predicate string, window string, threshold bigint, suppress_until timestamp_ntz"


def test_alert_states(spark):
    df, rows = make_events(spark)
    rules = spark.createDataFrame(
        [
            ("firing", "level = 'Error'", "1d", 1, None),
            ("ok", "level = 'Error'", "1h", 100000, None),
            ("suppressed", "level = 'Error'", "2h", 1, datetime(2024, 1, 5)),
            ("expired", "level = 'Error'", "3d", 1, datetime(2024, 1, 3)),
            ("silent", "level = 'Nothing'", "15m", 1, None),
        ],
        RULE_SCHEMA,
    )
    found = {r["rule_id"]: r for r in alert_state(df, rules, "2024-01-04T00:00:00Z").collect()}
    states = {"firing": "firing", "ok": "ok", "suppressed": "suppressed", "expired": "firing", "silent": "ok"}
    assert {k: r["state"] for k, r in found.items()} == states
    day = sum(r[2] == "Error" and r[1] >= datetime(2024, 1, 3) for r in rows)
    assert found["firing"]["observed"] == day and found["silent"]["observed"] == 0
    assert alert_state(df, rules.limit(0), "2024-01-04T00:00:00Z").count() == 0
    with pytest.raises(ValueError, match="unique"):
        alert_state(df, rules.union(rules), "2024-01-04T00:00:00Z")


def test_signals(spark):
    signals = spark.createDataFrame(
        [
            ("s1", "Tenant -  Big  Office", "", "environment = 't1'", "o1", True),
            ("s2", "Tenant - small office", None, "level = 'Error'", None, True),
            ("s3", "private", "mine", "level = 'Fatal'", "o1", False),
        ],
        "signal_id string, title string, description string, predicate string, owner_id string, is_shared boolean",
    )
    df, rows = make_events(spark, 300)
    both = {r["event_id"] for r in signal_scope(df, signals, "s1, s2").collect()}
    assert both == {r[0] for r in rows if r[6] == "t1" and r[2] == "Error"}
    either = signal_scope(df, signals, ["s1", "s2"], "or").count()
    assert either == sum(r[6] == "t1" or r[2] == "Error" for r in rows)
    with pytest.raises(ValueError, match="nope"):
        signal_predicate(signals, "s1,nope")
    assert {r["id"] for r in find_signals(signals, owner_id="o1").collect()} == {"s1"}
    assert find_signals(signals, title="OFFICE", partial=True).count() == 2
    names = spark.createDataFrame([("big OFFICE",), ("Small Office",), ("other",)], "name string")
    resolved = {r["name"]: r["signal_id"] for r in resolve_tenants(names, signals).collect()}
    assert resolved == {"big OFFICE": "s1", "Small Office": "s2", "other": None}


def test_small_operators(spark):
    df, rows = make_events(spark, 300)
    swept = sweep(df, hot=F.col("application") == "hot", bad=F.col("level") == "Error")
    counts = Counter(r["scope"] for r in swept.collect())
    assert counts == {"hot": sum(r[3] == "hot" for r in rows), "bad": sum(r[2] == "Error" for r in rows)}
    assert distinct_values(df, "exception").count() == len({r[4] for r in rows if r[4]})
    text = "RequestId: ab-12 then WorkspaceId: 4f2a77, Lambda: run-it-prod at OrderStore.cs:55 and transaction_id=77"
    found = identifiers(spark.createDataFrame([(text,)], "t string"), "t")
    assert {(r["kind"], r["identifier"]) for r in found.collect()} == {
        ("request", "ab-12"),
        ("workspace", "4f2a77"),
        ("function", "run-it-prod"),
        ("source_line", "OrderStore.cs:55"),
        ("transaction", "77"),
    }
    loose = spark.createDataFrame([('{"k": 3}',), ('{"k": "x"}',), ("broken",), (None,)], "props string")
    assert [r[0] for r in loose.select(prop("k", "int")).collect()] == [3, None, None, None]


def test_signal_ids_with_repeated_rows(spark):
    rows = [("s1", "a > 1"), ("s1", "a > 1"), ("s2", "b > 1"), ("s3", "a > 1"), ("s3", "a > 2")]
    signals = spark.createDataFrame(rows, "signal_id string, predicate string")
    df = spark.createDataFrame([(2, 2), (2, 0)], "a int, b int")
    assert signal_scope(df, signals, "s1,s2").count() == 1
    with pytest.raises(ValueError, match="several predicates: s3"):
        signal_scope(df, signals, "s3")


def test_more_rules_than_one_scan(spark, monkeypatch):
    from eventlens.operators import alerts

    df, _ = make_events(spark, 300)
    rules = spark.createDataFrame(
        [(f"r{i}", f"user_id = {i}", f"{i % 3 + 1}h", 1, None) for i in range(7)],
        "rule_id string, predicate string, window string, threshold bigint, suppress_until timestamp_ntz",
    )
    now = START + timedelta(hours=72)
    whole = sorted(map(tuple, alert_state(df, rules, now.isoformat() + "Z").collect()))
    monkeypatch.setattr(alerts, "RULES_PER_SCAN", 3)
    assert sorted(map(tuple, alert_state(df, rules, now.isoformat() + "Z").collect())) == whole and len(whole) == 7


def test_asof_deployment_after_the_window(spark):
    times = [datetime(2024, 1, 1, 5), datetime(2024, 1, 3, 5), datetime(2024, 1, 6, 5), datetime(2024, 1, 9)]
    df = spark.createDataFrame([(i, t, "a") for i, t in enumerate(times)], "event_id int, ts timestamp_ntz, application string")
    made = [("a", datetime(2024, 1, 1), "1"), ("a", datetime(2024, 1, 4), "2"), ("a", datetime(2024, 1, 8), "3")]
    table = spark.createDataFrame(made, "application string, deploy_ts timestamp_ntz, version string")
    found = changes.asof_deployment(df, table)
    assert [r["deployed_version"] for r in found.orderBy("event_id").collect()] == ["1", "1", "2", "3"]


def test_sortable_doubles(spark):
    """The integer orders all doubles as Spark does, one integer to a value."""
    rng = random.Random(4)
    values = [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(3000)]
    values += [m * 2.0**e for e in range(-1074, 1024, 7) for m in (1.0, -1.0)]
    values += [math.nextafter(2.0**e, side) for e in range(-1000, 1000, 9) for side in (0.0, math.inf)]
    values += [0.0, -0.0, 5e-324, -5e-324, 1.7976931348623157e308, math.inf, -math.inf, math.nan, 2.0**-1022]
    values = [v for v in values if not math.isnan(v)] + [math.nan]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    found = rows.select("v", aggregates.sortable(F.col("v")).alias("key")).collect()
    finite = [r for r in found if math.isfinite(r["v"])]
    for r in finite:
        bits = struct.unpack("<q", struct.pack("<d", abs(r["v"])))[0]
        assert r["key"] == (-bits if r["v"] < 0 else bits)
    keys = {str(r["v"]): r["key"] for r in found}
    assert keys["nan"] > keys["inf"] > max(r["key"] for r in finite)
    assert keys["-inf"] < min(r["key"] for r in finite)


def test_percentiles_of_odd_values(spark):
    rows = [("a", v) for v in (-math.inf, -1.5, -0.0, 0.0, 2.0, math.inf)] + [("b", math.inf)] * 3 + [("c", math.nan)]
    df = spark.createDataFrame(rows, "k string, v double")
    found = {r["k"]: r for r in percentiles(df, ["k"], "v", {"p0": 0, "p50": 50, "p100": 100}).collect()}
    assert tuple(found["a"])[1:] == (-math.inf, 0.0, math.inf) and found["b"]["p50"] == math.inf
    assert math.isnan(found["c"]["p50"])


def test_percentiles_with_weights(spark):
    rng = random.Random(8)
    rows = [(rng.choice("ab"), float(rng.randint(-5, 40)) / 8, rng.randint(1, 9)) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, v double, times int")
    points = {"p1": 1, "p50": 50, "p95": 95}
    for r in percentiles(df, ["k"], "v", points, weight="times").collect():
        spread = [v for k, v, times in rows if k == r["k"] for _ in range(times)]
        assert [r[name] for name in points] == pytest.approx([np.percentile(spread, p) for p in points.values()])
    with pytest.raises(ValueError, match="weights"):
        percentiles(df, ["k"], "v", points, method="exact", weight="times")


def test_percentiles_hold_no_group(spark):
    df, _ = make_events(spark, 200)
    plan = percentiles(df, ["application"], "elapsed", {"p": 50}, [F.countDistinct("user_id").alias("users")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in text.lower() and "ObjectHashAggregate" not in text


def test_asof_deployment_of_one_hot_application(spark):
    """Nine events in ten belong to one application and lie after its last deployment."""
    rng = random.Random(12)
    made = [("hot", START + timedelta(seconds=rng.randrange(500)), f"v{i:03d}") for i in range(60)]
    made += [("cold", START + timedelta(seconds=900), "c"), (None, START, "none"), ("hot", None, "never")]
    rows = [(i, START + timedelta(seconds=500 + rng.randrange(5)), "hot") for i in range(1800)]
    rows += [(5000 + i, START + timedelta(seconds=rng.randrange(1500)), rng.choice(["hot", "cold", "other", None])) for i in range(200)]
    events = spark.createDataFrame(rows, "event_id int, ts timestamp_ntz, application string").repartition(16)
    table = spark.createDataFrame(made, "application string, deploy_ts timestamp_ntz, version string")
    found = changes.asof_deployment(events, table)
    answers = found.collect()
    assert len(answers) == len(rows)
    for r in answers:
        known = [(at, v) for app, at, v in made if app and at and app == r["application"] and at <= r["ts"]]
        assert (r["deployed_at"], r["deployed_version"]) == (max(known) if known else (None, None))


def test_asof_deployment_edges(spark):
    events = spark.createDataFrame([(1, START, "a")], "event_id int, ts timestamp_ntz, application string")
    none = spark.createDataFrame([], "application string, deploy_ts timestamp_ntz, version string")
    assert changes.asof_deployment(events, none).collect()[0]["deployed_version"] is None
    made = spark.createDataFrame([("a", START, "1")], none.schema)
    assert changes.asof_deployment(events.limit(0), made).count() == 0
    assert changes.asof_deployment(events, made).collect()[0]["deployed_version"] == "1"


def test_analyses_of_one_scan(spark):
    """The counts of a report read the events once, and shared counts give what single ones do."""
    df, _ = make_events(spark)
    now, window = "2024-01-04T00:00:00Z", query_window("2024-01-04T00:00:00Z", "1d")
    parts = [
        changes.trend_counts(df, window, "1h", 6),
        changes.baseline_counts(df, now, "1d", 2),
        changes.before_after_counts(df, "2024-01-02T12:00:00Z", "12h"),
    ]
    counts = changes.counted(df, ["application"], parts)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1
    together = [
        changes.trend_of(df, counts, window, "1h", ["application"]),
        changes.baseline_of(counts, 2, "application"),
        changes.before_after_of(counts, "12h", "application"),
    ]
    alone = [
        changes.trend_class(df, window, "1h", ["application"]),
        changes.baseline_deviation(df, now, "1d", 2, "application"),
        changes.before_after(df, "2024-01-02T12:00:00Z", "12h", "application"),
    ]
    for a, b in zip(together, alone, strict=True):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize(("slice", "end", "k"), [("1h", "2024-01-03T12:00:00Z", 6), ("7h", "2024-01-03T12:34:00Z", 3), ("2d", "2024-01-02T00:00:00Z", 4)])
def test_trend_equals_the_dense_series(spark, slice, end, k):
    df, _ = make_events(spark)
    window = TimeWindow(instant("2024-01-01T03:20:00Z"), instant(end))
    scoped = df.filter((F.col("ts") >= "2024-01-01 03:20:00") & (F.col("ts") < end[:19].replace("T", " ")) & F.col("level").isin("Error", "Fatal"))
    dense = dense_slices(by_slice(scoped, slice, ["application"]), window, slice, ["application"])
    last = {r["application"]: r for r in changes.slice_deltas(dense, slice, k, ["application"]).orderBy("slice_start").collect()}
    found = changes.trend_class(df, window, slice, ["application"], k).collect()
    assert {r["application"] for r in found} == set(last)
    for r in found:
        want = last[r["application"]]
        assert (r["slice_start"], r["n"], r["delta"]) == (want["slice_start"], want["n"], want["delta"])
        assert r["trailing_mean"] == (None if want["trailing_mean"] is None else pytest.approx(want["trailing_mean"]))
