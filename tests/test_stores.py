"""Stored tables: file sizes by day, compaction, kept first sightings and sketches."""

import os
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventlens.functions.timerange import TimeWindow, instant
from eventlens.operators.aggregates import distinct_over, distinct_sketches
from eventlens.operators.changes import new_exception_types, new_exception_types_kept, roll_up_exceptions
from eventlens.operators.paging import budget
from eventlens.sources import tables
from eventlens.sources.tables import compact_events, row_bytes, write_events

START = datetime(2024, 1, 1)
SCHEMA = "event_id bigint, ts timestamp_ntz, application string, exception string, user_id bigint, message string"


def make_events(spark, n, days, seed=1, hot=None):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        day = hot if hot is not None and rng.random() < 0.7 else rng.randrange(days)
        at = START + timedelta(days=day, seconds=rng.randrange(86_400))
        thrown = f"E{rng.randint(0, 12)}" if rng.random() < 0.4 else None
        message = "".join(rng.choices("abcdefghij ", k=80))
        rows.append((i, at, f"svc-{rng.randint(0, 3)}", thrown, rng.randint(0, 400), message))
    return spark.createDataFrame(rows, SCHEMA)


def files_by_day(path):
    return {d[11:]: sum(f.endswith(".parquet") for f in os.listdir(f"{path}/{d}")) for d in os.listdir(path) if "=" in d}


def test_a_skewed_day_has_files_in_proportion(spark, tmp_path):
    df = make_events(spark, 12_000, 5, hot=2)
    width = row_bytes(df)
    assert 20 < width < 200
    path = str(tmp_path / "t")
    write_events(df, path, file_bytes=int(width * 600))
    found = files_by_day(path)
    assert 15 <= sum(found.values()) <= 30
    assert found["2024-01-03"] >= 0.5 * sum(found.values()) and min(found.values()) <= 4
    assert spark.read.parquet(path).count() == 12_000
    assert row_bytes(df.limit(0)) == 0


def test_rows_that_compress_well_do_not_meet_in_one_task(spark, tmp_path, monkeypatch):
    """Files follow the size of the rows in memory too; each is in the order of time."""
    df = make_events(spark, 4000, 2, seed=6).withColumn("message", F.lit("the same " * 50)).withColumn("tokens", F.array("message"))
    size = df.agg(F.sum(tables.sorted_bytes(df))).first()[0]
    assert 4000 * 900 < size < 4000 * 1200
    monkeypatch.setattr(tables, "SORT_BYTES", size // 10)
    path = str(tmp_path / "t")
    write_events(df, path)
    assert 10 <= sum(files_by_day(path).values()) <= 13
    back = spark.read.parquet(path)
    assert back.count() == 4000
    for name in back.inputFiles():
        times = [r["ts"] for r in spark.read.parquet(name).select("ts").coalesce(1).collect()]
        assert times == sorted(times) and len(times) <= 800
    # These files are as they should be; smaller ones are brought together to that size.
    assert compact_events(spark, path) == []
    write_events(df.withColumn("event_id", F.col("event_id") + 4000), path, files=60)
    days = compact_events(spark, path)
    assert days == ["2024-01-01", "2024-01-02"] and 20 <= sum(files_by_day(path).values()) <= 26
    assert spark.read.parquet(path).select("event_id").distinct().count() == 8000


def test_an_empty_table_is_written(spark, tmp_path):
    path = str(tmp_path / "t")
    write_events(make_events(spark, 5, 1).limit(0), path)
    assert files_by_day(path) == {}


def test_compaction(spark, tmp_path):
    path = str(tmp_path / "t")
    df = make_events(spark, 3000, 3, seed=4)
    for i in range(6):
        write_events(df.filter(F.col("event_id") % 6 == i).filter("event_id % 6 < 5 or ts < '2024-01-02'"), path, files=2)
    before = spark.read.parquet(path).drop("event_date").collect()
    small = files_by_day(path)
    done = compact_events(spark, path)
    after = files_by_day(path)
    assert done == sorted(small) and all(after[d] < small[d] for d in done) and max(after.values()) <= 3
    assert sorted(map(str, spark.read.parquet(path).drop("event_date").collect())) == sorted(map(str, before))
    assert compact_events(spark, path, least_files=5) == []


@pytest.mark.parametrize("cut", ["2023-12-01T00:00:00Z", "2024-01-03T07:11:13Z", "2024-01-05T00:00:00Z", "2024-03-01T00:00:00Z"])
def test_kept_first_sightings(spark, tmp_path, cut):
    df = make_events(spark, 400, 7, seed=9)
    path = str(tmp_path / "seen")
    for day in (0, 3, 1, 2, 3, 4, 5, 6):  # out of order, one day twice
        start = START + timedelta(days=day)
        roll_up_exceptions(df.filter((F.col("ts") >= start) & (F.col("ts") < start + timedelta(days=1))), path, "application")
    kept = new_exception_types_kept(spark, path, cut, "application").select("application", "exception", "first_ts", "n")
    whole = new_exception_types(df, cut, "application").select("application", "exception", "first_ts", "n")
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, whole.collect()))
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "event_id" not in plan


def test_sketches_of_any_range(spark):
    df = make_events(spark, 6000, 20, seed=3)
    stored = distinct_sketches(df, "1d", "user_id", ["application"])
    rows = df.collect()
    for first, last in ((0, 20), (3, 4), (5, 17)):
        window = TimeWindow(instant(f"2024-01-{first + 1:02}T00:00:00Z"), instant(f"2024-01-{last + 1:02}T00:00:00Z"))
        users = Counter()
        for app, user in {(r["application"], r["user_id"]) for r in rows if first <= (r["ts"] - START).days < last}:
            users[app] += 1
        found = {r["application"]: r["distinct"] for r in distinct_over(stored, window, ["application"]).collect()}
        assert set(found) == set(users)
        assert all(abs(found[a] - users[a]) <= max(1, 0.025 * users[a]) for a in users)
    empty = TimeWindow(instant("2025-01-01T00:00:00Z"), instant("2025-01-02T00:00:00Z"))
    assert distinct_over(stored, empty).first()["distinct"] == 0


def test_budget_runs_a_short_result_once(spark, tmp_path):
    """The kept top-k is all that is read; the input is not counted again."""
    df = make_events(spark, 300, 2)
    path = str(tmp_path / "t")
    df.write.parquet(path)
    cut = budget(spark.read.parquet(path), [F.asc("event_id")], limit=5000)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert path not in plan and cut.first()["truncated"]


def test_scratch_tables_are_released(spark, tmp_path, monkeypatch):
    from eventlens import session

    monkeypatch.setattr(session, "_scratch_root", lambda _: str(tmp_path / "mine"))
    kept = session.materialize(spark.range(5))
    assert kept.count() == 5 and os.listdir(tmp_path / "mine")
    session.release_scratch(spark)
    assert not os.path.exists(tmp_path / "mine")


def test_partitions_follow_the_data(spark):
    from eventlens.session import build_session

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert build_session(shuffled_gb=1000).conf.get("spark.sql.shuffle.partitions") == "5120"
        assert build_session(shuffled_gb=1).conf.get("spark.sql.shuffle.partitions") == "200"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
