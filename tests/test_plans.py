"""Sources, the query builder, and what reaches the scan."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from eventlens.functions.timerange import query_window, within
from eventlens.plans.dataset import NOW, log_events, signals
from eventlens.plans.event_query import EventQuery, query_stream
from eventlens.session import materialize, scratch_dir
from eventlens.sources.tables import map_events, read_events, write_events, write_json, write_log

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def test_time_range_and_columns_reach_the_scan(spark):
    chain = EventQuery.on(log_events(spark, SF), NOW).between("7d").group("event_type", slice="1h")
    text = plan(chain.agg(F.count("*").alias("n")).dataframe())
    pushed = re.search(r"PushedFilters: \[(.*)\]", text)[1]
    assert "GreaterThanOrEqual(ts,2024-01-24T00:00)" in pushed and "LessThan(ts,2024-01-31T00:00)" in pushed
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,event_type:string>", text)
    # A single shuffle, named once in the tree and once in the details.
    assert len(re.findall(r"\bExchange\b", text)) == 2


def test_event_table_prunes_days(spark, tmp_path):
    path = str(tmp_path / "events")
    events = log_events(spark, SF)
    write_events(events, path)
    stored = read_events(spark, path)
    assert stored.count() == events.count()
    week = within(stored, query_window(NOW, "7d"))
    assert re.search(r"PartitionFilters: \[.*event_date#\d+ >= 2024-01-24.*", plan(week))
    assert week.count() == within(events, query_window(NOW, "7d")).count()


def test_page_is_one_top_k(spark):
    page = EventQuery.on(log_events(spark, SF), NOW).recent("30d").page(10).redacted()
    assert "TakeOrderedAndProject" in plan(page.dataframe())
    assert page.dataframe().count() == 10


def test_json_events_use_the_declared_schema(spark, tmp_path):
    path = str(tmp_path / "json")
    write_json(log_events(spark, SF).select(F.col("event_id").cast("string"), "ts", "level", "status_code"), path)
    stored = read_events(spark, path, "json")
    assert dict(stored.dtypes)["status_code"] == "int" and dict(stored.dtypes)["message_tokens"].startswith("array")
    assert stored.filter("status_code >= 500").count() == log_events(spark, SF).filter("status_code >= 500").count()


def test_map_events(spark):
    raw = spark.createDataFrame([("1", "boom")], "id string, msg string")
    mapped = map_events(raw, {"event_id": F.col("id"), "message": F.col("msg")})
    assert mapped.first()["message"] == "boom" and mapped.first()["elapsed"] is None
    with pytest.raises(ValueError, match="colour"):
        map_events(raw, {"colour": F.col("id")})


def test_write_log(spark, tmp_path):
    path = str(tmp_path / "log")
    write_log(spark.createDataFrame([("a",), ("b",)], "value string"), path)
    assert {r[0] for r in spark.read.text(path).collect()} == {"a", "b"}


def test_builder_matches_sql(spark):
    events = log_events(spark, SF)
    chain = EventQuery.on(events, NOW).between("30d").where("level in ('Error', 'Fatal')").where("elapsed > :e", e=10)
    built = chain.group("application").agg(F.count("*").alias("n")).order(F.desc("n"), "application").limit(3)
    text = query_stream(
        within(events, query_window(NOW, "30d")),
        "select application, count(*) as n from stream where level in ('Error', 'Fatal') and elapsed > :e "
        "group by application order by n desc, application limit 3",
        e=10,
    )
    assert built.dataframe().collect() == text.collect()
    assert not spark.catalog.tableExists("stream")
    same = EventQuery.on(events, NOW).signal(signals(spark, SF), "signal-3").dataframe()
    assert same.count() == EventQuery.on(events, NOW).tenant("tenant-3").dataframe().count()
    braces = EventQuery.on(events, NOW).where("props like :p and props <> '{}'", p='{"k"%')
    assert braces.dataframe().count() == events.count()
    budgeted = EventQuery.on(events, NOW).select("event_id", "level").budgeted(F.desc("event_id")).dataframe()
    assert budgeted.first()["truncated"] and budgeted.count() == budgeted.first()["returned"]


def test_query_text_leaves_views_alone(spark):
    events = log_events(spark, SF)
    spark.range(3).createOrReplaceTempView("stream")
    rows = "WITH some AS (SELECT * FROM stream LIMIT 2) SELECT count(*) AS n FROM some"
    assert query_stream(events, rows).first()["n"] == 2
    assert query_stream(events, "SELECT count(*) AS n FROM stream").first()["n"] == events.count()
    assert spark.table("stream").count() == 3
    spark.catalog.dropTempView("stream")


def test_scratch(spark):
    assert scratch_dir(spark) != scratch_dir(spark)
    written = materialize(spark.range(10))
    assert written.count() == 10 and "parquet" in plan(written)


def test_csv_events(spark, tmp_path):
    rows = [("e1", "2024-01-01T00:00:00Z", '[{"text":"hi","property_name":"p"}]'), ("e2", "2024-01-02T00:00:00Z", None)]
    made = spark.createDataFrame(rows, "event_id string, ts string, message_tokens string")
    empty = [F.lit(None).cast("string").alias(f"c{i}") for i in range(9)]
    made.select("event_id", "ts", F.lit("Error").alias("level"), "message_tokens", *empty).write.csv(
        str(tmp_path / "csv"), escape='"'
    )
    found = {r["event_id"]: r for r in read_events(spark, str(tmp_path / "csv"), "csv", escape='"').collect()}
    assert found["e1"]["message_tokens"][0]["text"] == "hi" and found["e2"]["message_tokens"] is None
    assert found["e1"]["level"] == "Error"


def test_recursive_queries(spark):
    events = log_events(spark, SF)
    rows = "WITH RECURSIVE n(i) AS (SELECT 1 UNION ALL SELECT i + 1 FROM n WHERE i < 3) SELECT i, count(*) AS c FROM n, stream GROUP BY i"
    found = {r["i"]: r["c"] for r in query_stream(events, rows).collect()}
    assert found == {i: events.count() for i in (1, 2, 3)}


def test_rendered_and_shown_results(spark):
    rows = [("e1", [("job of Kari took ", None), (None, "ms"), (None, "gone"), (None, None)], '{"ms": 12, "who": "Kari"}', 13116900216, 2.5)]
    schema = "event_id string, message_tokens array<struct<text string, property_name string>>, props string, ref long, elapsed double"
    events = spark.createDataFrame(rows, schema).withColumn("ts", F.lit("2024-01-30T23:30:00").cast("timestamp_ntz"))
    page = EventQuery.on(events, NOW).recent("1h").page(5, render=True)
    assert page.dataframe().first()["rendered_message"] == "job of Kari took 12{gone}"
    shown = page.result().first()
    assert "Kari" not in shown["rendered_message"] and shown["rendered_message"].endswith("took 12{gone}")
    assert shown["event_id"] == "e1" and shown["elapsed"] == 2.5 and shown["ref"].startswith("[FNR_")
    assert "Kari" not in shown["props"] and "Kari" not in str(shown["message_tokens"])
    as_map = events.withColumn("props", F.from_json("props", "map<string,string>"))
    assert EventQuery.on(as_map, NOW).rendered().dataframe().first()["rendered_message"] == "job of Kari took 12{gone}"
    counted = EventQuery.on(events, NOW).group("ref").agg(F.count("*").alias("n"), F.max("ref").alias("top")).result().first()
    assert counted["n"] == 1 and counted["top"] == 13116900216 and counted["ref"].startswith("[FNR_")
