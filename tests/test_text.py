"""Text expressions and sinks."""

import json

from pyspark.sql import functions as F

from eventlens.functions.text import (
    access_level,
    code_record,
    error_code,
    error_record,
    lenient_long,
    level_name,
    log_line,
    mask_url_query,
    render_message,
    safe_error,
    template_text,
)
from eventlens.schema import MESSAGE_TOKENS
from eventlens.sources.tables import access_log, to_json_rows


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_levels(spark):
    assert column(spark, ["INFO", " Warn ", "verbose", "", None, "Silent"], level_name) == [
        "info", "warn", "info", "info", "info", "silent",
    ]
    assert column(spark, [500, 503, 404, 400, 399, 200], access_level, "int") == [
        "error", "error", "warn", "warn", "info", "info",
    ]


def test_url_masking(spark):
    urls = {
        "/mcp": "/mcp",
        "/callback?code=abc123&state=xyz": "/callback?code=<redacted>&state=<redacted>",
        "/x?flag&a=1": "/x?flag&a=<redacted>",
        "/x?": "/x",
        "/x?&&": "/x",
        "/x?a=1=2&b=": "/x?a=<redacted>&b=<redacted>",
        "/x?a=1?b=2": "/x?a=<redacted>",
    }
    assert column(spark, list(urls), mask_url_query) == list(urls.values())


def test_errors(spark):
    df = spark.createDataFrame([(500, "body"), (None, "bind failed")], "status int, message string")
    found = [r[0] for r in df.select(safe_error(F.col("status"), F.col("message"))).collect()]
    assert found == ["request failed (HTTP 500)", "bind failed"]
    assert column(spark, ["x AADSTS50076: no AADSTS1", "none"], error_code) == ["AADSTS50076", None]


def test_lenient_numbers(spark):
    assert column(spark, ["12", "chunked", None, ""], lenient_long) == [12, None, None, None]


def test_templates(spark):
    df = spark.createDataFrame(
        [(1, [("Hello ", None), (None, "Name"), (None, None), (None, "Gone")], {"Name": "Ada"}), (2, None, {})],
        MESSAGE_TOKENS_SCHEMA,
    )
    rows = df.select(template_text(F.col("t")).alias("a"), render_message(F.col("t"), F.col("p")).alias("b")).collect()
    assert [tuple(r) for r in rows] == [("Hello {Name}{Gone}", "Hello Ada{Gone}"), ("", "")]


MESSAGE_TOKENS_SCHEMA = f"i int, t {MESSAGE_TOKENS.simpleString()}, p map<string,string>"


def test_log_lines(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2026-06-24 12:00:00.5' AS ts, 'warn' AS level, 'slow' AS m, 3 AS n, CAST(null AS STRING) AS x")
    line = df.select(log_line(F.col("ts"), "gw", F.col("level"), F.col("m"), F.struct("n", "x"))).first()[0]
    assert line == '2026-06-24T12:00:00.500Z [gw] WARN  slow {"n":3,"x":null}'
    bare = df.select(log_line(F.col("ts"), "gw", F.col("level"), F.col("m"))).first()[0]
    assert bare == "2026-06-24T12:00:00.500Z [gw] WARN  slow"


def test_access_log_drops_probes(spark):
    df = spark.createDataFrame(
        [("GET", "/healthz", 200, "1", 1), ("GET", "/healthz?x=1", 200, "1", 1), ("POST", "/a?b=c", 404, "x", 7)],
        "method string, url string, status int, content_length string, ms bigint",
    )
    assert [tuple(r) for r in access_log(df).collect()] == [("warn", "POST", "/a?b=<redacted>", 404, None, 7)]


def test_json_rows(spark):
    row = to_json_rows(spark.sql("SELECT 1 AS a, CAST(null AS STRING) AS b, array('x') AS c")).first()["json"]
    assert json.loads(row) == {"a": 1, "b": None, "c": ["x"]}


def test_access_log_keeps_a_missing_url(spark):
    df = spark.createDataFrame(
        [("GET", None, 200, "5", 1)], "method string, url string, status int, content_length string, ms int"
    )
    assert [tuple(r) for r in access_log(df).collect()] == [("info", "GET", None, 200, 5, 1)]


def test_error_records(spark):
    rows = [("TypeError", None, "no such key"), ("HttpError", 500, "body with eva@firma.no"), (None, None, None)]
    df = spark.createDataFrame(rows, "name string, status int, message string")
    found = [tuple(r) for r in df.select(error_record(F.col("name"), F.col("status"), F.col("message")).alias("r")).select("r.*").collect()]
    assert found == [("TypeError", None, "no such key"), ("HttpError", 500, "request failed (HTTP 500)"), (None, None, None)]


def test_code_records(spark):
    rows = [("AuthError", "bad_grant", "AADSTS50020 for eva@firma.no AADSTS1"), ("", "", "no code"), (None, None, None)]
    df = spark.createDataFrame(rows, "name string, code string, message string")
    found = [tuple(r) for r in df.select(code_record(F.col("name"), F.col("code"), F.col("message")).alias("r")).select("r.*").collect()]
    assert found == [("AuthError", "bad_grant", "AADSTS50020"), (None, None, None), (None, None, None)]
