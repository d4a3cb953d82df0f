"""Scans, filters, signals, ranges, pages and text expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.functions.pii import Redactor
from eventlens.functions.text import (
    code_record,
    error_code,
    error_record,
    render_message,
    safe_error,
    template_text,
)
from eventlens.functions.timerange import TimeWindow, instant, within
from eventlens.operators.filters import (
    find_signals,
    is_error,
    prop,
    severity_threshold,
    signal_listing,
    slow_requests,
    symptom,
)
from eventlens.operators.investigate import identifiers
from eventlens.operators.paging import CHARACTER_LIMIT, EVENTS_NOTE, ROWSET_NOTE, budget, budget_summary
from eventlens.operators.tenants import resolve_tenants
from eventlens.plans.dataset import NOW, log_events, signals, table, tenants, with_tables
from eventlens.plans.event_query import EventQuery, query_stream
from eventlens.plans.registry import query, rounded
from eventlens.session import scratch_dir
from eventlens.sources.tables import access_log, log_lines, read_events, to_json_rows, write_events

E = with_tables("log_events")
S = with_tables("signals")
COLUMNS = ["event_id", "ts", "level", "application", "environment", "request_path", "status_code", "elapsed"]
LISTED = ", ".join(COLUMNS[:-1]) + ", round(elapsed, 6) AS elapsed"


def listed(df: DataFrame) -> DataFrame:
    return rounded(df.select(*COLUMNS), "elapsed")


def span(start: str, end: str) -> str:
    return f"ts >= TIMESTAMP '{start}' AND ts < TIMESTAMP '{end}'"


# ------------------------------------------------------------------- scans
@query(f"{E} SELECT {LISTED} FROM log_events WHERE {span('2024-01-10', '2024-01-17')}")
def event_scan(spark, sf_dir):
    """Write the event table by day, then read one week of it."""
    path = scratch_dir(spark)
    write_events(log_events(spark, sf_dir), path)
    week = TimeWindow(instant("2024-01-10T00:00:00Z"), instant("2024-01-17T00:00:00Z"))
    return listed(within(read_events(spark, path), week))


@query(
    f"""{E} SELECT level, request_path, count(*) AS n FROM log_events
    WHERE status_code >= 500 AND {span('2024-01-01', '2024-01-31')} AND environment = 'tenant-3'
    GROUP BY level, request_path"""
)
def tabular_query(spark, sf_dir):
    """SQL text over the stream, scoped by range and signal, with a parameter."""
    scoped = EventQuery.on(log_events(spark, sf_dir), NOW).between("30d").signal(signals(spark, sf_dir), "signal-3")
    text = "select level, request_path, count(*) as n from stream where status_code >= :min group by level, request_path"
    return query_stream(scoped.dataframe(), text, min=500)


@query(
    f"""{E} SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z [gateway] '
      || CASE WHEN level IN ('Error', 'Fatal') THEN 'ERROR' ELSE 'INFO ' END || ' ' || message
      || ' {{"status_code":' || status_code || ',"exception":' || coalesce('"' || exception || '"', 'null') || '}}'
      AS value
    FROM log_events"""
)
def text_log(spark, sf_dir):
    """Events as log lines with their fields as JSON."""
    df = log_events(spark, sf_dir).withColumn("level", F.when(is_error(), "error").otherwise("info"))
    return log_lines(df, "gateway", "level", "message", ["status_code", "exception"])


@query(
    f"""{E} SELECT '{{"event_id":' || event_id || ',"level":"' || level || '","exception":'
      || coalesce('"' || exception || '"', 'null') || ',"status_code":' || status_code || '}}' AS json FROM log_events"""
)
def json_rows(spark, sf_dir):
    return to_json_rows(log_events(spark, sf_dir).select("event_id", "level", "exception", "status_code"))


# ----------------------------------------------------------------- filters
@query(
    f"""{E} SELECT {LISTED} FROM log_events
    WHERE level IN ('Error', 'Fatal') AND application = 'svc-3' AND status_code <> 501"""
)
def filter_membership(spark, sf_dir):
    rows = is_error() & (F.col("application") == "svc-3") & (F.col("status_code") != 501)
    return listed(log_events(spark, sf_dir).filter(rows))


@query(f"{E} SELECT {LISTED} FROM log_events WHERE request_path LIKE '/api/e%/3' OR message LIKE '%Timeout%'")
def filter_like(spark, sf_dir):
    rows = F.col("request_path").like("/api/e%/3") | F.col("message").like("%Timeout%")
    return listed(log_events(spark, sf_dir).filter(rows))


@query(f"{E} SELECT level, count(*) AS n, count(exception) AS thrown FROM log_events WHERE exception IS NOT NULL OR level IS NULL GROUP BY level")
def filter_nulls(spark, sf_dir):
    rows = log_events(spark, sf_dir).filter(F.col("exception").isNotNull() | F.col("level").isNull())
    return rows.groupBy("level").agg(F.count("*").alias("n"), F.count("exception").alias("thrown"))


@query(f"{E} SELECT {LISTED} FROM log_events WHERE status_code >= 500 AND status_code <= 502 AND elapsed > 20 AND level = 'Error'")
def filter_args(spark, sf_dir):
    """Template variables in a filter."""
    chain = EventQuery.on(log_events(spark, sf_dir), NOW).where(
        "status_code >= :low and status_code <= :high and elapsed > :slow and level == :level",
        low=500,
        high=502,
        slow=20,
        level="Error",
    )
    return listed(chain.dataframe())


@query(f"{E} SELECT event_id, k FROM log_events WHERE k < 25")
def filter_property(spark, sf_dir):
    """Free-form properties, read from their JSON text."""
    df = table(spark, sf_dir, "events").select("event_id", prop("k", "int").alias("k"))
    return df.filter(F.col("k") < 25)


@query(
    f"""{E} SELECT event_id, CASE WHEN name IN ('debug', 'info', 'warn', 'error', 'silent') THEN name ELSE 'info' END AS severity
    FROM (SELECT event_id, lower(trim(CASE k % 6 WHEN 0 THEN ' Warn ' WHEN 1 THEN 'ERROR' WHEN 2 THEN 'debug'
            WHEN 3 THEN '' WHEN 4 THEN 'verbose' ELSE 'silent' END)) AS name FROM log_events)
    WHERE name IN ('warn', 'error', 'silent')"""
)
def severity_filter(spark, sf_dir):
    raw = F.get(F.array(*[F.lit(x) for x in (" Warn ", "ERROR", "debug", "", "verbose", "silent")]), F.col("k") % 6)
    df = log_events(spark, sf_dir).withColumn("level", raw)
    return severity_threshold(df, "WARN").select("event_id", "severity")


@query(f"{E} SELECT {LISTED} FROM log_events WHERE elapsed > 50")
def slow_request_list(spark, sf_dir):
    return listed(slow_requests(log_events(spark, sf_dir), 50))


@query(f"{E} SELECT {LISTED} FROM log_events WHERE message LIKE '%timeout%' OR exception LIKE '%Exception3%'")
def symptom_filter(spark, sf_dir):
    return listed(log_events(spark, sf_dir).filter(symptom("timeout", "Exception3")))


# ----------------------------------------------------------------- signals
@query(
    f"""{S}, {E[5:]} SELECT environment, count(*) AS n FROM log_events
    WHERE environment = 'tenant-2' OR environment = 'tenant-7' GROUP BY environment"""
)
def signal_scope(spark, sf_dir):
    chain = EventQuery.on(log_events(spark, sf_dir), NOW).signal(signals(spark, sf_dir), "signal-2, signal-7", "or")
    return chain.group("environment").agg(F.count("*").alias("n")).dataframe()


@query(f"{E} SELECT level, count(*) AS n FROM log_events WHERE environment = 'tenant-5' AND {span('2024-01-24', '2024-01-31')} GROUP BY level")
def tenant_events(spark, sf_dir):
    """The last week of one tenant."""
    chain = EventQuery.on(log_events(spark, sf_dir), NOW).between("7d").tenant("tenant-5").group("level")
    return chain.agg(F.count("*").alias("n")).result()


@query(
    f"""{S}, {E[5:]} SELECT environment, count(*) AS n FROM log_events
    WHERE environment = 'tenant-2' GROUP BY environment"""
)
def signal_scope_all(spark, sf_dir):
    """Several signals narrow the scope together; two of three have the same filter here."""
    chain = EventQuery.on(log_events(spark, sf_dir), NOW).signal(signals(spark, sf_dir), "signal-2,signal-22, signal-42")
    return chain.group("environment").agg(F.count("*").alias("n")).dataframe()


@query(
    f"""{S} SELECT signal_id AS id, title,
      CASE WHEN coalesce(description, '') = '' THEN 'No description provided' ELSE description END AS description,
      is_shared AS shared, owner_id FROM signals WHERE is_shared"""
)
def signal_list(spark, sf_dir):
    return signal_listing(signals(spark, sf_dir))


@query(
    f"""{S} SELECT signal_id AS id, title, description, is_shared AS shared, owner_id, predicate FROM signals
    WHERE NOT is_shared AND owner_id = 'owner-4' AND lower(title) LIKE '%customer#0000%'"""
)
def signal_catalog(spark, sf_dir):
    return find_signals(signals(spark, sf_dir), shared=False, owner_id="owner-4", title="CUSTOMER#0000", partial=True)


@query(
    f"""{S}, {with_tables('tenants')[5:]} SELECT t.name, s.signal_id, s.title, s.predicate
    FROM (SELECT DISTINCT upper(name) AS name FROM tenants) t
    LEFT JOIN signals s ON lower(regexp_replace(s.title, '^Tenant - *', '')) = lower(t.name)"""
)
def tenant_resolve(spark, sf_dir):
    """Names in another case than the titles, titles with uneven spacing."""
    names = tenants(spark, sf_dir).select(F.upper("name").alias("name"))
    return resolve_tenants(names, signals(spark, sf_dir))


# ------------------------------------------------------------------ ranges
def counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy("level").agg(F.count("*").alias("n"))


def counted_sql(where: str) -> str:
    return f"{E} SELECT level, count(*) AS n FROM log_events WHERE {where} GROUP BY level"


@query(counted_sql(span("2024-01-24", "2024-01-31")))
def range_relative(spark, sf_dir):
    """A relative range wins over explicit bounds."""
    chain = EventQuery.on(log_events(spark, sf_dir), NOW).between("7d", "2020-01-01T00:00:00Z", "2020-01-02T00:00:00Z")
    return counted(chain.dataframe())


@query(counted_sql(span("2024-01-20 10:00:00", "2024-01-31")))
def range_from_only(spark, sf_dir):
    chain = EventQuery.on(log_events(spark, sf_dir), NOW).between(start="2024-01-20T12:00:00+02:00")
    return counted(chain.dataframe())


@query(counted_sql(span("2024-01-14 06:00:00", "2024-01-15 06:00:00")))
def range_to_only(spark, sf_dir):
    """The 24 hours that end at the given time."""
    return counted(EventQuery.on(log_events(spark, sf_dir), NOW).between(end="2024-01-15T06:00:00Z").dataframe())


@query(counted_sql(span("2024-01-29 12:00:00", "2024-01-30 12:00:00")))
def range_default(spark, sf_dir):
    return counted(EventQuery.on(log_events(spark, sf_dir), "2024-01-30T12:00:00Z").between().dataframe())


@query(counted_sql("ts < TIMESTAMP '2024-01-15'"))
def range_open_start(spark, sf_dir):
    """Event pages take one-sided bounds as they are."""
    return counted(EventQuery.on(log_events(spark, sf_dir), NOW).recent(end="2024-01-15T00:00:00Z").dataframe())


@query(counted_sql(span("2024-01-30 11:00:00", "2024-01-30 12:00:00")))
def range_events_default(spark, sf_dir):
    return counted(EventQuery.on(log_events(spark, sf_dir), "2024-01-30T12:00:00Z").recent().dataframe())


# ------------------------------------------------------- pages and budgets
@query(f"{E} SELECT {LISTED} FROM log_events ORDER BY ts DESC, event_id DESC LIMIT 20")
def event_page(spark, sf_dir):
    return listed(EventQuery.on(log_events(spark, sf_dir), NOW).page().dataframe())


@query(
    f"""{E} SELECT {LISTED} FROM log_events
    WHERE (ts, event_id) < (SELECT (ts, event_id) FROM log_events WHERE event_id = 600)
    ORDER BY ts DESC, event_id DESC LIMIT 50"""
)
def event_page_after(spark, sf_dir):
    return listed(EventQuery.on(log_events(spark, sf_dir), NOW).page(50, after=600).dataframe())


@query(
    f"""{E}, ranked AS (
      SELECT ts, event_id, row_number() OVER (ORDER BY ts DESC, event_id DESC) AS i, count(*) OVER () AS total,
        6 + length(CAST(event_id AS VARCHAR)) + length(level) + 2 + length(message) + 2
          + length(coalesce('"' || exception || '"', 'null')) - 1 AS size
      FROM log_events WHERE level IN ('Error', 'Fatal')),
    running AS (SELECT i, total, sum(size) OVER (ORDER BY i) AS s FROM ranked),
    sizes AS (
      SELECT i, total, s + i - 1 + length('{{"Columns":["event_id","level","message","exception"],"Rows":[]}}') AS bare,
        length('"truncated":true,"returnedRows":,"truncation_message":"{ROWSET_NOTE.format(limit=CHARACTER_LIMIT).replace("'", "''")}",')
          + length(CAST(i AS VARCHAR)) AS note FROM running),
    fitting AS (
      SELECT coalesce(max(i) FILTER (i = total AND bare <= {CHARACTER_LIMIT}),
        max(i) FILTER (bare + note <= {CHARACTER_LIMIT} AND i IN (SELECT CAST(ceil(total / pow(2, e)) AS BIGINT) FROM range(1, 41) t(e))), 1) AS kept
      FROM sizes)
    SELECT l.event_id, level, message, exception, kept < r.total AS truncated, kept AS returned
    FROM log_events l JOIN ranked r USING (event_id) CROSS JOIN fitting WHERE r.i <= kept"""
)
def result_budget(spark, sf_dir):
    """A rowset cut by halving until its compact JSON fits."""
    errors = log_events(spark, sf_dir).filter(is_error())
    order = [F.desc("ts"), F.desc("event_id")]
    rows = errors.select("event_id", "level", "message", "exception", "ts")
    return budget(rows, order, layout="rowset", pretty=False, columns=["event_id", "level", "message", "exception"])


@query(f"{E} SELECT false AS truncated, count(*) AS returned, CAST(NULL AS VARCHAR) AS truncation_message FROM (SELECT DISTINCT application FROM log_events)")
def result_budget_summary(spark, sf_dir):
    """A result that fits is passed on whole."""
    counts = log_events(spark, sf_dir).groupBy("application").agg(F.count("*").alias("n"))
    return budget_summary(budget(counts, [F.desc("n"), F.asc("application")], layout="rowset"), layout="rowset")


def pretty_sql(indent: int) -> str:
    """An event as indented JSON inside a list at ``indent``."""
    pad, end = " " * (indent + 2), " " * indent
    return (
        f"'{end}{{{{' || chr(10) || '{pad}\"event_id\": ' || event_id || ',' || chr(10) || '{pad}\"level\": \"' || level || '\",' || chr(10)"
        f" || '{pad}\"message\": \"' || message || '\",' || chr(10)"
        f" || '{pad}\"exception\": ' || coalesce('\"' || exception || '\"', 'null') || chr(10) || '{end}}}}}'"
    ).replace("{{", "{").replace("}}", "}")


EVENTS_NOTED = EVENTS_NOTE.format(limit=CHARACTER_LIMIT).replace("'", "''")


@query(
    f"""{E}, ranked AS (
      SELECT event_id, level, message, exception, row_number() OVER (ORDER BY ts DESC, event_id DESC) AS i, count(*) OVER () AS total,
        {pretty_sql(4)} AS text FROM log_events WHERE level IN ('Error', 'Fatal')),
    sizes AS (
      SELECT i, total, length('{{' || chr(10) || '  "truncated": true,' || chr(10) || '  "returned": ' || i || ',' || chr(10)
          || '  "truncation_message": "{EVENTS_NOTED}",' || chr(10) || '  "events": [' || chr(10))
          + sum(length(text)) OVER (ORDER BY i) + 2 * (i - 1) + length(chr(10) || '  ]' || chr(10) || '}}') AS size FROM ranked),
    fitting AS (
      SELECT max(i) AS kept FROM sizes WHERE size <= {CHARACTER_LIMIT}
        AND i IN (SELECT CAST(ceil(total / pow(2, e)) AS BIGINT) FROM range(1, 41) t(e)))
    SELECT event_id, level, message, exception, true AS truncated, kept AS returned FROM ranked CROSS JOIN fitting WHERE i <= kept"""
)
def event_budget(spark, sf_dir):
    """A page of events that is far too long as indented JSON."""
    errors = log_events(spark, sf_dir).filter(is_error()).select("event_id", "level", "message", "exception", "ts")
    columns = ["event_id", "level", "message", "exception"]
    return budget(errors, [F.desc("ts"), F.desc("event_id")], redactor=Redactor(), columns=columns)


@query(
    f"""{E}, ranked AS (SELECT {pretty_sql(4)} AS text, row_number() OVER (ORDER BY ts DESC, event_id DESC) AS i, count(*) OVER () AS total
      FROM log_events WHERE level IN ('Error', 'Fatal')),
    sizes AS (
      SELECT i, total, length('{{' || chr(10) || '  "truncated": true,' || chr(10) || '  "returned": ' || i || ',' || chr(10)
          || '  "truncation_message": "{EVENTS_NOTED}",' || chr(10) || '  "events": [' || chr(10))
          + sum(length(text)) OVER (ORDER BY i) + 2 * (i - 1) + length(chr(10) || '  ]' || chr(10) || '}}') AS size FROM ranked)
    SELECT true AS truncated, max(i) AS returned, '{EVENTS_NOTED}' AS truncation_message FROM sizes WHERE size <= {CHARACTER_LIMIT}
      AND i IN (SELECT CAST(ceil(total / pow(2, e)) AS BIGINT) FROM range(1, 41) t(e))"""
)
def event_budget_summary(spark, sf_dir):
    """The note on a result that was cut."""
    return budget_summary(event_budget(spark, sf_dir))


@query(
    f"""{E} SELECT event_id, 'Handled ' || k || ' with {{Code}}' AS rendered_message FROM log_events
    WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-31' ORDER BY ts DESC, event_id DESC LIMIT 30"""
)
def event_page_rendered(spark, sf_dir):
    """A page with its messages rendered from the stored properties."""

    def token(text, hole):
        return F.struct(F.lit(text).cast("string").alias("text"), F.lit(hole).cast("string").alias("property_name"))

    tokens = F.array(token("Handled ", None), token(None, "k"), token(" with ", None), token(None, "Code"))
    events = log_events(spark, sf_dir).withColumn("message_tokens", tokens)
    page = EventQuery.on(events, NOW).recent("30d").page(30, render=True)
    return page.select("event_id", "rendered_message").result()


# ------------------------------------------------------------- expressions
@query(
    f"""{E} SELECT event_id, 'Call of {{Path}} took {{Elapsed}} ms ' || '{{Code}}' AS template,
      'Call of ' || request_path || ' took ' || k || ' ms ' || CASE WHEN k % 2 = 0 THEN CAST(status_code AS VARCHAR) ELSE '{{Code}}' END AS message
    FROM log_events"""
)
def rendered_message(spark, sf_dir):
    """Message templates as stored and with their holes filled."""

    def token(text=None, hole=None):
        return F.struct(
            F.lit(text).cast("string").alias("text"), F.lit(hole).cast("string").alias("property_name")
        )

    tokens = F.array(token("Call of "), token(hole="Path"), token(" took "), token(hole="Elapsed"), token(" ms "), token(hole="Code"))
    path, elapsed = F.col("request_path"), F.col("k").cast("string")
    code = F.when(F.col("k") % 2 == 0, F.col("status_code").cast("string"))
    props = F.create_map(F.lit("Path"), path, F.lit("Elapsed"), elapsed, F.lit("Code"), code)
    return log_events(spark, sf_dir).select(
        "event_id", template_text(tokens).alias("template"), render_message(tokens, props).alias("message")
    )


MASK_SQL = """CASE WHEN instr(url, '?') = 0 THEN url ELSE rtrim(split_part(url, '?', 1) || '?' || array_to_string(
        list_transform(list_filter(string_split(substr(url, instr(url, '?') + 1), '&'), lambda p: p <> ''),
          lambda p: CASE WHEN contains(p, '=') THEN split_part(p, '=', 1) || '=<redacted>' ELSE p END), '&'), '?') END"""


@query(f"SELECT page_id, {MASK_SQL} AS url FROM pages")
def masked_urls(spark, sf_dir):
    from eventlens.functions.text import mask_url_query

    return table(spark, sf_dir, "pages").select("page_id", mask_url_query(F.col("url")).alias("url"))


@query(
    f"""SELECT CASE WHEN status >= 500 THEN 'error' WHEN status >= 400 THEN 'warn' ELSE 'info' END AS level,
      'GET' AS method, {MASK_SQL} AS path, status, CASE WHEN page_id % 5 = 0 THEN NULL ELSE length(html) END AS bytes, page_id AS ms
    FROM (SELECT *, CASE page_id % 9 WHEN 0 THEN 503 WHEN 1 THEN 404 ELSE 200 END AS status FROM pages)
    WHERE page_id % 4 <> 0"""
)
def access_records(spark, sf_dir):
    """Requests derived from the pages; every fourth one is a health probe."""
    key = F.col("page_id")
    requests = table(spark, sf_dir, "pages").select(
        F.lit("GET").alias("method"),
        F.when(key % 4 == 0, "/healthz?probe=1").otherwise(F.col("url")).alias("url"),
        F.when(key % 9 == 0, 503).when(key % 9 == 1, 404).otherwise(200).alias("status"),
        F.when(key % 5 == 0, "chunked").otherwise(F.length("html").cast("string")).alias("content_length"),
        key.alias("ms"),
    )
    return access_log(requests)


@query(
    f"""{E} SELECT event_id, CASE WHEN level IN ('Error', 'Fatal') THEN 'request failed (HTTP ' || status_code || ')' ELSE message END AS error
    FROM log_events"""
)
def safe_errors(spark, sf_dir):
    status = F.when(is_error(), F.col("status_code"))
    return log_events(spark, sf_dir).select("event_id", safe_error(status, F.col("message")).alias("error"))


@query(
    f"""{E} SELECT event_id, coalesce(exception, 'none') AS error_name, CASE WHEN level IN ('Error', 'Fatal') THEN status_code END AS status,
      CASE WHEN level IN ('Error', 'Fatal') THEN 'request failed (HTTP ' || status_code || ')' ELSE message END AS error FROM log_events"""
)
def error_records(spark, sf_dir):
    """Error records whole: name, status, and the message only without a status."""
    name, status = F.coalesce("exception", F.lit("none")), F.when(is_error(), F.col("status_code"))
    record = error_record(name, status, F.col("message"))
    return log_events(spark, sf_dir).select("event_id", record.alias("record")).select("event_id", "record.*")


@query(
    f"""{E} SELECT event_id, exception AS error_name, CASE WHEN k % 3 > 0 THEN 'invalid_' || (k % 3) END AS error_code,
      CASE WHEN level = 'Error' THEN 'AADSTS' || (50000 + k) END AS message_code FROM log_events"""
)
def sign_in_errors(spark, sf_dir):
    """Machine-readable parts of failed sign-ins; empty names and codes count as missing."""
    k = F.col("k")
    short = F.when(k % 3 > 0, F.concat(F.lit("invalid_"), (k % 3).cast("string"))).otherwise("")
    text = F.concat(F.when(F.col("level") == "Error", F.concat(F.lit("AADSTS"), (50000 + k).cast("string"))), F.lit(": jane"))
    record = code_record(F.coalesce("exception", F.lit("")), short, text)
    return log_events(spark, sf_dir).select("event_id", record.alias("record")).select("event_id", "record.*")


@query(
    f"""{E} SELECT event_id, CASE WHEN level = 'Error' THEN 'AADSTS' || (50000 + k) END AS code FROM log_events"""
)
def error_codes(spark, sf_dir):
    """Messages derived from the events, some with a code in the middle of the text."""
    code = F.concat(F.lit("AADSTS"), (50000 + F.col("k")).cast("string"), F.lit(": denied AADSTS1 for "))
    text = F.concat(F.when(F.col("level") == "Error", code).otherwise("passed "), F.col("message"))
    return log_events(spark, sf_dir).select("event_id", error_code(text).alias("code"))


@query(
    f"""{E} SELECT kind, identifier, count(*) AS n FROM (
      SELECT 'request' AS kind, 'r-' || user_id AS identifier FROM log_events
      UNION ALL SELECT 'workspace', lpad(CAST(k AS VARCHAR), 8, '0') FROM log_events WHERE level = 'Error'
      UNION ALL SELECT 'source_line', 'Handler' || (k % 6) || '.cs:' || k FROM log_events WHERE exception IS NOT NULL
      UNION ALL SELECT 'transaction', CAST(event_id % 50 AS VARCHAR) FROM log_events WHERE level = 'Fatal'
      UNION ALL SELECT 'function', 'sync-' || (k % 9) FROM log_events WHERE level = 'Warning')
    GROUP BY kind, identifier"""
)
def identifier_report(spark, sf_dir):
    k = F.col("k").cast("string")
    text = F.concat_ws(
        " ",
        F.col("message"),
        F.concat(F.lit("RequestId: r-"), F.col("user_id").cast("string")),
        F.when(F.col("level") == "Error", F.concat(F.lit("(WorkspaceId="), F.lpad(k, 8, "0"), F.lit(")"))),
        F.when(F.col("exception").isNotNull(), F.concat(F.lit("at Handler"), (F.col("k") % 6).cast("string"), F.lit(".cs:"), k)),
        F.when(F.col("level") == "Fatal", F.concat(F.lit("transaction_id="), (F.col("event_id") % 50).cast("string"))),
        F.when(F.col("level") == "Warning", F.concat(F.lit("Lambda: sync-"), (F.col("k") % 9).cast("string"))),
    )
    return identifiers(log_events(spark, sf_dir).select(text.alias("text")), "text")


@query(
    r"""SELECT source, 'ip' AS kind, identifier, count(*) AS n FROM (
      SELECT source, unnest(regexp_extract_all(text, '\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b')) AS identifier FROM documents)
    GROUP BY source, identifier"""
)
def identifiers_by_source(spark, sf_dir):
    pattern = r"(?<![A-Za-z0-9_])((?:[0-9]{1,3}\.){3}[0-9]{1,3})(?![A-Za-z0-9_])"
    return identifiers(table(spark, sf_dir, "documents"), "text", {"ip": pattern}, ("source",))
