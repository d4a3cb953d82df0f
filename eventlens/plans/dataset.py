"""The log-event tables behind the registered queries, derived from the driver's tables.

Each table is given twice, as Spark expressions and as the SQL of the check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NOW = "2024-01-31T00:00:00Z"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log_columns() -> dict[str, Column]:
    k = F.get_json_object("props", "$.k").cast("int")
    error = F.col("event_type") == "error"
    path = F.concat(F.lit("/api/"), F.col("event_type"), F.lit("/"), (k % 5).cast("string"))
    level = (
        F.when(error & (k >= 90), "Fatal")
        .when(error, "Error")
        .when((F.col("event_type") == "signup") & (k < 10), "Warning")
        .otherwise("Information")
    )
    status = F.when(error, 500 + k % 4).when(k < 10, 400 + k % 4).otherwise(200)
    message = F.concat(
        F.col("event_type"), F.lit(" on "), path, F.when(error & (k % 7 == 0), " ended in timeout").otherwise(" done")
    )
    return {
        "level": level,
        "message": message,
        "exception": F.when(error, F.concat(F.lit("Exception"), (k % 6).cast("string"))),
        "application": F.concat(F.lit("svc-"), (k % 8).cast("string")),
        "environment": F.concat(F.lit("tenant-"), (F.col("user_id") % 20).cast("string")),
        "request_path": path,
        "status_code": status.cast("int"),
        "elapsed": F.col("value"),
        "k": k,
    }


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events")
    columns = [c.alias(name) for name, c in log_columns().items()]
    return raw.select("event_id", "ts", "user_id", "event_type", "props", *columns)


LOG_EVENTS_SQL = """
log_events AS (
  SELECT event_id, ts, user_id, event_type, props, k,
    CASE WHEN event_type = 'error' AND k >= 90 THEN 'Fatal' WHEN event_type = 'error' THEN 'Error'
         WHEN event_type = 'signup' AND k < 10 THEN 'Warning' ELSE 'Information' END AS level,
    event_type || ' on ' || '/api/' || event_type || '/' || (k % 5) ||
      CASE WHEN event_type = 'error' AND k % 7 = 0 THEN ' ended in timeout' ELSE ' done' END AS message,
    CASE WHEN event_type = 'error' THEN 'Exception' || (k % 6) END AS exception,
    'svc-' || (k % 8) AS application,
    'tenant-' || (user_id % 20) AS environment,
    '/api/' || event_type || '/' || (k % 5) AS request_path,
    CASE WHEN event_type = 'error' THEN 500 + k % 4 WHEN k < 10 THEN 400 + k % 4 ELSE 200 END AS status_code,
    value AS elapsed
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One saved filter per customer: the events of that customer's tenant."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("signal-"), key.cast("string")).alias("signal_id"),
        F.concat(F.lit("Tenant -"), F.when(key % 2 == 0, "  ").otherwise(" "), F.col("c_name")).alias("title"),
        F.when(key % 4 == 0, F.lit(None)).when(key % 4 == 1, "").otherwise(F.col("c_mktsegment")).alias("description"),
        F.concat(F.lit("environment = 'tenant-"), (key % 20).cast("string"), F.lit("'")).alias("predicate"),
        F.concat(F.lit("owner-"), F.col("c_nationkey").cast("string")).alias("owner_id"),
        (key % 3 != 0).alias("is_shared"),
    )


SIGNALS_SQL = """
signals AS (
  SELECT 'signal-' || c_custkey AS signal_id,
    'Tenant -' || CASE WHEN c_custkey % 2 = 0 THEN '  ' ELSE ' ' END || c_name AS title,
    CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN '' ELSE c_mktsegment END AS description,
    'environment = ''tenant-' || (c_custkey % 20) || '''' AS predicate,
    'owner-' || c_nationkey AS owner_id, c_custkey % 3 <> 0 AS is_shared
  FROM customer
)"""


def tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display names of the tenants, from the customer table."""
    slug = F.concat(F.lit("tenant-"), F.col("c_custkey").cast("string"))
    return table(spark, sf_dir, "customer").select(slug.alias("slug"), F.col("c_name").alias("name"))


TENANTS_SQL = "tenants AS (SELECT 'tenant-' || c_custkey AS slug, c_name AS name FROM customer)"


def deployments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deployments read off the event log: some of the sign-up events."""
    k = F.get_json_object("props", "$.k").cast("int")
    return (
        table(spark, sf_dir, "events")
        .filter((F.col("event_type") == "signup") & (k < 3))
        .select(
            F.concat(F.lit("svc-"), (F.col("user_id") % 7).cast("string")).alias("application"),
            F.col("ts").alias("deploy_ts"),
            F.concat(F.lit("v"), F.col("event_id").cast("string")).alias("version"),
        )
    )


DEPLOYMENTS_SQL = """
deployments AS (
  SELECT 'svc-' || (user_id % 7) AS application, ts AS deploy_ts, 'v' || event_id AS version
  FROM events WHERE event_type = 'signup' AND CAST(json_extract_string(props, '$.k') AS INTEGER) < 3
)"""

RULES = [
    ("many-errors", "level in ('Error', 'Fatal')", "1d", 40, None),
    ("fatal", "level = 'Fatal'", "6h", 1_000_000, None),
    ("slow", "elapsed > 30", "12h", 1, "2024-02-01 00:00:00"),
    ("timeouts", "message like '%timeout%'", "7d", 5, "2024-01-30 00:00:00"),
    ("client-errors", "status_code between 400 and 499", "2h", 1_000_000, "2024-03-01 00:00:00"),
    ("never", "exception = 'none'", "30d", 1, None),
]


def rules(spark: SparkSession) -> DataFrame:
    frame = spark.createDataFrame(
        RULES, "rule_id string, predicate string, window string, threshold bigint, suppress_until string"
    )
    return frame.withColumn("suppress_until", F.col("suppress_until").cast("timestamp_ntz"))


def with_tables(*names: str) -> str:
    """``WITH`` clause of the named derived tables."""
    known = {
        "log_events": LOG_EVENTS_SQL,
        "signals": SIGNALS_SQL,
        "tenants": TENANTS_SQL,
        "deployments": DEPLOYMENTS_SQL,
    }
    return "WITH " + ", ".join(known[n].strip() for n in names) + " "
