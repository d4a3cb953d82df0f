"""Table shapes the operators expect (extra columns are always allowed)."""

from __future__ import annotations

from pyspark.sql import types as T

MESSAGE_TOKENS = T.ArrayType(
    T.StructType(
        [
            T.StructField("text", T.StringType()),
            T.StructField("property_name", T.StringType()),
        ]
    )
)

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("ts", T.TimestampType(), False),
        T.StructField("level", T.StringType()),
        T.StructField("message_tokens", MESSAGE_TOKENS),
        T.StructField("message", T.StringType()),
        T.StructField("exception", T.StringType()),
        T.StructField("application", T.StringType()),
        T.StructField("environment", T.StringType()),
        T.StructField("request_path", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("elapsed", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

SIGNALS = T.StructType(
    [
        T.StructField("signal_id", T.StringType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("description", T.StringType()),
        T.StructField("predicate", T.StringType(), False),
        T.StructField("owner_id", T.StringType()),
        T.StructField("is_shared", T.BooleanType(), False),
    ]
)

TENANTS = T.StructType(
    [
        T.StructField("slug", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
    ]
)

DEPLOYMENTS = T.StructType(
    [
        T.StructField("application", T.StringType(), False),
        T.StructField("deploy_ts", T.TimestampType(), False),
        T.StructField("version", T.StringType()),
    ]
)

RULES = T.StructType(
    [
        T.StructField("rule_id", T.StringType(), False),
        T.StructField("predicate", T.StringType(), False),
        T.StructField("window", T.StringType(), False),
        T.StructField("threshold", T.LongType(), False),
        T.StructField("suppress_until", T.TimestampType()),
    ]
)
