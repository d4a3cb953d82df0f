"""Named queries and the SQL that checks each of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under the name of its function."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            CHECKS[fn.__name__] = sql
        return fn

    return register


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles at six places, as both engines agree on them."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def naive(column: str) -> Column:
    """A zoned timestamp as naive UTC time."""
    return F.col(column).cast("timestamp_ntz").alias(column)
