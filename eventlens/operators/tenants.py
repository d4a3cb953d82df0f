"""Tenant names, slugs and signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def loose_key(text: Column, prefix: str = "") -> Column:
    """Title without prefix, case and spacing."""
    plain = F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))
    if not prefix:
        return plain
    start = " ".join(prefix.lower().split())
    return F.when(plain.startswith(start), F.trim(F.substr(plain, F.lit(len(start) + 1)))).otherwise(plain)


def resolve_tenants(names: DataFrame, signals: DataFrame, prefix: str = "Tenant -", name: str = "name") -> DataFrame:
    """Match display names with signal titles; names without a signal get NULL."""
    wanted = names.select(name).distinct().withColumn("_key", loose_key(F.col(name)))
    known = signals.select("signal_id", "title", "predicate", loose_key(F.col("title"), prefix).alias("_key"))
    return wanted.join(known, "_key", "left").drop("_key")


def with_tenant_name(df: DataFrame, tenants: DataFrame, column: str = "environment") -> DataFrame:
    """Add the display name of each slug; apply it to aggregated results."""
    names = tenants.select(F.col("slug").alias("_slug"), F.col("name").alias("tenant_name"))
    return df.join(names, F.col(column) == F.col("_slug"), "left").drop("_slug")
