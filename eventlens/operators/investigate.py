"""The standard questions of an investigation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.functions.timerange import slice_start
from eventlens.operators.aggregates import by_slice, count_by, percentiles, top_k, worst_first
from eventlens.operators.filters import is_error, symptom
from eventlens.operators.tenants import with_tenant_name


def errors_by(df: DataFrame, *by: str) -> DataFrame:
    """Errors per key, worst first."""
    return worst_first(count_by(df.filter(is_error()), *by), "n", *by)


def errors_per_slice(df: DataFrame, slice: str = "5m", *by: str) -> DataFrame:
    return by_slice(df.filter(F.col("level") == "Error"), slice, by)


def percentile_per_slice(
    df: DataFrame, column: str, point: float, prefix: str, slice: str, method: str = "narrowed"
) -> DataFrame:
    """A percentile per slice for the paths that start with ``prefix``."""
    scoped = df.filter(F.col("request_path").startswith(prefix))
    sliced = scoped.select(slice_start(slice).alias("slice_start"), column)
    return percentiles(sliced, ["slice_start"], column, {"value": point}, [F.count("*").alias("n")], method)


def top_failing(df: DataFrame, min_status: int = 500, k: int = 20) -> DataFrame:
    failing = df.filter(F.col("status_code") >= min_status)
    return top_k(count_by(failing, "request_path"), k, "n", "request_path")


def path_latency(df: DataFrame, prefix: str, column: str = "elapsed", method: str = "narrowed") -> DataFrame:
    scoped = df.filter(F.col("request_path").startswith(prefix))
    return percentiles(scoped, ["request_path"], column, {"p95": 95}, [F.avg(column).alias("mean")], method)


def affected_users(df: DataFrame, min_status: int = 500, approx: bool = False) -> DataFrame:
    users = F.approx_count_distinct("user_id") if approx else F.countDistinct("user_id")
    return df.filter(F.col("status_code") >= min_status).agg(users.alias("users"))


def errors_by_tenant(df: DataFrame, tenants: DataFrame | None = None) -> DataFrame:
    counts = count_by(df.filter(is_error()), "environment")
    if tenants is not None:
        counts = with_tenant_name(counts, tenants)
    return worst_first(counts, "n", "environment")


def tenant_errors_per_slice(df: DataFrame, slug: str, slice: str = "5m") -> DataFrame:
    return errors_per_slice(df.filter(F.col("environment") == slug), slice)


def tenant_share(df: DataFrame, slug: str, slice: str = "1h") -> DataFrame:
    """Errors of one tenant next to those of the fleet, in one pass."""
    mine = F.col("environment") == slug
    counts = by_slice(
        df.filter(is_error()),
        slice,
        aggs=[F.count_if(mine).alias("tenant_errors"), F.count("*").alias("fleet_errors")],
    )
    return counts.withColumn("share", F.col("tenant_errors") / F.col("fleet_errors"))


def error_spread(df: DataFrame, slice: str = "1h") -> DataFrame:
    """Services with errors per slice."""
    return by_slice(
        df.filter(is_error()),
        slice,
        aggs=[F.countDistinct("application").alias("services"), F.count("*").alias("n")],
    )


def sweep(df: DataFrame, **scopes: Column) -> DataFrame:
    """Rows of several filters over one window, labelled, in one scan.

    A row that passes two filters appears once under each label.
    """
    labels = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in scopes.items()]))
    any_scope = F.lit(False)
    for rule in scopes.values():
        any_scope = any_scope | rule
    return df.filter(any_scope).withColumn("scope", F.explode(labels))


def symptom_search(df: DataFrame, text: str, exception: str | None = None) -> DataFrame:
    """The reported symptom next to every error of the same window."""
    return sweep(df, symptom=symptom(text, exception), broad=is_error())


# Kinds of identifiers worth quoting in a report; group 1 is the identifier.
IDENTIFIERS = {
    "request": r"(?i:request[-_ ]?id)[:=] ?([0-9A-Za-z-]+)",
    "transaction": r"(?i:transaction[-_ ]?id)[:=] ?([0-9A-Za-z-]+)",
    "workspace": r"(?i:workspace[-_ ]?id)[:=] ?([0-9A-Za-z-]+)",
    "function": r"(?i:lambda|function)[:=] ?([0-9A-Za-z_-]+)",
    "source_line": r"(?<![A-Za-z0-9_])([A-Za-z_][A-Za-z0-9_]*+\.(?:cs|py|ts|js|java|go):[0-9]+)",
}


def identifiers(df: DataFrame, column: str, patterns: dict[str, str] | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Identifiers found in a text column, with the number of times each occurs.

    The text is dropped before the counting, so only identifiers are shuffled.
    """
    found = F.array(
        *[
            F.struct(
                F.lit(kind).alias("kind"),
                F.regexp_extract_all(F.col(column), F.lit(pattern), 1).alias("values"),
            )
            for kind, pattern in (patterns or IDENTIFIERS).items()
        ]
    )
    kinds = df.select(*by, F.inline(found))
    listed = kinds.select(*by, "kind", F.explode("values").alias("identifier"))
    return listed.groupBy(*by, "kind", "identifier").agg(F.count("*").alias("n"))
