"""Predicates on events and the saved filters ("signals")."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.functions.pii import Redactor
from eventlens.functions.text import LEVEL_RANKS, level_name, level_rank
from eventlens.operators.redact import redact

NO_DESCRIPTION = "No description provided"
ERROR_LEVELS = ("Error", "Fatal")


def is_error(level: str = "level") -> Column:
    return F.col(level).isin(*ERROR_LEVELS)


def symptom(text: str, exception: str | None = None) -> Column:
    """Literal terms of a report, in the message or in the exception."""
    found = F.col("message").contains(text)
    return found if exception is None else found | F.col("exception").contains(exception)


def prop(name: str, dtype: str = "string", props: str = "props") -> Column:
    """A free-form property held as JSON text; NULL when absent or of another type."""
    return F.try_variant_get(F.try_parse_json(F.col(props)), f"$.{name}", dtype)


def tenant_scope(df: DataFrame, slug: str, column: str = "environment") -> DataFrame:
    return df.filter(F.col(column) == slug)


def severity_threshold(df: DataFrame, threshold: str, level: str = "level") -> DataFrame:
    """Rows at or above a severity; both sides are normalised, unknown is info."""
    known = threshold.strip().lower()
    rank = LEVEL_RANKS.get(known, LEVEL_RANKS["info"])
    return df.filter(level_rank(F.col(level)) >= rank).withColumn("severity", level_name(F.col(level)))


def slow_requests(df: DataFrame, threshold: float, column: str = "elapsed") -> DataFrame:
    return df.filter(F.col(column) > threshold)


def find_signals(
    signals: DataFrame,
    shared: bool = True,
    owner_id: str | None = None,
    title: str | None = None,
    partial: bool = False,
    redactor: Redactor = Redactor(),
) -> DataFrame:
    """Catalog of saved filters; ``partial`` matches titles by case-insensitive substring.

    A result for display: personal data is masked in everything but the ids.
    ``signal_predicate`` reads the table itself.
    """
    found = signals.filter(F.col("is_shared") == shared)
    if owner_id is not None:
        found = found.filter(F.col("owner_id") == owner_id)
    if title is not None:
        wanted = F.lower(F.lit(title))
        name = F.lower("title")
        found = found.filter(name.contains(wanted) if partial else name == wanted)
    listed = found.select(
        F.col("signal_id").alias("id"),
        "title",
        "description",
        F.col("is_shared").alias("shared"),
        "owner_id",
        "predicate",
    )
    return redact(listed, redactor, exclude=("id", "owner_id"))


def signal_listing(signals: DataFrame, redactor: Redactor = Redactor()) -> DataFrame:
    """The shared signals as a listing, with a default description; masked like the catalog."""
    return find_signals(signals, redactor=redactor).select(
        "id",
        "title",
        F.coalesce(F.nullif("description", F.lit("")), F.lit(NO_DESCRIPTION)).alias("description"),
        "shared",
        "owner_id",
    )


def signal_predicate(signals: DataFrame, ids: str | list[str], combine: str = "and") -> Column:
    """The predicate behind comma-separated signal ids.

    Only one row for each of the named ids reaches the driver, as text that
    becomes part of the plan.  An id that has two predicates is an error.
    """
    names = [i.strip() for i in ids.split(",")] if isinstance(ids, str) else list(ids)
    rows = signals.filter(F.col("signal_id").isin(*names)).groupBy("signal_id")
    found = rows.agg(F.min("predicate").alias("predicate"), F.max("predicate").alias("other")).collect()
    texts = {r["signal_id"]: r["predicate"] for r in found}
    missing = [n for n in names if n not in texts]
    if missing:
        raise ValueError(f"unknown signal ids: {', '.join(missing)}")
    unclear = sorted(r["signal_id"] for r in found if r["predicate"] != r["other"])
    if unclear:
        raise ValueError(f"signal ids with several predicates: {', '.join(unclear)}")
    return reduce({"and": and_, "or": or_}[combine], [F.expr(texts[n]) for n in names])


def signal_scope(df: DataFrame, signals: DataFrame, ids: str | list[str], combine: str = "and") -> DataFrame:
    return df.filter(signal_predicate(signals, ids, combine))
