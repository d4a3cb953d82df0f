"""Newest-first pages, keyset cursors, and the size budget of a result."""

from __future__ import annotations

import json
from collections.abc import Collection
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlens.functions.jsonsize import INDENT, cells_length, json_length
from eventlens.functions.pii import Redactor
from eventlens.operators.redact import MEASURES, redact
from eventlens.session import materialize

# Page and payload limits, and the notes on a cut result (their
# length counts towards the payload).
MAX_PAGE = 50
DEFAULT_PAGE = 20
CHARACTER_LIMIT = 25_000
EVENTS_NOTE = (
    "Response exceeded {limit} characters. Reduce 'count', narrow the time 'range', "
    "or add a 'filter' expression to get more targeted results."
)
ROWSET_NOTE = (
    "Response exceeded {limit} characters and rows were truncated. Add a 'limit' clause, "
    "narrow the time range, or group at a coarser level."
)


def event_page(
    df: DataFrame,
    count: int = DEFAULT_PAGE,
    after: object = None,
    ts: str = "ts",
    event_id: str = "event_id",
) -> DataFrame:
    """The newest ``count`` events, or those that follow the cursor ``after``.

    ``after`` is the id of the last event seen, or its ``(ts, id)`` pair, which
    saves the lookup.  Either way the page filter holds literals only, so the
    scan skips everything newer than the cursor.
    """
    if not 1 <= count <= MAX_PAGE:
        raise ValueError(f"count must be between 1 and {MAX_PAGE}")
    page = df
    if after is not None:
        page = page.filter(_older_than(df, after, ts, event_id))
    return page.orderBy(F.desc(ts), F.desc(event_id)).limit(count)


def _older_than(df: DataFrame, after: object, ts: str, event_id: str) -> Column:
    kind = df.schema[ts].dataType
    if isinstance(after, tuple):
        at, last = after
    else:
        found = df.filter(F.col(event_id) == F.lit(after)).select(ts).head(1)
        if not found:
            raise ValueError(f"no event with id {after!r} to continue from")
        at, last = found[0][0], after
    at = F.lit(at.isoformat(sep=" ") if isinstance(at, datetime) else at).cast(kind)
    # The first condition alone is what the scan can use to skip data.
    return (F.col(ts) <= at) & ((F.col(ts) < at) | (F.col(event_id) < F.lit(last)))


def budget(
    df: DataFrame,
    order: list[Column],
    limit: int = CHARACTER_LIMIT,
    layout: str = "events",
    pretty: bool = True,
    redactor: Redactor | None = None,
    columns: list[str] | None = None,
    measures: Collection[str] = MEASURES,
) -> DataFrame:
    """Halve the rows until the JSON payload fits into ``limit`` characters.

    Adds ``truncated`` and ``returned`` to every kept row.  ``layout`` is
    ``events`` (an array of objects) or ``rowset`` (column names and row
    arrays).  A row takes two characters at least, so rows past ``limit / 2``
    can never fit: a top-k brings the rest into one small task, where the
    running size is taken.  Redaction, if any, runs on those rows only
    and leaves ``measures`` numbers.  ``columns`` names the payload where ``order`` needs columns beyond it.

    The top-k is run while the query is built and kept in the scratch folder.  A
    result of fewer rows is thereby counted too, so its query runs once; only of
    a longer one the rows are counted, without their payload.
    """
    most = limit // 2 + 1
    # The position is fixed before redaction can change a sort column.
    top = df.orderBy(*order).limit(most)
    top = top.withColumn("_k", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    top = materialize(top if columns is None else top.select(*columns, "_k"))
    found = top.count()
    total = F.lit(found if found < most else df.count()).cast("bigint")
    if redactor is not None:
        top = redact(top, redactor, ("_k", "event_id"), measures=measures)
    names = [c for c in top.columns if c != "_k"]
    bare_row, wrapped_row = _row_lengths(top, names, layout, pretty)
    running = Window.orderBy("_k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    note = _note(layout, limit)
    sized = (
        top.withColumn("_n", total)
        .withColumn("_bare", F.sum(bare_row).over(running))
        .withColumn("_wrapped", F.sum(wrapped_row).over(running))
    )
    k = F.col("_k")
    halvings = F.transform(
        F.sequence(F.lit(1), F.lit(40)), lambda i: F.ceil(F.col("_n") / F.pow(F.lit(2), i)).cast("bigint")
    )
    whole = (k == F.col("_n")) & (_payload(F.col("_bare"), k, names, layout, pretty, None) <= limit)
    fits = F.array_contains(halvings, k) & (
        _payload(F.col("_wrapped"), k, names, layout, pretty, note) <= limit
    )
    everything = Window.partitionBy()
    kept = F.coalesce(
        F.max(F.when(whole, k)).over(everything),
        F.max(F.when(fits, k)).over(everything),
        F.lit(1).cast("bigint"),
    )
    return (
        sized.withColumn("returned", kept)
        .withColumn("truncated", F.col("returned") < F.col("_n"))
        .filter(k <= F.col("returned"))
        .select(*names, "truncated", "returned")
    )


def budget_summary(budgeted: DataFrame, limit: int = CHARACTER_LIMIT, layout: str = "events") -> DataFrame:
    """One row that says whether and how far a result was cut."""
    cut = F.coalesce(F.bool_or("truncated"), F.lit(False))
    return budgeted.agg(
        cut.alias("truncated"),
        F.count("*").alias("returned"),
        F.when(cut, F.lit(_note(layout, limit))).alias("truncation_message"),
    )


def _note(layout: str, limit: int) -> str:
    return (EVENTS_NOTE if layout == "events" else ROWSET_NOTE).format(limit=limit)


def _row_lengths(df: DataFrame, names: list[str], layout: str, pretty: bool) -> tuple[Column, Column]:
    types = [df.schema[n].dataType for n in names]
    columns = [F.col(n) for n in names]
    if layout == "rowset":
        row = cells_length(columns, types, pretty, 2)
        return row, row
    schema = df.select(*names).schema
    whole = F.struct(*columns)
    return json_length(whole, schema, pretty, 1), json_length(whole, schema, pretty, 2)


def _payload(rows: Column, k: Column, names: list[str], layout: str, pretty: bool, note: str | None) -> Column:
    """Length of the payload that holds ``k`` rows of length ``rows`` in all."""
    digits = F.length(k.cast("string"))

    def listed(depth: int) -> Column:
        frame = rows + k + 1
        return frame + k * (1 + INDENT * (depth + 1)) + 1 + INDENT * depth if pretty else frame

    if layout == "events" and note is None:
        return listed(0)
    # The same payload around an empty list and a one-digit count, measured as text.
    around: dict = {}
    if note is not None:
        around["truncated"] = True
        around["returned" if layout == "events" else "returnedRows"] = 0
        around["truncation_message"] = note
    if layout == "rowset":
        around["Columns"] = names
    around["events" if layout == "events" else "Rows"] = []
    text = json.dumps(
        around,
        ensure_ascii=False,
        indent=INDENT if pretty else None,
        separators=(",", ": ") if pretty else (",", ":"),
    )
    extra = F.lit(0) if note is None else digits - 1
    return F.lit(len(text) - 2) + extra + listed(1)
