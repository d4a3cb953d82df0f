"""A query over events as a chain of steps that ends in a plain DataFrame."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlens.functions.pii import Redactor
from eventlens.functions.text import render_message
from eventlens.functions.timerange import TimeWindow, events_window, query_window, slice_start, within
from eventlens.operators.filters import signal_predicate, tenant_scope
from eventlens.operators.paging import DEFAULT_PAGE, budget, event_page
from eventlens.operators.redact import MEASURES, redact


@dataclass(frozen=True)
class EventQuery:
    """Scope, filter, group, order and limit events; every step returns a new query.

    The time window applies first and as literals, so it always reaches the
    scan.  Redaction and the size budget apply last, to the rows of the result.
    """

    df: DataFrame
    now: str | datetime
    keys: tuple[Column, ...] = ()
    by_time: Column | None = None
    measures: tuple[str, ...] = MEASURES

    @classmethod
    def on(cls, events: DataFrame, now: str | datetime) -> EventQuery:
        return cls(events, now)

    def _with(self, df: DataFrame) -> EventQuery:
        return replace(self, df=df)

    def window(self, window: TimeWindow) -> EventQuery:
        return self._with(within(self.df, window))

    def between(self, range: str | None = None, start: str | None = None, end: str | None = None) -> EventQuery:
        """Range policy of aggregates: the last 24 hours unless told otherwise."""
        return self.window(query_window(self.now, range, start, end))

    def recent(self, range: str | None = None, start: str | None = None, end: str | None = None) -> EventQuery:
        """Range policy of event pages: the last hour unless told otherwise."""
        return self.window(events_window(self.now, range, start, end))

    def signal(self, signals: DataFrame, ids: str | list[str], combine: str = "and") -> EventQuery:
        return self._with(self.df.filter(signal_predicate(signals, ids, combine)))

    def tenant(self, slug: str) -> EventQuery:
        return self._with(tenant_scope(self.df, slug))

    def where(self, predicate: str | Column, **args: Any) -> EventQuery:
        """Filter by a Column or by SQL text, whose ``:name`` parameters come from ``args``."""
        if isinstance(predicate, Column):
            return self._with(self.df.filter(predicate))
        if not args:
            return self._with(self.df.filter(F.expr(predicate)))
        text = predicate.replace("{", "{{").replace("}", "}}")
        return self._with(
            self.df.sparkSession.sql(f"SELECT * FROM {{events}} WHERE {text}", args=args, events=self.df)
        )

    def group(self, *keys: str, slice: str | None = None) -> EventQuery:
        """Group by properties, by a time slice such as ``5m``, or by both."""
        return replace(
            self,
            keys=tuple(F.col(k) for k in keys),
            by_time=None if slice is None else slice_start(slice).alias("slice_start"),
        )

    def agg(self, *aggs: Column) -> EventQuery:
        keys = self.keys if self.by_time is None else (self.by_time, *self.keys)
        found = self.df.groupBy(*keys).agg(*aggs)
        # What is aggregated is a measure: it stays a number when the result is masked.
        return replace(self, df=found, keys=(), by_time=None, measures=(*self.measures, *found.columns[len(keys) :]))

    def select(self, *columns: str | Column) -> EventQuery:
        return self._with(self.df.select(*columns))

    def order(self, *columns: str | Column) -> EventQuery:
        return self._with(self.df.orderBy(*columns))

    def limit(self, n: int) -> EventQuery:
        return self._with(self.df.limit(n))

    def page(self, count: int = DEFAULT_PAGE, after: object = None, render: bool = False) -> EventQuery:
        """The newest events, or those after a cursor; ``render`` adds their rendered message."""
        page = self._with(event_page(self.df, count, after))
        return page.rendered() if render else page

    def rendered(self, tokens: str = "message_tokens", props: str = "props", name: str = "rendered_message") -> EventQuery:
        """Add the message with its holes filled from the properties, a map or JSON text."""
        text = isinstance(self.df.schema[props].dataType, T.StringType)
        values = F.from_json(props, "map<string,string>") if text else F.col(props)
        return self._with(self.df.withColumn(name, render_message(F.col(tokens), values)))

    def redacted(
        self,
        redactor: Redactor = Redactor(),
        exclude: Sequence[str] = ("event_id",),
        numeric: Sequence[str] | None = None,
        json: Sequence[str] = ("props",),
    ) -> EventQuery:
        return self._with(redact(self.df, redactor, exclude, numeric, json, self.measures))

    def result(self, redactor: Redactor = Redactor(), exclude: Sequence[str] = ("event_id",)) -> DataFrame:
        """What may be shown of a query: its rows with personal data masked, unless the redactor is switched off.

        ``dataframe`` gives the raw rows, for further steps.
        """
        return self.redacted(redactor, exclude).dataframe()

    def budgeted(self, *order: Column, layout: str = "rowset", **options: Any) -> EventQuery:
        return self._with(budget(self.df, list(order), layout=layout, **{"measures": self.measures, **options}))

    def dataframe(self) -> DataFrame:
        return self.df


def query_stream(df: DataFrame, query: str, **args: Any) -> DataFrame:
    """Spark SQL over the scoped events, which the query calls ``stream``.

    The name holds within the query alone: a view called ``stream`` of the
    session stays as it is, and queries of several threads do not meet.
    """
    spark = df.sparkSession
    view = f"stream_{uuid.uuid4().hex}"
    own = re.match(r"\s*with\b(\s+recursive\b)?", query, re.IGNORECASE)
    recursive = " RECURSIVE" if own and own[1] else ""
    rest = "," + query[own.end() :] if own else " " + query
    df.createOrReplaceTempView(view)
    try:
        return spark.sql(f"WITH{recursive} stream AS (SELECT * FROM {view}){rest}", args=args or None)
    finally:
        spark.catalog.dropTempView(view)
