"""Alert state: rules counted over their own windows in a single scan."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.functions.pii import Redactor
from eventlens.functions.timerange import TimeWindow, instant, slice_length, ts_literal, within
from eventlens.operators.redact import redact

# Rules that are counted by one aggregate.
RULES_PER_SCAN = 200


@dataclass(frozen=True)
class Rule:
    rule_id: str
    predicate: str
    window: timedelta
    threshold: int
    suppress_until: datetime | None

    @property
    def matches(self) -> Column:
        return F.expr(self.predicate)


def load_rules(rules: DataFrame) -> list[Rule]:
    """Rule definitions on the driver: configuration text, which becomes part of the plan."""
    rows = rules.select("rule_id", "predicate", "window", "threshold", "suppress_until").collect()
    loaded = [Rule(r[0], r[1], slice_length(r[2]), r[3], r[4]) for r in rows]
    if len({r.rule_id for r in loaded}) < len(loaded):
        raise ValueError("alert rule ids are not unique")
    return sorted(loaded, key=lambda r: r.rule_id)


def state_of(observed: Column, threshold: Column, suppress_until: Column, now: Column) -> Column:
    """firing at or above the threshold, unless suppressed; else ok."""
    return (
        F.when(suppress_until > now, "suppressed").when(observed >= threshold, "firing").otherwise("ok")
    )


def alert_state(df: DataFrame, rules: DataFrame, now: str | datetime, redactor: Redactor = Redactor()) -> DataFrame:
    """State of every rule at ``now``, rules without a matching event included; personal data in names is masked.

    The scan covers the longest window once for ``RULES_PER_SCAN`` rules.  Each
    rule is a conditional count, combined map-side, so a single row per task is
    shuffled; the row of counts is then turned into one row per rule.
    """
    loaded = load_rules(rules)
    if len(loaded) > RULES_PER_SCAN:
        groups = [loaded[i : i + RULES_PER_SCAN] for i in range(0, len(loaded), RULES_PER_SCAN)]
        states = reduce(DataFrame.unionByName, [_state(df, rules, group, now) for group in groups])
    else:
        states = _state(df, rules, loaded, now)
    return redact(states, redactor, exclude=("state",), numeric=())


def _state(df: DataFrame, rules: DataFrame, loaded: list[Rule], now: str | datetime) -> DataFrame:
    at = instant(now)
    columns = "rule_id string, state string, observed bigint, threshold bigint, as_of " + df.schema["ts"].dataType.simpleString()
    if not loaded:
        return df.sparkSession.createDataFrame([], columns)
    longest = max(r.window for r in loaded)
    scoped = within(df, TimeWindow(at - longest, at))

    def recent(rule: Rule) -> Column:
        if rule.window == longest:
            return rule.matches
        return (F.col("ts") >= ts_literal(df, at - rule.window)) & rule.matches

    counts = scoped.agg(*[F.count_if(recent(r)).alias(f"_{i}") for i, r in enumerate(loaded)])
    as_of = ts_literal(df, at)

    def until(rule: Rule) -> Column:
        # A rule's time is a naive UTC value or an aware one, as its table has it.
        kind = rules.schema["suppress_until"].dataType
        return F.lit(rule.suppress_until).cast(kind).cast(df.schema["ts"].dataType)

    per_rule = F.array(
        *[
            F.struct(
                F.lit(r.rule_id).alias("rule_id"),
                state_of(F.col(f"_{i}"), F.lit(r.threshold), until(r), as_of).alias("state"),
                F.col(f"_{i}").alias("observed"),
                F.lit(r.threshold).cast("bigint").alias("threshold"),
                as_of.alias("as_of"),
            )
            for i, r in enumerate(loaded)
        ]
    )
    return counts.select(F.inline(per_rule))
