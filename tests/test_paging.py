"""Pages, cursors and the size budget."""

import json
import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventlens.operators.paging import CHARACTER_LIMIT, EVENTS_NOTE, ROWSET_NOTE, budget, budget_summary, event_page

START = datetime(2024, 1, 1)


def events(spark, n=130):
    rng = random.Random(4)
    rows = [(i, START + timedelta(seconds=rng.randint(0, 40)), rng.choice(["a", "b"])) for i in range(n)]
    return spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, level string"), rows


def test_pages_join_to_the_whole_order(spark):
    df, rows = events(spark)
    expected = [r[0] for r in sorted(rows, key=lambda r: (r[1], r[0]), reverse=True)]
    seen, after = [], None
    while True:
        page = event_page(df, 50, after).collect()
        if not page:
            break
        seen += [r["event_id"] for r in page]
        # By id, or by the pair that saves the lookup.
        after = page[-1]["event_id"] if len(seen) == 50 else (page[-1]["ts"], page[-1]["event_id"])
    assert seen == expected


def test_page_limits(spark):
    df, _ = events(spark, 60)
    assert event_page(df).count() == 20
    for count in (0, 51):
        with pytest.raises(ValueError):
            event_page(df, count)
    with pytest.raises(ValueError, match="no event"):
        event_page(df, 5, after=999)


def payload(rows, layout, pretty, note_limit=None):
    """The response text, written out."""
    indent, separators = (2, (",", ": ")) if pretty else (None, (",", ":"))
    names = list(rows[0])
    inner = rows if layout == "events" else {"Columns": names, "Rows": [list(r.values()) for r in rows]}
    if note_limit is None:
        return json.dumps(inner, ensure_ascii=False, indent=indent, separators=separators)
    meta = {"truncated": True}
    if layout == "events":
        meta |= {"returned": len(rows), "truncation_message": EVENTS_NOTE.format(limit=note_limit), "events": rows}
    else:
        meta |= {"returnedRows": len(rows), "truncation_message": ROWSET_NOTE.format(limit=note_limit), **inner}
    return json.dumps(meta, ensure_ascii=False, indent=indent, separators=separators)


def halved(rows, layout, pretty, limit):
    """Halve step by step, as the specification has it."""
    if len(payload(rows, layout, pretty)) <= limit or len(rows) == 1:
        return rows, False
    while True:
        if len(rows) > 1:
            rows = rows[: math.ceil(len(rows) / 2)]
        if len(payload(rows, layout, pretty, limit)) <= limit or len(rows) == 1:
            return rows, True


@pytest.mark.parametrize("layout", ["events", "rowset"])
@pytest.mark.parametrize("pretty", [True, False])
@pytest.mark.parametrize("n, limit", [(1, 100), (3, 10000), (90, 2000), (400, 3000), (257, 20000), (2, 60)])
def test_budget(spark, layout, pretty, n, limit):
    rng = random.Random(n)
    rows = [
        {
            "event_id": i,
            "level": rng.choice(["Error", 'quo"te', "tab\t", None, "ø\u0001"]),
            "elapsed": rng.choice([1.0, 2.5, None, -3.25]),
            "ok": rng.choice([True, False, None]),
            "props": {"a": rng.randint(0, 1000), "tags": ["x"] * rng.randint(0, 3)},
        }
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "event_id bigint, level string, elapsed double, ok boolean, props struct<a:int,tags:array<string>>")
    plain = [{**r, "elapsed": int(r["elapsed"]) if r["elapsed"] == 1.0 else r["elapsed"]} for r in rows]
    kept, cut = halved(plain, layout, pretty, limit)
    found = budget(df, [F.asc("event_id")], limit, layout, pretty)
    assert [r["event_id"] for r in found.orderBy("event_id").collect()] == [r["event_id"] for r in kept]
    summary = budget_summary(found, limit, layout).first()
    assert (summary["truncated"], summary["returned"]) == (cut, len(kept))
    assert (summary["truncation_message"] is not None) == cut


def test_budget_of_nothing(spark):
    df, _ = events(spark, 1)
    empty = budget(df.limit(0), [F.desc("ts")])
    assert empty.count() == 0
    assert budget_summary(empty).first()["truncated"] is False
    assert CHARACTER_LIMIT == 25_000


def test_length_of_doubles(spark):
    from pyspark.sql import types as T

    from eventlens.functions.jsonsize import json_length

    cases = {
        0.00012: "0.00012", 12345678.5: "12345678.5", 1e21: "1e+21", 1.5e22: "1.5e+22", 123456789012345680000.0: "123456789012345680000",
        1e-6: "0.000001", 1.25e-7: "1.25e-7", -0.5: "-0.5", 0.0: "0", -3.0: "-3", 100.0: "100", 1e7: "10000000",
        float("inf"): "null", float("-inf"): "null", 1e-100: "1e-100",
    }
    df = spark.createDataFrame([(v,) for v in cases] + [(float("nan"),)], "v double")
    found = [(r["v"], r["n"]) for r in df.select("v", json_length(F.col("v"), T.DoubleType()).alias("n")).collect()]
    assert [n for _, n in found] == [len(cases.get(v, "null")) for v, _ in found]
