"""Range policies with a fixed clock."""

from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import given
from hypothesis import strategies as st

from eventlens.functions.timerange import RANGES, align_down, events_window, instant, query_window, slice_length

NOW = "2026-06-24T12:00:00Z"


def utc(*parts):
    return datetime(*parts, tzinfo=timezone.utc)


@pytest.mark.parametrize(
    "args, start, end",
    [
        ({"range": "1h"}, utc(2026, 6, 24, 11), utc(2026, 6, 24, 12)),
        (
            {"range": "15m", "from_date_utc": "2020-01-01T00:00:00Z", "to_date_utc": "2020-01-02T00:00:00Z"},
            utc(2026, 6, 24, 11, 45),
            utc(2026, 6, 24, 12),
        ),
        (
            {"from_date_utc": "2026-06-01T00:00:00Z", "to_date_utc": "2026-06-02T00:00:00Z"},
            utc(2026, 6, 1),
            utc(2026, 6, 2),
        ),
        ({"from_date_utc": "2026-06-23T00:00:00Z"}, utc(2026, 6, 23), utc(2026, 6, 24, 12)),
        ({"to_date_utc": "2026-06-24T06:00:00Z"}, utc(2026, 6, 23, 6), utc(2026, 6, 24, 6)),
        ({"to_date_utc": "2026-06-20T00:00:00Z"}, utc(2026, 6, 19), utc(2026, 6, 20)),
        ({}, utc(2026, 6, 23, 12), utc(2026, 6, 24, 12)),
        (
            {"from_date_utc": "2026-06-24T14:00:00+02:00", "to_date_utc": "2026-06-24T12:00:00Z"},
            utc(2026, 6, 24, 12),
            utc(2026, 6, 24, 12),
        ),
    ],
)
def test_query_policy(args, start, end):
    window = query_window(NOW, **args)
    assert (window.start, window.end) == (start, end)


@pytest.mark.parametrize(
    "args, named",
    [
        ({"from_date_utc": "2026-06-24T00:00:00Z", "to_date_utc": "2026-06-23T00:00:00Z"}, "toDateUtc"),
        ({"from_date_utc": "2026-06-25T00:00:00Z"}, "the current time"),
    ],
)
def test_inverted_ranges_name_their_bound(args, named):
    with pytest.raises(ValueError, match=named):
        query_window(NOW, **args)


def test_every_range_ends_now():
    lengths = "1m 15m 30m 1h 2h 6h 12h 1d 7d 14d 30d".split()
    assert list(RANGES) == lengths
    for token in lengths:
        assert query_window(NOW, token).end - query_window(NOW, token).start == RANGES[token]
    with pytest.raises(ValueError):
        query_window(NOW, "4h")


def test_events_policy_keeps_open_sides():
    assert events_window(NOW).start == utc(2026, 6, 24, 11)
    assert events_window(NOW, from_date_utc="2026-06-01T00:00:00Z").end is None
    assert events_window(NOW, to_date_utc="2026-06-01T00:00:00Z").start is None
    inverted = events_window(NOW, None, "2026-06-02T00:00:00Z", "2026-06-01T00:00:00Z")
    assert inverted.start > inverted.end


def test_times_need_an_offset():
    with pytest.raises(ValueError):
        instant("2026-06-24T12:00:00")


@pytest.mark.parametrize("token", ["0m", "5", "m5", "5w", "-5m", "1.5h"])
def test_bad_slices(token):
    with pytest.raises(ValueError):
        slice_length(token)


@given(st.datetimes(datetime(2000, 1, 1), datetime(2040, 1, 1)), st.integers(1, 500), st.sampled_from(["d", "h", "m", "s", "ms"]))
def test_alignment(at, n, unit):
    length = slice_length(f"{n}{unit}")
    start = align_down(at.replace(tzinfo=timezone.utc), length)
    assert timedelta(0) <= at.replace(tzinfo=timezone.utc) - start < length
