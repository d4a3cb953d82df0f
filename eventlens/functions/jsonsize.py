"""Length of a value as JSON text, computed from its type without building the text."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

INDENT = 2


def _string(value: Column) -> Column:
    units = F.octet_length(F.encode(value, "UTF-16BE")) / 2
    short = F.length(F.regexp_replace(value, r'[^"\\\x08\x0C\n\r\t]', ""))
    long = F.length(F.regexp_replace(value, r"[^\x00-\x07\x0B\x0E-\x1F]", ""))
    return units + short + long * 5 + 2


def _number(value: Column) -> Column:
    """Shortest decimal form: plain from 1e-6 up to 1e21, else with an exponent; not finite is ``null``."""
    text = F.abs(value).cast("string")
    mantissa, power = F.substring_index(text, "E", 1), F.regexp_extract(text, "E(.*)", 1).try_cast("int")
    whole = F.substring_index(mantissa, ".", 1)
    digits = F.concat(whole, F.substring_index(mantissa, ".", -1))
    significant = F.ltrim(digits, F.lit("0"))
    # 0.DDD times 10 to the power of ``point``, with ``count`` digits.
    point = F.length(whole) + F.coalesce(power, F.lit(0)) - (F.length(digits) - F.length(significant))
    count = F.length(F.rtrim(significant, F.lit("0")))
    exponent = count + F.when(count > 1, 1).otherwise(0) + 2 + F.length(F.abs(point - 1).cast("string"))
    size = (
        F.when((point > 21) | (point < -5), exponent)
        .when(point >= count, point)
        .when(point > 0, count + 1)
        .otherwise(count + 2 - point)
    )
    sign = F.when(value < 0, 1).otherwise(0)
    infinite = F.abs(value) == float("inf")
    return F.when(F.isnan(value) | infinite, F.lit(4)).when(value == 0, F.lit(1)).otherwise(sign + size)


def _framed(total: Column, count: Column, pretty: bool, depth: int) -> Column:
    """Brackets, commas and line breaks around ``count`` members of length ``total``."""
    size = total + count + 1
    if pretty:
        size = size + count * (1 + INDENT * (depth + 1)) + 1 + INDENT * depth
    return F.when(count == 0, F.lit(2)).otherwise(size)


def _sum(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0).cast("bigint"), lambda a, b: a + b)


def json_length(value: Column, dtype: T.DataType, pretty: bool = True, depth: int = 0) -> Column:
    """Characters of ``value`` as JSON; ``depth`` is its nesting level in the payload."""
    colon = 2 if pretty else 1
    if isinstance(dtype, T.StringType):
        size = _string(value)
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        size = F.lit(len('"2024-01-15T10:00:00.000Z"'))
    elif isinstance(dtype, T.DateType):
        size = F.lit(len('"2024-01-15"'))
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        size = _number(value)
    elif isinstance(dtype, T.ArrayType):
        items = F.transform(value, lambda x: json_length(x, dtype.elementType, pretty, depth + 1))
        size = _framed(_sum(items), F.size(value), pretty, depth)
    elif isinstance(dtype, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: _string(e["key"]).cast("bigint")
            + colon
            + json_length(e["value"], dtype.valueType, pretty, depth + 1),
        )
        size = _framed(_sum(entries), F.size(value), pretty, depth)
    elif isinstance(dtype, T.StructType):
        total = F.lit(0).cast("bigint")
        for f in dtype.fields:
            total = total + len(json.dumps(f.name, ensure_ascii=False)) + colon
            total = total + json_length(value[f.name], f.dataType, pretty, depth + 1)
        size = _framed(total, F.lit(len(dtype.fields)), pretty, depth)
    else:
        size = F.length(value.cast("string"))
    return F.coalesce(size, F.lit(len("null"))).cast("bigint")


def cells_length(columns: list[Column], types: list[T.DataType], pretty: bool, depth: int) -> Column:
    """Length of one rowset row: its values as a JSON array."""
    total = F.lit(0).cast("bigint")
    for column, dtype in zip(columns, types):
        total = total + json_length(column, dtype, pretty, depth + 1)
    return _framed(total, F.lit(len(columns)), pretty, depth)
