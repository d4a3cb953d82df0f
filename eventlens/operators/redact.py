"""Redaction of whole DataFrames, nested values, and the audit report."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlens.functions.pii import Redactor


def has_text(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return has_text(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return has_text(dtype.valueType)
    if isinstance(dtype, T.VariantType):
        return True
    if isinstance(dtype, T.StructType):
        return any(has_text(f.dataType) for f in dtype.fields)
    return isinstance(dtype, T.StringType)


# Well-known measures of events, which stay numbers.
MEASURES = ("elapsed", "status_code")


def holds_identity(dtype: T.DataType) -> bool:
    """Whether a number of this type can have the eleven digits of any identity number."""
    if isinstance(dtype, T.DecimalType):
        return dtype.precision - dtype.scale >= 11
    return isinstance(dtype, (T.LongType, T.DoubleType))


def _leaves(dtype: T.DataType, path: str) -> list[tuple[str, T.DataType]]:
    if isinstance(dtype, T.ArrayType):
        return _leaves(dtype.elementType, path)
    if isinstance(dtype, T.MapType):
        return _leaves(dtype.valueType, path)
    if isinstance(dtype, T.StructType):
        return [leaf for f in dtype.fields for leaf in _leaves(f.dataType, f"{path}.{f.name}")]
    return [(path, dtype)]


def numeric_paths(
    schema: T.StructType, numeric: Collection[str] | None, measures: Collection[str], exclude: Collection[str]
) -> list[str]:
    """Paths of the number leaves that are rewritten to text: the named ones, or all that can hold an identity number."""
    if numeric is not None:
        return list(numeric)
    kept = (*measures, *exclude)
    leaves = [leaf for f in schema.fields for leaf in _leaves(f.dataType, f.name)]
    return [
        path
        for path, dtype in leaves
        if holds_identity(dtype) and not any(path == k or path.startswith(k + ".") for k in kept)
    ]


def redact_value(
    value: Column,
    dtype: T.DataType,
    redactor: Redactor,
    numeric: Collection[str] = (),
    exclude: Collection[str] = (),
    path: str = "",
    json: Collection[str] = (),
) -> Column:
    """Mask every text leaf of ``value``; keys, structure and other leaves stay.

    ``numeric``, ``exclude`` and ``json`` (JSON text) hold dotted paths; elements of arrays and maps
    share the path of their container.
    """
    if path in exclude:
        return value
    if path in numeric and isinstance(dtype, (T.IntegralType, T.DecimalType, T.FloatType, T.DoubleType)):
        if isinstance(dtype, T.IntegralType):
            return redactor.number(value)
        # A fraction is no identity number and stays as Spark writes it; a whole number is written without one.
        whole = F.when(value == F.floor(value), value.try_cast("bigint"))
        return F.coalesce(redactor.number(whole), value.cast("string"))
    inside = any(p == path or p.startswith(path + ".") for p in numeric)
    if not redactor.enabled or not (has_text(dtype) or inside):
        return value
    if isinstance(dtype, T.StringType):
        return redact_json(value, redactor) if path in json else redactor.text(value)
    if isinstance(dtype, T.VariantType):
        return F.parse_json(redact_json(F.to_json(value), redactor))
    if isinstance(dtype, T.ArrayType):
        return F.transform(
            value, lambda x: redact_value(x, dtype.elementType, redactor, numeric, exclude, path, json)
        )
    if isinstance(dtype, T.MapType):
        return F.transform_values(
            value, lambda _, v: redact_value(v, dtype.valueType, redactor, numeric, exclude, path, json)
        )
    fields = [
        redact_value(value[f.name], f.dataType, redactor, numeric, exclude, f"{path}.{f.name}", json).alias(f.name)
        for f in dtype.fields
    ]
    return F.when(value.isNotNull(), F.struct(*fields))


def redact(
    df: DataFrame,
    redactor: Redactor = Redactor(),
    exclude: Collection[str] = ("event_id",),
    numeric: Collection[str] | None = None,
    json: Collection[str] = ("props",),
    measures: Collection[str] = MEASURES,
) -> DataFrame:
    """Mask personal data in every column, at any depth.

    Apply it last, after filters, aggregates and limits: rows that are grouped
    by a raw value stay apart even where their placeholders coincide.  Key
    columns are excluded, so that page cursors keep working.  Numbers that can
    hold an identity number become text, at any depth, so that one can be masked;
    ``measures`` (counts, durations) stay numbers.  ``numeric`` names the leaves
    to rewrite instead; with ``()`` no number changes.  ``json`` lists the
    columns of JSON text, whose keys and layout stay.  A redactor that is switched
    off leaves everything as it is.  Stateless, so it runs on streams too.
    """
    if not redactor.enabled:
        return df if numeric is None else _redacted(df, redactor, exclude, numeric, json)
    rewritten = numeric_paths(df.schema, numeric if "FNR" in redactor.kinds else numeric or (), measures, exclude)
    return _redacted(df, redactor, exclude, rewritten, json)


def _redacted(
    df: DataFrame, redactor: Redactor, exclude: Collection[str], numeric: Collection[str], json: Collection[str]
) -> DataFrame:
    return df.select(
        *[
            redact_value(F.col(f"`{f.name}`"), f.dataType, redactor, numeric, exclude, f.name, json).alias(f.name)
            for f in df.schema.fields
        ]
    )


# A string with its colon if it is a key, a number, or what lies between.
JSON_TOKEN = r'"[^"]*+"(?:\s*+:)?|-?\d[\d.eE+-]*+|[^"\d-]++|["-]'
# Stand for an escaped backslash and an escaped quote; JSON text has neither as it is.
BACKSLASH, QUOTE = "\x01", "\x02"


def redact_json(text: Column, redactor: Redactor = Redactor()) -> Column:
    """Mask the values of JSON text of any shape.

    Text values are masked after their escapes are resolved; whole numbers that
    are identity numbers become text.  Everything else, keys and layout included,
    stays as it is.  Text that is not JSON is masked as text.
    """
    if not redactor.enabled:
        return text

    def value(token: Column) -> Column:
        plain = F.replace(F.replace(token, F.lit(QUOTE), F.lit('\\"')), F.lit(BACKSLASH), F.lit("\\\\"))
        decoded = F.get(F.from_json(F.concat(F.lit("["), plain, F.lit("]")), "array<string>"), F.lit(0))
        masked = redactor.text(decoded)
        encoded = F.to_json(F.array(masked))
        text_value = F.when(masked == decoded, plain).otherwise(F.substr(encoded, F.lit(2), F.length(encoded) - 2))
        # 5.0 and 5e10 are whole numbers too.
        exact = F.when(token.rlike("[.eE]"), token.try_cast("double")).cast("double")
        whole = F.when(exact.between(-1e11, 1e11) & (exact == F.floor(exact)), exact.try_cast("bigint"))
        number = F.concat(F.lit('"'), redactor.number(F.coalesce(whole, token.try_cast("bigint"))), F.lit('"'))
        is_text = token.startswith('"') & token.endswith('"') & (F.length(token) > 1)
        return (
            F.when(is_text, F.coalesce(text_value, plain))
            .when(token.rlike("^-?[0-9][0-9.eE+-]{9}") & number.startswith('"['), number)
            .otherwise(plain)
        )

    marked = F.replace(F.replace(text, F.lit("\\\\"), F.lit(BACKSLASH)), F.lit('\\"'), F.lit(QUOTE))
    tokens = F.regexp_extract_all(marked, F.lit(JSON_TOKEN), F.lit(0))
    masked = F.array_join(F.transform(tokens, value), "")
    return F.when(F.try_parse_json(text).isNull(), redactor.text(text)).otherwise(masked)


def pii_audit(
    df: DataFrame,
    columns: Collection[str],
    by: Collection[str] = (),
    redactor: Redactor = Redactor(),
) -> DataFrame:
    """Values found and rows affected, per text column and kind.

    One pass: each kind is counted on the text that the earlier kinds left over.
    """
    found = df.select(*by, *[redactor.findings(F.col(c)).alias(f"_{c}") for c in columns])
    measures = [(c, kind, f"_{c}_{kind}") for c in columns for kind in redactor.kinds]
    counted = found.select(
        *by, *[F.get(f"_{c}", F.lit(i)).alias(f"_{c}_{kind}") for c in columns for i, kind in enumerate(redactor.kinds)]
    )
    sums = [m for _, _, n in measures for m in (F.sum(n).alias(n), F.count_if(F.col(n) > 0).alias(n + "_rows"))]
    totals = counted.groupBy(*by).agg(*sums)
    rows = F.array(
        *[
            F.struct(
                F.lit(column).alias("column"),
                F.lit(kind).alias("kind"),
                F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias("found"),
                F.col(n + "_rows").alias("rows_affected"),
            )
            for column, kind, n in measures
        ]
    )
    return totals.select(*by, F.inline(rows))
