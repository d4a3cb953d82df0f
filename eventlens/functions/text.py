"""Text expressions: templates, URL masking, error summaries, access levels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MASK = "<redacted>"

# Severity ranks; anything unknown ranks as info.
LEVEL_RANKS = {"debug": 10, "info": 20, "warn": 30, "error": 40, "silent": 100}


def template_text(tokens: Column) -> Column:
    """Message template with its holes shown as ``{Name}``; NULL gives ``''``."""
    shown = F.transform(
        tokens,
        lambda t: F.coalesce(t["text"], F.concat(F.lit("{"), t["property_name"], F.lit("}")), F.lit("")),
    )
    return F.coalesce(F.array_join(shown, ""), F.lit(""))


def render_message(tokens: Column, props: Column) -> Column:
    """Message template with its holes filled from the map ``props``."""
    shown = F.transform(
        tokens,
        lambda t: F.coalesce(
            t["text"],
            F.try_element_at(props, t["property_name"]),
            F.concat(F.lit("{"), t["property_name"], F.lit("}")),
            F.lit(""),
        ),
    )
    return F.coalesce(F.array_join(shown, ""), F.lit(""))


def mask_url_query(url: Column) -> Column:
    """Keep path and parameter names, mask every parameter value."""
    at = F.instr(url, "?")
    base = F.substring_index(url, "?", 1)
    pairs = F.filter(F.split(F.substr(url, at + 1), "&", -1), lambda p: p != "")
    masked = F.array_join(
        F.transform(
            pairs,
            lambda p: F.when(
                F.instr(p, "=") > 0, F.concat(F.substring_index(p, "=", 1), F.lit("=" + MASK))
            ).otherwise(p),
        ),
        "&",
    )
    return (
        F.when(at == 0, url)
        .when(F.size(pairs) == 0, base)
        .otherwise(F.concat(base, F.lit("?"), masked))
    )


def safe_error(status: Column, message: Column) -> Column:
    """The message, unless the error carries an HTTP status: then a fixed summary."""
    summary = F.concat(F.lit("request failed (HTTP "), status.cast("string"), F.lit(")"))
    return F.when(status.isNotNull(), summary).otherwise(message)


def error_code(message: Column, pattern: str = r"AADSTS\d+") -> Column:
    """First machine-readable code in a message, else NULL."""
    return F.nullif(F.regexp_extract(message, pattern, 0), F.lit(""))


def error_record(name: Column, status: Column, message: Column) -> Column:
    """What may be logged of an error: its name, its HTTP status, and the message only where there is no status."""
    return F.struct(
        name.alias("error_name"), status.cast("int").alias("status"), safe_error(status, message).alias("error")
    )


def code_record(name: Column, code: Column, message: Column, pattern: str = r"AADSTS\d+") -> Column:
    """Machine-readable parts of a failed sign-in: name, short code and the code in the message, never the message."""
    return F.struct(
        F.nullif(name, F.lit("")).alias("error_name"),
        F.nullif(code, F.lit("")).alias("error_code"),
        error_code(message, pattern).alias("message_code"),
    )


def access_level(status: Column) -> Column:
    return F.when(status >= 500, "error").when(status >= 400, "warn").otherwise("info")


def lenient_long(text: Column) -> Column:
    """A number held as text; anything else is NULL."""
    return text.try_cast("bigint")


def level_name(level: Column) -> Column:
    """Normalise a level to one of the known names; unknown or empty is ``info``."""
    name = F.lower(F.trim(level))
    return F.when(name.isin(*LEVEL_RANKS), name).otherwise("info")


def level_rank(level: Column) -> Column:
    name = F.lower(F.trim(level))
    rank = F.lit(LEVEL_RANKS["info"])
    for known, value in LEVEL_RANKS.items():
        rank = F.when(name == known, value).otherwise(rank)
    return rank


def log_line(ts: Column, name: str, level: Column, message: Column, fields: Column | None = None) -> Column:
    """``<ts> [name] LEVEL message {json}``; the JSON only when it has a field."""
    parts = [
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
        F.lit(f"[{name}]"),
        F.rpad(F.upper(level), 5, " "),
        message,
    ]
    if fields is not None:
        encoded = F.to_json(fields, {"ignoreNullFields": "false"})
        parts.append(F.when(encoded != "{}", encoded))
    return F.concat_ws(" ", *parts)
