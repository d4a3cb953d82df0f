"""Redaction of text, nested values, numbers and results, and the audit report.

The tables of the driver hold e-mail addresses but no Norwegian numbers or
names, so those texts are derived from the orders: every order gives one text
whose form depends on its key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.functions.pii import (
    AMBIGUOUS_NAMES,
    CONTROL_1,
    CONTROL_2,
    EXEMPT_DOMAINS,
    EXEMPT_TLDS,
    FIRST_NAMES,
    MONTH_DAYS,
    SURNAMES,
    Redactor,
)
from eventlens.operators.redact import pii_audit as audit
from eventlens.operators.redact import redact, redact_json
from eventlens.plans.dataset import NOW, log_events, table, with_tables
from eventlens.plans.event_query import EventQuery
from eventlens.plans.registry import query

E = with_tables("log_events")
REDACTOR = Redactor()


# ------------------------------------------------- the same rules in the check
def sql_list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def hash_sql(token: str) -> str:
    return (
        f"lpad(CAST(list_reduce(list_transform(string_split(lower({token}), ''), lambda c: CAST(unicode(c) AS BIGINT)), "
        "lambda h, c: (h * 31 + c) % 4294967296, CAST(0 AS BIGINT)) % 10000 AS VARCHAR), 4, '0')"
    )


def mark_sql(kind: str, token: str) -> str:
    return f"('[{kind}_' || {hash_sql(token)} || ']')"


def splice_sql(text: str, pattern: str, kind: str, valid: Callable[[str], str]) -> str:
    return (
        f"array_to_string(list_transform(list_zip(string_split_regex({text}, '{pattern}'), regexp_extract_all({text}, '{pattern}')), "
        f"lambda z: z[1] || CASE WHEN z[2] IS NULL THEN '' WHEN {valid('z[2]')} THEN {mark_sql(kind, 'z[2]')} ELSE z[2] END), '')"
    )


def email_valid_sql(match: str) -> str:
    domain = f"lower(split_part({match}, '@', 2))"
    return (
        f"NOT list_contains({sql_list(EXEMPT_DOMAINS)}, {domain}) "
        f"AND NOT list_contains({sql_list(EXEMPT_TLDS)}, regexp_extract({domain}, '[a-z]+$'))"
    )


def identity_valid_sql(match: str) -> str:
    digits = f"regexp_replace({match}, '[^0-9]', '', 'g')"

    def d(i: int) -> str:
        return f"CAST(substr({digits}, {i + 1}, 1) AS INTEGER)"

    def control(weights) -> str:
        return "((11 - (" + " + ".join(f"{d(i)} * {w}" for i, w in enumerate(weights)) + ") % 11) % 11)"

    day = f"(({d(0)} * 10 + {d(1)}) - CASE WHEN {d(0)} * 10 + {d(1)} > 40 THEN 40 ELSE 0 END)"
    month = f"(({d(2)} * 10 + {d(3)}) - CASE WHEN {d(2)} * 10 + {d(3)} > 40 THEN 40 ELSE 0 END)"
    dated = f"({month} BETWEEN 1 AND 12 AND {day} BETWEEN 1 AND coalesce(list_extract({list(MONTH_DAYS)}, {month}), 0))"
    return f"(length({digits}) = 11 AND ({d(0)} >= 8 OR {dated}) AND {control(CONTROL_1)} = {d(9)} AND {control(CONTROL_2)} = {d(10)})"


def phone_valid_sql(match: str) -> str:
    return f"regexp_replace({match}, ' ', '', 'g') NOT LIKE '0047%'"


EMAIL_RE = r"\b[A-Za-z0-9_][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
IDENTITY_RE = r"\b[0-9]{6} ?[0-9]{5}\b"
LOCAL_PHONE_RE = r"\b[0-9]{2} [0-9]{2} [0-9]{2} [0-9]{2}\b|\b[0-9]{3} [0-9]{2} [0-9]{3}\b|\b[49][0-9]{7}\b"
NAME_RE = "[A-ZÆØÅ][a-zæøåäöéèü]+"
KNOWN = sql_list(sorted(set(FIRST_NAMES + SURNAMES)))
DOUBTFUL = sql_list(AMBIGUOUS_NAMES)


def redacted_sql(source: str, key: str) -> str:
    """All kinds masked in the column ``text`` of a table, one step after the other."""

    def next_to(gap: str, other: str) -> str:
        return f"coalesce({gap} IN (' ', '-') AND list_contains({KNOWN}, lower({other})), false)"

    masked = (
        f"list_contains({KNOWN}, lower(w)) AND (NOT list_contains({DOUBTFUL}, lower(w)) "
        f"OR (i > 1 AND {next_to('gaps[i]', 'words[i - 1]')}) OR {next_to('gaps[i + 1]', 'words[i + 1]')})"
    )
    return f"""a AS (SELECT {key}, {splice_sql('text', EMAIL_RE, 'EMAIL', email_valid_sql)} AS text FROM {source}),
    b AS (SELECT {key}, {splice_sql('text', IDENTITY_RE, 'FNR', identity_valid_sql)} AS text FROM a),
    c AS (SELECT {key}, {splice_sql('text', LOCAL_PHONE_RE, 'PHONE', phone_valid_sql)} AS text FROM b),
    cut AS (SELECT {key}, regexp_extract_all(text, '{NAME_RE}') AS words, string_split_regex(text, '{NAME_RE}') AS gaps FROM c),
    d AS (SELECT {key}, gaps[-1] AS tail, list_transform(words, lambda w, i: {{'gap': gaps[i], 'token': w, 'masked': {masked}}}) AS tokens FROM cut),
    redacted AS (SELECT {key}, array_to_string(list_transform(tokens, lambda t: t.gap || CASE WHEN t.masked
      THEN {mark_sql('NAME', 't.token')} ELSE t.token END), '') || tail AS text FROM d)"""


# -------------------------------------------------------------- stored texts
@query(f"SELECT doc_id, {splice_sql('text', EMAIL_RE, 'EMAIL', email_valid_sql)} AS text FROM documents")
def redact_email(spark, sf_dir):
    masked = REDACTOR.mask("EMAIL", F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", masked.alias("text"))


@query(f"WITH {redacted_sql('documents', 'doc_id')} SELECT doc_id, text FROM redacted")
def redact_documents(spark, sf_dir):
    return redact(table(spark, sf_dir, "documents").select("doc_id", "text"), exclude=["doc_id"])


@query(f"WITH {redacted_sql('conversations', 'conv_id, turn')} SELECT conv_id, turn, text FROM redacted")
def redact_conversations(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return redact(turns, exclude=["conv_id", "turn"])


def hits_sql(text: str, pattern: str, valid: Callable[[str], str]) -> str:
    return f"len(list_filter(regexp_extract_all({text}, '{pattern}'), lambda m: {valid('m')}))"


@query(
    f"""WITH {redacted_sql('documents', 'doc_id, source')}, hits AS (
      SELECT source, 'EMAIL' AS kind, {hits_sql('text', EMAIL_RE, email_valid_sql)} AS h FROM documents
      UNION ALL SELECT source, 'FNR', {hits_sql('text', IDENTITY_RE, identity_valid_sql)} FROM a
      UNION ALL SELECT source, 'PHONE', {hits_sql('text', LOCAL_PHONE_RE, phone_valid_sql)} FROM b
      UNION ALL SELECT source, 'NAME', len(list_filter(tokens, lambda t: t.masked)) FROM d)
    SELECT source, 'text' AS "column", kind, CAST(sum(h) AS BIGINT) AS found, count(*) FILTER (h > 0) AS rows_affected
    FROM hits GROUP BY source, kind"""
)
def pii_audit(spark, sf_dir):
    return audit(table(spark, sf_dir, "documents"), ["text"], ["source"])


# ------------------------------------------------------------- derived texts
IDENTITY_SQL = """ids AS (SELECT o_orderkey, sep, six, five FROM (SELECT o_orderkey, o_custkey,
      CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN ' ' ELSE '-' END AS sep,
      lpad(CAST((o_orderkey * 7919) % 100000 AS VARCHAR), 5, '0') AS five,
      CASE o_custkey % 4 WHEN 3 THEN '8' || lpad(CAST((o_orderkey * 31) % 100000 AS VARCHAR), 5, '0')
        ELSE lpad(CAST(day(o_orderdate) + CASE WHEN o_custkey % 4 = 1 THEN 40 ELSE 0 END AS VARCHAR), 2, '0')
          || lpad(CAST(month(o_orderdate) + CASE WHEN o_custkey % 4 = 2 THEN 40 ELSE 0 END AS VARCHAR), 2, '0')
          || lpad(CAST(year(o_orderdate) % 100 AS VARCHAR), 2, '0') END AS six FROM orders))"""


def identity_candidates(spark, sf_dir) -> DataFrame:
    """Eleven digits per order: ordinary, D-, H- and FH-numbers, about one in a hundred valid."""

    def two(number: Column) -> Column:
        return F.lpad(number.cast("string"), 2, "0")

    key, group = F.col("o_orderkey"), F.col("o_custkey") % 4
    dated = F.concat(
        two(F.dayofmonth("o_orderdate") + F.when(group == 1, 40).otherwise(0)),
        two(F.month("o_orderdate") + F.when(group == 2, 40).otherwise(0)),
        two(F.year("o_orderdate") % 100),
    )
    free = F.concat(F.lit("8"), F.lpad(((key * 31) % 100000).cast("string"), 5, "0"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 3 == 0, "").when(key % 3 == 1, " ").otherwise("-").alias("sep"),
        F.when(group == 3, free).otherwise(dated).alias("six"),
        F.lpad(((key * 7919) % 100000).cast("string"), 5, "0").alias("five"),
    )


@query(
    f"""WITH {IDENTITY_SQL} SELECT o_orderkey, 'record ' || CASE WHEN sep <> '-' AND {identity_valid_sql('six || five')}
      THEN {mark_sql('FNR', 'six || sep || five')} ELSE six || sep || five END || ' closed' AS text FROM ids"""
)
def redact_identity_numbers(spark, sf_dir):
    text = F.concat(F.lit("record "), F.col("six"), F.col("sep"), F.col("five"), F.lit(" closed"))
    ids = identity_candidates(spark, sf_dir)
    return ids.select("o_orderkey", REDACTOR.mask("FNR", text).alias("text"))


@query(
    f"""WITH {IDENTITY_SQL} SELECT o_orderkey, CASE WHEN {identity_valid_sql('six || five')} THEN {mark_sql('FNR', 'six || five')}
      ELSE CAST(CAST(six || five AS BIGINT) AS VARCHAR) END AS national_id FROM ids"""
)
def redact_numbers(spark, sf_dir):
    """Identity numbers held as integers, where a leading zero is lost."""
    ids = identity_candidates(spark, sf_dir)
    numbers = ids.select("o_orderkey", F.concat("six", "five").cast("bigint").alias("national_id"))
    return redact(numbers, numeric=["national_id"])


def phone_forms(digits: str, group: Callable[[int, int], str]) -> list[str]:
    """SQL of the ways a number is written; ``group`` cuts digits out."""
    pairs = " || ' ' || ".join(group(i, 2) for i in (1, 3, 5, 7))
    triple = " || ' ' || ".join([group(1, 3), group(4, 2), group(6, 3)])
    return [
        f"'+47 ' || {pairs}",
        f"'0047' || {digits}",
        pairs,
        triple,
        digits,
        f"'+47 ' || {digits} || '90'",
        f"{pairs} || ' 90'",
        f"'x' || {digits}",
        f"'ø' || {digits}",
    ]


FORMS = phone_forms("s", lambda start, length: f"substr(s, {start}, {length})")
PHONE_NUMBER = "lpad(CAST((o_orderkey * 7919 + 40000000) % 100000000 AS {text}), 8, '0')"


def phone_check() -> str:
    mobile, local = "substr(s, 1, 1) IN ('4', '9')", "s NOT LIKE '0047%'"

    def marked(form: str, when: str) -> str:
        return f"CASE WHEN {when} THEN {mark_sql('PHONE', form)} ELSE {form} END"

    expected = [
        marked(FORMS[0], "true"),
        marked(FORMS[1], "true"),
        marked(FORMS[2], local),
        marked(FORMS[3], local),
        marked(FORMS[4], mobile),
        FORMS[5],
        marked(FORMS[2], local) + " || ' 90'",
        FORMS[7],
        "'ø' || " + marked("s", mobile),
    ]
    cases = " ".join(f"WHEN {i} THEN {e}" for i, e in enumerate(expected))
    return f"""SELECT o_orderkey, 'caller ' || CASE o_orderkey % 9 {cases} END || ' hung up' AS text
      FROM (SELECT o_orderkey, {PHONE_NUMBER.format(text='VARCHAR')} AS s FROM orders)"""


@query(phone_check())
def redact_phones(spark, sf_dir):
    cases = " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(FORMS))
    orders = table(spark, sf_dir, "orders").withColumn("s", F.expr(PHONE_NUMBER.format(text="STRING")))
    text = F.expr(f"'caller ' || CASE o_orderkey % 9 {cases} END || ' hung up'")
    return orders.select("o_orderkey", REDACTOR.mask("PHONE", text).alias("text"))


NAMES_SQL = f"""names AS (SELECT o_orderkey, upper(f[1]) || substr(f, 2) AS f, upper(l[1]) || substr(l, 2) AS l
    FROM (SELECT o_orderkey, {sql_list(FIRST_NAMES)}[o_orderkey % {len(FIRST_NAMES)} + 1] AS f,
      {sql_list(SURNAMES)}[o_orderkey % {len(SURNAMES)} + 1] AS l FROM orders))"""


def named(spark, sf_dir) -> DataFrame:
    """A first name and a surname of the dictionary per order."""

    def word(words: list[str]) -> Column:
        found = F.get(F.array(*[F.lit(w) for w in words]), (F.col("o_orderkey") % len(words)).cast("int"))
        return F.initcap(found)

    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", word(FIRST_NAMES).alias("f"), word(SURNAMES).alias("l"))


def name_check() -> str:
    f, l = mark_sql("NAME", "f"), mark_sql("NAME", "l")

    def alone(token: str, mark: str) -> str:
        return f"CASE WHEN list_contains({DOUBTFUL}, lower({token})) THEN {token} ELSE {mark} END"

    fa, la = alone("f", f), alone("l", l)
    return f"""WITH {NAMES_SQL} SELECT o_orderkey, CASE o_orderkey % 6
      WHEN 0 THEN 'owner ' || {f} || ' ' || {l} || ' logged in' WHEN 1 THEN 'owner ' || lower(f) || ' ' || upper(l)
      WHEN 2 THEN 'mail ' || {fa} || ' sendt' WHEN 3 THEN {f} || '-' || {l}
      WHEN 4 THEN {fa} || ';' || {la} ELSE {fa} || '  ' || {la} END AS text FROM names"""


@query(name_check())
def redact_names(spark, sf_dir):
    text = F.expr(
        """CASE o_orderkey % 6 WHEN 0 THEN 'owner ' || f || ' ' || l || ' logged in' WHEN 1 THEN 'owner ' || lower(f) || ' ' || upper(l)
        WHEN 2 THEN 'mail ' || f || ' sendt' WHEN 3 THEN f || '-' || l WHEN 4 THEN f || ';' || l ELSE f || '  ' || l END"""
    )
    return named(spark, sf_dir).select("o_orderkey", REDACTOR.mask("NAME", text).alias("text"))


# ----------------------------------------------------- nested values, results
MAIL_SQL = "'user' || user_id || '@mail' || (k % 3) || '.example.com'"
NESTED_SQL = f"""SELECT event_id, '{{"Id":"event-9' || lpad(CAST(event_id AS VARCHAR), 7, '0') || '","Level":"' || level
      || '","RenderedMessage":"sent to ' || {mark_sql('EMAIL', MAIL_SQL)} || '","Properties":{{"StatusCode":' || status_code
      || ',"Notes":["' || {mark_sql('EMAIL', MAIL_SQL)} || '","seen by ' || {mark_sql('NAME', "'kari'")} || ' twice"]}}}}' AS payload
    FROM log_events"""


def mail() -> Column:
    return F.concat(
        F.lit("user"), F.col("user_id").cast("string"), F.lit("@mail"), (F.col("k") % 3).cast("string"), F.lit(".example.com")
    )


@query(f"{E} {NESTED_SQL}")
def redact_nested(spark, sf_dir):
    """Strings at any depth; ids, numbers and structure stay."""
    payload = F.struct(
        F.concat(F.lit("event-9"), F.lpad(F.col("event_id").cast("string"), 7, "0")).alias("Id"),
        F.col("level").alias("Level"),
        F.concat(F.lit("sent to "), mail()).alias("RenderedMessage"),
        F.struct(
            F.col("status_code").alias("StatusCode"), F.array(mail(), F.lit("seen by Kari twice")).alias("Notes")
        ).alias("Properties"),
    )
    nested = log_events(spark, sf_dir).select("event_id", payload.alias("payload"))
    masked = redact(nested, exclude=["event_id", "payload.Id"])
    return masked.select("event_id", F.to_json("payload").alias("payload"))


@query(
    f"""{E} SELECT event_id, '{{"k":' || k || ',"mail":"' || {mark_sql('EMAIL', MAIL_SQL)} || '"}}' AS props FROM log_events"""
)
def redact_json_text(spark, sf_dir):
    """JSON text: values are masked, keys and ordinary numbers are left alone."""
    text = F.to_json(F.struct(F.col("k").cast("bigint").alias("k"), mail().alias("mail")))
    return log_events(spark, sf_dir).select("event_id", redact_json(text).alias("props"))


@query(f"{E} SELECT {mark_sql('EMAIL', 'mail')} AS mail, n FROM (SELECT {MAIL_SQL} AS mail, count(*) AS n FROM log_events GROUP BY 1)")
def redact_rowset(spark, sf_dir):
    """An aggregate result; keys with equal placeholders stay separate rows."""
    chain = EventQuery.on(log_events(spark, sf_dir).withColumn("mail", mail()), NOW).group("mail")
    return chain.agg(F.count("*").alias("n")).result()


@query("SELECT doc_id, text FROM documents")
def redact_switched_off(spark, sf_dir):
    """A redactor that is switched off changes nothing."""
    return redact(table(spark, sf_dir, "documents").select("doc_id", "text"), Redactor(enabled=False))


VALID_SQL = identity_valid_sql("six || five")
MARKED_SQL = f"CASE WHEN {VALID_SQL} THEN {mark_sql('FNR', 'six || five')}"


@query(
    f"""WITH {IDENTITY_SQL} SELECT o_orderkey, {MARKED_SQL} ELSE CAST(CAST(six || five AS BIGINT) AS VARCHAR) END AS held,
      {MARKED_SQL} ELSE CAST(CAST(six || five AS BIGINT) AS VARCHAR) END AS inner_id,
      {MARKED_SQL} ELSE CAST(CAST(six || five AS BIGINT) AS VARCHAR) END AS exact_id,
      200 AS status, CAST(o_orderkey % 7 AS BIGINT) AS n FROM ids"""
)
def redact_numbers_at_any_depth(spark, sf_dir):
    """Numbers of a table, a struct in an array, and a decimal, without any of them being named."""
    number = F.concat("six", "five").cast("bigint")
    held = identity_candidates(spark, sf_dir).select(
        "o_orderkey",
        number.alias("held"),
        F.array(F.struct(F.struct(number.alias("id"), F.lit(200).alias("status")).alias("in"))).alias("nested"),
        number.cast("decimal(20,2)").alias("exact_id"),
        (F.col("o_orderkey") % 7).alias("n"),
    )
    masked = redact(held, exclude=["o_orderkey"], measures=["n"])
    inner = F.get("nested", F.lit(0))["in"]
    return masked.select("o_orderkey", "held", inner["id"].alias("inner_id"), "exact_id", inner["status"].alias("status"), "n")


def json_number_sql(plain: str) -> str:
    return f"CASE WHEN {VALID_SQL} THEN '\"' || {mark_sql('FNR', 'six || five')} || '\"' ELSE CAST(CAST(six || five AS BIGINT) AS VARCHAR) || '{plain}' END"


def identity_json(spark, sf_dir) -> DataFrame:
    number = F.concat("six", "five").cast("bigint").cast("string")
    text = F.concat(F.lit('{"a":'), number, F.lit('.0,"b":['), number, F.lit(",1.5,true]}"))
    return identity_candidates(spark, sf_dir).select("o_orderkey", text.alias("props"))


@query(
    f"""WITH {IDENTITY_SQL} SELECT o_orderkey,
      '{{"a":' || {json_number_sql('.0')} || ',"b":[' || {json_number_sql('')} || ',1.5,true]}}' AS props FROM ids"""
)
def redact_json_numbers(spark, sf_dir):
    """Identity numbers in JSON text, written as whole numbers with and without a fraction."""
    return redact(identity_json(spark, sf_dir), exclude=["o_orderkey"])


@query(
    f"""{E} SELECT event_id, '{{"k":' || k || ',"mail":"' || {mark_sql('EMAIL', MAIL_SQL)} || '"}}' AS props,
      '{{"k":' || k || ',"mail":"' || {mark_sql('EMAIL', MAIL_SQL)} || '"}}' AS bag FROM log_events"""
)
def redact_properties(spark, sf_dir):
    """Free-form properties of the events, as JSON text and as a VARIANT."""
    rows = log_events(spark, sf_dir).withColumn("mail", F.concat(F.lit(',"mail":"'), mail(), F.lit('"}')))
    props = F.regexp_replace(F.replace("props", F.lit(" ")), r"\}$", F.col("mail"))
    bags = rows.select("event_id", props.alias("props"), F.parse_json(props).alias("bag"))
    return redact(bags).withColumn("bag", F.to_json("bag"))
