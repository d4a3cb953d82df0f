"""Redaction: examples, properties, and a plain re-implementation as yardstick."""

import random
import re

import pytest
from pyspark.sql import functions as F

from eventlens.functions.pii import AMBIGUOUS_NAMES, FIRST_NAMES, SURNAMES, Redactor
from eventlens.functions.splice import MARK, SEPARATOR
from eventlens.operators.alerts import alert_state
from eventlens.operators.filters import find_signals, signal_listing
from eventlens.operators.redact import pii_audit, redact, redact_json
from eventlens.plans.event_query import EventQuery

R = Redactor()


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "i int, t string")


def redacted(spark, values, redactor=R):
    rows = texts(spark, values).select("i", redactor.text(F.col("t")).alias("t")).orderBy("i").collect()
    return [r["t"] for r in rows]


# Synthetic identity numbers (ordinary, written with a blank, H- and FH-number), one that has
# lost its leading zero, and a number of eleven digits that is none.
ORDINARY, SPACED, H_NUMBER, FH_NUMBER = "13116900216", "131169 00216", "13114690281", "81234567055"
SHORTENED, NO_IDENTITY = 5069010042, "17000000000"

MASKED = [
    (f"record {ORDINARY} closed", "record [FNR_#] closed"),
    (f"id={SPACED}, retry", "id=[FNR_#], retry"),
    (f"temporary number {H_NUMBER} assigned", "temporary number [FNR_#] assigned"),
    (f"shared number {FH_NUMBER} assigned", "shared number [FNR_#] assigned"),
    (f"ø{ORDINARY}", "ø[FNR_#]"),
    (SPACED, "[FNR_#]"),
    ("meeting with Marit Hansen moved", "meeting with [NAME_#] [NAME_#] moved"),
    ("signed by Liv Dahl-Lunde", "signed by [NAME_#] [NAME_#]-[NAME_#]"),
    ("Tom Strand logged in", "[NAME_#] [NAME_#] logged in"),
    ("JanKowalski", "[NAME_#]Kowalski"),
    (
        f"owner Eva Moen; id {ORDINARY}; mail eva@firma.no; phone +47 41 23 45 67",
        "owner [NAME_#] [NAME_#]; id [FNR_#]; mail [EMAIL_#]; phone [PHONE_#]",
    ),
    ("first Rune Olsen\nsecond rune@firma.no", "first [NAME_#] [NAME_#]\nsecond [EMAIL_#]"),
    ("write to eva.moen@firma.no before noon", "write to [EMAIL_#] before noon"),
    ("caller +47 22 11 00 99 hung up", "caller [PHONE_#] hung up"),
    ("caller 0047 22 11 00 99 hung up", "caller [PHONE_#] hung up"),
    ("22 33 44 55 og 412 34 567 og 90000001", "[PHONE_#] og [PHONE_#] og [PHONE_#]"),
    (f"a{MARK}b Kari {MARK}{MARK} {ORDINARY}", f"a{MARK}b [NAME_#] {MARK}{MARK} [FNR_#]"),
    ("a@x.example.com", "[EMAIL_#]"),
]
UNCHANGED = [
    f"epoch {NO_IDENTITY} ms",
    "Else branch skipped",
    "Per minute limit reached",
    "Tom list; Odd count",
    "Per\tBerg",
    SPACED.replace(" ", "\t"),
    SPACED.replace(" ", "\n"),
    "kari@example.com",
    "x@sub.test",
    "offset +47 9876543210 bytes",
    "00 47 12 34",
    "12345678",
    "KARI kari",
    "",
    None,
]


def test_masked(spark):
    found = redacted(spark, [t for t, _ in MASKED])
    assert [re.sub(r"_\d{4}\]", "_#]", t) for t in found] == [e for _, e in MASKED]


def test_unchanged(spark):
    assert redacted(spark, UNCHANGED) == UNCHANGED


def test_switched_off(spark):
    values = [t for t, _ in MASKED]
    assert redacted(spark, values, Redactor(enabled=False)) == values


def test_placeholders_are_stable(spark):
    found = redacted(spark, ["Kari", "then Kari left", "Kari Olsen"])
    assert len({re.search(r"\[NAME_\d{4}\]", t)[0] for t in found}) == 1


def test_idempotent(spark):
    once = redacted(spark, [t for t, _ in MASKED if MARK not in t])
    assert redacted(spark, once) == once


def test_custom_parts(spark):
    own = Redactor(names=["zoë", "o'hara"], ambiguous=["zoë"], exempt_domains=(), kinds=("NAME", "EMAIL"))
    found = redacted(spark, ["Zoë spoke", f"kari@example.com {ORDINARY}"], own)
    assert found[0] == "Zoë spoke"
    assert re.fullmatch(rf"\[EMAIL_\d{{4}}\] {ORDINARY}", found[1])


def nested_event(spark):
    return spark.sql(
        f"""SELECT 'event-91234567' AS Id, 'Error' AS Level, 'job of Kari' AS RenderedMessage,
        named_struct('StatusCode', 200, 'Notes', array('Ola waits', 'ok', null), 'Extra', map('Kari', 'Kari')) AS Properties,
        array(named_struct('a', 'Kari', 'b', true, 'c', array({ORDINARY}, 7L))) AS many, map('x', {ORDINARY}) AS held,
        {ORDINARY} AS NationalId, {SHORTENED} AS Short, -{ORDINARY} AS Neg, 7 AS n, 12L AS Total, 2.5D AS elapsed"""
    )


def test_nested_and_numeric(spark):
    row = redact(nested_event(spark), exclude=["Id"], numeric=["NationalId", "Short", "Neg"]).first()
    assert row["Id"] == "event-91234567" and row["Level"] == "Error" and row["n"] == 7
    assert "Kari" not in row["RenderedMessage"]
    assert row["Properties"]["StatusCode"] == 200
    assert row["Properties"]["Notes"][0].startswith("[NAME_") and row["Properties"]["Notes"][1:] == ["ok", None]
    assert list(row["Properties"]["Extra"]) == ["Kari"] and row["Properties"]["Extra"]["Kari"].startswith("[NAME_")
    assert row["many"][0]["a"].startswith("[NAME_") and row["many"][0]["b"] is True and row["many"][0]["c"][1] == 7
    assert row["NationalId"].startswith("[FNR_") and row["Neg"] == row["NationalId"]
    assert row["Short"].startswith("[FNR_")


def test_numbers_by_default_at_any_depth(spark):
    masked = redact(nested_event(spark), exclude=["Id"], measures=["Total", "elapsed"])
    row = masked.first()
    assert row["NationalId"] == row["Neg"] == row["many"][0]["c"][0] == row["held"]["x"]
    assert row["NationalId"].startswith("[FNR_") and row["Short"].startswith("[FNR_")
    assert row["many"][0]["c"][1] == "7"
    assert (row["n"], row["Total"], row["elapsed"], row["Properties"]["StatusCode"]) == (7, 12, 2.5, 200)
    kept = redact(nested_event(spark), exclude=["Id"], numeric=())
    assert kept.schema["NationalId"].dataType.simpleString() == "bigint"
    off = redact(nested_event(spark), Redactor(enabled=False))
    assert off.dtypes == nested_event(spark).dtypes and off.first() == nested_event(spark).first()
    other = redact(nested_event(spark), Redactor(kinds=("EMAIL",)))
    assert dict(other.dtypes)["NationalId"] == "bigint"


def test_rowset(spark):
    """An aggregate keeps its measures as numbers; its keys are masked."""
    rows = spark.createDataFrame(
        [("eva.moen@firma.no", i) for i in range(12)] + [("kari@example.com", i) for i in range(3)],
        "UserEmail string, i int",
    )
    found = EventQuery.on(rows, "2024-01-01T00:00:00Z").group("UserEmail").agg(F.count("*").alias("Count")).result()
    assert dict(found.dtypes)["Count"] == "bigint"
    values = {r["Count"]: r["UserEmail"] for r in found.collect()}
    assert values[12].startswith("[EMAIL_") and values[3] == "kari@example.com"


def test_signals_and_alerts_are_masked(spark):
    schema = "signal_id string, title string, description string, predicate string, owner_id string, is_shared boolean"
    row = ("signal-91234567", "cases of Eva Moen", None, "message like '%eva@firma.no%'", "91234567", True)
    signals = spark.createDataFrame([row], schema)
    found = find_signals(signals).first()
    assert found["id"] == "signal-91234567" and found["owner_id"] == "91234567"
    assert "Eva" not in found["title"] and "eva@" not in found["predicate"]
    assert "Eva" not in signal_listing(signals).first()["title"]
    assert find_signals(signals, redactor=Redactor(enabled=False)).first()["title"] == row[1]
    rules = spark.createDataFrame(
        [("watch Eva Moen", "true", "1h", 1, None)],
        "rule_id string, predicate string, window string, threshold bigint, suppress_until timestamp_ntz",
    )
    events = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 00:30:00' AS ts")
    state = alert_state(events, rules, "2024-01-01T01:00:00Z")
    assert "Eva" not in state.first()["rule_id"] and state.first()["observed"] == 1
    assert dict(state.dtypes)["observed"] == "bigint"


def test_json_numbers(spark):
    cases = [
        (f'{{"a":{ORDINARY}.0}}', True),
        (f'{{"a":{ORDINARY}.00,"b":1}}', True),
        ('{"a":1.3116900216e10}', True),
        (f'{{"a":-{ORDINARY}}}', True),
        (f'{{"a":{SHORTENED}.0}}', True),
        (f'{{"a":{ORDINARY}.5}}', False),
        (f'{{"a":{NO_IDENTITY}.0,"b":0.13116900216}}', False),
        ('{"a":1e400,"b":131169002160000}', False),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, j string")
    for r in df.select("i", redact_json(F.col("j")).alias("j")).collect():
        assert ("[FNR_" in r["j"]) == cases[r["i"]][1], r["j"]
        assert cases[r["i"]][1] or r["j"] == cases[r["i"]][0]


def test_json_text(spark):
    cases = [
        ('{"Kari": "Kari", "n": 13116900216}', r'\{"Kari": "\[NAME_\d{4}\]", "n": "\[FNR_\d{4}\]"\}'),
        ('{"phone": 91234567, "fnr":13116900217, "x":[1.5e3,-2,null,true]}', None),
        (r'{"a\"b":"c:\\Kari\" \u004bari", "k" : {"z":""}}', r'\{"a\\"b":"c:\\\\\[NAME_\d{4}\]\\" \[NAME_\d{4}\]", "k" : \{"z":""\}\}'),
        ("no json, Kari", r"no json, \[NAME_\d{4}\]"),
        ('"Kari', r'"\[NAME_\d{4}\]'),
        ("[]", None),
        ("", None),
        (None, None),
    ]
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(cases)], "i int, j string").coalesce(1)
    values = {r["i"]: r["j"] for r in df.select("i", redact_json(F.col("j")).alias("j")).collect()}
    for i, (text, expected) in enumerate(cases):
        assert values[i] == text if expected is None else re.fullmatch(expected, values[i]), values[i]
    row = redact(df.where("i = 0").select(F.col("j").alias("props"), F.parse_json("j").alias("v"))).first()
    assert row["props"] == values[0] and "Kari" not in str(row["v"].toPython()["Kari"]) and "FNR" in row["v"].toPython()["n"]


def test_numbers_of_other_types(spark):
    df = spark.sql(f"SELECT {ORDINARY}D AS d, CAST({ORDINARY} AS DECIMAL(20, 2)) AS e, 1.5D AS f, CAST(NULL AS DOUBLE) AS g")
    row = redact(df, numeric=["d", "e", "f", "g"]).first()
    assert row["d"].startswith("[FNR_") and row["e"] == row["d"] and row["f"] == "1.5" and row["g"] is None


def test_audit_counts_what_redaction_masks(spark):
    df = texts(spark, [t for t, _ in MASKED]).withColumn("source", F.col("i") % 2)
    counted = {(r["source"], r["kind"]): r["found"] for r in pii_audit(df, ["t"], ["source"]).collect()}
    for parity in (0, 1):
        expected = "".join(e for i, (_, e) in enumerate(MASKED) if i % 2 == parity)
        for kind in R.kinds:
            assert counted[(parity, kind)] == expected.count(f"[{kind}_#]")


# ------------------------------------------------------------- the yardstick
KNOWN = set(FIRST_NAMES + SURNAMES)


def digits_ok(value):
    d = [int(c) for c in value]
    if d[0] < 8:
        day, month = d[0] * 10 + d[1], d[2] * 10 + d[3]
        day, month = day - 40 * (day > 40), month - 40 * (month > 40)
        longest = {4: 30, 6: 30, 9: 30, 11: 30, 2: 29}.get(month, 31)
        if not (1 <= month <= 12 and 1 <= day <= longest):
            return False
    for n, weights in ((9, [3, 7, 6, 1, 8, 9, 4, 5, 2]), (10, [5, 4, 3, 2, 7, 6, 5, 4, 3, 2])):
        if (11 - sum(a * b for a, b in zip(d, weights)) % 11) % 11 != d[n]:
            return False
    return True


def mark_names(text):
    words = list(re.finditer("[A-ZÆØÅ][a-zæøåäöéèü]+", text))
    out, at = "", 0
    for i, w in enumerate(words):
        name = w[0].lower()
        near = [
            words[j]
            for j, gap in (
                (i - 1, text[words[i - 1].end() : w.start()] if i else ""),
                (i + 1, text[w.end() : words[i + 1].start()] if i + 1 < len(words) else ""),
            )
            if gap in (" ", "-")
        ]
        if name in KNOWN and (name not in AMBIGUOUS_NAMES or any(n[0].lower() in KNOWN for n in near)):
            out += text[at : w.start()] + "<N>"
            at = w.end()
    return out + text[at:]


def test_names_against_yardstick(spark):
    rng = random.Random(7)
    pieces = ["Kari", "Per", "Berg", "Tom", "Else", "Ola", "Owner", "per", "X", "Lund", "Ås", "Bjørn", "Moen", "Moe"]
    gaps = [" ", "-", "  ", "", ";", ", ", "\n"]
    values = ["".join(rng.choice(pieces) + rng.choice(gaps) for _ in range(rng.randint(1, 9))) for _ in range(600)]
    rows = texts(spark, values).select("i", R.mask("NAME", F.col("t")).alias("t")).orderBy("i").collect()
    assert [re.sub(r"\[NAME_\d{4}\]", "<N>", r["t"]) for r in rows] == [mark_names(v) for v in values]


def test_identity_numbers_against_yardstick(spark):
    rng = random.Random(3)
    values = []
    for _ in range(3000):
        day = rng.choice([rng.randint(0, 32), rng.randint(40, 72)])
        month = rng.choice([rng.randint(0, 13), rng.randint(40, 53)])
        start = rng.choice([f"{day:02}{month:02}{rng.randint(0, 99):02}", f"{rng.randint(80, 99)}{rng.randint(0, 9999):04}"])
        nine = start + f"{rng.randint(0, 999):03}"
        # Both control digits are completed, then sometimes spoilt.
        for weights in ([3, 7, 6, 1, 8, 9, 4, 5, 2], [5, 4, 3, 2, 7, 6, 5, 4, 3, 2]):
            control = (11 - sum(int(a) * b for a, b in zip(nine, weights)) % 11) % 11
            nine += str(control % 10 if rng.random() < 0.9 else rng.randint(0, 9))
        values.append(nine)
    expected = [digits_ok(v) for v in values]
    assert 200 < sum(expected) < 2900
    rows = texts(spark, values).select("i", R.hits("FNR", F.col("t")).alias("n")).orderBy("i").collect()
    assert [r["n"] == 1 for r in rows] == expected


def test_one_search_equals_kind_by_kind(spark):
    """Random mixtures of everything that might match, with rejected numbers between and the marks themselves."""
    rng = random.Random(21)
    pieces = [
        ORDINARY, SPACED, FH_NUMBER, NO_IDENTITY, "131169 00217", "004712 34567", "004712 34567 8", "+47 22 11 00 99", "0047 22110099",
        "22 33 44 55", "00 47 12 34", "412 34 567", "90000001", "12345678", "Kari", "Per", "Berg", "Ola", "Tom", "Owner", "ø", "x",
        "eva@firma.no", "Kari@example.com", MARK, SEPARATOR, "5", "123456 00471 2345678", "",
    ]
    values = ["".join(rng.choice(pieces) + rng.choice([" ", "", "-", ";", "  ", "\n"]) for _ in range(rng.randint(1, 7))) for _ in range(3000)]
    rows = texts(spark, values)
    t = F.col("t")
    for kinds in (("EMAIL", "FNR", "PHONE", "NAME"), ("FNR", "NAME"), ("PHONE", "NAME")):
        redactor = Redactor(kinds=kinds)
        in_turn = t
        for kind in kinds:
            in_turn = redactor.mask(kind, in_turn)
        found = rows.select("t", redactor.text(t).alias("one"), in_turn.alias("many"), redactor.findings(t).alias("n")).collect()
        assert [r["t"] for r in found if r["one"] != r["many"]] == []
        for r in found:
            assert [r["one"].count(f"[{k}_") for k in kinds] == r["n"]


@pytest.mark.parametrize("sf", ["0.001"])
def test_no_valid_number_survives(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    left = docs.select(R.text(F.col("text")).alias("t")).select(R.findings(F.col("t")).alias("f"))
    assert left.filter(F.exists("f", lambda n: n > 0)).count() == 0
    assert left.count() == docs.count()
