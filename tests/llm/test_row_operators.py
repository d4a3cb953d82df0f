"""Operators that look at one text at a time, against plain Python."""

import re

import pytest

import __spark_entry__ as contract
from eventlens.llm.license_scan import GATES, rules, scan_licenses
from eventlens.llm.quality_rules import repetition_report

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

EDGES = [
    (1, None),
    (2, ""),
    (3, " \t\n\r\x0b\x0c "),
    (4, "eine\u00a0wort \u2003 x\x1cy\x85z"),
    (5, "a b c d e f g h " * 40),
    (6, "line one here\n\nline one here\n \nline one here\nother"),
    (7, "word " * 30),
    (8, " ".join(f"w{i}" for i in range(50_000))),
    (8, "repeated id"),
    (8, "repeated id"),
    (None, "no id\nno id"),
    (9, "#*$ %&| <> é𝄞"),
]


def brute_rules(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    inside = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), failed)


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def key(row):
    return tuple((v is None, v if v is not None else 0) for v in row)


def test_quality_rules_edges(docs_of):
    got = repetition_report(docs_of(EDGES)).select("doc_id", *BASE).collect()
    assert sorted(map(tuple, got), key=key) == sorted(((d, *brute_rules(t)) for d, t in EDGES), key=key)


def test_quality_rules_on_table(spark, sample):
    got = contract.queries()["op7_quality_rules"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in sample.collect()}
    assert len(got) == len(texts)
    for row in got:
        assert tuple(row[c] for c in BASE) == brute_rules(texts[row.doc_id])
        assert not (row.base_failed and row.kept)


def test_repetition_verdict(docs_of):
    fresh = " ".join(f"w{i}" for i in range(300))
    rows = {r.doc_id: r for r in repetition_report(docs_of([(1, fresh), (2, fresh + " " + fresh), (3, (fresh[:200] + "\n") * 3)])).collect()}
    assert rows[1].kept and not rows[2].kept and not rows[3].kept
    assert rows[2].dup_chars_5 == rows[2].word_chars and rows[1].dup_chars_5 == 0


def test_quality_rules_empty_table(docs_of):
    assert repetition_report(docs_of([])).count() == 0


LICENSE_EDGES = [
    (1, None),
    (2, ""),
    (3, "CC BY cc-by CC/BY 4.0, all rights reserved all Rights RESERVED"),
    (4, "GNU General Public License, version 3. General public license general public"),
    (5, "acc by cc bye cc\u00a0by all rights reservedé ALL RIGHTS RESERVED"),
    (6, "Licensed under the Apache License, Version 2.0. " * 300),
    (7, "SPDX-License-Identifier: MIT\nPermission is hereby granted, free of charge, to any person obtaining a copy"),
    (8, "İ K licensed under the MIT License or \u212ait"),
    (8, "same id, CC BY-NC 4.0"),
    (None, "cc by"),
    (9, "'; drop \\ cc by"),
]

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def brute_license(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        want = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(want)] == want]
        places += at
        if at:
            labels.add(label)
    # Every rule on every text, without gates, and suppression by comparing all detections.
    spaced = " " + " ".join(words) + " " if words else " "
    found = []
    for _, pattern, label, tier in rules():
        found += [(m.start(), tier, -m.end(), label) for m in re.finditer(pattern, spaced, re.ASCII)]
    found.sort()
    kept = []
    for i, (start, tier, end, label) in enumerate(found):
        over = (
            j != i and s <= start and e <= end and t <= tier and (t < tier or j < i)
            for j, (s, t, e, _) in enumerate(found)
        )
        if not any(over):
            kept.append((label, tier, start, -end))
    method = sorted(labels | {k[0] for k in kept})
    return (
        len(words),
        len(places),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted(labels)),
        ",".join(method),
        kept,
    )


def license_row(row):
    kept = [tuple(d) for d in row.detections]
    return (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels, row.labels, kept)


def test_license_rules_are_gated():
    assert len(rules()) >= 300
    assert all(any(gate in keyword for gate in GATES) for keyword, _, _, _ in rules())


def test_license_scan_edges(docs_of):
    got = scan_licenses(docs_of(LICENSE_EDGES)).collect()
    key = lambda r: (repr(r[0]), r[1])
    assert sorted(((r.doc_id, license_row(r)) for r in got), key=lambda r: repr(r)) == sorted(
        ((d, brute_license(t)) for d, t in LICENSE_EDGES), key=lambda r: repr(r)
    )
    assert all(0 <= r.score <= 1 for r in got) and {r.score for r in got if not r.labels} == {0.0}


def test_license_scan_on_table(spark, sample):
    texts = {r.doc_id: r.text for r in sample.collect()}
    got = scan_licenses(sample).collect()
    assert len(got) == len(texts)
    for row in got:
        assert license_row(row) == brute_license(texts[row.doc_id])
    assert any(r.labels for r in got)
    assert scan_licenses(sample.where("false")).count() == 0


@pytest.mark.parametrize(
    ("text", "label"),
    [
        ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl-3.0"),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
        ("SPDX-License-Identifier: MIT", "mit"),
    ],
)
def test_license_labels(docs_of, text, label):
    assert label in scan_licenses(docs_of([(1, text)])).first().labels.split(",")
