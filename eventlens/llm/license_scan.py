"""License scan: ordered signature rules over the words of a text.

A text is reduced to its words in lower case, one space between them.  Rules are
regular expressions over that form, each with a keyword that must occur before
the expression is tried, a label and a tier (0 is the most specific).  A
detection that lies inside one of a better tier, or of the same tier, is
suppressed.  Everything is built-in expressions inside one scan; a text without
any of the ``GATES`` costs a few substring searches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases of the base scan.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Label, keyword, and the name as it is written in running text.  Every keyword
# holds one of the GATES.
LICENSES = [
    ("apache-1.0", "apache", r"apache (?:software )?licen[sc]e (?:v|version )?1 0"),
    ("apache-1.1", "apache", r"apache (?:software )?licen[sc]e (?:v|version )?1 1"),
    ("apache-2.0", "apache", r"apache (?:software )?licen[sc]e(?: (?:v|version )?2(?: 0)?)?"),
    ("mit", "mit licen", r"mit licen[sc]e"),
    ("mit-0", "mit no attribution", r"mit no attribution(?: licen[sc]e)?"),
    ("expat", "expat licen", r"expat licen[sc]e"),
    ("x11", "x11 licen", r"x11 licen[sc]e"),
    ("isc", "isc licen", r"isc licen[sc]e"),
    ("bsd-2-clause", "bsd", r"(?:simplified|freebsd|2 clause|two clause) bsd licen[sc]e|bsd 2 clause(?: licen[sc]e)?"),
    ("bsd-3-clause", "bsd", r"(?:new|modified|revised|3 clause|three clause) bsd licen[sc]e|bsd 3 clause(?: licen[sc]e)?"),
    ("bsd-4-clause", "bsd", r"(?:original|old|4 clause|four clause) bsd licen[sc]e|bsd 4 clause(?: licen[sc]e)?"),
    ("bsd", "bsd licen", r"bsd licen[sc]e"),
    ("gpl-1.0", "general public", r"(?:gnu )?general public licen[sc]e (?:v|version )?1(?: 0)?(?! \d)"),
    ("gpl-2.0", "general public", r"(?:gnu )?general public licen[sc]e (?:v|version )?2(?: 0)?"),
    ("gpl-3.0", "general public", r"(?:gnu )?general public licen[sc]e (?:v|version )?3(?: 0)?"),
    ("gpl", "general public", r"gnu general public licen[sc]e"),
    ("gpl-2.0", "gpl", r"gpl ?v?2(?: 0)?(?: only| or later)?"),
    ("gpl-3.0", "gpl", r"gpl ?v?3(?: 0)?(?: only| or later)?"),
    ("lgpl-2.0", "general public", r"(?:gnu )?library general public licen[sc]e(?: (?:v|version )?2(?: 0)?)?"),
    ("lgpl-2.1", "general public", r"(?:gnu )?lesser general public licen[sc]e (?:v|version )?2 1"),
    ("lgpl-3.0", "general public", r"(?:gnu )?lesser general public licen[sc]e (?:v|version )?3(?: 0)?"),
    ("lgpl", "general public", r"(?:gnu )?lesser general public licen[sc]e"),
    ("agpl-3.0", "general public", r"(?:gnu )?affero general public licen[sc]e(?: (?:v|version )?3(?: 0)?)?"),
    ("gfdl", "free documentation licen", r"(?:gnu )?free documentation licen[sc]e(?: (?:v|version )?1 [123])?"),
    ("mpl-1.0", "mozilla", r"mozilla public licen[sc]e (?:v|version )?1 0"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[sc]e (?:v|version )?1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[sc]e (?:v|version )?2 0"),
    ("mpl", "mozilla", r"mozilla public licen[sc]e"),
    ("epl-1.0", "eclipse public licen", r"eclipse public licen[sc]e (?:v|version )?1 0"),
    ("epl-2.0", "eclipse public licen", r"eclipse public licen[sc]e (?:v|version )?2 0"),
    ("epl", "eclipse public licen", r"eclipse public licen[sc]e"),
    ("eupl", "european union public licen", r"european union public licen[sc]e(?: (?:v|version )?1 [12])?"),
    ("cddl", "common development and distribution licen", r"common development and distribution licen[sc]e"),
    ("cpl-1.0", "common public licen", r"common public licen[sc]e(?: (?:v|version )?1 0)?"),
    ("artistic-1.0", "artistic licen", r"artistic licen[sc]e (?:v|version )?1 0"),
    ("artistic-2.0", "artistic licen", r"artistic licen[sc]e (?:v|version )?2 0"),
    ("artistic", "artistic licen", r"artistic licen[sc]e"),
    ("zlib", "zlib licen", r"zlib licen[sc]e|zlib libpng licen[sc]e"),
    ("boost-1.0", "boost software licen", r"boost software licen[sc]e(?: (?:v|version )?1 0)?"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "public licen", r"do what the fuck you want to public licen[sc]e"),
    ("psf-2.0", "python software foundation licen", r"python software foundation licen[sc]e(?: (?:v|version )?2)?"),
    ("php-3.0", "php licen", r"php licen[sc]e(?: (?:v|version )?3 0?1?)?"),
    ("openssl", "openssl licen", r"openssl licen[sc]e"),
    ("ofl-1.1", "open font licen", r"(?:sil )?open font licen[sc]e(?: (?:v|version )?1 [01])?"),
    ("odbl-1.0", "database licen", r"open (?:data commons open )?database licen[sc]e(?: (?:v|version )?1 0)?"),
    ("odc-by-1.0", "attribution licen", r"open data commons attribution licen[sc]e(?: (?:v|version )?1 0)?"),
    ("ogl", "government licen", r"open government licen[sc]e(?: (?:v|version )?[123](?: 0)?)?"),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-nc-nd", "cc by", r"cc by nc nd(?: [1234] 0)?"),
    ("cc-by-nc-sa", "cc by", r"cc by nc sa(?: [1234] 0)?"),
    ("cc-by-nc", "cc by", r"cc by nc(?: [1234] 0)?"),
    ("cc-by-nd", "cc by", r"cc by nd(?: [1234] 0)?"),
    ("cc-by-sa", "cc by", r"cc by sa(?: [1234] 0)?"),
    ("cc-by", "cc by", r"cc by(?: [1234] 0)?"),
    ("cc-by-nc-nd", "creative commons", r"creative commons attribution non ?commercial no ?deriv(?:ative|ativework)?s?"),
    ("cc-by-nc-sa", "creative commons", r"creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nc", "creative commons", r"creative commons attribution non ?commercial"),
    ("cc-by-nd", "creative commons", r"creative commons attribution no ?deriv(?:ative|ativework)?s?"),
    ("cc-by-sa", "creative commons", r"creative commons attribution share ?alike"),
    ("cc-by", "creative commons", r"creative commons attribution"),
    ("cc", "creative commons", r"creative commons"),
    ("ms-pl", "microsoft public licen", r"microsoft public licen[sc]e"),
    ("upl-1.0", "universal permissive licen", r"universal permissive licen[sc]e(?: (?:v|version )?1 0)?"),
    ("afl-3.0", "academic free licen", r"academic free licen[sc]e(?: (?:v|version )?[123] [01])?"),
    ("osl-3.0", "open software licen", r"open software licen[sc]e(?: (?:v|version )?[123] 0)?"),
]

# How a license is named: tier, words before, words after.
FORMS = [
    (1, r"(?:licen[sc]ed|released|distributed|published|provided|available) (?:to you )?under (?:the )?(?:terms of (?:the )?)?(?:a )?", ""),
    (1, r"(?:subject to|governed by|covered by|use of this (?:file|work|software) is governed by) (?:the )?(?:terms of (?:the )?)?", ""),
    (2, r"", r" or (?:\(?at your option\)? )?(?:any )?later(?: version)?"),
    (3, r"", ""),
]

# Identifiers as they follow "SPDX-License-Identifier:".
SPDX_IDS = (
    "apache-2.0 mit isc bsd-2-clause bsd-3-clause gpl-2.0 gpl-3.0 lgpl-2.1 lgpl-3.0 agpl-3.0 mpl-2.0 epl-2.0 "
    "cc0-1.0 cc-by-4.0 cc-by-sa-4.0 unlicense zlib bsl-1.0 ofl-1.1 artistic-2.0"
).split()

# Sentences that belong to one license or kind of notice: label, tier, keyword, expression.
NOTICES = [
    ("mit", 1, "permission", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", 1, "permission", r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", 1, "redistribution", r"redistribution and use in source and binary forms with or without modification"),
    ("bsd-3-clause", 1, "endorse or promote", r"neither the name of .{1,80}? may be used to endorse or promote products"),
    ("gpl", 1, "free software", r"this (?:program|library|file) is free software you can redistribute it and or modify it"),
    ("mpl-2.0", 1, "mozilla", r"this source code form is subject to the terms of the mozilla public licen[sc]e v 2 0"),
    ("boost-1.0", 1, "permission", r"permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("zlib", 1, "warranty", r"this software is provided as is without any express or implied warranty"),
    ("unlicense", 1, "public domain", r"free and unencumbered software released into the public domain"),
    ("public-domain", 2, "public domain", r"(?:released|dedicated|placed) (?:in|into|to) the public domain"),
    ("public-domain", 3, "public domain", r"(?:is|are) (?:in|of) the public domain"),
    ("cc0-1.0", 1, "public domain", r"creative commons (?:zero|public domain dedication)|cc0 public domain dedication"),
    ("warranty-disclaimer", 2, "warrant", r"without warranties or conditions of any kind"),
    ("warranty-disclaimer", 2, "warranty", r"without warranty of any kind"),
    ("proprietary", 2, "confidential", r"proprietary and confidential"),
    ("proprietary", 2, "prohibited", r"unauthorized (?:copying|reproduction|use) .{0,60}?(?:is )?(?:strictly )?prohibited"),
    ("copyright", 3, "copyright", r"copyright (?:c )?(?:\d{4} )+"),
    ("permission-required", 2, "permission", r"without (?:the )?(?:prior )?(?:express )?written permission"),
    ("noncommercial", 2, "commercial", r"(?:for )?non ?commercial use only"),
    ("personal-use", 2, "personal use", r"for personal use only"),
]

GATES = [
    "licen", "apache", "bsd", "general public", "gpl", "mozilla", "cc0", "cc by", "creative commons",
    "mit no attribution", "spdx", "permission", "redistribution", "endorse or promote", "free software", "warrant",
    "public domain", "confidential", "prohibited", "copyright", "commercial", "personal use",
]

CONFIDENCE = [1.0, 0.95, 0.8, 0.6]
BASE_CONFIDENCE = 0.5
SPAN = "struct<start:int,tier:int,neg_end:int,label:string>"


def rules() -> list[tuple[str, str, str, int]]:
    """All rules as (keyword, expression, label, tier); expressions begin and end at word bounds."""
    found = []
    for label, keyword, name in LICENSES:
        for tier, before, after in FORMS:
            found.append((keyword, f" {before}(?:{name}){after}(?= )", label, tier))
    for spdx in SPDX_IDS:
        words = spdx.replace("-", " ").replace(".", " ")
        found.append(("spdx", f" spdx licen[sc]e identifier {words}(?= )", spdx, 0))
    for label, tier, keyword, expression in NOTICES:
        found.append((keyword, f" {expression}(?= )", label, tier))
    return found


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _rule_array() -> str:
    rows = (
        f"named_struct('keyword', {_quoted(k)}, 'pattern', {_quoted(p)}, 'label', {_quoted(label)}, 'tier', {tier})"
        for k, p, label, tier in rules()
    )
    return f"array({', '.join(rows)})"


def spaced_words(text: Column) -> Column:
    """The words of a text in lower case, a space before and after each; a single space if there are none."""
    # These two letters are the only ones outside ASCII whose lower case holds an ASCII letter.
    plain = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("å")), F.lit("İ"), F.lit("å"))
    words = F.regexp_replace(F.lower(plain), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    return F.when(F.trim(words) == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), F.trim(words), F.lit(" ")))


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def _base(spaced: Column) -> dict[str, Column]:
    """Count, first and last start, and labels of the base phrases."""
    counts, firsts, lasts, labels = [], [], [], []
    total = _spaces(spaced)
    for phrase, label in BASE_PHRASES.items():
        present = spaced.contains(f" {phrase} ")
        pieces = F.split(spaced, f" {phrase}(?= )", -1)
        width = len(phrase.split())
        counts.append(F.when(present, (F.size(pieces) - 1).cast("long")).otherwise(F.lit(0).cast("long")))
        firsts.append(F.when(present, _spaces(F.element_at(pieces, 1))))
        lasts.append(F.when(present, total - width - _spaces(F.element_at(pieces, -1))))
        labels.append(F.when(present, F.lit(label)))
    return {
        "n_base": sum(counts[1:], counts[0]),
        "first_word": F.least(*firsts),
        "last_word": F.greatest(*lasts),
        "base_found": F.array_sort(F.array_compact(F.array(*labels))),
    }


def _spans(spaced: str) -> str:
    """All matches of the rules whose keyword occurs, as spans sorted by start, tier and falling end."""
    matches = f"regexp_extract_all({spaced}, r.pattern, 0)"
    pieces = f"split({spaced}, r.pattern, -1)"
    of_rule = f"""
        aggregate(
          sequence(1, size(m.found)),
          named_struct('at', 0, 'spans', cast(array() as array<{SPAN}>)),
          (s, i) -> named_struct(
            'at', s.at + length(element_at(m.pieces, i)) + length(element_at(m.found, i)),
            'spans', concat(s.spans, array(cast(named_struct(
              'start', s.at + length(element_at(m.pieces, i)),
              'tier', m.tier,
              'neg_end', -(s.at + length(element_at(m.pieces, i)) + length(element_at(m.found, i))),
              'label', m.label) as {SPAN})))),
          s -> s.spans)"""
    tried = (
        f"transform(filter({_rule_array()}, r -> contains({spaced}, r.keyword)), r -> "
        f"named_struct('tier', r.tier, 'label', r.label, 'found', {matches}, 'pieces', {pieces}))"
    )
    return f"array_sort(flatten(transform(filter({tried}, m -> size(m.found) > 0), m -> {of_rule})))"


def _kept(spans: str) -> str:
    """Spans outside every earlier span of the same or a better tier; ``e0``..``e3`` are the furthest ends so far."""
    ends = [f"greatest(s.e{t}, if(d.tier = {t}, -d.neg_end, -1))" for t in range(4)]
    inside = " or ".join(f"(d.tier >= {t} and -d.neg_end <= s.e{t})" for t in range(4))
    state = ", ".join(f"'e{t}', {end}" for t, end in enumerate(ends))
    start = ", ".join(f"'e{t}', -1" for t in range(4))
    return (
        f"aggregate({spans}, named_struct({start}, 'kept', cast(array() as array<{SPAN}>)), "
        f"(s, d) -> if({inside}, s, named_struct({state}, 'kept', concat(s.kept, array(d)))), s -> s.kept)"
    )


def scan_licenses(docs: DataFrame) -> DataFrame:
    """License phrases and detections of each row of ``docs``.

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score and ``detections``: label, tier, and the span in characters of the
    spaced words (``spaced_words``).  Of equal spans on one tier the label first
    in order stays.  NULL and empty texts have no words, labels '' and score 0.
    Repeated rows are reported each; other columns are ignored.
    """
    spaced = docs.select(F.col("doc_id").cast("long").alias("doc_id"), spaced_words(F.col("text")).alias("spaced"))
    text = F.col("spaced")
    gate = F.lit(False)
    for word in GATES:
        gate = gate | text.contains(word)
    rows = spaced.withColumns({**_base(text), "n_words": _spaces(text) - 1, "gate": gate})
    rows = rows.withColumn("spans", F.expr(f"if(gate, {_spans('spaced')}, cast(array() as array<{SPAN}>))"))
    rows = rows.withColumn("kept", F.expr(_kept("spans")))
    found = F.array_sort(F.array_distinct(F.concat(F.col("base_found"), F.transform("kept", lambda k: k["label"]))))
    best = F.array_min(F.transform("kept", lambda k: k["tier"]))
    levels = F.array(*map(F.lit, CONFIDENCE))
    score = F.greatest(
        F.when(F.size("kept") > 0, F.element_at(levels, best + 1)).otherwise(F.lit(0.0)),
        F.when(F.col("n_base") > 0, F.lit(BASE_CONFIDENCE)).otherwise(F.lit(0.0)),
    )
    return rows.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_found", ",").alias("base_labels"),
        F.array_join(found, ",").alias("labels"),
        score.alias("score"),
        F.transform(
            "kept",
            lambda k: F.struct(k["label"].alias("label"), k["tier"].alias("tier"), k["start"].alias("start"), (-k["neg_end"]).alias("end")),
        ).alias("detections"),
    )
