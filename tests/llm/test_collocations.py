"""Collocations against plain counting, the sort against a dictionary, and the routing of crowded prefixes."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from eventlens.llm import collocations as module
from eventlens.llm.collocations import BREAK, LONGEST, collocations, multikey_quicksort, routed, stretches

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n long, phrase string, size int, head string, a long"


def pieces_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall("[^\x20\x09]+", piece) for piece in re.split("[.,;:!?\x0a-\x0d]", lower)]


def brute(rows, least, top):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces_of(text):
            totals[lang] += len(words)
            for size in range(1, LONGEST + 1):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    found = []
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {
            longer[i : i + size]: max(frequent[longer], 0)
            for longer in sorted(frequent, key=frequent.get)
            for size in range(2, len(longer))
            for i in range(len(longer) - size + 1)
        }
        scored = []
        for phrase, a in frequent.items():
            if inside.get(phrase, 0) >= a:
                continue
            cuts = [(1000 * a * totals[lang] // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 1, 2, "x", 3, "y", 4) for i, (t, lang) in enumerate(rows)], DOCS)


def got(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def corpus(seed=7, docs=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Ünï", "naïve", "of", "the", "a b", "A-Z", "x y"]
    phrases = ["the of the of the", "new york city hall", "of the", "w1 w2 w3 w4 w5 w6", "Ünï naïve"]
    rows = []
    for _ in range(docs):
        parts = [rng.choice(phrases) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randint(0, 80))]
        ends = [rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r", "! ", "\x0b"]) for _ in parts]
        rows.append(("".join(a + b for a, b in zip(parts, ends, strict=True)), rng.choice(["en", "de", None])))
    return rows


@pytest.mark.parametrize(("least", "top", "limit"), [(8, 50, 10**6), (3, 2000, 40), (2, 2000, 5)])
def test_equals_plain_counting(spark, least, top, limit):
    rows = corpus()
    assert got(collocations(frame(spark, rows), least, top, 12, limit)) == brute(rows, least, top)


def test_filters_never_change_the_result(spark):
    rows = corpus(11, 60)
    results = [got(collocations(frame(spark, rows), 3, 2000, width)) for width in (6, 16)]
    assert results[0] == results[1] == brute(rows, 3, 2000)


def test_nulls_empties_repeats_and_long_texts(spark):
    rows = [(None, "en"), ("", None), ("...", "en"), ("a", "en")] + [("Same words here", "en")] * 30
    rows += [("long text of words, " * 20_000, "fr"), ("one " * 5_000, None), ("und word " * 20, "und")]
    assert got(collocations(frame(spark, rows), 10)) == brute(rows, 10, 2000)
    assert got(collocations(frame(spark, []), 10)) == []


def test_products_beyond_64_bits(spark):
    phrases = spark.createDataFrame([("en", "a b", 2, 4 * 10**12)], "lang string, phrase string, size int, a long")
    counts = spark.createDataFrame([("en", "a", 5 * 10**12), ("en", "b", 7 * 10**12)], "lang string, phrase string, n long")
    totals = spark.createDataFrame([("en", 9 * 10**14)], "lang string, n long")
    row = module.best_cuts(phrases, counts, totals).first()
    assert row["score"] == 1000 * 4 * 10**12 * 9 * 10**14 // (35 * 10**24)


def test_sort_counts_prefixes():
    rng = np.random.default_rng(2)
    keys = np.zeros((3000, LONGEST + 1), dtype=np.int32)
    sizes = rng.integers(2, LONGEST + 1, len(keys))
    for i, size in enumerate(sizes):
        keys[i, : size + 1] = rng.integers(1, 5, size + 1)
    weights = rng.integers(1, 4, len(keys))
    expected = Counter()
    for key, size, weight in zip(keys, sizes, weights, strict=True):
        for depth in range(2, size + 1):
            expected[tuple(key[: depth + 1])] += int(weight)
    for least, shared in ((1, 2), (50, 2), (50, 4)):
        found = {tuple(keys[row][: depth + 1]): n for row, depth, n in multikey_quicksort(keys, weights, least, shared)}
        assert found == {p: n for p, n in expected.items() if n >= least or len(p) - 1 < shared}


def test_crowded_prefixes_are_routed_deeper(spark):
    rows = [("en", f"of the w{i}", 3, 1) for i in range(30)] + [("en", "of the", 2, 1)] * 50
    rows += [("en", f"a b c d{i % 3}", 4, 1) for i in range(30)] + [("en", "x y", 2, 1)]
    placed = routed(spark.createDataFrame(rows, "lang string, phrase string, size int, n long"), 10).collect()
    depth = {r["phrase"]: r["depth"] for r in placed}
    assert depth["x y"] == 2 and depth["of the"] == depth["of the w1"] == 3 and depth["a b c d1"] == 3
    assert {r["phrase"]: r["n"] for r in placed}["of the"] == 50 and sum(r["n"] for r in placed) == len(rows)


def test_stretches_never_cut_a_piece():
    text = "Aa bb, cc dd ee. " * 50
    whole = [w for part in stretches([text], 10**6) for w in part]
    for size in (1, 7, 60):
        parts = list(stretches([text, "", "x. y"], size))
        assert max(map(len, parts)) < 90
        joined = [w for part in parts for w in part if w != BREAK]
        assert joined == [w for w in whole if w != BREAK] + [b"x", b"y"]
        runs = [tuple(r.split()) for part in parts for r in b" ".join(part).split(BREAK) if r.split()]
        assert set(runs) <= {(b"aa", b"bb"), (b"cc", b"dd", b"ee"), (b"x",), (b"y",)}
