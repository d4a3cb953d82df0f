"""Removal of repeated passages against brute force."""

import hashlib
import random
import re

import numpy as np

import __spark_entry__ as contract
from eventlens.llm import substring_dedup
from eventlens.llm.common import window_hashes
from eventlens.llm.substring_dedup import REACH, WINDOW, _in_smaller, anchors, remove_repeats

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    order = lambda v: (v is not None, v or 0)
    least = {}
    texts = [(d, WORD.findall(t or "")) for d, t in rows]
    for d, words in texts:
        for i in range(len(words) - WINDOW + 1):
            w = tuple(words[i : i + WINDOW])
            if w not in least or order(d) < order(least[w]):
                least[w] = d
    result = []
    for d, words in texts:
        gone = set()
        for i in range(len(words) - WINDOW + 1):
            if order(least[tuple(words[i : i + WINDOW])]) < order(d):
                gone.update(range(i, i + WINDOW))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        result.append((d, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(result, key=repr)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=repr)


def passages(seed=1):
    """Texts that share passages around the limit, at their ends, nested, and copies."""
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    shared = [fresh(n) for n in (49, 50, 51, 60, 120, 400)]
    rows = []
    for doc in range(120):
        words = fresh(rng.randint(0, 90))
        for _ in range(rng.randint(0, 3)):
            part = rng.choice(shared)
            low = rng.choice([0, 0, rng.randrange(len(part))])
            words += part[low : low + rng.choice([30, 49, 50, 51, 75, 500])] + fresh(rng.choice([0, 1, 40]))
        rows.append((doc, rng.choice([" ", "\n", " \t"]).join(words)))
    rows += [(200 + i, rows[5][1]) for i in range(30)] + [(300, " ".join(["same"] * 500)), (301, " ".join(["same"] * 70))]
    rng.shuffle(rows)
    return rows


EDGES = [(900, None), (901, ""), (902, "short"), (None, "n " * 80), (903, "n " * 60), (904, "é " * 55), (905, "é " * 55), (905, "é " * 55),
         (906, "a b " * 40), (906, "b a " * 50), (907, "b a " * 30), (-5, "a b " * 30)]


def test_against_brute_force(docs_of):
    rows = passages() + EDGES
    assert got(remove_repeats(docs_of(rows))) == brute(rows)


def test_table(spark, sample):
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    assert got(contract.queries()["op3_substring_dedup"](spark, SF)) == brute(rows)
    assert any(n for _, _, n, _ in brute(rows))


def test_nothing_repeats(docs_of):
    assert [r[2] for r in got(remove_repeats(docs_of([(1, "a " * 60), (2, "b " * 60)])))] == [0, 0]
    assert remove_repeats(docs_of([])).count() == 0


def test_text(docs_of):
    rows = passages()
    for r in remove_repeats(docs_of(rows), with_text=True).collect():
        assert hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256


def test_every_window_has_an_anchor():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    starts, _ = anchors(hashes)
    for first in range(len(hashes) - WINDOW + 1):
        assert ((starts >= first) & (starts < first + REACH)).any()
    assert len(starts) < 3 * len(hashes) / REACH


def test_windows_are_told_apart_by_both_hashes(spark):
    rows = [(1, [7, 8], [70, 80]), (2, [7, 8], [71, 80]), (3, [7], [71])]
    found = _in_smaller(spark.createDataFrame(rows, "doc long, hashes array<long>, checks array<long>")).collect()
    assert {(r["doc"], tuple(r["hashes"])) for r in found} == {(2, (8,)), (3, (7,))}
    words = np.arange(1, 200, dtype=np.uint64)
    found, checks = (window_hashes(words, WINDOW, f) for f in (substring_dedup._FACTORS, substring_dedup._CHECK_FACTORS))
    assert len(found) == 150 and not np.isin(found, checks).any()
