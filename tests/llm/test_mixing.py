"""Mixing: targets against plain arithmetic, totals near them, the cube's invariants."""

import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

import __spark_entry__ as contract
from eventlens.llm import mixing
from eventlens.llm.mixing import fly, land, mix_sources, mixed_documents

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    capped = set()
    total = sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        free = sum(weight[s] for s in order if s not in capped)
        target = {s: Fraction(3 * sizes[s]) if s in capped else Fraction(left * weight[s], free) for s in order}
        over = {s for s in order if s not in capped and target[s] >= 3 * sizes[s]}
        if not over:
            return target
        capped |= over
        if len(capped) == len(order):
            return {s: Fraction(3 * sizes[s]) for s in order}


def check(rows, docs):
    sizes, longest = Counter(), Counter()
    want = Counter()
    for doc_id, text, source in docs:
        n = len(WORD.findall(text or ""))
        sizes[source] += n
        longest[source] = max(longest[source], n)
        want[(doc_id, source, n)] += 1
    assert Counter((r.doc_id, r.source, r.size) for r in rows) == want
    targets = brute_targets(sizes)
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(float(targets[r.source]))
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        taken[r.source] += r.taken
    for source, target in targets.items():
        assert abs(taken[source] - target) <= max(longest[source], 1)


def test_flight_keeps_totals():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 50, 500):
        size = rng.integers(0, 3000, n).astype(float).tolist()
        chance = rng.random(n).tolist()
        before = (sum(chance), float(np.dot(size, chance)))
        fly(size, chance, rng)
        assert sum(0 < p < 1 for p in chance) <= 2
        assert sum(chance) == pytest.approx(before[0], abs=1e-6)
        assert np.dot(size, chance) == pytest.approx(before[1], abs=1e-2)
        land(size, chance)
        assert set(chance) <= {0.0, 1.0}


def test_flight_is_fair():
    taken = np.zeros(6)
    for seed in range(4000):
        chance = [0.3] * 6
        size = [5.0, 4.0, 4.0, 9.0, 1.0, 2.0]
        fly(size, chance, np.random.default_rng(seed))
        taken += chance
    assert np.allclose(taken / 4000, 0.3, atol=0.03)


def docs_for_edges():
    rows = [(i, "w " * (1 + i % 17), "hot") for i in range(300)]
    rows += [(1000 + i, "x y " * (i % 5), "Z") for i in range(30)]
    rows += [(2000, None, "empty"), (2001, "", "empty"), (2002, "only one here", None), (2003, "w " * 4000, "é")]
    rows += [(3000, "again and again", "rep")] * 4 + [(3000, "another text", "rep"), (None, "no id", "rep")]
    return rows


def test_edges(docs_of, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_UNITS", 16)  # several levels
    rows = docs_for_edges()
    got = mix_sources(docs_of(rows)).collect()
    check(got, rows)
    again = mix_sources(docs_of(rows[::-1])).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    out = mixed_documents(docs_of(rows))
    assert out.columns == docs_of(rows).columns
    want = defaultdict(int)
    for r in got:
        want[(r.doc_id, r.source)] += r.copies
    texts = Counter((r.doc_id, r.source) for r in out.collect())
    assert texts == Counter({k: v for k, v in want.items() if v})


def test_empty(docs_of):
    assert mix_sources(docs_of([])).count() == 0
    assert mixed_documents(docs_of([])).count() == 0
    nothing = mix_sources(docs_of([(1, None), (2, " ")])).collect()
    assert [(r.target, r.taken) for r in nothing] == [(0.0, 0), (0.0, 0)]


def test_table(spark, sample):
    got = contract.queries()["op1_mixing"](spark, SF).collect()
    check(got, [(r.doc_id, r.text, r.source) for r in sample.collect()])
