"""Packing: every piece has its place, plans are tight, ids are the tokenizer's."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
from eventlens.llm.packing import CAPACITY, UnitIds, default_tokenizer, pack_documents, plan_packing

SF = "/root/testdata/sf0.001"


def check_plan(counts, capacity):
    plan = plan_packing(counts, capacity)
    placed = Counter()
    for contents, times in plan.bins:
        assert sum(n * k for n, k in contents) <= capacity
        for n, k in contents:
            placed[n] += k * times
    assert placed == Counter({k: v for k, v in counts.items() if v})
    return plan


def fewest(items, capacity):
    """Fewest bins by trying all ways."""
    items = sorted(items, reverse=True)
    best = len(items)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for room in set(bins):
            if room >= items[i]:
                rest = list(bins)
                rest.remove(room)
                place(i + 1, [*rest, room - items[i]])
        place(i + 1, [*bins, capacity - items[i]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(40))
def test_plan_against_all_packings(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 10, 15])
    items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
    plan = check_plan(Counter(items), capacity)
    best = fewest(items, capacity)
    assert best <= plan.sequences <= best + 1
    # Fixing the dominating sets never costs a bin.
    left = Counter(items)
    fixed = 0
    for contents, times in plan.bins:
        if fixed >= plan.fixed:
            break
        fixed += times
        for n, k in contents:
            left[n] -= k * times
    assert fixed + fewest(list(left.elements()), capacity) == best


def test_plan_of_many_items():
    rng = random.Random(1)
    counts = Counter({n: rng.randint(0, 10**9) for n in range(1, CAPACITY + 1)})
    plan = check_plan(counts, CAPACITY)
    total = sum(n * k for n, k in counts.items())
    assert plan.sequences <= 1.01 * -(-total // CAPACITY) + 1
    assert len(plan.bins) < 10 * CAPACITY
    assert check_plan(Counter({1: 10**12}), CAPACITY).sequences == -(-(10**12) // CAPACITY)


def check_packed(rows, capacity):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return by_sequence


TEXTS = ["Don't stop, it's 12.5! A'b", "", None, "É́é ǅ K İ <|endoftext|> ok.\x0bq", "x " * 5000, "same", "same", "...,a .b, c."]


def test_ids_are_those_of_the_tokenizer(sample):
    tokenizer = Tokenizer.from_file(default_tokenizer())
    tokenizer.encode_special_tokens = True
    texts = [*TEXTS, *(r.text for r in sample.limit(60).collect())]
    for text, ids in zip(texts, UnitIds(default_tokenizer()).of(texts), strict=True):
        assert np.frombuffer(ids, dtype="<u4").tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


ODD = ["word### stachö, Öl!! ÀÞß÷×ÿ. a'. it's, x's... <|endoftext|>, b_c_ 1.5%% e-mail- (a) [b] c\\ é\u0301? é,\u0301 =\u0338 a=\u0338 a=", "Σς. İx! ſt# ﬁn; ǅ$$ ´` q`` q'`"]


def test_marks_of_all_kinds_and_forgotten_units(sample, monkeypatch):
    """Marks are parted from words where the tokenizer parts them, so they add no units; units are learned anew."""
    tokenizer = Tokenizer.from_file(default_tokenizer())
    tokenizer.encode_special_tokens = True
    marks = [chr(n) for n in range(33, 127) if not chr(n).isalnum()]
    pairs = [f"{w}{m}{k}" for w in ("ab", "é", "Ö", "7", "İ", "'s") for m in marks for k in ("", *marks)]
    texts = [*ODD, " ".join(pairs), *(r.text for r in sample.limit(30).collect())]
    monkeypatch.setattr(UnitIds, "LIMIT", 500)
    monkeypatch.setattr(UnitIds, "CHUNK_BYTES", 2_000)
    units = UnitIds(default_tokenizer())
    for text, ids in zip(texts * 2, units.of(texts * 2), strict=True):
        assert np.frombuffer(ids, dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    fresh = UnitIds(default_tokenizer())
    list(fresh.of(["word word### word, öl öl! öl%%%"]))
    assert set(fresh.known) == {b"word", b"###", b",", "öl".encode(), b"!", b"%%%"}


def test_edges(docs_of):
    rows = pack_documents(docs_of([*enumerate(TEXTS), (5, "same"), (None, "no id")]), capacity=512).collect()
    check_packed(rows, 512)
    pieces = Counter(r.doc_id for r in rows)
    assert pieces[4] > 5 and pieces[5] == 2 and pieces[None] == 1 and pieces[1] == pieces[2] == 1
    assert pack_documents(docs_of([])).count() == 0


def test_table(spark, sample):
    tokenizer = Tokenizer.from_file(default_tokenizer())
    rows = contract.queries()["op5_packing"](spark, SF).collect()
    sequences = check_packed(rows, CAPACITY)
    total = sum(r.length for r in rows)
    assert len(sequences) <= 1.02 * total / CAPACITY + 1
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    for doc in sample.collect():
        ids = np.array([*tokenizer.encode(doc.text, add_special_tokens=False).ids, 0], dtype="<u4")
        mine = sorted(pieces[doc.doc_id], key=lambda r: r.piece)
        want = [ids[i : i + CAPACITY] for i in range(0, len(ids), CAPACITY)]
        assert [(r.start, r.length, r.ids_crc32) for r in mine] == [
            (CAPACITY * i, len(p), zlib.crc32(p.tobytes())) for i, p in enumerate(want)
        ]
    assert list(itertools.chain(sequences))
