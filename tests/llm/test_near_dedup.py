"""Near-duplicates and components against brute force."""

import random
import re

import numpy as np
import pytest

import __spark_entry__ as contract
from eventlens.llm import near_dedup
from eventlens.llm.common import WordHashes
from eventlens.llm.components import components
from eventlens.llm.near_dedup import drop_near_duplicates, estimate, minhash, near_duplicates, odd_sketch, shingles

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_set(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)} or {tuple(words)}


def brute(rows):
    sets = [brute_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    least = {}
    order = lambda v: (v is not None, v or 0)
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id, key=order)
    return sorted(((d, len(s), least[root(i)], d == least[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def chains(seed=5):
    """Groups of edited copies, chains whose ends are not similar, and loose texts."""
    rng = random.Random(seed)
    rows, doc = [], 0
    for _ in range(25):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(60, 200))]
        for _ in range(rng.randint(1, 8)):
            rows.append((doc, " ".join(words)))
            doc += 1
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    passage = " ".join(f"p{i}" for i in range(60))
    for i in range(40):  # half of each is the same passage
        rows.append((doc + i, passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(60))))
    rng.shuffle(rows)
    return rows


EDGES = [(900, None), (901, ""), (902, " \n"), (903, "One two"), (904, "one TWO"), (905, "one"), (906, "one"), (907, "one two three"),
         (908, "É a b"), (909, "é A B"), (910, "a a a a a"), (911, "a a a"), (912, "x y"), (912, "x y"), (None, "lone text here now")]


@pytest.mark.parametrize("blocks", [(512, 2048), (2, 3)])
def test_against_brute_force(docs_of, monkeypatch, blocks):
    monkeypatch.setattr(near_dedup, "LEFT_BLOCK", blocks[0])
    monkeypatch.setattr(near_dedup, "RIGHT_BLOCK", blocks[1])
    rows = chains() + EDGES
    assert got(near_duplicates(docs_of(rows))) == brute(rows)


def test_texts_that_share_a_doc_id(docs_of, monkeypatch):
    """Sets are told apart by themselves: a link of one text is not lost to another text of the same doc_id."""
    rng = random.Random(8)
    a, b, c = ([f"{name}{rng.randrange(10**6)}" for _ in range(120)] for name in "abc")
    near = lambda words: " ".join([*words[:-1], "end"])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (5, near(a)), (7, near(b)), (None, " ".join(c)), (None, "lone"), (9, near(c)), (1, "else")]
    expected = brute(rows)
    assert {(d, c) for d, _, c, _ in expected} >= {(5, 1), (7, 1), (9, None)}
    for few in (10**6, 0):  # sent to the documents, or joined by shuffle
        monkeypatch.setattr(near_dedup, "BROADCAST_ROWS", few)
        assert got(near_duplicates(docs_of(rows))) == expected
    kept = sorted(((r.doc_id, r.text) for r in drop_near_duplicates(docs_of(rows)).collect()), key=repr)
    assert kept == sorted([rows[0], rows[1], rows[4], rows[5], rows[7]], key=repr)


def test_clashing_columns(docs_of):
    docs = docs_of(chains()[:60])
    names = ["node", "tag", "kept_doc", "kept_tag", "digest", "_id", "_sha", "component", "bucket"]
    odd = docs.selectExpr("*", *[f"doc_id + 1 as {n}" for n in names])
    out = drop_near_duplicates(odd)
    assert out.columns == odd.columns and all(r[n] == r["doc_id"] + 1 for r in out.collect() for n in names)
    assert out.count() == drop_near_duplicates(docs).count()


def test_star_of_dissimilar_leaves(docs_of):
    """The smallest document is only a leaf: others hang together by a middle one it does not lead to at once."""
    rng = random.Random(1)
    middle = [f"m{i}" for i in range(150)]
    rows = []
    for leaf in range(30):
        words = list(middle)
        for at in rng.sample(range(0, 150, 4), 3):
            words[at] = f"leaf{leaf}_{at}"
        rows.append((leaf, " ".join(words)))
    rows.append((77, " ".join(middle)))
    assert got(near_duplicates(docs_of(rows))) == brute(rows)


def test_table(spark, sample):
    assert got(contract.queries()["op9_near_dedup"](spark, SF)) == brute([(r.doc_id, r.text) for r in sample.collect()])


def test_drop(docs_of):
    rows = chains()
    docs = docs_of(rows)
    out = drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(d for d, _, _, kept in brute(rows) if kept)
    assert near_duplicates(docs_of([])).count() == 0 and drop_near_duplicates(docs_of([])).count() == 0


def test_sketch_estimates():
    rng = random.Random(3)
    for similarity in (0.7, 0.85, 0.95):
        seen = []
        for _ in range(30):
            words = [f"w{rng.random()}" for _ in range(400)]
            n = int(400 * (1 - similarity) / (1 + similarity) / 3 * 1.0)
            other = list(words)
            for at in rng.sample(range(0, 399, 3), n):
                other[at] = "other"
            a, b = (shingles(" ".join(w), WordHashes()) for w in (words, other))
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            apart = np.bitwise_count(odd_sketch(minhash(a)) ^ odd_sketch(minhash(b))).sum()
            seen.append(float(estimate(apart)) - true)
        assert abs(np.mean(seen)) < 0.03 and np.std(seen) < 0.06


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(300, 400)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    rows = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert rows == {i: root(i) for i in list(parent)}
