"""Toxicity and quality: held-out accuracy, edges, and what may be an input."""

import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as contract
from eventlens.llm.quality_classifier import STATISTICS, Kernel, isotonic, quality, statistics
from eventlens.llm.toxicity import (
    DEPTH,
    END,
    LONGEST_PASSAGE,
    PASSAGE,
    count_words,
    discounts,
    drop_toxic,
    expression,
    model_of,
    passages,
    spellings,
    steps,
    toxicity,
    train,
)

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int, text string, label int"


def remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


@pytest.fixture(scope="module")
def corpus(spark, docs_of):
    """Toxic texts hold words that others never have; poor texts are all capitals."""
    rng = random.Random(2)
    plain = [f"word{i}" for i in range(300)]
    bad = [f"slur{i}" for i in range(8)]
    rows, labels = [], []
    for i in range(1500):
        toxic, poor = rng.random() < 0.2, rng.random() < 0.3
        words = rng.choices(plain, k=rng.randint(30, 120))
        if toxic:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(bad)
        text = " ".join(words)
        rows.append((i, text.upper() + "!!" if poor else text, f"s{i % 3}"))
        labels.append((i, int(not poor), int(toxic), "other", 1))
    edges = [(5000, None), (5001, ""), (5002, " \n "), (5003, "x " * 50_000), (5003, "again"), (5003, "again"), (None, "slur1")]
    return docs_of(rows + edges), spark.createDataFrame([*labels, (7, None, None, None, None), (None, 1, 1, None, 1), (8, 0, 0, None, 0)], LABELS), labels


def check(rows, labels, column, modulus, held):
    assert len(rows) == 1507
    truth = {row[0]: row[column] for row in labels}
    hits = total = 0
    for r in rows:
        if r.doc_id is not None:
            assert r.held_out == (remainder(r.doc_id, modulus) == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.doc_id in truth and r.held_out:
            total += 1
            hits += r.predicted == truth[r.doc_id]
    assert total > 100 and hits / total > 0.97


def test_toxicity(corpus):
    docs, labels, truth = corpus
    rows = toxicity(docs, labels).collect()
    check(rows, truth, 2, 5, 0)
    assert {r.predicted for r in rows if r.doc_id in (5000, 5001, 5002)} == {0}


def test_quality(corpus):
    docs, labels, truth = corpus
    check(quality(docs, labels).collect(), truth, 1, 3, 1)


def test_without_labels_or_documents(spark, corpus, docs_of):
    docs, labels, _ = corpus
    none = labels.where("false")
    for run in (toxicity, quality):
        rows = run(docs.limit(20), none).collect()
        assert len(rows) == 20 and all(0 <= r.score <= 1 for r in rows)
        assert run(docs_of([]), labels).count() == 0


def test_held_out_labels_and_other_columns_have_no_say(spark, corpus):
    docs, labels, _ = corpus
    for run, column, modulus, held in ((toxicity, "toxic", 5, 0), (quality, "quality", 3, 1)):
        part = f"crc32(cast(doc_id as string)) % {modulus} = {held}"
        turned = labels.withColumn(column, F.expr(f"if({part}, 1 - {column}, {column})"))
        other = docs.selectExpr("doc_id", "text", "'zz' as lang", "'q' as source")
        key = lambda r: (r.doc_id is None, r.doc_id or 0, r.score)
        a = sorted(run(docs, labels).collect(), key=key)
        b = sorted(run(other, turned).collect(), key=key)
        assert np.allclose([r.score for r in a], [r.score for r in b], atol=1e-6)


def test_isotonic_and_statistics():
    assert np.allclose(isotonic(np.array([1.0, 0.0, 2.0, 1.0]), np.array([2.0, 2.0, 2.0, 2.0])), [0.25, 0.25, 0.75, 0.75])
    assert not statistics(None).any() and len(statistics("A b. c")) == STATISTICS


def test_features_approximate_a_gaussian_kernel():
    rng = np.random.default_rng(1)
    d, n = 6, 4096
    kernel = Kernel(np.zeros(d), np.ones(d), rng.normal(size=(d, n)) / np.sqrt(d), rng.uniform(0, 2 * np.pi, n), None, None, None)
    x = rng.normal(size=(5, d))
    z = kernel.features(x)[:, :-1]
    distance = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    assert np.allclose(z @ z.T, np.exp(-distance / (2 * d)), atol=0.08)


def test_held_out_quality(spark):
    scored = contract.queries()["op4_quality"](spark, SF)
    truth = spark.read.parquet(f"{SF}/labels.parquet")
    rows = scored.where("held_out").join(truth, "doc_id").collect()
    assert scored.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert sum(r.predicted == r["quality"] for r in rows) >= 0.95 * len(rows)


def test_held_out_toxicity(spark):
    """Toxic and ordinary documents apart, so that no constant answer passes; some labels are wrong."""
    sf = "/root/testdata/sf0.1"
    scored = contract.queries()["op2_toxicity"](spark, sf)
    rows = scored.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert scored.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    toxic = [r.predicted for r in rows if r.toxic == 1]
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert len(toxic) > 80 and sum(toxic) >= 0.9 * len(toxic)
    assert sum(clean) <= 0.05 * len(clean)


def test_steps_of_words():
    assert list(steps("")) == [("", END)]
    assert list(steps("ab")) == [("", "a"), ("a", "ab"), ("ab", "ab" + END)]
    long = list(steps("abcdefghijk"))
    assert len(long) == DEPTH + 1 and long[-1] == ("abcdefgh", "abcdefghijk" + END)
    assert list(steps("abcdefg"))[-1] == ("abcdefg", "abcdefg" + END) and len(list(steps("abcdefg"))) == DEPTH
    assert expression(b"(Idiot!)") == "idiot" and expression(b"---") == "---" and expression("É".encode()) == "é"


def plain_counts(texts):
    """Of each word, in how many different passages each class has it."""
    seen = [set(), set()]
    for text, label in texts:
        current = []
        for raw in (text or "").encode().split():
            current.append(expression(raw))
            if xxhash.xxh32_intdigest(current[-1].encode()) % PASSAGE == 0 or len(current) == LONGEST_PASSAGE:
                seen[label].add(tuple(current))
                current = []
        seen[label].add(tuple(current))
    words = {w for part in seen for p in part for w in p}
    return {w: tuple(sum(w in p for p in part) for part in seen) for w in words}


def test_counts_of_passages_and_spellings(spark):
    rng = random.Random(4)
    words = ["ab", "abc", "Abc!", "abcdefghijklm", "abcdefghxy", "x", "--", "été", *[f"w{i}" for i in range(60)]]
    texts = [(" ".join(rng.choices(words, k=rng.randint(0, 40))), rng.randrange(2)) for _ in range(60)]
    texts += [texts[0]] * 30 + [(None, 1), ("", 0), ("same " * 500, 1)]
    rows = spark.createDataFrame([(t, y, i % 4 == 0) for i, (t, y) in enumerate(texts)], "text string, label int, apart boolean")
    counts = {r["word"]: r for r in count_words(passages(rows)).collect()}
    whole = plain_counts(texts)
    seen = plain_counts([t for i, t in enumerate(texts) if i % 4])
    assert set(counts) == set(whole)
    for word, r in counts.items():
        assert (r["all_ordinary"], r["all_toxic"]) == whole[word]
        assert (r["ordinary"], r["toxic"]) == seen.get(word, (0, 0))
    tree = {}
    for word, n in whole.items():
        for step in steps(word):
            old = tree.get(step, (0, 0))
            tree[step] = (old[0] + n[0], old[1] + n[1])
    found = spellings(count_words(passages(rows))).collect()
    assert {(r["context"], r["spelling"]): (r["all_ordinary"], r["all_toxic"]) for r in found} == tree


def test_models_are_probabilities(spark):
    """The kept and the shared mass of a context add up to one in both classes, and give the log ratios."""
    rng = random.Random(1)
    rows = [("", c, rng.randint(400, 900), rng.randint(40, 90)) for c in "abcdef"] + [("", "z", 10, 200)]
    rows += [("z", "zo", 5, 120), ("z", "zu", 5, 80), ("a", "ab", 300, 30), ("a", "ac", 300, 30)]
    counts = spark.createDataFrame(rows, "context string, spelling string, ordinary long, toxic long")
    model = model_of(counts)
    assert set(model.backoff) == {""} and "z" in model.own and "zo" not in model.own
    totals = [sum(r[i] for r in rows if r[0] == "") for i in (2, 3)]
    both = {r[1]: r[2] + r[3] for r in rows if r[0] == ""}
    kept = 200 - both["z"] * totals[1] / sum(totals) - model.discounts["toxic"][2]
    free = 1 - kept / totals[1]
    shared = both["z"] / sum(totals)
    assert model.own["z"] == pytest.approx(np.log(kept / totals[1] + free * shared) - np.log(shared))
    assert model.backoff[""] == pytest.approx(np.log(free))
    assert model.word("zo") == pytest.approx(model.own["z"]) and model.word("ab") == pytest.approx(model.backoff[""])
    assert model.word("zoé") == model.word("zo") and model.word("") == pytest.approx(model.backoff[""])


def test_discounts_from_counts_of_counts(spark):
    counts = [1] * 40 + [2] * 16 + [3] * 9 + [4] * 5 + [7] * 3
    df = spark.createDataFrame([(n,) for n in counts], "toxic long")
    y = 40 / (40 + 32)
    assert discounts(df, "toxic") == pytest.approx([1 - 2 * y * 16 / 40, 2 - 3 * y * 9 / 16, 3 - 4 * y * 5 / 9])
    assert discounts(df.where("toxic > 2"), "toxic") == [0.75, 0.75, 0.75]


def test_models_in_use_on_real_documents(spark):
    sf = "/root/testdata/sf0.1"
    model = train(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    assert len(model.own) > 10 and any(v > 1 for v in model.own.values()) and any(v != 0 for v in model.backoff.values())
    assert model.word("the") == pytest.approx(0, abs=0.2)


def test_drop_toxic_keeps_any_columns(spark, corpus):
    docs, labels, truth = corpus
    names = ["per_word", "_per_word", "_scored", "label", "apart"]
    odd = docs.selectExpr("*", *[f"doc_id + 9007199254740993 as {n}" for n in names])
    kept = drop_toxic(odd, labels)
    assert kept.dtypes == odd.dtypes
    rows = kept.collect()
    assert all(r[n] is None or r[n] == r["doc_id"] + 9007199254740993 for r in rows for n in names)
    toxic = {i for i, _, bad, _, _ in truth if bad}
    assert len([r for r in rows if r["doc_id"] in toxic]) < 0.05 * len(toxic)
    assert drop_toxic(docs.limit(0), labels).count() == 0
