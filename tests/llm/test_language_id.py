"""Language identification: subwords against plain Python, learning, calibration, and the edges."""

import numpy as np
import pytest

from eventlens.llm import language_id as module
from eventlens.llm.language_id import Model, has_letter, identify, languages, rising, stretches, subwords, train

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, at long, shard int"


def plain_subwords(text):
    words, word = [], ""
    for c in text.lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            words.append(f" {word} ")
            word = ""
    return [w[i : i + k] for k in module.SUBWORDS for w in words for i in range(len(w) - k + 1)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, 0.5, 1, 2) for r in rows], DOCS)


@pytest.mark.parametrize("text", ["", "a", "ab cd", "Hello, wörld  x1y abc!", "ÇA  VA?\n1 2 3", "\U00020000x \ud800"])
def test_subwords(text):
    found, plain = subwords(text).tolist(), plain_subwords(text)
    assert len(found) == len(plain)
    one = {}
    for bucket, word in zip(found, plain, strict=True):
        assert one.setdefault(word, bucket) == bucket
    assert all(0 <= b < module.BUCKETS for b in found)


def test_long_texts_are_read_whole():
    text = "Straße und Häuser, " * 40_000
    parts = list(stretches(text))
    assert len(parts) > 1 and "".join(parts) == text
    model = Model(["a", "b"], np.random.default_rng(1).normal(size=(module.BUCKETS, 4)), np.ones((4, 2)))
    whole = (model.embeddings @ model.layer)[subwords(text)].mean(axis=0)
    assert np.allclose(model.logits([text])[0], whole)


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r["doc_id"]: (r["lang"], r["text"]) for r in docs.collect()}
    found = [r for r in languages(docs).collect() if r["held_out"] and has_letter(truth[r["doc_id"]][1])]
    right = [truth[r["doc_id"]][0] == r["lang_pred"] for r in found]
    most = max(sum(truth[r["doc_id"]][0] == lang for r in found) for lang in ("en", "de", "fr", "es"))
    assert len(found) > 100 and most / len(found) < 0.8
    assert np.mean(right) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in found)


def test_edges(spark):
    rows = [(i, "the quick brown fox and the dog" if i % 2 else "der schnelle braune fuchs und der hund", "en" if i % 2 else "de") for i in range(80)]
    rows += [(1000, None, "en"), (1001, "", None), (1002, "123 ... 4", "de"), (1003, "den hund", None), (None, "the dog", "en"), (1004, "the dog", "und")]
    rows += [rows[3], rows[3]]
    df = frame(spark, rows)
    found = languages(df).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    for doc_id in (1000, 1001, 1002):
        assert by_id[doc_id]["lang_pred"] == "und" and by_id[doc_id]["score"] == 0 and by_id[doc_id]["rejected"]
    assert by_id[1003]["lang_pred"] == "de" and by_id[None]["lang_pred"] == by_id[1004]["lang_pred"] == "en"
    assert sorted(map(str, found)) == sorted(map(str, languages(df).collect()))


def test_no_labels_and_empty_tables(spark):
    assert languages(frame(spark, [])).count() == 0
    unlabelled = frame(spark, [(1, "some text", None), (2, None, None)])
    assert train(unlabelled) is None
    assert {r["lang_pred"] for r in identify(unlabelled, None).collect()} == {"und"}


def test_labels_are_no_input(spark):
    rows = [(i, "the quick brown fox" if i % 2 else "der schnelle fuchs", "en" if i % 2 else "de") for i in range(60)]
    model = train(frame(spark, rows))
    other = [(i, t, "xx") for i, t, _ in rows]
    one, two = (sorted(map(tuple, identify(frame(spark, r), model).collect())) for r in (rows, other))
    assert one == two


def test_calibration_curve():
    hits, n = np.array([0, 4, 2, 9, 10]), np.array([10, 10, 10, 10, 10])
    curve = rising(hits, n)
    assert (np.diff(curve) >= 0).all() and curve[1] == curve[2] == (6 + 0.5) / 21 and 0 < curve[0] < curve[-1] < 1
