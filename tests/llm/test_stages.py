"""Every stage of the pipeline on odd inputs, and exact duplicates against plain Python."""

import hashlib
import random
from collections import Counter

import pytest

import corpus_pipeline
from eventlens.llm import exact_dedup
from eventlens.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from eventlens.llm.mixing import mix_sources, mixed_documents
from eventlens.llm.substring_dedup import remove_repeats

SF = "/root/testdata/sf0.001"
CLASHING = "_id _sha _tag _key _copies _per_word _scored short longer node tag key copies rows nth row sha doc at size".split()


def odd_rows():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(50)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 60))), "en", f"s{i % 3}") for i in range(40)]
    rows += [rows[3]] * 3 + [(77, rows[5][1], None, None), (78, None, "en", "s1"), (78, "", None, "s1"), (None, "lone words", "en", None)]
    rows += [(None, rows[6][1], "en", "s2"), (80, "same id", "en", "s0"), (80, "other text", "en", "s0"), (81, "long " * 40_000, "en", "s1")]
    return rows


def odd_documents(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(*r, 9) for r in rows], schema)
    return docs.selectExpr("*", *[f"coalesce(doc_id, -1) * 3 + 9007199254740993 as {c}" for c in CLASHING])


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_rows_and_clashing_columns(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = odd_documents(spark, odd_rows())
    out = stage(spark, docs, SF)
    found = out.collect()
    assert found
    if name != "packing":
        assert out.dtypes == docs.dtypes
        had = set(map(tuple, docs.collect()))
        assert all(tuple(r) in had for r in found)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_tables(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = odd_documents(spark, odd_rows()).limit(0)
    out = stage(spark, docs, SF)
    assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)


def test_repeats_with_clashing_columns(spark):
    docs = odd_documents(spark, odd_rows())
    assert remove_repeats(docs).count() == docs.count()


def test_equal_rows_share_what_is_taken(spark):
    """A hot group of equal rows: together they are taken as often as the mix says, each as evenly as it goes."""
    rows = [(1, "same words in all rows", "en", "a")] * 90 + [(i, f"text {i} of many", "en", "b") for i in range(2, 40)]
    docs = odd_documents(spark, rows)
    wanted = Counter()
    for r in mix_sources(docs).collect():
        wanted[r["doc_id"]] += r["copies"]
    found = Counter(r["doc_id"] for r in mixed_documents(docs).collect())
    assert found == Counter({k: n for k, n in wanted.items() if n})


def plain_duplicates(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    found, seen = [], set()
    for doc_id, text in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        first = (doc_id, text or "") not in seen
        seen.add((doc_id, text or ""))
        sha = hashlib.sha256((text or "").encode()).hexdigest()
        found.append((doc_id, keep, len(ids), doc_id == keep and first, sha))
    return sorted(found, key=repr)


@pytest.mark.parametrize("block", [1, 7, 512])
def test_exact_duplicates(spark, docs_of, monkeypatch, block):
    monkeypatch.setattr(exact_dedup, "BLOCK_BYTES", block)
    rng = random.Random(block)
    texts = ["", None, "a", "ab", "ba", "abab", "ab" * 40, "ab" * 40 + "a", "é" * 9, "x" * 512, "x" * 513, "x" * 1024, "y" * 511 + "é"]
    rows = [(i, rng.choice(texts)) for i in range(60)]
    rows += [(5, "ab"), (5, "ab"), (5, "ba"), (None, "a"), (None, "lone"), (None, "lone"), (None, "other")]
    found = exact_duplicates(docs_of(rows))
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, found.select(*columns).collect()), key=repr) == plain_duplicates(rows)
    kept = sorted(((r["doc_id"], r["text"]) for r in drop_exact_duplicates(docs_of(rows)).collect()), key=repr)
    largest = {}
    for doc_id, text in rows:
        known = largest.get(text or "")
        largest[text or ""] = doc_id if known is None else known if doc_id is None else max(known, doc_id)
    # Of rows that repeat both doc_id and text one stays; NULL and empty texts are the same.
    assert Counter((d, t or "") for d, t in kept) == Counter({(largest[t or ""], t or ""): 1 for _, t in rows})


def test_exact_duplicates_of_very_long_texts_and_empty_tables(spark, docs_of):
    long = "0123456789" * 30_000
    rows = [(1, long), (2, long), (3, long + "!"), (4, "!" + long)]
    found = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_duplicates(docs_of(rows)).collect()}
    assert found == {1: (2, 2, False), 2: (2, 2, True), 3: (3, 1, True), 4: (4, 1, True)}
    assert exact_duplicates(docs_of([])).count() == 0 and drop_exact_duplicates(docs_of([])).count() == 0
