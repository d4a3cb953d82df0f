"""The Merkle manifest against plain Python, and what its proofs catch."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from eventlens.llm.merkle import fold, manifest, verification

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree long, place string, node int, n int, path string"


def sha(text):
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    def part(v):
        return "-" if v is None else f"{len(str(v).encode('utf-8'))}:{v}"

    return sha("".join(map(part, (doc_id, source, lang, n_chars, text))))


def tree(nodes, fanout):
    """The top and, for every node, its steps as (left, right)."""
    steps = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for i in range(len(steps)):
            first = at[i] // fanout * fanout
            run = nodes[first : first + fanout]
            own = at[i] - first
            steps[i].append(("".join(run[:own]), "".join(run[own + 1 :])))
            at[i] //= fanout
        nodes = [sha("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]
    return (nodes[0] if nodes else None), steps


def brute(rows, fanout=3):
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode("utf-8")))
    groups = {}
    for source in sources:
        own = [(r[0], leaf(r[0], r[3], r[2], r[4], r[1]), r) for r in rows if r[3] == source]
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        groups[source] = (own, *tree([x[1] for x in own], fanout))
    root, upper = tree([groups[s][1] for s in sources], fanout)
    found = []
    for source, above in zip(sources, upper, strict=True):
        own, subroot, steps = groups[source]
        for (doc_id, mark, row), path in zip(own, steps, strict=True):
            whole = path + above
            text = row[1]
            if text is not None and zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf(doc_id, source, row[2], row[4], text)
            for left, right in whole:
                node = sha(left + node + right)
            proof = sha("".join(a + b for a, b in whole))
            found.append((doc_id, mark, subroot, root, proof, node, node == root))
    return sorted(found, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x", 1, 2, "y") for r in rows], DOCS)


def got(df):
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def corpus(sizes, seed=3):
    rng = random.Random(seed)
    rows = []
    for source, size in sizes.items():
        for _ in range(size):
            doc_id = rng.randrange(10**6)
            text = rng.choice(["", "a\nb", "naïve \U0001f600 text", "x" * 30, f"line\n{doc_id}\n"])
            rows.append((doc_id, text, rng.choice(["en", None]), source, rng.choice([5, None])))
    return rows


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 1},
        {"a": 3, "b": 1},
        {"a": 2, "b": 4, None: 5, "é": 10, "Z": 27},
        {f"s{i}": 1 + i % 3 for i in range(14)},
        {"hot": 250, "b": 9, "": 28},
    ],
)
def test_equals_plain_python(spark, sizes):
    rows = corpus(sizes)
    assert got(verification(frame(spark, rows))) == brute(rows)


def test_nulls_ties_and_repeats(spark):
    rows = [
        (None, None, None, None, None),
        (None, "a\nb", "en", None, 3),
        (1, "a", "en", "s", 1),
        (1, "a", "en", "s", 1),
        (1, "b\n", "en", "s", 1),
        (2, None, None, "s", None),
        (2, "long " * 200_000, "en", "s", 10**6),
    ]
    assert got(verification(frame(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert got(verification(frame(spark, []))) == []


def test_other_fanouts_and_carried_columns(spark):
    rows = corpus({"a": 40, "b": 7}, seed=9)
    for fanout in (2, 5):
        found = manifest(frame(spark, rows), [F.col("n_chars").alias("size")], fanout)
        wrong = found.where(fold(F.col("leaf"), F.col("path")) != F.col("root"))
        assert wrong.count() == 0 and "size" in found.columns
        assert {r[0] for r in found.select("root").collect()} == {brute(rows, fanout)[0][3]}
    with pytest.raises(ValueError, match="fanout"):
        manifest(frame(spark, rows), fanout=1)


def test_lengths_keep_fields_apart(spark):
    rows = [(1, "b", "a", "s", 1), (1, "", "ab", "s", 1), (1, None, "ab", "s", 1), (1, "-", "ab", "s", 1)]
    leaves = {r["leaf"] for r in manifest(frame(spark, rows)).collect()}
    assert len(leaves) == 4
