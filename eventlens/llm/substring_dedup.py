"""Substring de-duplication by level-wise doubling.

A passage of ``WINDOW`` words can only repeat if the shorter windows in it repeat.
Windows of a quarter of the length are counted first, at anchors alone: the
anchor of a full window is the short window inside with the smallest hash, so
equal windows have equal anchors.  Anchors that occur in several documents are
extended to twice the length, to both sides; full windows are formed only where
the anchor has survived both levels.  It ends early when no candidates survive.

What a level passes on is, per document, the hashes that occur elsewhere too;
the documents find the places again from their words.  Counting combines in each
task before the shuffle, and looking the counts up is an equi-join, so a passage
that many documents share is no hot spot.  Documents with equal words are one
document to the levels: all but the smallest are removed whole.

The levels below compare windows by 64-bit hashes, which can only let too much
through.  Full windows are compared by 128 bits, two hashes with factors of their
own, so among 10^13 windows no two unequal ones are expected to meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import WordHashes, frames, multipliers, window_hashes, words_of
from eventlens.session import materialize

WINDOW = 50
HALF = (WINDOW + 1) // 2
QUARTER = (HALF + 1) // 2
REACH = WINDOW - QUARTER + 1  # starts of short windows inside a full one
NO_ID = -(2**63)

_FACTORS = multipliers(64, seed=3)
_CHECK_FACTORS = multipliers(64, seed=33)


def own_anchors(short: np.ndarray) -> np.ndarray:
    """For each full window, the start of the smallest short window inside, the first of equal ones."""
    blocks = []
    for first in range(0, len(short) - REACH + 1, 1 << 16):
        view = sliding_window_view(short[first : first + (1 << 16) + REACH - 1], REACH)
        blocks.append(first + np.arange(len(view)) + view.argmin(axis=1))
    return np.concatenate(blocks) if blocks else np.empty(0, dtype=np.int64)


def anchors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the short windows that are the anchor of a full one."""
    short = window_hashes(hashes, QUARTER, _FACTORS)
    starts = np.unique(own_anchors(short))
    return starts, short[starts]


def _extended(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the anchors' extensions to the right and to the left; -1 where the text ends."""
    last = len(hashes) - HALF
    right = np.where(starts <= last, starts, -1)
    left = starts + QUARTER - HALF
    return right, np.where(left >= 0, left, -1)


def extensions(hashes: np.ndarray, survivors: np.ndarray) -> np.ndarray:
    """Hashes of the half-length windows around the surviving anchors."""
    starts, short = anchors(hashes)
    at = np.concatenate(_extended(hashes, starts[np.isin(short, survivors)]))
    return np.unique(window_hashes(hashes, HALF, _FACTORS)[at[at >= 0]]) if len(at) else np.empty(0, dtype=np.uint64)


def candidates(hashes: np.ndarray, survivors: np.ndarray, longer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both hashes of the full windows whose anchor, and its extensions inside the window, occur elsewhere."""
    short = window_hashes(hashes, QUARTER, _FACTORS)
    own = own_anchors(short)
    if not len(own):
        return own.astype(np.uint64), own.astype(np.uint64)
    starts, at = np.unique(own, return_inverse=True)
    alive = np.isin(short[starts], survivors)
    half = window_hashes(hashes, HALF, _FACTORS)
    right, left = _extended(hashes, starts)
    right_alive = (right >= 0) & np.isin(half[right], longer)
    left_alive = (left >= 0) & np.isin(half[left], longer)
    inside = own - np.arange(len(own))
    open_ = alive[at]
    open_ &= right_alive[at] | (inside > WINDOW - HALF)
    open_ &= left_alive[at] | (inside < HALF - QUARTER)
    if not open_.any():
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.uint64)
    found, first = np.unique(window_hashes(hashes, WINDOW, _FACTORS)[open_], return_index=True)
    return found, window_hashes(hashes, WINDOW, _CHECK_FACTORS)[open_][first]


def _id(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(NO_ID))


def _scan(docs: DataFrame) -> DataFrame:
    """doc (an id), digest of the words, and the hashes of the anchors of each row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes_of = WordHashes()

        def row(text: str | None) -> tuple:
            hashes = hashes_of.of(words_of(text))
            return xxhash.xxh3_128_digest(hashes.tobytes()), np.unique(anchors(hashes)[1]).view(np.int64)

        def build(batch: pd.DataFrame) -> pd.DataFrame:
            result = pd.DataFrame([row(t) for t in batch["text"]], columns=["digest", "hashes"])
            result.insert(0, "doc", batch["doc"].array)
            return result

        yield from frames(batches, build)

    rows = docs.select(_id(F.col("doc_id")).alias("doc"), "text")
    return rows.mapInPandas(run, "doc long, digest binary, hashes array<long>")


def _elsewhere(found: DataFrame) -> DataFrame:
    """Per document, the hashes that other documents have too.  ``found`` has doc and ``hashes``, each hash once."""
    entries = found.select("doc", F.explode("hashes").alias("hash"))
    spans = entries.groupBy("hash").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high")
    return entries.join(spans, "hash").groupBy("doc").agg(F.collect_set("hash").alias("hashes"))


def _in_smaller(found: DataFrame) -> DataFrame:
    """Per document, the hashes of its full windows that smaller documents have too, by both hashes."""
    entries = found.select("doc", F.inline(F.arrays_zip("hashes", "checks"))).withColumnsRenamed(
        {"hashes": "hash", "checks": "check"}
    )
    spans = entries.groupBy("hash", "check").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high")
    shared = entries.join(spans, ["hash", "check"]).where("doc > low")
    return shared.groupBy("doc").agg(F.collect_set("hash").alias("hashes"))


def _beside(docs: DataFrame, side: DataFrame, how: str) -> DataFrame:
    """``docs`` joined with what is known of each document; by shuffle at every size, without sorting texts."""
    return docs.withColumn("doc", _id(F.col("doc_id"))).join(side.hint("shuffle_hash"), "doc", how)


def _per_document(
    rows: DataFrame, columns: list[str], of: Callable[..., tuple[np.ndarray, ...]], names: tuple[str, ...] = ("hashes",)
) -> DataFrame:
    """doc and ``names``: what ``of`` makes of the word hashes and the ``columns`` of each row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes_of = WordHashes()

        def build(batch: pd.DataFrame) -> pd.DataFrame:
            made = []
            for text, *known in zip(batch["text"], *(batch[c] for c in columns), strict=True):
                arrays = [np.asarray(k, dtype=np.int64).view(np.uint64) for k in known]
                made.append(of(hashes_of.of(words_of(text)), *arrays))
            return batch[["doc"]].assign(**{n: [m[i].view(np.int64) for m in made] for i, n in enumerate(names)})

        yield from frames(batches, build)

    schema = "doc long, " + ", ".join(f"{n} array<long>" for n in names)
    return rows.select("doc", "text", *columns).mapInPandas(run, schema)


def repeated_windows(docs: DataFrame, scanned: DataFrame) -> DataFrame:
    """Per document (doc), the hashes of its full windows that smaller documents have too."""
    first = scanned.groupBy("digest").agg(F.min("doc").alias("doc"))
    # Of documents with equal words the smallest stands for all.
    single = scanned.join(first, ["digest", "doc"]).select("doc", "hashes")
    short = materialize(_elsewhere(single))
    if short.isEmpty():
        return short
    rows = _beside(docs, short.withColumnRenamed("hashes", "short"), "inner")
    longer = materialize(_elsewhere(_per_document(rows, ["short"], lambda *known: (extensions(*known),))))
    if longer.isEmpty():
        return longer
    both = materialize(
        short.withColumnRenamed("hashes", "short").join(longer.withColumnRenamed("hashes", "longer"), "doc")
    )
    rows = _beside(docs, both, "inner")
    full = _per_document(rows, ["short", "longer"], candidates, ("hashes", "checks"))
    return materialize(_in_smaller(full))


REMOVED = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """Remove the words of every window of ``WINDOW`` words that also starts in a smaller document.

    Returns doc_id, n_words, n_removed, kept_sha256, and with ``with_text`` the
    kept words joined by spaces, for each row of ``docs``.  Windows are judged on
    the input.  A NULL text has no words; a NULL doc_id is smaller than all
    others; repeated rows, and others that share a doc_id, take nothing from
    each other.  Other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    scanned = materialize(_scan(docs))
    repeated = repeated_windows(docs, scanned)
    first = scanned.groupBy("digest").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    copies = scanned.join(first.where("first < last"), "digest").where("doc > first")
    known = (
        repeated.withColumn("digests", F.array().cast("array<binary>"))
        .unionByName(copies.select("doc", F.array().cast("array<long>").alias("hashes"), F.array("digest").alias("digests")))
        .groupBy("doc")
        .agg(F.flatten(F.collect_list("hashes")).alias("hashes"), F.flatten(F.collect_list("digests")).alias("digests"))
    )
    rows = _beside(docs, materialize(known), "left")
    schema = REMOVED + (", text string" if with_text else "")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes_of = WordHashes()

        def row(text: str | None, found: np.ndarray | None, digests: list | None) -> tuple:
            words = words_of(text)
            kept = words
            if found is not None and len(words) >= WINDOW:
                hashes = hashes_of.of(words)
                if xxhash.xxh3_128_digest(hashes.tobytes()) in {bytes(d) for d in digests}:
                    kept = []
                elif len(found):
                    windows = window_hashes(hashes, WINDOW, _FACTORS)
                    starts = np.flatnonzero(np.isin(windows, np.asarray(found, dtype=np.int64).view(np.uint64)))
                    edges = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(edges, starts, 1)
                    np.add.at(edges, starts + WINDOW, -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]
            joined = b" ".join(kept)
            return len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode("utf-8")

        def build(batch: pd.DataFrame) -> pd.DataFrame:
            made = [row(*r) for r in zip(batch["text"], batch["hashes"], batch["digests"], strict=True)]
            result = pd.DataFrame(made, columns=["n_words", "n_removed", "kept_sha256", "text"])
            result.insert(0, "doc_id", batch["doc_id"].array)
            return result if with_text else result.drop(columns="text")

        yield from frames(batches, build)

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "hashes", "digests").mapInPandas(run, schema)
