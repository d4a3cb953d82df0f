"""Quality classifier: ridge regression on random Fourier features, calibrated isotonically.

A text is described by a few statistics of its bytes, words and lines.  Random
Fourier features of the standardised statistics approximate a Gaussian kernel,
so a linear fit on them is a smooth non-linear fit on the statistics.  Every
partition adds up its share of the normal equations, the sums are added by key,
and one system of ``FEATURES`` equations is solved.  Scores of training rows that
the fit has not seen are put into bins, on which an isotonic curve is fitted.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import fold, frames, text_tag
from eventlens.session import materialize

FEATURES = 256
RIDGE = 1.0
HELD_OUT_MODULUS, HELD_OUT = 3, 1
CALIBRATION_MODULUS, CALIBRATION = 6, 2  # of the training rows
BINS = 2048
LOW, HIGH = -0.5, 1.5

_ASCII = np.arange(256)
_KINDS = np.stack(
    [
        (_ASCII >= ord("a")) & (_ASCII <= ord("z")),
        (_ASCII >= ord("A")) & (_ASCII <= ord("Z")),
        (_ASCII >= ord("0")) & (_ASCII <= ord("9")),
        np.isin(_ASCII, list(b" \t\v\f\r")),
        _ASCII == ord("\n"),
        np.isin(_ASCII, list(b".,;:?")),
        _ASCII == ord("!"),
        _ASCII == ord("|"),
        np.isin(_ASCII, list(b"#*$%&<>")),
        np.isin(_ASCII, list(b"@/\\_=+~^`{}[]")),
        (_ASCII >= 0xC0),
    ]
).astype(float)
STATISTICS = len(_KINDS) + 11


def statistics(text: str | None) -> np.ndarray:
    """The statistics of one text; those of an empty text are zero."""
    data = (text or "").encode("utf-8")
    words = data.split()
    if not words:
        return np.zeros(STATISTICS)
    histogram = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256).astype(float)
    shares = histogram / len(data)
    present = shares[shares > 0]
    lengths = np.fromiter(map(len, words), dtype=float, count=len(words))
    counts = Counter(words)
    times = np.fromiter(counts.values(), dtype=float, count=len(counts))
    lines = [line for line in data.split(b"\n") if line.strip()]
    again = len(lines) - len(set(lines))
    sentences = max(1.0, histogram[ord(".")] + histogram[ord("!")] + histogram[ord("?")])
    pairs = set(zip(words, words[1:], strict=False))
    return np.concatenate(
        [
            np.sqrt(_KINDS @ shares),
            [
                np.log1p(len(words)),
                lengths.mean(),
                lengths.std(),
                lengths.max() ** 0.5,
                len(counts) / len(words),
                times.max() / len(words),
                1.0 - len(pairs) / max(1, len(words) - 1),
                again / len(lines),
                np.log1p(len(words) / len(lines)),
                np.log1p(len(words) / sentences),
                -(present * np.log2(present)).sum(),
            ],
        ]
    )


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, tag (of the text) and ``stats`` for each row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from frames(
            batches,
            lambda batch: batch[["doc_id", "tag"]].assign(
                stats=[statistics(text).astype("float32") for text in batch["text"]]
            ),
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_tag(F.col("text")).alias("tag"), "text")
    return rows.mapInPandas(run, "doc_id long, tag long, stats array<float>")


def _matrix(batch: pd.DataFrame) -> np.ndarray:
    return np.stack(batch["stats"].to_numpy()).astype(float)


def partition_sums(rows: DataFrame, size: int, of: Callable[[pd.DataFrame], np.ndarray]) -> np.ndarray:
    """Sum over all batches of a vector of ``size`` numbers; each partition sends its own sum only."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for batch in batches:
            if len(batch):
                total += of(batch)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"slot": at.astype("int64"), "value": total[at]})

    sums = rows.mapInPandas(run, "slot long, value double").groupBy("slot").agg(F.sum("value").alias("value")).toPandas()
    result = np.zeros(size)
    result[sums["slot"]] = sums["value"]
    return result


@dataclass
class Kernel:
    """Standardisation, random features, and the fit."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        z = np.sqrt(2.0 / len(self.phases)) * np.cos(x @ self.directions + self.phases)
        return np.concatenate([z, np.ones((len(x), 1))], axis=1)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.knots, self.values)


def isotonic(y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Rising means of neighbours: pool adjacent violators of ``y`` (sums) over ``n`` (counts)."""
    blocks: list[list[float]] = []  # sum, count, width
    for s, c in zip(y.tolist(), n.tolist(), strict=True):
        blocks.append([s, c, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.concatenate([np.full(int(w), s / c) for s, c, w in blocks]) if blocks else np.empty(0)


def train(described: DataFrame, labels: DataFrame, label: str = "quality") -> Kernel:
    """Fit on rows of ``describe`` whose document is labelled and not held out."""
    known = (
        labels.where(F.col(label).isNotNull() & (fold("doc_id", HELD_OUT_MODULUS) != HELD_OUT))
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("label"))
    )
    part = fold("doc_id", CALIBRATION_MODULUS)
    rows = described.join(known, "doc_id").select("stats", "label", (part == CALIBRATION).alias("apart"))
    rows = materialize(rows)
    fitting, apart = rows.where(~F.col("apart")), rows.where("apart")

    d = STATISTICS
    moments = partition_sums(
        fitting, 2 * d + 1, lambda b: np.concatenate([[len(b)], _matrix(b).sum(axis=0), (_matrix(b) ** 2).sum(axis=0)])
    )
    n = max(moments[0], 1.0)
    mean = moments[1 : d + 1] / n
    scale = np.sqrt(np.maximum(moments[d + 1 :] / n - mean**2, 1e-8))
    rng = np.random.Generator(np.random.PCG64(4))
    kernel = Kernel(
        mean,
        scale,
        rng.normal(size=(d, FEATURES)) / np.sqrt(d),
        rng.uniform(0, 2 * np.pi, FEATURES),
        np.zeros(FEATURES + 1),
        np.array([0.0, 1.0]),
        np.array([0.0, 1.0]),
    )

    size = FEATURES + 1
    upper = np.triu_indices(size)

    def equations(batch: pd.DataFrame) -> np.ndarray:
        z = kernel.features(_matrix(batch))
        return np.concatenate([(z.T @ z)[upper], z.T @ batch["label"].to_numpy(dtype=float)])

    sums = partition_sums(fitting, len(upper[0]) + size, equations)
    gram = np.zeros((size, size))
    gram[upper] = sums[: len(upper[0])]
    gram = np.triu(gram) + np.triu(gram, 1).T
    ridge = RIDGE * np.eye(size)
    ridge[-1, -1] = 1e-6  # the constant is free
    kernel.weights = np.linalg.solve(gram + ridge, sums[len(upper[0]) :])

    def binned(batch: pd.DataFrame) -> np.ndarray:
        at = np.clip((kernel.raw(_matrix(batch)) - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(int)
        y = batch["label"].to_numpy(dtype=float)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, weights=y, minlength=BINS)])

    bins = partition_sums(apart, 2 * BINS, binned)
    count, good = bins[:BINS], bins[BINS:]
    filled = np.flatnonzero(count)
    if len(filled):
        kernel.knots = LOW + (filled + 0.5) * (HIGH - LOW) / BINS
        kernel.values = isotonic(good[filled], count[filled])
    return kernel


def score(described: DataFrame, kernel: Kernel) -> DataFrame:
    """doc_id, tag, score (0 to 1) and predicted (1 if score >= 0.5) for each row of ``describe``."""
    sent = described.sparkSession.sparkContext.broadcast(kernel)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from frames(
            batches, lambda b: b[["doc_id", "tag"]].assign(score=np.clip(sent.value.score(_matrix(b)), 0.0, 1.0))
        )

    scored = described.mapInPandas(run, "doc_id long, tag long, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out() -> Column:
    return fold("doc_id", HELD_OUT_MODULUS) == HELD_OUT


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the rows that are not held out and score all: doc_id, held_out, score, predicted.

    NULL and empty texts are described by zeros and scored like others.  Repeated
    rows are scored each, NULL doc_ids are passed on; columns other than doc_id
    and text are never looked at.  Without usable labels every score is 0.
    """
    described = materialize(describe(docs))
    scored = score(described, train(described, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
