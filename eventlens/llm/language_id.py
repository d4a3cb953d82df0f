"""Language identification: averaged embeddings of hashed subwords and a linear softmax.

A text is lower-cased and cut into words of letters; the subwords are the runs of
2 to 4 characters of a word with its two ends marked.  Each is hashed to one of
``BUCKETS`` embeddings, the mean over the whole text goes through one linear layer,
and a softmax over the languages gives the score.

Training takes passages of ``PASSAGE`` characters from all over the labelled
texts, up to a bound per language.  They are dealt to ``SHARDS`` groups by hash;
in every round each group runs stochastic gradient descent in numpy from the
shared parameters, and the results are averaged.  An isotonic curve, fitted on
documents that gave no passages, turns the softmax into the chance of being
right; below ``TRUSTED`` a prediction is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import fold, frames, mix
from eventlens.session import materialize

BUCKETS = 1 << 15
SIZE = 16
SUBWORDS = (2, 3, 4)
PASSAGE = 400
# Bounds of the sample: passages of a language, and documents of the calibration.
PASSAGES = 8_000
CALIBRATION_ROWS = 20_000
SHARDS = 8
ROUNDS = 4
RATE = 0.5
BINS = 1_024
TRUSTED = 0.9
HELD_OUT_MODULUS, HELD_OUT = 5, 0
APART_MODULUS, APART = 10, 3  # of the training documents: those of the calibration
UNKNOWN = "und"
STRETCH = 1 << 18  # characters described at a time

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def subwords(text: str) -> np.ndarray:
    """Buckets of all subwords of a text whose ends count as ends of words."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[points]
    codes = np.where(letter, points, 0).astype(np.uint64)
    found, hashes = [], codes
    whole = letter
    for size in range(2, max(SUBWORDS) + 1):
        n = len(codes) - size + 1
        if n <= 0:
            break
        hashes = mix(hashes[:n] * _FACTOR + codes[size - 1 :])
        # Only the first and the last character may be ends of a word.
        whole = letter[:-1] | letter[1:] if size == 2 else whole[:n] & letter[size - 2 : size - 2 + n]
        if size in SUBWORDS:
            found.append(hashes[whole] >> np.uint64(65 - BUCKETS.bit_length()))
    return np.concatenate(found).astype(np.int64) if found else np.empty(0, dtype=np.int64)


def stretches(text: str) -> Iterator[str]:
    """The text in parts of bounded size, cut where no word runs on if there is such a place."""
    at = 0
    while at < len(text):
        end = at + STRETCH
        while end < len(text) and text[end].isalpha() and end < at + 2 * STRETCH:
            end += 1
        yield text[at:end]
        at = end


@dataclass
class Model:
    languages: list[str]
    embeddings: np.ndarray
    layer: np.ndarray
    knots: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0]))
    chances: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0]))

    def logits(self, texts: list[str]) -> np.ndarray:
        """Mean embedding through the layer.  The mean of products is the product of the mean."""
        table = self.embeddings @ self.layer
        return np.stack([_mean(table, text) for text in texts])

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the best language and its softmax."""
        p = softmax(self.logits(texts))
        best = p.argmax(axis=1)
        return best, p[np.arange(len(p)), best]


def _mean(table: np.ndarray, text: str) -> np.ndarray:
    total, n = np.zeros(table.shape[1]), 0
    for part in stretches(text):
        at = subwords(part)
        total += np.bincount(at, minlength=len(table)) @ table if len(at) > len(table) else table[at].sum(axis=0)
        n += len(at)
    return total / max(n, 1)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def descend(model: Model, texts: list[str], labels: np.ndarray, rate: float, seed: int) -> None:
    """One pass of stochastic gradient descent over the passages, in place, with a falling rate."""
    order = np.random.Generator(np.random.PCG64(seed)).permutation(len(texts))
    for step, i in enumerate(order):
        at, times = np.unique(subwords(texts[i]), return_counts=True)
        if not len(at):
            continue
        share = times / times.sum()
        hidden = share @ model.embeddings[at]
        wrong = softmax(hidden @ model.layer)
        wrong[labels[i]] -= 1.0
        now = rate * (1 - step / len(order))
        back = model.layer @ wrong
        model.layer -= now * np.outer(hidden, wrong)
        # The mean divides a gradient by the length; it is not divided again, or long passages would teach nothing.
        model.embeddings[at] -= now * np.outer(np.minimum(times, 4), back) / 4


def _hash_share(*columns: str) -> Column:
    """A number from 0 to 1 that depends on the columns only."""
    return F.pmod(F.xxhash64(*columns, F.lit(11)), F.lit(1 << 30)) / float(1 << 30)


def labelled(docs: DataFrame) -> DataFrame:
    """doc_id, text, lang and ``apart`` of the rows that may be learned from."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "doc_id", "text", F.col("lang").cast("string").alias("lang")
    )
    known = known.where((fold("doc_id", HELD_OUT_MODULUS) != HELD_OUT) & (F.col("lang") != UNKNOWN))
    part = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(APART_MODULUS))
    return known.withColumn("apart", part == APART)


def passages(rows: DataFrame, bound: int) -> DataFrame:
    """lang, passage, shard: about ``bound`` passages of each language, from all over its texts.

    Which ones is decided by hash, so the choice is the same on every run.
    """
    cut = F.ceil(F.length("text") / PASSAGE)
    pieces = rows.select("doc_id", "lang", "text", cut.alias("pieces")).where("pieces > 0")
    sizes = materialize(pieces.groupBy("lang").agg(F.sum("pieces").alias("all")))
    places = pieces.select("doc_id", "lang", "text", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("at"))
    chosen = places.join(sizes, "lang").where(_hash_share("doc_id", "at") < bound / F.col("all"))
    start = (F.col("at") * PASSAGE + 1).cast("int")
    return chosen.select(
        "lang",
        F.col("text").substr(start, F.lit(PASSAGE)).alias("passage"),
        "doc_id",
        "at",
        F.pmod(F.xxhash64("doc_id", "at", F.lit(3)), F.lit(SHARDS)).cast("int").alias("shard"),
    )


def _learner(sent: Broadcast, numbers: dict[str, int], rate: float, turn: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """One round of a shard: from the shared parameters to its own."""

    def learn(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["doc_id", "at", "passage"])
        own = Model(list(numbers), sent.value.embeddings.copy(), sent.value.layer.copy())
        descend(own, shard["passage"].tolist(), shard["lang"].map(numbers).to_numpy(), rate, turn)
        values = np.concatenate([own.embeddings.ravel(), own.layer.ravel()]).astype(np.float32)
        return pd.DataFrame({"parameters": [values.tobytes()]})

    return learn


def train(docs: DataFrame) -> Model | None:
    """Fit and calibrate on the labelled rows; None if there are none with a letter."""
    spark = docs.sparkSession
    rows = labelled(docs)
    sample = materialize(passages(rows.where(~F.col("apart")), PASSAGES))
    languages = [r["lang"] for r in sample.select("lang").distinct().orderBy("lang").collect()]
    if not languages:
        return None
    rng = np.random.Generator(np.random.PCG64(11))
    model = Model(
        languages,
        rng.uniform(-1 / SIZE, 1 / SIZE, (BUCKETS, SIZE)).astype(np.float32),
        np.zeros((SIZE, len(languages)), dtype=np.float32),
    )
    numbers = {lang: i for i, lang in enumerate(languages)}
    for turn in range(ROUNDS):
        learn = _learner(spark.sparkContext.broadcast(model), numbers, RATE / (1 + turn), turn)
        shards = sample.groupBy("shard").applyInPandas(learn, "parameters binary").toPandas()["parameters"]
        mean = np.mean([np.frombuffer(p, dtype=np.float32) for p in sorted(shards)], axis=0)
        cut = BUCKETS * SIZE
        model = Model(languages, mean[:cut].reshape(BUCKETS, SIZE), mean[cut:].reshape(SIZE, -1))
    _calibrate(model, rows.where("apart"), numbers)
    return model


def _calibrate(model: Model, apart: DataFrame, numbers: dict[str, int]) -> None:
    """Fit the chance of being right on documents the model has not learned from."""
    total = apart.count()
    chosen = apart.where(_hash_share("doc_id") < CALIBRATION_ROWS / max(total, 1)).select("lang", "text")
    sent = chosen.sparkSession.sparkContext.broadcast(model)

    def bins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = np.zeros((2, BINS), dtype=np.int64)
        for batch in batches:
            batch = batch[[has_letter(t) for t in batch["text"]]]
            if len(batch):
                best, p = sent.value.predict(batch["text"].tolist())
                right = best == batch["lang"].map(numbers).fillna(-1).to_numpy()
                at = np.minimum((p * BINS).astype(int), BINS - 1)
                count[0] += np.bincount(at, minlength=BINS)
                count[1] += np.bincount(at[right], minlength=BINS)
        at = np.flatnonzero(count[0])
        yield pd.DataFrame({"bin": at, "n": count[0][at], "hits": count[1][at]})

    sums = chosen.mapInPandas(bins, "bin long, n long, hits long").groupBy("bin")
    found = sums.agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).orderBy("bin").toPandas()
    if len(found):
        model.knots = (found["bin"].to_numpy() + 0.5) / BINS
        model.chances = rising(found["hits"].to_numpy(), found["n"].to_numpy())


def rising(hits: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Isotonic shares: neighbours that fall are pooled.  Each pool counts half a hit and half a miss more."""
    pools: list[list[float]] = []
    for h, c in zip(hits.tolist(), n.tolist(), strict=True):
        pools.append([h, c, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            h2, c2, w2 = pools.pop()
            pools[-1] = [pools[-1][0] + h2, pools[-1][1] + c2, pools[-1][2] + w2]
    shares = np.concatenate([np.full(int(w), (h + 0.5) / (c + 1)) for h, c, w in pools])
    return np.maximum.accumulate(shares)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score and rejected for every row.

    The score is the calibrated chance that the prediction is right.  NULL texts
    and texts without a letter get ``und`` with score 0, and so does everything
    without a model.  ``rejected`` marks scores below ``TRUSTED``, ``und`` too.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = sent.value
        names = np.array([] if known is None else known.languages, dtype=object)

        def build(batch: pd.DataFrame) -> pd.DataFrame:
            lang = np.full(len(batch), UNKNOWN, dtype=object)
            score = np.zeros(len(batch))
            usable = np.flatnonzero([known is not None and has_letter(t) for t in batch["text"]])
            if len(usable):
                best, p = known.predict(batch["text"].iloc[usable].tolist())
                lang[usable] = names[best]
                score[usable] = np.clip(np.interp(p, known.knots, known.chances), 0.0, 1.0)
            return pd.DataFrame({"doc_id": batch["doc_id"], "lang_pred": lang, "score": score})

        yield from frames(batches, build)

    found = rows.mapInPandas(run, "doc_id long, lang_pred string, score double")
    return found.withColumn("rejected", F.col("score") < TRUSTED)


def languages(docs: DataFrame) -> DataFrame:
    """Train on the rows that are not held out and predict all: doc_id, held_out, lang_pred, score, rejected.

    Rows with a NULL lang are not learned from; NULL doc_ids count as the empty
    text where rows are told apart, repeated rows are predicted each, an empty
    table gives no rows.  ``lang``, ``source`` and ``doc_id`` are no inputs of a
    prediction, and other columns are never looked at.
    """
    held_out = fold("doc_id", HELD_OUT_MODULUS) == HELD_OUT
    found = identify(docs, train(docs))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")
