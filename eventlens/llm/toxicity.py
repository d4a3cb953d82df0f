"""Toxicity by class-conditional Kneser-Ney models of the spelling of words.

Two models, one of toxic and one of ordinary texts, give the probability of a word
character by character, the context being the beginning of the word.  Counts are
Kneser-Ney's: not how often a word is written, but in how many different passages
it stands, so what is copied a thousand times counts once.
From what a class has seen of a spelling, a discount is taken (estimated from the
counts of counts of the class) together with what the class would have seen if it
did not differ from the other; the mass set free goes to the counts that both
classes share.  A class has counts of its own only where it stands out against
its share of the context; rare and neutral spellings have the same probability
in both models.  So an inflected or new form of a toxic word is told by its stem,
and differences of length, language or amount of text between the classes are not
taken for toxicity.

A text is scored by the difference of both log-likelihoods per distinct word; a
logistic curve, fitted on training texts that the models have not seen, turns it
into a probability.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlens.llm.common import fold, join_labels, returning_memory, unused_name, words_of
from eventlens.session import materialize

DEPTH = 8  # characters of a word that are followed one by one; the rest is one step
ODDS = 1.5  # a class stands out in a context with more than this many times its odds there ...
DEVIATIONS = 3.0  # ... by this many standard deviations
HELD_OUT_MODULUS = 5
CALIBRATION_FOLD = 1  # of the training folds 1..4
BINS_PER_UNIT = 4096
PASSAGE, LONGEST_PASSAGE = 4, 64  # words of a passage, on average and at most
HELD = 100_000  # different words or passages that a task holds before it passes them on
EDGES = ".,;:!?\"'()[]{}<>|#*$%&-_/\\"
END = "\n"  # no word has one
NEUTRAL = -0.5  # the largest logit of a text in which neither class stands out

CLASSES = ["ordinary", "toxic"]
COUNTS = [*CLASSES, "all_ordinary", "all_toxic"]  # without and with the texts of the calibration


def expression(word: bytes) -> str:
    """A word without case and the marks around it."""
    plain = word.decode("utf-8").lower()
    return plain.strip(EDGES) or plain


def steps(word: str) -> Iterator[tuple[str, str]]:
    """The contexts of a word, each with the spelling it is followed to."""
    whole = word + END
    for i in range(min(len(whole), DEPTH)):
        yield whole[:i], whole[: i + 1]
    if len(whole) > DEPTH:
        yield whole[:DEPTH], whole


class Expressions(dict):
    """The plain form of a word as it is written, and whether a passage ends with it."""

    LIMIT = 120_000

    def __missing__(self, raw: bytes) -> tuple[str, bool]:
        if len(self) >= self.LIMIT:
            self.clear()
        word = expression(raw)
        value = self[raw] = (word, xxhash.xxh32_intdigest(word.encode("utf-8")) % PASSAGE == 0)
        return value


def passages(rows: DataFrame) -> DataFrame:
    """passage and ``flags``: the different passages of the texts, and the classes that have them.

    ``rows`` has text, label and ``apart``, which tells the texts of the
    calibration.  A passage ends with certain words, so copies of a text fall into
    the same passages wherever they stand, and only those that were edited differ.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plain = Expressions()
        held: dict[str, int] = {}

        def found() -> pd.DataFrame:
            flags = np.fromiter(held.values(), dtype=np.int32, count=len(held))
            return pd.DataFrame({"passage": np.array(list(held), dtype=object), "flags": flags})

        for batch in batches:
            for text, label, apart in zip(batch["text"], batch["label"], batch["apart"], strict=True):
                flag = 1 << (2 * int(apart) + int(label))
                current: list[str] = []
                for word, last in map(plain.__getitem__, words_of(text)):
                    current.append(word)
                    if last or len(current) == LONGEST_PASSAGE:
                        passage = " ".join(current)
                        held[passage] = held.get(passage, 0) | flag
                        current = []
                if current:
                    passage = " ".join(current)
                    held[passage] = held.get(passage, 0) | flag
                if len(held) >= HELD:
                    yield found()
                    held.clear()
        yield found()

    cut = rows.select("text", "label", "apart").mapInPandas(returning_memory(run), "passage string, flags int")
    return cut.groupBy("passage").agg(F.bit_or("flags").alias("flags"))


def count_words(passages: DataFrame) -> DataFrame:
    """word and ``COUNTS``: in how many different passages each class has the word."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[int, Counter] = {}

        def counted() -> pd.DataFrame:
            words = list(set().union(*counts.values()))
            table = {"word": np.array(words, dtype=object)}
            for name, mask in zip(COUNTS, (1, 2, 5, 10), strict=True):
                parts = [n for flags, n in counts.items() if flags & mask]
                table[name] = np.array([sum(n[w] for n in parts) for w in words], dtype=np.int64)
            return pd.DataFrame(table)

        for batch in batches:
            for flags, found in batch.groupby("flags")["passage"]:
                words = map(set, found.str.split(" "))
                counts.setdefault(flags, Counter()).update(chain.from_iterable(words))
            if sum(map(len, counts.values())) >= HELD:
                yield counted()
                counts = {}
        yield counted()

    schema = "word string, " + ", ".join(f"{c} long" for c in COUNTS)
    return passages.mapInPandas(returning_memory(run), schema).groupBy("word").agg(*[F.sum(c).alias(c) for c in COUNTS])


def spellings(words: DataFrame) -> DataFrame:
    """context, spelling and ``COUNTS`` of all steps of all words."""
    whole = F.concat("word", F.lit(END))
    size = F.length(whole)
    ends = F.concat(
        F.sequence(F.lit(1), F.least(size, F.lit(DEPTH))), F.when(size > DEPTH, F.array(size)).otherwise(F.array())
    )
    start = F.least(F.col("end") - 1, F.lit(DEPTH))
    each = words.select(whole.alias("whole"), *COUNTS, F.explode(ends).alias("end"))
    cut = each.select(
        F.col("whole").substr(F.lit(1), start).alias("context"),
        F.col("whole").substr(F.lit(1), F.col("end")).alias("spelling"),
        *COUNTS,
    )
    return cut.groupBy("context", "spelling").agg(*[F.sum(c).alias(c) for c in COUNTS])


def discounts(counts: DataFrame, name: str) -> list[float]:
    """Kneser-Ney's discounts of counts of one, of two, and of three or more, from the counts of counts."""
    few = counts.where(F.col(name).between(1, 4)).groupBy(name).count().collect()
    n = {r[0]: r[1] for r in few}
    if not all(n.get(i) for i in (1, 2, 3, 4)):
        return [0.75, 0.75, 0.75]
    y = n[1] / (n[1] + 2 * n[2])
    return [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.1), float(i)) for i in (1, 2, 3)]


@dataclass
class KneserNey:
    """Log ratios of both models: of the spellings in which a class stands out, and of the back-off of their contexts."""

    own: dict[str, float]
    backoff: dict[str, float]
    discounts: dict[str, list[float]] = field(default_factory=dict)
    slope: float = 1.0
    intercept: float = NEUTRAL

    def __post_init__(self) -> None:
        self.paths = {context[:i] for context in self.backoff for i in range(len(context) + 1)}

    def word(self, word: str) -> float:
        """Difference of the log-likelihoods of a word.  Where no class stands out, both have the shared one."""
        total = 0.0
        for context, spelling in steps(word):
            if context not in self.paths:
                break
            weight = self.backoff.get(context)
            if weight is not None:
                total += self.own.get(spelling, weight)
        return total


class Scorer(dict):
    """Scores texts; remembers a word as it is written with its plain form and its log ratio."""

    LIMIT = 120_000

    def __init__(self, model: KneserNey) -> None:
        super().__init__()
        self.model = model

    def __missing__(self, raw: bytes) -> tuple[str, float]:
        if len(self) >= self.LIMIT:
            self.clear()
        word = expression(raw)
        value = self[raw] = (word, self.model.word(word))
        return value

    def per_word(self, text: str | None) -> float:
        """Difference of the log-likelihoods per distinct word; 0 for a text without words."""
        found = dict(map(self.__getitem__, set(words_of(text))))
        return sum(found.values()) / len(found) if found else 0.0


def model_of(counts: DataFrame) -> KneserNey:
    """Both models from counts of spellings (context, spelling, ordinary, toxic)."""
    taken = {c: discounts(counts, c) for c in CLASSES}
    contexts = counts.groupBy("context").agg(*[F.sum(c).alias(f"total_{c}") for c in CLASSES])
    both, everything = F.col("ordinary") + F.col("toxic"), F.col("total_ordinary") + F.col("total_toxic")
    table = counts.where(both > 0).join(contexts, "context").withColumn("shared", both / everything)
    for c in CLASSES:
        share = F.col(f"total_{c}") / everything
        raised = both * (ODDS * share / (1 + (ODDS - 1) * share))
        one, two, more = taken[c]
        discount = F.when(F.col(c) == 1, one).when(F.col(c) == 2, two).otherwise(more)
        stands_out = F.col(c) > raised + one + DEVIATIONS * F.sqrt(raised)
        kept = F.when(stands_out, F.greatest(F.col(c) - both * share - discount, F.lit(0.0))).otherwise(0.0)
        table = table.withColumn(f"kept_{c}", kept)
    # Spellings in which a class stands out: few, whatever the number of texts.
    found = table.where((F.col("kept_ordinary") > 0) | (F.col("kept_toxic") > 0)).toPandas()
    own: dict[str, float] = {}
    backoff: dict[str, float] = {}
    for context, group in found.groupby("context"):
        free, logs = [], []
        for c in CLASSES:
            total = max(float(group[f"total_{c}"].iloc[0]), 1.0)
            free.append(1.0 - float(group[f"kept_{c}"].sum()) / total)
            logs.append(np.log(group[f"kept_{c}"].to_numpy() / total + free[-1] * group["shared"].to_numpy()))
        backoff[context] = float(np.log(free[1]) - np.log(free[0]))
        own.update(zip(group["spelling"], (logs[1] - logs[0]).tolist(), strict=True))
    return KneserNey(own, backoff, taken)


def _fit_logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton steps on weighted points, with a slight pull to zero."""
    scale = np.sqrt(np.average(x**2, weights=n)) or 1.0
    design = np.stack([x / scale, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (n * (y - p)) - 1e-3 * beta
        curvature = (design * (n * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(curvature, gradient)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def with_score(docs: DataFrame, model: KneserNey, name: str, text: bool = True) -> DataFrame:
    """``docs`` as they are, or without ``text``, and the difference of the log-likelihoods per word as ``name``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if text or f.name != "text"]
    schema = T.StructType([*kept, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            scores = pa.array([scorer.per_word(t.as_py()) for t in texts], pa.float64())
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, scores], names=[*[f.name for f in kept], name])

    return docs.mapInArrow(returning_memory(run), schema)


def probability(model: KneserNey, per_word: Column) -> Column:
    raw = F.lit(model.slope) * per_word + F.lit(model.intercept)
    return 1.0 / (1.0 + F.exp(-F.greatest(F.least(raw, F.lit(30.0)), F.lit(-30.0))))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", usable: Column | None = None) -> KneserNey:
    """Fit the models and the curve on labelled rows; ``usable`` picks rows by ``doc_id``.

    All usable rows are counted.  What is sent to the executors are the spellings
    that stand out: their number follows how many expressions the classes differ
    in, not how many texts there are.
    """
    part = fold("doc_id", HELD_OUT_MODULUS)
    usable = part != 0 if usable is None else usable
    rows = join_labels(docs, labels, label, usable).withColumn("apart", part == CALIBRATION_FOLD)
    counts = materialize(spellings(count_words(passages(rows))))
    # The curve is fitted on texts that its models have not seen; the models that score have seen all.
    first = model_of(counts.select("context", "spelling", *CLASSES))
    whole = [F.col(f"all_{c}").alias(c) for c in CLASSES]
    model = model_of(counts.select("context", "spelling", *whole))
    scored = with_score(rows.where("apart").select("text", "label"), first, "per_word", text=False)
    bins = scored.groupBy(F.round(F.col("per_word") * BINS_PER_UNIT).cast("long").alias("bin"), "label").count().toPandas()
    if len(bins):
        x, y = bins["bin"].to_numpy(dtype=float) / BINS_PER_UNIT, bins["label"].to_numpy(dtype=float)
        # The rarer class weighs more than its texts, but less than the other: by the root of the ratio.
        n = bins["count"].to_numpy(dtype=float)
        n = n / np.sqrt(np.maximum(np.where(y == 1, n[y == 1].sum(), n[y == 0].sum()), 1.0))
        model.slope, model.intercept = _fit_logistic(x, y, n * (bins["count"].sum() / n.sum()))
        # A text in which neither class stands out is not toxic.
        model.intercept = min(model.intercept, NEUTRAL)
    return model


def score(docs: DataFrame, model: KneserNey) -> DataFrame:
    """doc_id, per_word, score (0 to 1) and predicted (1 if score >= 0.5) for each row of ``docs``.

    NULL and empty texts have per_word 0 and the score of the curve there.
    Repeated rows are scored each; NULL doc_ids are passed on; columns other than
    doc_id and text are never looked at.
    """
    rows = with_score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model, "per_word", text=False)
    scored = rows.select("doc_id", "per_word", probability(model, F.col("per_word")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the rows that are not held out and score all: doc_id, held_out, score, predicted, per_word."""
    scored = score(docs, train(docs, labels))
    return scored.select(
        "doc_id", (fold("doc_id", HELD_OUT_MODULUS) == 0).alias("held_out"), "score", "predicted", "per_word"
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic, with all their columns.

    One pass scores and filters.  NULL and empty texts, repeated rows and empty
    tables as in ``score``; the columns may have any names.
    """
    model = train(docs, labels)
    name = unused_name(docs, "per_word")
    return with_score(docs, model, name).where(probability(model, F.col(name)) < 0.5).drop(name)
