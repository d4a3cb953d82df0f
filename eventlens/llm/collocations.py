"""Phrase collocations: suffix pointers sorted by multikey three-way quicksort.

A suffix is the stretch of up to ``LONGEST`` words that starts at one place of a
text.  All suffixes with the same leading words are brought together, and their
pointers are sorted word by word: a step splits a segment into the pointers below,
at and above a pivot word, and only those at the pivot go on to the next word.
The size of that equal part is the number of occurrences of the words so far;
a part that is too small for a frequent phrase is abandoned.

A phrase is no more frequent than its words and its pairs.  Two bitmaps of a fixed
size, of words and of pairs whose counts can reach the minimum, are made first,
and a suffix ends where its next pair cannot: what they wrongly let through is
found out later, so they save work and never change a result.  Equal suffixes of
a stretch of texts travel as one row with a weight.  Leading words that head too
many rows for one group are routed by one word more, after their equal rows have
been summed; the counts of the shorter phrase are then added up over its groups.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlens.llm.common import mix
from eventlens.session import materialize

LONGEST = 5
LEAST = 100
TOP = 2_000
FILTER_BITS = 24  # a bitmap has 2 ** FILTER_BITS bits, 2 MB
ROUTED_ROWS = 200_000  # rows of one group, and of one prefix before it is routed deeper
STRETCH = 1 << 21  # bytes of text cut into words at a time; a piece is never cut
HELD = 400_000  # different phrases counted in a task before they are passed on
PAIRS_HELD = 1 << 22

UNKNOWN = "und"
BREAK = b"\xff"  # no byte of UTF-8
_PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _PIECE_ENDS, b"abcdefghijklmnopqrstuvwxyz" + b"\n" * len(_PIECE_ENDS)
)
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def stretches(texts: list[str], size: int = STRETCH) -> Iterator[list[bytes]]:
    """The words of whole texts, ``BREAK`` where a piece ends, in lists of bounded texts or single pieces."""
    parts: list[bytes] = []
    held = 0
    for text in texts:
        data = text.encode("utf-8").translate(_FOLD)
        at = 0
        while at < len(data):
            end = data.find(b"\n", at + size) if len(data) - at > size else -1
            part = data[at:] if end < 0 else data[at:end]
            parts.append(part)
            held += len(part)
            at += len(part) + 1
            if held >= size:
                yield _words(parts)
                parts, held = [], 0
    if parts:
        yield _words(parts)


def _words(parts: list[bytes]) -> list[bytes]:
    return b"\n".join(parts).replace(b"\n", b" " + BREAK + b" ").split()


class Filter:
    """A bitmap over hashes; without bits it lets everything through."""

    def __init__(self, bits: np.ndarray, width: int) -> None:
        self.bits, self.shift = bits, np.uint64(64 - width)
        self.bytes, self.byte_shift = bits.astype("<u8").tobytes(), 64 - width

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> self.shift
        return (self.bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1

    def has_one(self, value: int) -> bool:
        at = value >> self.byte_shift
        return self.bytes[at >> 3] >> (at & 7) & 1 == 1


class Codes(dict):
    """Hash of a word of one language; 0 for words that are not frequent, and for breaks."""

    HELD = 300_000

    def __init__(self, lang: str, words: Filter) -> None:
        super().__init__()
        self.seed, self.words = xxhash.xxh3_64_intdigest(lang.encode("utf-8")), words

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.HELD:
            self.clear()
        value = 0
        if word != BREAK:
            found = word_code(word, self.seed)
            if self.words.has_one(found):
                value = found
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def word_code(word: bytes, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(word, seed=seed) or 1


def pair_codes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a pair of known words starts, and the hashes of these pairs."""
    at = np.flatnonzero((codes[:-1] != 0) & (codes[1:] != 0))
    return at, mix(codes[at] * _PAIR + codes[at + 1])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def _by_language(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, list[bytes]]]:
    for batch in batches:
        for lang, texts in batch.groupby("lang", sort=False)["text"]:
            for words in stretches(texts.tolist()):
                yield lang, words


class Tally:
    """Counts of phrases by language, passed on when there are too many."""

    def __init__(self, held: int = HELD) -> None:
        self.counts: dict[str, Counter] = {}
        self.held = held

    def of(self, lang: str) -> Counter:
        return self.counts.setdefault(lang, Counter())

    def full(self) -> bool:
        return sum(map(len, self.counts.values())) >= self.held

    def rows(self) -> pd.DataFrame:
        parts = [
            counted([lang] * len(counts), [p.decode("utf-8") for p in counts], list(counts.values()))
            for lang, counts in self.counts.items()
            if counts
        ]
        self.counts = {}
        return pd.concat(parts) if parts else counted([], [], [])


def counted(langs: list[str], phrases: list[str | None], n: list[int]) -> pd.DataFrame:
    """A frame whose columns have their types even without rows."""
    texts = {"lang": np.array(langs, dtype=object), "phrase": np.array(phrases, dtype=object)}
    return pd.DataFrame(texts | {"n": np.array(n, dtype=np.int64)})


def word_counts(texts: DataFrame, least: int) -> DataFrame:
    """lang, phrase, n of the frequent words, and all words of a language under the NULL phrase."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tally, totals = Tally(), Counter()
        for lang, words in _by_language(batches):
            counts = tally.of(lang)
            counts.update(words)
            totals[lang] += len(words) - counts.pop(BREAK, 0)
            if tally.full():
                yield tally.rows()
        yield tally.rows()
        yield counted(list(totals), [None] * len(totals), list(totals.values()))

    parts = texts.mapInPandas(run, "lang string, phrase string, n long").groupBy("lang", "phrase")
    summed = parts.agg(F.sum("n").alias("n"))
    return materialize(summed.where(F.col("phrase").isNull() | (F.col("n") >= least)))


def _bitmap(buckets: DataFrame, width: int) -> Filter:
    """A bitmap from a column ``bucket``: at most 2 ** width / 64 numbers reach the driver."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bucket") % 64).cast("int"))
    found = buckets.groupBy(F.floor(F.col("bucket") / 64).cast("int").alias("at")).agg(F.bit_or(bit).alias("bits"))
    rows = found.toPandas()
    bits = np.zeros(max(1, 2**width // 64), dtype=np.uint64)
    bits[rows["at"].to_numpy()] = rows["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return Filter(bits, width)


def word_filter(words: DataFrame, width: int) -> Filter:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            codes = [
                word_code(word.encode("utf-8"), xxhash.xxh3_64_intdigest(lang.encode("utf-8"))) >> (64 - width)
                for lang, word in zip(batch["lang"], batch["phrase"], strict=True)
            ]
            yield pd.DataFrame({"bucket": np.array(codes, dtype=np.int64)})

    return _bitmap(words.select("lang", "phrase").mapInPandas(run, "bucket long"), width)


def pair_filter(texts: DataFrame, words: Filter, least: int, width: int) -> Filter:
    """Counts of pairs by hash; a bucket counts at least what each of its pairs does."""
    sent = texts.sparkSession.sparkContext.broadcast(words)

    def buckets(held: list[np.ndarray]) -> pd.DataFrame:
        bucket, n = np.unique(np.concatenate(held), return_counts=True)
        return pd.DataFrame({"bucket": bucket.astype(np.int32), "n": n.astype(np.int64)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes: dict[str, Codes] = {}
        held, size = [], 0
        for lang, found in _by_language(batches):
            _, pairs = pair_codes(_codes(codes, lang, sent.value).of(found))
            held.append((pairs >> np.uint64(64 - width)).astype(np.uint32))
            size += len(pairs)
            if size >= PAIRS_HELD:
                yield buckets(held)
                held, size = [], 0
        if held:
            yield buckets(held)

    sums = texts.mapInPandas(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    return _bitmap(sums.where(F.col("n") >= least), width)


def _codes(kept: dict[str, Codes], lang: str, words: Filter) -> Codes:
    if lang not in kept:
        if len(kept) >= 8:
            kept.clear()
        kept[lang] = Codes(lang, words)
    return kept[lang]


def suffixes(texts: DataFrame, words: Filter, pairs: Filter) -> DataFrame:
    """lang, phrase, size, n: suffixes of two words and more, cut before the first pair that cannot be frequent."""
    sent = texts.sparkSession.sparkContext.broadcast((words, pairs))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tally, codes = Tally(), {}
        known, likely = sent.value
        for lang, found in _by_language(batches):
            at, pair = pair_codes(_codes(codes, lang, known).of(found))
            goes_on = np.zeros(len(found) + LONGEST, dtype=bool)
            goes_on[at[likely.has(pair)]] = True
            start = np.flatnonzero(goes_on)
            end, going = start + 2, np.ones(len(start), dtype=bool)
            for step in range(1, LONGEST - 1):
                going &= goes_on[start + step]
                end += going
            places = zip(start.tolist(), end.tolist(), strict=True)
            tally.of(lang).update(map(b" ".join, (found[i:j] for i, j in places)))
            if tally.full():
                yield tally.rows()
        yield tally.rows()

    rows = texts.mapInPandas(run, "lang string, phrase string, n long")
    return materialize(rows.withColumn("size", F.regexp_count("phrase", F.lit(" ")) + 1))


def _head(depth: int) -> Column:
    return F.substring_index("phrase", " ", depth)


def routed(rows: DataFrame, limit: int = ROUTED_ROWS) -> DataFrame:
    """``suffixes`` with ``depth``, the number of leading words that all rows of a group share.

    Two words as a rule.  Leading words of more than ``limit`` rows are told apart
    by one word more, and so on; equal rows of such prefixes are summed first, so
    that at full length a group has one row.  There are at most rows / limit
    such prefixes, and they are a written table.
    """
    settled: DataFrame | None = None
    for depth in range(2, LONGEST + 1):
        crowded = None
        if depth < LONGEST:
            heads = rows.groupBy("lang", _head(depth).alias("head")).agg(F.count("*").alias("rows"))
            crowded = materialize(heads.where(F.col("rows") > limit).select("lang", "head", F.lit(True).alias("hot")))
        last = crowded is None or crowded.isEmpty()
        if last:
            here = rows
        else:
            marked = rows.withColumn("head", _head(depth)).join(crowded, ["lang", "head"], "left")
            here = marked.where(F.col("hot").isNull())
            same = marked.where("hot").groupBy("lang", "phrase", "size")
            rows = materialize(same.agg(F.sum("n").alias("n")))
        here = here.select("lang", "phrase", "size", "n", F.lit(depth).alias("depth"))
        settled = here if settled is None else settled.unionByName(here)
        if last:
            break
    return settled


def multikey_quicksort(
    keys: np.ndarray, weights: np.ndarray, least: int, shared: int
) -> Iterator[tuple[int, int, int]]:
    """Phrases of sorted suffix pointers: (a row that starts with it, its words, its weight).

    ``keys`` has a language and then ``LONGEST`` words a row, 0 after the last.
    Rows that share ``shared`` leading words are all here, so the weight of an
    equal part of that many words and more is a final count: parts below
    ``least`` are abandoned.  Shorter phrases of two words and more are parts of
    a count, which are given out whatever they weigh.
    """
    stack = [(np.arange(len(keys)), 0)]
    while stack:
        rows, at = stack.pop()
        column = keys[rows, at]
        pivot = sorted((column[0], column[len(column) // 2], column[-1]))[1]
        partial = shared > 2 and at < shared
        for side in (column < pivot, column > pivot):
            part = rows[side]
            if len(part) and (partial or weights[part].sum() >= least):
                stack.append((part, at))
        if pivot == 0 and at > 0:
            continue  # these suffixes have ended
        equal = rows[column == pivot]
        weight = int(weights[equal].sum())
        if weight < least and not partial:
            continue
        if at >= 2:
            yield int(equal[0]), at, weight
        if at < LONGEST:
            stack.append((equal, at + 1))


def _sort_group(group: pd.DataFrame, least: int) -> pd.DataFrame:
    lists = [phrase.split(" ") for phrase in group["phrase"]]
    sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    flat, _ = pd.factorize(np.array(list(chain.from_iterable(lists)), dtype=object))
    keys = np.zeros((len(lists), LONGEST + 1), dtype=np.int32)
    langs = group["lang"].to_numpy()
    keys[:, 0] = pd.factorize(langs)[0] + 1
    starts = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(lists)), sizes)
    keys[row, np.arange(len(flat)) - starts[row] + 1] = flat + 1
    weights = group["n"].to_numpy(dtype=np.int64)
    found = list(multikey_quicksort(keys, weights, least, int(group["depth"].iloc[0])))
    phrases = [" ".join(lists[i][:size]) for i, size, _ in found]
    result = counted([langs[i] for i, _, _ in found], phrases, [weight for _, _, weight in found]).rename(columns={"n": "a"})
    result.insert(2, "size", np.array([size for _, size, _ in found], dtype=np.int32))
    return result


def phrase_counts(rows: DataFrame, least: int, limit: int = ROUTED_ROWS) -> DataFrame:
    """lang, phrase, size, a of all phrases that occur ``least`` times or more."""
    groups = max(1, math.ceil(rows.count() / limit))
    placed = routed(rows, limit)
    bucket = F.pmod(F.xxhash64("lang", F.substring_index("phrase", " ", 2), "depth"), F.lit(groups))
    for depth in range(3, LONGEST + 1):
        deeper = F.pmod(F.xxhash64("lang", _head(depth), "depth"), F.lit(groups))
        bucket = F.when(F.col("depth") == depth, deeper).otherwise(bucket)
    sort: Callable[[pd.DataFrame], pd.DataFrame] = lambda group: _sort_group(group, least)
    sorted_ = placed.withColumn("bucket", bucket).groupBy("depth", "bucket")
    parts = sorted_.applyInPandas(sort, "lang string, phrase string, size int, a long")
    summed = parts.groupBy("lang", "phrase", "size").agg(F.sum("a").alias("a"))
    return materialize(summed.where(F.col("a") >= least))


def best_cuts(phrases: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the lowest-scoring cut of each phrase, ties to the shortest first part."""
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select(
        "lang",
        "phrase",
        "a",
        "k",
        F.expr("substring_index(phrase, ' ', k)").alias("first"),
        F.expr("substring_index(phrase, ' ', k - size)").alias("rest"),
    )
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    joined = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    exact = "cast({} as decimal(18, 0))"  # products have up to 37 digits
    score = f"({exact.format('1000 * a')} * {exact.format('n')}) div ({exact.format('l')} * {exact.format('r')})"
    lowest = F.min(F.struct(F.expr(score).cast("long").alias("score"), "k", "l", "r")).alias("cut")
    best = joined.groupBy("lang", "phrase", "a", "n").agg(lowest)
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def maximal(phrases: DataFrame) -> DataFrame:
    """Phrases that no longer phrase with the same count contains.

    A phrase between the two has the same count as well, so it is enough to look
    at phrases of one word more.
    """
    inner = F.array(
        F.expr("substring_index(phrase, ' ', size - 1)"), F.expr("substring_index(phrase, ' ', 1 - size)")
    )
    contained = phrases.where("size > 2").select("lang", "a", F.explode(inner).alias("phrase"))
    return phrases.join(contained, ["lang", "phrase", "a"], "left_anti")


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, width: int = FILTER_BITS, limit: int = ROUTED_ROWS
) -> DataFrame:
    """The ``top`` best-scoring phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``a``, ``l`` and ``r`` count the phrase and both parts of its lowest-scoring
    cut, ``n`` all words of the language; score is the whole part of
    1000 a n / (l r).  Ties go to the larger ``a``, then to the bytewise smaller
    phrase.  NULL texts are empty, a NULL lang is ``und``; repeated rows count
    each; an empty table gives no rows; columns other than lang and text are
    never looked at.  Texts are read whole, a piece at a time at least.
    """
    texts = _texts(docs)
    tallied = word_counts(texts, least)
    words = tallied.where(F.col("phrase").isNotNull())
    totals = tallied.where(F.col("phrase").isNull()).select("lang", "n")
    known = word_filter(words, width)
    likely = pair_filter(texts, known, least, width)
    phrases = phrase_counts(suffixes(texts, known, likely), least, limit)
    counts = words.unionByName(phrases.select("lang", "phrase", F.col("a").alias("n")))
    scored = best_cuts(maximal(phrases), counts, totals)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
