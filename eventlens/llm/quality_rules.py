"""Quality rules on repetition: how much of a text lies inside repeated passages.

For several lengths n, every window of n words gets a rolling 64-bit hash; the
characters of words that lie in a window occurring twice or more are counted
once.  Repeated lines are measured the same way.  The work is one pass over the
documents without a shuffle; all lengths share the hashes of the words, and a
length is only looked at if a shorter one found a repetition, since every
repeated window holds repeated shorter windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import WordHashes, frames, multipliers, window_hashes, words_of

# Share of characters that may lie in repeated windows of n words, and in repeated lines.
WINDOW_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_LIMIT = 0.20
BASE_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"

_FACTORS = multipliers(64, seed=8)

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, dup_line_chars long, "
    + ", ".join(f"dup_chars_{n} long" for n in WINDOW_LIMITS)
)


def repeated_words(hashes: np.ndarray, length: int) -> np.ndarray | None:
    """Which words lie in a window that occurs twice or more; None if no window does."""
    windows = window_hashes(hashes, length, _FACTORS)
    if len(windows) < 2:
        return None
    order = np.sort(windows)
    again = order[1:][order[1:] == order[:-1]]
    if not len(again):
        return None
    starts = np.flatnonzero(np.isin(windows, again))
    edges = np.zeros(len(hashes) + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + length, -1)
    return np.cumsum(edges[:-1]) > 0


def measure(text: str | None, hashes_of: WordHashes) -> tuple:
    """The columns of ``SCHEMA`` after doc_id for one text."""
    text = text or ""
    words = words_of(text)
    n_words = len(words)
    word_chars = len(text) - sum(map(text.count, SPACES))
    n_symbols = sum(map(text.count, SYMBOLS))

    seen: set[str] = set()
    n_dup_lines = dup_line_chars = 0
    if "\n" in text:
        for line in text.split("\n"):
            if line in seen:
                n_dup_lines += 1
                dup_line_chars += len(line) - sum(map(line.count, SPACES))
            elif line.strip(SPACES):
                seen.add(line)

    hashes = hashes_of.of(words)
    sizes = None
    covered: dict[int, int] = {}
    n_repeat_words = 0
    for length in WINDOW_LIMITS:
        inside = repeated_words(hashes, length)
        if inside is None:
            break
        if sizes is None:
            sizes = np.fromiter((len(w.decode("utf-8")) for w in words), dtype=np.int64, count=n_words)
        covered[length] = int(sizes[inside].sum())
        if length == BASE_WINDOW:
            n_repeat_words = int(inside.sum())

    base_failed = n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words
    clean = dup_line_chars <= LINE_LIMIT * word_chars and all(
        covered.get(n, 0) <= limit * word_chars for n, limit in WINDOW_LIMITS.items()
    )
    return (
        n_words,
        word_chars,
        n_symbols,
        n_dup_lines,
        n_repeat_words,
        base_failed,
        clean and not base_failed,
        dup_line_chars,
        *(covered.get(n, 0) for n in WINDOW_LIMITS),
    )


def repetition_report(docs: DataFrame) -> DataFrame:
    """Measures and verdict for each row of ``docs``, in the columns of ``SCHEMA``.

    A NULL text has no words and fails as too short; so does an empty one.  Rows
    that repeat are reported each; NULL doc_ids are passed on; other columns are
    ignored.
    """
    names = [part.split()[0] for part in SCHEMA.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes_of = WordHashes()

        def build(batch: pd.DataFrame) -> pd.DataFrame:
            rows = [measure(text, hashes_of) for text in batch["text"]]
            result = pd.DataFrame(rows, columns=names[1:])
            result.insert(0, "doc_id", batch["doc_id"].array)
            return result

        yield from frames(batches, build)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, SCHEMA)
