"""Helpers shared by the training-data operators.

Words are the maximal runs of bytes other than space and ``\\x09-\\x0D``, which
is what ``bytes.split()`` gives for UTF-8; no other character counts as white
space.  A document is told from others by ``doc_id`` and a hash of its text, so
rows that share a ``doc_id`` with different texts do not run together.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.session import materialize

WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8").split() if text else []


def text_tag(text: Column) -> Column:
    """Tells apart the texts of rows that share a ``doc_id``."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def fold(remainder_of: str, modulus: int) -> Column:
    """``crc32`` of a column as text, modulo ``modulus``; NULL counts as the empty text."""
    text = F.coalesce(F.col(remainder_of).cast("string"), F.lit(""))
    return (F.crc32(text) % modulus).cast("int")


class WordHashes(dict):
    """64-bit hash of each word, remembered for the words a task sees often."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def multipliers(length: int, seed: int) -> np.ndarray:
    """Fixed odd 64-bit factors."""
    rng = np.random.Generator(np.random.PCG64(seed))
    return rng.integers(0, 2**63, size=length, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; a bijection, so it adds no collisions."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def window_hashes(hashes: np.ndarray, length: int, factors: np.ndarray) -> np.ndarray:
    """Hash of every window of ``length`` consecutive words; empty if there is none.

    The hash of two windows put end to end follows from theirs, so a window of
    any length is built from windows of powers of two in a few passes.
    """
    if len(hashes) < length:
        return np.empty(0, dtype=np.uint64)
    result, done, span, step = None, 0, hashes, 1
    rest, level = length, 0
    while rest:
        if rest & 1:
            if result is None:
                result, done = span, step
            else:
                n = len(hashes) - done - step + 1
                result = mix(result[:n] * factors[2 * level] + span[done : done + n])
                done += step
        rest >>= 1
        if rest:
            n = len(span) - step
            span = mix(span[:n] * factors[2 * level + 1] + span[step : step + n])
            step *= 2
        level += 1
    return result


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def returning_memory(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for a partition, after which the worker gives what it no longer needs back to the system.

    A Python worker lives on between tasks and stages; without this it keeps the
    most it ever held, beside the JVM of the executor.
    """

    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim is not None:
            trim(0)

    return wrapped


def frames(batches: Iterator[pd.DataFrame], build) -> Iterator[pd.DataFrame]:
    """Apply ``build`` to every batch that has rows."""
    for batch in batches:
        if len(batch):
            yield build(batch)


# Rows of a checked side that are sent whole to every executor; a few ten MB.
BROADCAST_ROWS = 1_000_000


def join_labels(docs: DataFrame, labels: DataFrame, label: str, where: Column) -> DataFrame:
    """``docs`` that have a label, as columns doc_id, text and ``label`` (0 or 1).

    ``where`` picks documents by ``doc_id``.  A document labelled several times
    has the largest label.  Few labels are sent to the documents, so that no text
    moves; more than ``BROADCAST_ROWS`` are joined by shuffle.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .where(where)
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("label"))
    )
    known = materialize(known)
    few = known.count() <= BROADCAST_ROWS
    return docs.select("doc_id", "text").where(where).join(F.broadcast(known) if few else known, "doc_id")


def in_order(rows: DataFrame, name: str, *order: str) -> DataFrame:
    """``rows`` with their place (from 0) in ascending order, NULL first, as a written table.

    The order is made by range, so no task holds more than its stretch; one count
    per partition reaches the driver.
    """
    keys = [F.col(c).asc_nulls_first() for c in order]
    sorted_ = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = materialize(
        sorted_.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    )
    parts = placed.groupBy("_part").agg(F.count("*").alias("n"), F.min("_at").alias("first")).orderBy("_part").collect()
    bases, before = [], 0
    for row in parts:
        bases.append((row["_part"], before - row["first"]))
        before += row["n"]
    bases = rows.sparkSession.createDataFrame(bases, "_part int, _base long")
    return placed.join(F.broadcast(bases), "_part").select(*rows.columns, (F.col("_at") + F.col("_base")).alias(name))


def unused_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    name, n = base, 0
    while name.lower() in taken:
        name, n = f"{base}_{n}", n + 1
    return name
