"""Mixing sources to target weights by balanced sampling with the cube method.

Every source gets a target; target over size is how often its documents are
taken on average.  The whole part is taken as it is.  The fraction is an
inclusion probability, and the cube method decides it: probabilities move along
the null space of two constraints, words and documents of the source, so both
totals stay what they were while units reach 0 or 1 (flight).  With two
constraints three undecided units always leave a direction to move in, so at
most two stay undecided.

Sources are cut into blocks of ``BLOCK_UNITS`` documents, each of which flies on
its own; what the blocks leave undecided forms the blocks of the next level,
until a source has one block, whose last two units are landed by trying their
four outcomes.  Long documents are decided first, so the last ones are short.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import WORD_PATTERN, in_order, text_tag, unused_name
from eventlens.session import materialize

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_UNITS = 2_048
CLOSE = 1e-9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def _ranked(totals: DataFrame) -> DataFrame:
    """``totals`` with ``rank``, the place of its source by code point, NULL last.

    The order is made by range; only one count per partition reaches the driver.
    """
    order = F.col("source").asc_nulls_last()
    sorted_ = totals.repartitionByRange(order).sortWithinPartitions(order)
    placed = materialize(
        sorted_.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    )
    parts = placed.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("first")).orderBy("part").collect()
    bases, before = [], 0
    for row in parts:
        bases.append((row["part"], before - row["first"]))
        before += row["n"]
    bases = totals.sparkSession.createDataFrame(bases, "part int, base long")
    return placed.join(F.broadcast(bases), "part").select(*totals.columns, (F.col("at") + F.col("base")).alias("rank"))


def source_targets(rows: DataFrame) -> DataFrame:
    """Per source: source_size, docs, rank, and ``target``.

    Weights share the sum of all sizes; no target exceeds ``MAX_REPEATS`` times
    its source, and what is cut off is shared again by weight.  Each round of
    sharing is one aggregate over the sources.
    """
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    weights = F.array(*map(F.lit, WEIGHTS))
    sources = materialize(
        _ranked(totals).withColumn("weight", F.element_at(weights, (F.col("rank") % len(WEIGHTS) + 1).cast("int")))
    )
    cap = MAX_REPEATS * F.col("source_size")
    everything = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    total, level, full = everything[0] or 0, 0.0, 0
    weight = everything[1] or 1
    while True:
        level = (total - full) / weight
        over = cap <= F.col("weight") * level
        row = sources.agg(F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("weight")))).first()
        if (row[0] or 0) == full or not row[1]:
            break
        full, weight = row[0], row[1]
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(float(level)))
    return sources.withColumn("target", target)


def fly(size: list[float], chance: list[float], rng: np.random.Generator) -> None:
    """Decide the units in order, in place, until at most two have a chance other than 0 or 1."""
    pending = [i for i, p in enumerate(chance) if CLOSE < p < 1 - CLOSE]
    draws = iter(rng.random(len(pending) + 1).tolist())
    active: list[int] = []
    at = 0
    while True:
        while len(active) < 3 and at < len(pending):
            active.append(pending[at])
            at += 1
        if len(active) < 3:
            return
        a, b, c = active
        move = (size[b] - size[c], size[c] - size[a], size[a] - size[b])
        if not any(move):
            move = (1.0, -1.0, 0.0)
        up = down = math.inf
        for k, v in zip(active, move, strict=True):
            if v:
                room, used = (1 - chance[k]) / abs(v), chance[k] / abs(v)
                up = min(up, room if v > 0 else used)
                down = min(down, used if v > 0 else room)
        step = up if next(draws) * (up + down) < down else -down
        left = []
        for k, v in zip(active, move, strict=True):
            p = chance[k] + step * v
            # The bound that limited the step is reached, whatever rounding says.
            slack = CLOSE + 1e-12 * abs(step * v)
            chance[k] = 0.0 if p <= slack else 1.0 if p >= 1 - slack else p
            if 0 < chance[k] < 1:
                left.append(k)
        if len(left) == 3:  # rounding on extreme sizes: settle the nearest
            k = min(left, key=lambda i: min(chance[i], 1 - chance[i]))
            chance[k] = float(round(chance[k]))
            left.remove(k)
        active = left


def land(size: list[float], chance: list[float]) -> None:
    """Decide the last units, in place, by the outcome whose words, then documents, are nearest."""
    last = [i for i, p in enumerate(chance) if 0 < p < 1]
    outcomes = [[]]
    for _ in last:
        outcomes = [[*o, x] for o in outcomes for x in (0.0, 1.0)]

    def distance(outcome: list[float]) -> tuple[float, float]:
        moved = [x - chance[i] for i, x in zip(last, outcome, strict=True)]
        return abs(sum(m * size[i] for m, i in zip(moved, last, strict=True))), abs(sum(moved))

    for i, x in zip(last, min(outcomes, key=distance), strict=True):
        chance[i] = x


UNIT = "doc_id long, tag long, rank long, size long, blocks long, block long, chance double"


def _decide_block(key: tuple, units: pd.DataFrame) -> pd.DataFrame:
    rank, block, blocks = (int(v) for v in key)
    ids = units["doc_id"].fillna(-1)
    order = np.lexsort((units["tag"], ids, -units["size"]))
    units = units.iloc[order].reset_index(drop=True)
    size, chance = units["size"].astype(float).tolist(), units["chance"].tolist()
    seed = zlib.crc32(f"{rank}/{block}/{blocks}".encode())
    fly(size, chance, np.random.Generator(np.random.PCG64(seed)))
    if blocks == 1:
        land(size, chance)
    return units.assign(chance=chance)


def decide(units: DataFrame) -> DataFrame:
    """``units`` (``UNIT``; one chance per rank, ``blocks`` for the whole rank) with chance 0 or 1."""
    spread = F.pmod(F.xxhash64("doc_id", "tag", "size"), F.col("blocks"))
    done = []
    while True:
        flown = units.withColumn("block", spread).groupBy("rank", "block", "blocks").applyInPandas(_decide_block, UNIT)
        flown = materialize(flown)
        open_ = (F.col("chance") > 0) & (F.col("chance") < 1)
        done.append(flown.where(~open_))
        left = flown.where(open_)
        if left.isEmpty():
            break
        # Each block leaves two units at most.
        units = left.withColumn("blocks", F.ceil(2 * F.col("blocks") / F.lit(BLOCK_UNITS)).cast("long"))
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def mix_sources(docs: DataFrame) -> DataFrame:
    """How often the mix takes each row of ``docs``.

    Returns doc_id, tag (of the text), source, size (words), source_size, target,
    copies (0 to ``MAX_REPEATS``) and taken (size times copies).  A NULL text has
    no words, a NULL source is a source of its own, the last in order.  A source
    without words has target 0 and no copies.  Rows that repeat count each;
    NULL doc_ids are units like others; other columns are ignored.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_tag(F.col("text")).alias("tag"),
        "source",
        word_count(F.col("text")).alias("size"),
    )
    rows = materialize(rows)
    targets = materialize(source_targets(rows))
    to_join = targets.withColumnRenamed("source", "_source")
    units = rows.join(to_join, rows["source"].eqNullSafe(to_join["_source"]))
    mean = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    units = units.select(
        "doc_id",
        "tag",
        "rank",
        "size",
        F.ceil(F.col("docs") / F.lit(BLOCK_UNITS)).cast("long").alias("blocks"),
        F.lit(0).cast("long").alias("block"),
        (mean - F.floor(mean)).alias("chance"),
    )
    decided = decide(units)
    per_rank = targets.select(
        "rank", "source", "source_size", "target", F.floor(F.coalesce(mean, F.lit(0.0))).cast("long").alias("whole")
    )
    copies = (F.col("whole") + F.col("chance").cast("long")).alias("copies")
    joined = decided.join(per_rank, "rank").select(
        "doc_id", "tag", "source", "size", "source_size", "target", copies
    )
    return joined.withColumn("taken", F.col("size") * F.col("copies"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as the mix takes them, each as often as its copies say, with all their columns.

    NULLs as in ``mix_sources``.  Rows with equal doc_id and text share what was
    taken of them, as evenly as it goes; an empty table stays empty; the columns
    may have any names.
    """
    key, tag, copies, rows, nth, row = (unused_name(docs, n) for n in ("key", "tag", "copies", "rows", "nth", "row"))
    taken = mix_sources(docs).groupBy("doc_id", "tag").agg(F.sum("copies").alias(copies), F.count("*").alias(rows))
    taken = materialize(taken).select(F.col("doc_id").alias(key), F.col("tag").alias(f"{tag}_of"), copies, rows)
    marked = docs.withColumn(tag, text_tag(F.col("text")))
    same = marked["doc_id"].eqNullSafe(taken[key]) & (marked[tag] == taken[f"{tag}_of"])

    def repeated(found: DataFrame, times: Column) -> DataFrame:
        return found.select(*docs.columns, F.explode(F.array_repeat(F.lit(1), times.cast("int"))).alias(nth)).drop(nth)

    once = repeated(marked.join(taken.where(F.col(rows) == 1), same), F.col(copies))
    several = taken.where(F.col(rows) > 1)
    if several.isEmpty():
        return once
    shared = materialize(marked.join(several, same).withColumn(row, F.monotonically_increasing_id()))
    # The place among equal rows, by range: a thousand equal rows need not meet in one task.
    placed = in_order(shared.select(F.col(key).alias("a"), F.col(tag).alias("b"), F.col(row).alias("c")), "at", "a", "b", "c")
    first = placed.groupBy("a", "b").agg(F.min("at").alias("first"))
    nths = placed.alias("l").join(first.alias("r"), F.col("l.a").eqNullSafe(F.col("r.a")) & (F.col("l.b") == F.col("r.b")))
    nths = nths.select(F.col("l.c").alias(row), (F.col("at") - F.col("first")).alias(nth))
    share = F.floor(F.col(copies) / F.col(rows)) + (F.col(nth) < F.col(copies) % F.col(rows)).cast("int")
    return once.unionByName(repeated(shared.join(nths, row), share))
