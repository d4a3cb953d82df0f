"""Exact de-duplication by deterministic block naming.

Texts are cut into blocks of ``BLOCK_BYTES`` bytes.  Grouping sorts the blocks
and gives every distinct one an integer name: the address of its first
occurrence, which no other content can have.  Adjacent names are then named in
pairs, level by level, until each document is left with one name.  Documents
that finish on the same level have the same name exactly if their texts are the
same bytes; no fingerprint decides anything.

Cost: the blocks cross the network twice (naming, and looking the names up);
every further level moves half as many integers as the one before.  A block
that many documents share is combined on the map side when it is named, and
looked up by a plain equi-join, which adaptive execution splits where it is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import unused_name
from eventlens.session import materialize

BLOCK_BYTES = 512
KEY = ["doc_id", "tag"]


def _address(position: Column) -> Column:
    """An integer for a place: the document in the high digits, the position in the low ones."""
    document = F.coalesce(F.col("doc_id").cast("decimal(38,0)"), F.lit("-9223372036854775809").cast("decimal(38,0)"))
    # A text has fewer than 2 ** 23 blocks; the other bits tell texts of one doc_id apart.
    tag = F.col("tag").bitwiseAND(F.lit(2**38 - 1))
    low = F.shiftleft(tag, 23).bitwiseOR(position.cast("long"))
    scale = F.lit(str(2**61)).cast("decimal(38,0)")
    return (document * scale + low.cast("decimal(38,0)")).cast("decimal(38,0)")


def _blocks(docs: DataFrame) -> DataFrame:
    """A row per block, the first with the text's SHA-256; an empty or NULL text is one empty block."""
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), data.alias("data"))
    rows = rows.withColumn("sha", F.unhex(F.sha2("data", 256))).withColumn("tag", F.xxhash64("sha"))
    starts = F.sequence(F.lit(1), F.greatest(F.length("data"), F.lit(1)), F.lit(BLOCK_BYTES))
    pieces = F.transform(starts, lambda s: F.substring(F.col("data"), s, F.lit(BLOCK_BYTES)))
    placed = rows.select(*KEY, "sha", F.posexplode(pieces).alias("position", "block"))
    return placed.withColumn("sha", F.when(F.col("position") == 0, F.col("sha")))


def _named(places: DataFrame, content: list[str]) -> DataFrame:
    """Per document, the names of its places in order, and how often the row occurs.

    ``places`` has the document's key, ``position`` and the ``content`` columns;
    ``copies`` counts identical rows of the input, ``sha`` is in the first place only.
    """
    names = places.groupBy(*content).agg(F.min(_address(F.col("position"))).alias("name"))
    looked_up = places.join(names, content)
    return (
        looked_up.groupBy(*KEY)
        .agg(
            F.array_sort(F.collect_set(F.struct("position", "name"))).alias("found"),
            F.sum(F.when(F.col("position") == 0, F.col("copies"))).alias("copies"),
            F.max("sha").alias("sha"),
        )
        .select(*KEY, "sha", "copies", F.transform("found", lambda x: x["name"]).alias("names"))
    )


def _pairs(level: DataFrame) -> DataFrame:
    """Adjacent names side by side; the last of an odd number stands alone with -1 below every address."""
    alone = F.lit("-99999999999999999999999999999999999999").cast("decimal(38,0)")
    starts = F.sequence(F.lit(1), F.size("names"), F.lit(2))
    pairs = F.transform(
        starts,
        lambda i: F.struct(
            F.element_at("names", i).alias("left"),
            F.coalesce(F.try_element_at(F.col("names"), i + 1), alone).alias("right"),
        ),
    )
    rows = level.select(*KEY, "sha", "copies", F.posexplode(pairs).alias("position", "pair"))
    first = F.when(F.col("position") == 0, F.col("sha")).alias("sha")
    return rows.select(*KEY, first, "copies", "position", "pair.left", "pair.right")


def identities(docs: DataFrame) -> DataFrame:
    """One row per distinct (doc_id, text): its key, ``sha``, ``copies``, and the identity ``(level, name)``."""
    blocks = _blocks(docs).withColumn("copies", F.lit(1).cast("long"))
    level, depth = materialize(_named(blocks, ["block"])), 0
    done = []
    while True:
        ready = F.size("names") == 1
        done.append(
            level.where(ready).select(*KEY, "sha", "copies", F.lit(depth).alias("level"), F.element_at("names", 1).alias("name"))
        )
        rest = level.where(~ready)
        if rest.isEmpty():
            break
        level, depth = materialize(_named(_pairs(rest), ["left", "right"])), depth + 1
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Group the documents whose texts are identical; of a group the largest ``doc_id`` stays.

    Returns a row for each row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256.  A NULL text counts as empty.  A NULL doc_id is smaller than all
    others.  Of rows that repeat both doc_id and text one stays; all count in
    group_size.  Other columns of ``docs`` are ignored.
    """
    rows = identities(docs)
    groups = rows.groupBy("level", "name").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    joined = rows.join(groups, ["level", "name"])
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("nth")
    return joined.select("*", each).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; repeated rows stay once.

    NULLs as in ``exact_duplicates``; an empty table stays empty; the columns may
    have any names.
    """
    rows = materialize(identities(docs))
    groups = rows.groupBy("level", "name").agg(F.max("doc_id").alias("keep_id"))
    kept = rows.join(groups, ["level", "name"]).where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    sha, doc, key = (unused_name(docs, n) for n in ("sha", "doc", "key"))
    marked = docs.withColumn(sha, F.unhex(F.sha2(F.coalesce(F.col("text").cast("binary"), F.lit(b"")), 256)))

    def staying(chosen: DataFrame) -> DataFrame:
        keys = chosen.select(F.col("doc_id").alias(doc), F.col("sha").alias(key))
        same = marked["doc_id"].eqNullSafe(keys[doc]) & (marked[sha] == keys[key])
        return marked.join(keys, same, "left_semi")

    once = staying(kept.where("copies = 1")).drop(sha)
    repeated = kept.where("copies > 1")
    if repeated.isEmpty():
        return once
    return once.unionByName(staying(repeated).dropDuplicates(["doc_id", sha]).drop(sha))
