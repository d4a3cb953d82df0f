"""Merkle manifest of a document table by slot pivot.

Every row is a leaf: the SHA-256 of its fields, each with its length, so that no
two different rows write the same bytes.  The leaves of a source, in order, are
hashed in runs of ``fanout`` neighbours until one node remains, the subroot; the
subroots, in order of their sources, are hashed likewise into the root.

One level is one aggregate: the place of a node, divided by the fanout, gives its
parent and its slot, and a conditional aggregate per slot spreads the children of
a parent into columns.  All columns put together are hashed into the parent; all
but a child's own are its siblings.  The way down explodes the same rows again,
so siblings need no search, and every join meets three children per parent at
most, however large a source is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import in_order
from eventlens.session import materialize

FANOUT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings on its ``path``."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings on a path, level by level, left to right."""
    steps = F.transform(path, lambda step: F.concat(step["left"], step["right"]))
    return F.sha2(F.array_join(steps, ""), 256)


def _climb(nodes: DataFrame, fanout: int, carried: Sequence[str] = ()) -> tuple[list[DataFrame], DataFrame]:
    """Hash ``tree, place, n, node`` up to one node a tree.

    ``n`` is the number of nodes of the tree on that level.  Gives the pivoted
    rows of every level (one at least), lowest first, and the top nodes.  A tree
    that is down to one node stays as it is while others climb on.
    """
    levels: list[DataFrame] = []
    while True:
        slot = F.col("place") % fanout
        children = [F.max(F.when(slot == s, F.col("node"))).alias(f"child{s}") for s in range(fanout)]
        extra = [
            F.max(F.when(slot == s, F.struct(*carried))).alias(f"extra{s}") for s in range(fanout) if carried
        ]
        parent = F.floor(F.col("place") / fanout).alias("place")
        pivoted = nodes.groupBy("tree", parent, "n").agg(*children, *extra)
        together = F.concat(*[F.coalesce(f"child{s}", F.lit("")) for s in range(fanout)])
        hashed = F.when(F.col("n") == 1, F.col("child0")).otherwise(F.sha2(together, 256))
        levels.append(materialize(pivoted.withColumn("node", hashed)))
        nodes = levels[-1].select("tree", "place", F.ceil(F.col("n") / fanout).alias("n"), "node")
        carried = ()
        if (nodes.agg(F.max("n")).first()[0] or 0) <= 1:
            return levels, nodes


def _descend(levels: list[DataFrame], tops: DataFrame, fanout: int, carried: Sequence[str] = ()) -> DataFrame:
    """From ``tree, place, path`` (and more) of the top nodes to those of the lowest nodes, with their ``node``.

    Each step puts a child's siblings in front of the path of its parent.
    """
    also = [c for c in tops.columns if c not in ("tree", "place", "path")]
    paths = tops
    for depth, level in reversed(list(enumerate(levels))):
        extras = bool(carried) and depth == 0

        def child(s: int, extras: bool = extras) -> Column:
            def siblings(slots: range) -> Column:
                return F.concat(F.lit(""), *[F.coalesce(f"child{i}", F.lit("")) for i in slots])

            step = F.struct(siblings(range(s)).alias("left"), siblings(range(s + 1, fanout)).alias("right"))
            path = F.when(F.col("n") == 1, F.col("path")).otherwise(F.concat(F.array(step), F.col("path")))
            extra = [F.col(f"extra{s}").alias("extra")] if extras else []
            place = (F.col("place") * fanout + s).alias("place")
            whole = F.struct(place, path.alias("path"), F.col(f"child{s}").alias("node"), *extra)
            return F.when(F.col(f"child{s}").isNotNull(), whole)

        children = F.array_compact(F.array(*[child(s) for s in range(fanout)]))
        down = level.drop("node").join(paths.select("tree", "place", "path", *also), ["tree", "place"])
        paths = down.select("tree", *also, F.inline(children))
    return paths.select("*", "extra.*").drop("extra") if carried else paths


def manifest(docs: DataFrame, carry: Sequence[Column] = (), fanout: int = FANOUT) -> DataFrame:
    """The leaf and the path of every row: doc_id, leaf, subroot, root, path, and the ``carry`` columns.

    ``path`` lists the siblings from the leaf's own run up to the root, as
    structs of the hashes left and right of the node; ``fold(leaf, path)`` gives
    ``root``.  Leaves ascend by doc_id, NULL first, equal doc_ids by leaf; sources
    ascend bytewise, NULL first.  Repeated rows are leaves each.  An empty table
    gives an empty manifest, a lone leaf is its own subroot, a lone subroot the
    root.  Columns of ``docs`` other than the five fields are only read by
    ``carry``, whose names must not be doc_id or source.
    """
    if fanout < 2:
        raise ValueError("a fanout below 2 never ends")
    spark = docs.sparkSession
    hashed = materialize(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            leaf_hash(*map(F.col, FIELDS)).alias("node"),
            *carry,
        ).withColumn("row_number", F.monotonically_increasing_id())
    )
    extra = [c for c in hashed.columns if c not in ("source", "node", "row_number")]
    leaves = in_order(hashed, "at", "source", "doc_id", "node", "row_number")
    sizes = leaves.groupBy("source").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    sources = in_order(sizes, "tree", "source")
    placed = leaves.alias("l").join(sources.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source")))
    nodes = placed.select("tree", (F.col("at") - F.col("first")).alias("place"), "n", "node", *extra)
    levels, subroots = _climb(nodes, fanout, extra)

    # The subroots are the leaves of one more tree.
    total = sources.count()
    trunk = subroots.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(total).cast("long").alias("n"), "node"
    )
    upper, top = _climb(trunk, fanout)
    root = top.first()
    no_steps = F.array().cast("array<struct<left:string,right:string>>")
    start = spark.range(1).select(F.col("id").alias("tree"), F.col("id").alias("place"), no_steps.alias("path"))
    tops = _descend(upper, start, fanout).select(
        F.col("place").alias("tree"), F.lit(0).cast("long").alias("place"), "path", F.col("node").alias("subroot")
    )
    found = _descend(levels, materialize(tops), fanout, extra)
    return found.select(
        "doc_id",
        F.col("node").alias("leaf"),
        "subroot",
        F.lit(root["node"] if root else None).cast("string").alias("root"),
        "path",
        *[c for c in extra if c != "doc_id"],
    )


def tampered_leaf() -> Column:
    """The leaf after a text has lost its line feeds, where 2 divides the CRC-32 of doc_id.

    A NULL doc_id counts as the empty text, whose CRC-32 is 0; a NULL text stays.
    """
    hit = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 2 == 0
    changed = hit & F.contains("text", F.lit("\n"))
    others = [F.col(c) for c in FIELDS[:-1]]
    cut = leaf_hash(*others, F.replace("text", F.lit("\n")))
    return F.when(changed, cut).otherwise(leaf_hash(*others, F.col("text")))


def verification(docs: DataFrame) -> DataFrame:
    """The manifest with digests of its proofs, checked against tampered leaves.

    doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.  NULLs, ties
    and empty tables as in ``manifest``.
    """
    rows = manifest(docs, [tampered_leaf().alias("tampered")])
    checked = rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        fold(F.col("tampered"), F.col("path")).alias("folded_root"),
    )
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))
