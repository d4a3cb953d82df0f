"""Connected components of a link table, by shuffles alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smallest neighbour, or itself, to its larger neighbours."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node ties its smaller neighbours, and itself, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long), the component being its smallest node.

    Alternates large and small stars until the links no longer change, which
    takes about as many rounds as the logarithm of the longest path.  A node with
    many links is combined map-side and joined by key, where skew is split.
    """
    current = materialize(edges.where("a <> b").select("a", "b").distinct())
    state = None
    while True:
        current = materialize(_small_star(_large_star(current).distinct()).where("a <> b").distinct())
        row = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    return (
        current.select(F.col("a").alias("node"), F.col("b").alias("component"))
        .unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("component")))
        .distinct()
    )
