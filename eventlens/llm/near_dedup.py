"""Near-duplicates by MinHash, with odd sketches to sort candidates out and full sets to confirm them.

A document is the set of its word shingles.  Its MinHash values are cut into
bands; documents that agree in a band share a bucket.  The values are also
folded into an odd sketch, a bitmap that keeps the parity of the values hashed
to each bit: the bits in which two sketches differ tell how many values differ,
and so the similarity, most precisely where it is high.  What the sketches let
through is confirmed on the full sets, so every link is exact.

Documents with equal sets are one node from the start.  Within a bucket nodes are
first compared with the bucket's smallest node only, which ties most groups
together with a link per node.  Nodes of a bucket that are still apart are then
compared with all others there, in blocks, by sketch, which names the nodes that
may be linked to another component.  Those are compared by their full sets, in
blocks again, and a block returns no more links than it takes to tie its
components together.  Nothing is given up on, and no group is ever spelled out
in pairs.

A pair of similarity 0.85 misses every band with a probability of about 1e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from eventlens.llm.common import (
    BROADCAST_ROWS,
    WordHashes,
    frames,
    in_order,
    mix,
    multipliers,
    returning_memory,
    text_tag,
    unused_name,
    window_hashes,
    words_of,
)
from eventlens.llm.components import components
from eventlens.session import materialize

SHINGLE = 3
PERCENT = 85
BANDS, ROWS = 28, 5
SKETCH_BITS = 1024
# Five standard deviations of the estimate below the threshold.
SKETCH_LEAST = 0.68
LEFT_BLOCK, RIGHT_BLOCK = 512, 2048
BLOCK_SHINGLES = 2_000_000  # of each side of a block
COMPARED = 1 << 14  # pairs of sketches, and
SHINGLE_BLOCK = 1024  # shingles, looked at in one step
NO_ID = -(2**63)

_HASHES = BANDS * ROWS
_FACTORS = multipliers(64, seed=9)
_PERMUTATIONS = multipliers(_HASHES, seed=90)
_IN_BAND = multipliers(ROWS, seed=91)
_BAND_SALT = multipliers(BANDS, seed=92)
_SKETCH_SALT = multipliers(_HASHES, seed=93)
_WORDS = SKETCH_BITS // 64


def shingles(text: str | None, hashes_of: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct shingles of a text, sorted; of the whole text if it has fewer words."""
    words = words_of(text.lower() if text and text.isascii() else _ascii_lower(text))
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = hashes_of.of(words)
    if len(words) < size:
        # Marked by their number of words, so that they differ from longer shingles.
        mark = np.uint64(len(words) * int(_FACTORS[-1]) % 2**64)
        return mix(window_hashes(hashes, len(words), _FACTORS) + mark)
    return np.unique(window_hashes(hashes, size, _FACTORS))


def _ascii_lower(text: str | None) -> str | None:
    return text.encode("utf-8").lower().decode("utf-8") if text else text


def minhash(found: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each of ``BANDS * ROWS`` permutations of 64-bit numbers."""
    least = np.full(_HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(found), 2048):
        products = _PERMUTATIONS[:, None] * found[None, at : at + 2048]
        np.minimum(least, products.min(axis=1), out=least)
    return least


def band_keys(values: np.ndarray) -> np.ndarray:
    rows = (mix(values).reshape(BANDS, ROWS) * _IN_BAND).sum(axis=1, dtype=np.uint64)
    return mix(rows + _BAND_SALT)


def odd_sketch(values: np.ndarray) -> np.ndarray:
    """Parity of the MinHash values that fall on each bit, as 64-bit words."""
    bits = (mix(values * _SKETCH_SALT + _SKETCH_SALT) % np.uint64(SKETCH_BITS)).astype(np.int64)
    parity = (np.bincount(bits, minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(parity).view(np.uint64)


def estimate(differing: np.ndarray) -> np.ndarray:
    """Similarity of two sets from the number of bits in which their sketches differ."""
    apart = np.minimum(2.0 * differing / SKETCH_BITS, 0.999999)
    return 1.0 + SKETCH_BITS / (4.0 * _HASHES) * np.log1p(-apart)


def _differing_bound(least: float) -> int:
    """The most bits two sketches may differ in for an estimate of ``least``."""
    return int(np.flatnonzero(estimate(np.arange(SKETCH_BITS // 2)) >= least)[-1])


DESCRIBED = "doc_id long, tag long, n_shingles long, digest binary, keys array<long>, sketch array<long>"


def describe(docs: DataFrame) -> DataFrame:
    """Tag of the text, and size, digest, band keys and odd sketch of its shingle set; the last three NULL for an empty set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes_of = WordHashes()

        def row(text: str | None) -> tuple:
            found = shingles(text, hashes_of)
            if not len(found):
                return 0, None, None, None
            values = minhash(found)
            return len(found), digest_of(found), band_keys(values).view(np.int64), odd_sketch(values).view(np.int64)

        def build(batch: pd.DataFrame) -> pd.DataFrame:
            rows = [row(text) for text in batch["text"]]
            result = pd.DataFrame(rows, columns=["n_shingles", "digest", "keys", "sketch"])
            result.insert(0, "doc_id", batch["doc_id"].array)
            result.insert(1, "tag", batch["tag"])
            return result

        yield from frames(batches, build)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_tag(F.col("text")).alias("tag"), "text")
    return rows.mapInPandas(returning_memory(run), DESCRIBED)


def digest_of(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def _known(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(NO_ID))


def _sets(docs: DataFrame, wanted: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles) of the nodes named by ``wanted``, from a document that has the set."""
    named = materialize(wanted.join(nodes.select("node", "doc", "digest"), "node"))
    few = named.count() <= BROADCAST_ROWS
    rows = docs.select(_known(F.col("doc_id")).alias("doc"), "text").join(F.broadcast(named) if few else named, "doc")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes_of = WordHashes()
        for batch in batches:
            found = [shingles(t, hashes_of) for t in batch["text"]]
            # Other texts with the same doc_id have other sets.
            same = np.array([digest_of(f) == d for f, d in zip(found, batch["digest"], strict=True)], dtype=bool)
            if same.any():
                sets = [f.view(np.int64) for f, is_same in zip(found, same, strict=True) if is_same]
                yield pd.DataFrame({"node": batch["node"].to_numpy()[same], "shingles": sets})

    sets = rows.mapInPandas(returning_memory(run), "node long, shingles array<long>")
    return sets.groupBy("node").agg(F.first("shingles").alias("shingles"))


def confirm(docs: DataFrame, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = materialize(_sets(docs, wanted, nodes))
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    union = F.size("of_a") + F.size("of_b") - F.col("common")
    joined = pairs.select("a", "b").join(left, "a").join(right, "b").withColumn("common", common)
    return joined.where(100 * F.col("common") >= PERCENT * union).select("a", "b")


def _promising(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs whose sizes and sketches allow the wanted similarity."""
    one = nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sketch").alias("s_a"))
    two = nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sketch").alias("s_b"))
    differing = F.aggregate(
        F.zip_with("s_a", "s_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, n: s + n
    )
    sizes = 100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")
    joined = pairs.join(one, "a").join(two, "b").where(sizes)
    return joined.where(differing <= _differing_bound(SKETCH_LEAST)).select("a", "b")


def _involved(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The nodes of a block that have a promising partner in another component."""
    left, right = rows[rows["apart"]], rows[~rows["apart"]]
    if not len(left) or not len(right):
        return pd.DataFrame({"bucket": [], "node": []}, dtype=np.int64)
    bound = _differing_bound(SKETCH_LEAST)
    ours, theirs = (np.stack(part["sketch"].to_numpy()).view(np.uint64) for part in (left, right))
    n_left, n_right = left["n_shingles"].to_numpy(), right["n_shingles"].to_numpy()
    c_left, c_right = left["component"].to_numpy(), right["component"].to_numpy()
    step = max(1, COMPARED // len(right))
    any_left, any_right = np.zeros(len(left), dtype=bool), np.zeros(len(right), dtype=bool)
    for at in range(0, len(left), step):
        part = slice(at, at + step)
        fits = c_left[part, None] != c_right
        fits &= 100 * np.minimum(n_left[part, None], n_right) >= PERCENT * np.maximum(n_left[part, None], n_right)
        fits &= np.bitwise_count(ours[part, None] ^ theirs).sum(axis=2, dtype=np.int64) <= bound
        any_left[part] |= fits.any(axis=1)
        any_right |= fits.any(axis=0)
    nodes = np.union1d(left["node"].to_numpy()[any_left], right["node"].to_numpy()[any_right])
    return pd.DataFrame({"bucket": np.full(len(nodes), key[0], dtype=np.int64), "node": nodes})


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets on the left with all on the right."""
    shared = np.intersect1d(np.concatenate(right), np.concatenate(left))
    result = np.zeros((len(left), len(right)), dtype=np.int64)

    def cells(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        flat = np.concatenate(sets)
        at = np.minimum(np.searchsorted(shared, flat), max(len(shared) - 1, 0))
        known = shared[at] == flat if len(shared) else np.zeros(len(flat), dtype=bool)
        order = np.argsort(at[known], kind="stable")
        return owner[known][order], at[known][order]

    (owner_l, at_l), (owner_r, at_r) = cells(left), cells(right)
    for first in range(0, len(shared), SHINGLE_BLOCK):
        width = min(SHINGLE_BLOCK, len(shared) - first)
        tables = []
        for owner, at, n in ((owner_l, at_l, len(left)), (owner_r, at_r, len(right))):
            low, high = np.searchsorted(at, (first, first + width))
            one = np.zeros((n, width), dtype=np.float32)
            one[owner[low:high], at[low:high] - first] = 1.0
            tables.append(one)
        result += (tables[0] @ tables[1].T).astype(np.int64)  # whole numbers, so exact
    return result


def _ties(_: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Links of a block, by full sets, that tie its components together; no two of them tie the same."""
    left, right = rows[rows["apart"]], rows[~rows["apart"]]
    found = []
    if len(left) and len(right):
        sets_l, sets_r = (
            [np.asarray(s, dtype=np.int64).view(np.uint64) for s in part["shingles"]] for part in (left, right)
        )
        sizes_l, sizes_r = (np.array([len(s) for s in sets]) for sets in (sets_l, sets_r))
        names, numbers = np.unique(np.r_[left["component"], right["component"]], return_inverse=True)
        c_left, c_right = numbers[: len(left)], numbers[len(left) :]
        n_left, n_right = left["node"].to_numpy(), right["node"].to_numpy()
        # Everything that is tied to a component carries the same mark.
        marks = np.arange(len(names))
        common = _common(sets_l, sets_r)
        union = sizes_l[:, None] + sizes_r - common
        linked = (100 * common >= PERCENT * union) & (c_left[:, None] != c_right)
        for k in np.flatnonzero(linked.any(axis=1)).tolist():
            partners = np.flatnonzero(linked[k])
            # One partner for each component that is not tied to this one yet.
            _, one = np.unique(marks[c_right[partners]], return_index=True)
            for p in partners[one].tolist():
                own, other = marks[c_left[k]], marks[c_right[p]]
                if own != other:
                    found.append((n_left[k], n_right[p]))
                    marks[marks == other] = own
    return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)


def _blocks(rows: DataFrame, columns: list[str]) -> GroupedData:
    """The nodes of each bucket that are apart from its main component, set against all of its nodes, block by block.

    ``rows`` has bucket, node, n_shingles, apart and ``columns``.  A block has
    about ``LEFT_BLOCK`` and ``RIGHT_BLOCK`` nodes at most, fewer where sets are large.
    """
    weight, strays = F.col("n_shingles"), F.col("apart").cast("long")
    parts = rows.groupBy("bucket").agg(
        F.ceil(F.greatest(F.sum(strays) / F.lit(LEFT_BLOCK), F.sum(strays * weight) / F.lit(BLOCK_SHINGLES))).cast("int").alias("lefts"),
        F.ceil(F.greatest(F.count("*") / F.lit(RIGHT_BLOCK), F.sum(weight) / F.lit(BLOCK_SHINGLES))).cast("int").alias("rights"),
    )
    rows = rows.join(parts.where("lefts > 0"), "bucket")
    spread = F.xxhash64("node")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.where("apart").select(
        "*", F.pmod(spread, F.col("lefts")).cast("int").alias("i"), every("rights").alias("j")
    )
    right = rows.withColumn("apart", F.lit(False)).select(
        "*", every("lefts").alias("i"), F.pmod(spread, F.col("rights")).cast("int").alias("j")
    )
    names = ["bucket", "i", "j", "apart", "node", *columns]
    return left.select(*names).unionByName(right.select(*names)).groupBy("bucket", "i", "j")


def _remaining_links(docs: DataFrame, members: DataFrame, labels: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (a, b) that tie all components with a link between two nodes of one bucket."""
    placed = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = materialize(placed)
    buckets = placed.groupBy("bucket").agg(
        F.mode("component", deterministic=True).alias("main"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
    )
    mixed = buckets.where("low <> high").select("bucket", "main")
    rows = placed.join(mixed, "bucket").withColumn("apart", F.col("component") != F.col("main")).drop("main")
    described = nodes.select("node", "n_shingles", "sketch")
    rows = materialize(rows.join(nodes.select("node", "n_shingles"), "node"))
    blocks = _blocks(rows.join(described.drop("n_shingles"), "node"), ["n_shingles", "component", "sketch"])
    involved = blocks.applyInPandas(_involved, "bucket long, node long").distinct()
    rows = materialize(rows.join(involved, ["bucket", "node"]))
    sets = materialize(_sets(docs, rows.select("node").distinct(), nodes))
    blocks = _blocks(rows.join(sets, "node"), ["component", "shingles"])
    return blocks.applyInPandas(_ties, "a long, b long").distinct()


def link_components(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, component) of the nodes that are tied to others.

    ``nodes`` has node, n_shingles, keys and sketch, one row for each set, its
    digest, and ``doc``, the smallest doc_id of the documents that have it.
    """
    entries = nodes.select(F.explode("keys").alias("key"), "node")
    buckets = entries.groupBy("key").agg(
        F.count("*").alias("size"), F.min("node").alias("hub"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("who")
    )
    # Bands often gather the same nodes: one bucket stands for all with equal members.
    buckets = buckets.where("size > 1").groupBy("size", "who", "hub").agg(F.min("key").alias("key"))
    buckets = materialize(buckets)
    members = materialize(entries.join(buckets.select("key", "hub"), "key").select(F.col("key").alias("bucket"), "hub", "node"))
    stars = members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    tested = materialize(_promising(stars, nodes))
    labels = materialize(components(confirm(docs, tested, nodes)))

    links = materialize(_remaining_links(docs, members.select("bucket", "node"), labels, nodes))
    if links.isEmpty():
        return labels
    # Tie the components, not the nodes, and hand the new names down.
    of = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"{c}_is"))
    joined = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    ties = joined.select(F.coalesce("a_is", "a").alias("a"), F.coalesce("b_is", "b").alias("b"))
    renamed = materialize(components(ties)).select(F.col("node").alias("component"), F.col("component").alias("now"))
    old = labels.join(renamed, "component", "left").select("node", F.coalesce("now", "component").alias("component"))
    new = renamed.select(F.col("component").alias("node"), F.col("now").alias("component"))
    return materialize(old.unionByName(new.join(labels, "node", "left_anti")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Components of near-duplicate documents, one row for each row of ``docs``.

    Returns doc_id, n_shingles, component_id (the smallest doc_id reachable by
    links of at least ``PERCENT`` percent similarity, itself included) and kept
    (doc_id = component_id).  A NULL text, or one without words, is linked with
    nothing.  Repeated rows share their component and are kept or not alike.  A
    NULL doc_id is smaller than all others.  Other columns are ignored.
    """
    return _placed(docs).drop("tag")


def _placed(docs: DataFrame) -> DataFrame:
    """``near_duplicates`` with the tag of each row's text."""
    described = materialize(describe(docs))
    sets = described.where(F.col("digest").isNotNull()).groupBy("digest")
    nodes = sets.agg(
        F.min(_known(F.col("doc_id"))).alias("doc"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("keys").alias("keys"),
        F.first("sketch").alias("sketch"),
    )
    # A node is a set, whichever documents have it: its number is its place in the order of the digests.
    nodes = in_order(nodes, "node", "digest")
    labels = link_components(docs, nodes)
    members = nodes.select("digest", "doc", "node").join(labels, "node", "left")
    members = materialize(members.select("digest", "doc", F.coalesce("component", "node").alias("component")))
    smallest = members.groupBy("component").agg(F.min("doc").alias("smallest"))
    placed = members.join(smallest, "component").select("digest", "smallest")
    rows = described.select("doc_id", "tag", "n_shingles", "digest").join(placed, "digest", "left")
    component = F.coalesce("smallest", _known(F.col("doc_id")))
    component = F.when(component != NO_ID, component)
    return rows.select(
        "doc_id",
        "tag",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: the smallest doc_id of each component, with all their columns.

    Rows without a word stay, repeated rows alike, and so do rows that share the
    smallest doc_id of their component.  An empty table stays empty; the columns
    may have any names.
    """
    kept = _placed(docs).where("kept").select("doc_id", "tag").distinct()
    doc, tag = unused_name(docs, "kept_doc"), unused_name(docs, "kept_tag")
    kept = kept.select(_known(F.col("doc_id")).alias(doc), F.col("tag").alias(tag))
    marked = docs.withColumns({doc: _known(F.col("doc_id")), tag: text_tag(F.col("text"))})
    return marked.join(kept, [doc, tag], "left_semi").select(*docs.columns)
