"""Best-fit packing of tokenised documents into sequences of a fixed length.

Lengths are integers up to the capacity, so the whole instance is described by
one count per length, however many documents there are.  On these counts the
plan is made: pairs and single items that Martello and Toth's dominance
criterion proves to be in some best packing are fixed for good, the instance
shrinks, and what is left is packed best fit, longest first.  Equal bins are
handled together, so the plan has a few bins per length.  The documents are then
numbered within their length, in chunks, and each number has its place in the
plan.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlens.llm.common import returning_memory
from eventlens.session import materialize

CAPACITY = 2048
END_OF_DOCUMENT = 0
CHUNK_ROWS = 2_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

# Marks at the end of a unit, after a letter or digit, are a token of their own:
# the unit has the ids of what comes before and then those of the marks.  Not all
# characters are marks here: an apostrophe may begin a token that goes on with
# letters, and the others stand in the names of special tokens.
_LATIN = rb"\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]"  # accented Latin letters, as UTF-8
_MARK = rb"[!-&(-/:;=?@\[-`{}~]"
_MARKS = re.compile(rb"(%b)(?:(?<=[a-z0-9].)|(?<=%b.))(%b*)(?=\s|\Z)" % (_MARK, _LATIN, _MARK), re.DOTALL)

# Latin letters, as UTF-8: the tokeniser never cuts between them.
_LETTERS = re.compile(rb"(?:[a-z]+|%b)+" % _LATIN)
WORD_END = "</w>"


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their names in a text are ordinary text
    return tokenizer


# Letters only, each kind that ``_LETTERS`` knows.
_PROBE = "the quick brown fox jumps over a lazy dog " + " ".join(chr(n) + "e" + chr(n) for n in range(0xDF, 0x100) if chr(n).isalpha())


@lru_cache(maxsize=2)
def _word_tokenizer(path: str):
    """The tokeniser for lower-case words of letters between spaces, which need no patterns to be told apart."""
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    tokenizer = Tokenizer.from_file(path)
    tokenizer.normalizer = normalizers.Sequence([])
    byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), byte_level])
    ids = [t.encode(_PROBE, add_special_tokens=False).ids for t in (tokenizer, _tokenizer(path))]
    return tokenizer if ids[0] == ids[1] else _tokenizer(path)


class UnitIds:
    """Ids of units of text, as little-endian 32-bit integers, remembered up to ``LIMIT`` units.

    Units are remembered in two halves: when one is full, the older half is
    forgotten, but for units that came up again meanwhile.
    """

    LIMIT = 400_000
    CHUNK_BYTES = 1 << 20
    TOGETHER = 1_000  # units of letters encoded in one call

    def __init__(self, path: str):
        self.tokenizer, self.words = _tokenizer(path), _word_tokenizer(path)
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True

    def _learn(self, units: set[bytes]) -> None:
        missing = units.difference(self.known)  # looks up the units, not all that is known
        if len(self.known) + len(missing) > self.LIMIT // 2:
            self.before, self.known = self.known, {}
            missing = set(units)
        again = {unit: self.before[unit] for unit in missing if unit in self.before}
        self.known.update(again)
        missing.difference_update(again)
        plain = list(filter(_LETTERS.fullmatch, missing))
        for at in range(0, len(plain), self.TOGETHER):
            missing.difference_update(self._learn_together(plain[at : at + self.TOGETHER]))
        others = list(missing)
        encoded = self.tokenizer.encode_batch_fast([u.decode("utf-8") for u in others], add_special_tokens=False)
        for unit, encoding in zip(others, encoded, strict=True):
            self.known[unit] = np.asarray(encoding.ids, dtype="<u4").tobytes()

    def _learn_together(self, units: list[bytes]) -> list[bytes]:
        """Learn units of letters in one call; those it could not tell apart, all or none, are left out.

        Each of them is one word, whose last id alone is that of a word's end.
        """
        text = b" ".join(units).decode("utf-8").lower()
        ids = np.asarray(self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(units) or ends[-1] != len(ids):
            return []
        data, starts = ids.astype("<u4").tobytes(), [0, *ends[:-1].tolist()]
        self.known.update((s, data[4 * a : 4 * b]) for s, a, b in zip(units, starts, ends.tolist(), strict=True))
        return units

    def of(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text.  Only units of about ``CHUNK_BYTES`` of text are looked up at a time."""
        for first, last in _chunks([len(t or "") for t in texts], self.CHUNK_BYTES):
            units = [_MARKS.sub(rb" \1\2", (t or "").encode("utf-8").lower()).split() for t in texts[first:last]]
            self._learn(set().union(*units))
            for one in units:
                yield b"".join(map(self.known.__getitem__, one))


def _chunks(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    first = total = 0
    for i, size in enumerate(sizes):
        total += size
        if total >= limit:
            yield first, i + 1
            first, total = i + 1, 0
    if first < len(sizes):
        yield first, len(sizes)


@lru_cache(maxsize=2)
def _units(path: str) -> UnitIds:
    return UnitIds(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def tokenise(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """The pieces of each document: doc_id, piece, start, length, ids_crc32, and ``ids`` if asked for.

    A document is the ids of its text and one end id; only longer ones than
    ``capacity`` are cut.  NULL and empty texts have the end id alone.  Rows are
    taken one by one, so repeated rows give repeated pieces; other columns are
    ignored.  ``tokenizer`` is a file that every executor can open.
    """
    path = tokenizer or default_tokenizer()
    end = np.array([END_OF_DOCUMENT], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        units = _units(path)
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch["doc_id"], units.of(batch["text"].tolist()), strict=True):
                data = ids + end
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), part))
            result = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
            result["doc_id"] = pd.array([None if pd.isna(r[0]) else int(r[0]) for r in rows], dtype="Int64")
            yield result if with_ids else result.drop(columns="ids")

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInPandas(returning_memory(run), PIECES + (", ids binary" if with_ids else ""))


class Plan:
    """Bins with equal contents, in the order they were made: contents by length, and how many there are."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.bins: list[tuple[tuple[tuple[int, int], ...], int]] = []
        self.fixed = 0

    def add(self, contents: Counter, times: int) -> None:
        if times:
            self.bins.append((tuple(sorted(contents.items(), reverse=True)), times))

    @property
    def sequences(self) -> int:
        return sum(times for _, times in self.bins)


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Bins for ``counts[length]`` items of each length up to ``capacity``."""
    left = {length: n for length, n in counts.items() if n}
    plan = Plan(capacity)
    _reduce(left, capacity, plan)
    plan.fixed = plan.sequences
    _best_fit(left, capacity, plan)
    return plan


def _reduce(left: dict[int, int], capacity: int, plan: Plan) -> None:
    """Fix item sets that dominate every other set with their longest item.

    Longest first, an item is fixed alone if not even the shortest goes with it;
    with the longest item that fits if both fill the bin, since whatever else
    could go with it takes no more than that item; and with the longest that
    fits if no two items go with it.  Each is repeated until nothing changes,
    because a smaller instance lets more sets dominate.
    """
    changed = True
    while changed:
        changed = False
        for length in sorted(left, reverse=True):
            while left.get(length):
                room = capacity - length
                present = sorted(left)
                shortest = [n for n in present[:3] for _ in range(min(2, left[n] - (n == length)))][:2]
                if not shortest or shortest[0] > room:
                    fits = []
                    contents = Counter({length: 1})
                else:
                    at = bisect.bisect_right(present, room) - 1
                    fits = [present[at]]
                    if fits[0] == length and left[length] < 2:
                        fits = [present[at - 1]] if at else []
                    two_fit = len(shortest) == 2 and sum(shortest) <= room
                    if not fits or (fits[0] != room and two_fit):
                        break
                    contents = Counter([length, *fits])
                times = min(left[n] // need for n, need in contents.items())
                _take(left, contents, times)
                plan.add(contents, times)
                changed = True


def _take(left: dict[int, int], contents: Counter, times: int) -> None:
    for length, need in contents.items():
        left[length] -= need * times
        if not left[length]:
            del left[length]


def _best_fit(left: dict[int, int], capacity: int, plan: Plan) -> None:
    """Longest first, into the fullest bin with room; bins with equal contents are filled together."""
    groups: dict[int, list[list]] = {}  # room -> [contents, bins]
    rooms: list[int] = []

    def put(room: int, contents: Counter, bins: int) -> None:
        if not bins:
            return
        if room not in groups:
            groups[room] = []
            bisect.insort(rooms, room)
        groups[room].append([contents, bins])

    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                fill = capacity // length
                full, rest = divmod(n, fill)
                put(capacity - fill * length, Counter({length: fill}), full)
                put(capacity - rest * length, Counter({length: rest}), 1 if rest else 0)
                break
            room = rooms[at]
            contents, bins = groups[room].pop()
            if not groups[room]:
                del groups[room]
                rooms.pop(at)
            fill = room // length
            full = min(bins, n // fill)
            put(room - fill * length, contents + Counter({length: fill}), full)
            n, bins = n - full * fill, bins - full
            if bins and n:  # fewer than fill: one more bin takes them
                put(room - n * length, contents + Counter({length: n}), 1)
                n, bins = 0, bins - 1
            put(room, contents, bins)
    left.clear()
    for room in rooms:
        for contents, bins in groups[room]:
            plan.add(contents, bins)


def _slots(plan: Plan) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first, last, per_bin, base, offset): items first..last-1 of a length, by their number."""
    numbered: Counter = Counter()
    rows, base = [], 0
    for contents, times in plan.bins:
        offset = 0
        for length, need in contents:
            first = numbered[length]
            numbered[length] += need * times
            rows.append((length, first, numbered[length], need, base, offset))
            offset += need * length
        base += times
    return rows


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: every piece has a place of its own in a sequence.

    Only the counts by length, at most ``capacity`` of them, reach the driver.
    Pieces of equal length are interchangeable and are numbered by doc_id and
    piece, so reruns agree, but for rows that are equal in all columns.
    """
    spark = pieces.sparkSession
    pieces = materialize(pieces)
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    if not counts:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    plan = plan_packing(counts, capacity)

    chunks = [(length, -(-n // CHUNK_ROWS)) for length, n in counts.items()]
    by_length = spark.createDataFrame(chunks, "length long, chunks long")
    # At most ``capacity`` rows, and the plan has a few bins for each.
    slots = spark.createDataFrame(
        _slots(plan), "length long, first long, last long, per_bin long, base long, at long"
    )
    where = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("chunks"))
    rows = pieces.join(F.broadcast(by_length), "length").withColumn("chunk", where)
    order = [F.col(c).asc_nulls_first() for c in ("doc_id", "piece", "ids_crc32")]
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("length", "chunk").orderBy(*order)) - 1)
    sizes = rows.groupBy("length", "chunk").count()
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    numbered = rows.join(sizes, ["length", "chunk"]).withColumn("number", F.col("nth") + F.col("before"))
    fits = (F.col("number") >= F.col("first")) & (F.col("number") < F.col("last"))
    slots = slots.withColumnRenamed("length", "_length")
    placed = numbered.join(F.broadcast(slots), (numbered["length"] == slots["_length"]) & fits)
    inside = F.col("number") - F.col("first")
    return placed.select(
        *pieces.columns,
        (F.col("base") + F.floor(inside / F.col("per_bin")).cast("long")).alias("sequence_id"),
        (F.col("at") + (inside % F.col("per_bin")) * F.col("length")).alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise ``docs`` and pack the pieces; see ``tokenise`` and ``pack``."""
    return pack(tokenise(docs, tokenizer, capacity), capacity)
