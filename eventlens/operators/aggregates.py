"""Group-bys, time slices, dense series and exact percentiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlens.functions.timerange import (
    MICROSECOND,
    TimeWindow,
    align_down,
    slice_length,
    slice_start,
    ts_literal,
    within,
)
from eventlens.session import materialize


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def worst_first(df: DataFrame, measure: str, *keys: str) -> DataFrame:
    """Order by a measure, largest first; the keys break ties."""
    return df.orderBy(F.desc(measure), *[F.asc_nulls_last(k) for k in keys])


def top_k(df: DataFrame, k: int, measure: str, *keys: str) -> DataFrame:
    return worst_first(df, measure, *keys).limit(k)


def distinct_values(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct values as rows, so that no group has to fit into one array."""
    return df.select(*by, column).filter(F.col(column).isNotNull()).distinct()


def distinct_count(column: str, approx: bool = False) -> Column:
    """Exact counts deduplicate by (group, value) first, so a hot group is spread out."""
    return F.approx_count_distinct(column) if approx else F.countDistinct(column)


def by_slice(df: DataFrame, slice: str, by: Sequence[str] = (), aggs: Sequence[Column] = (), ts: str = "ts") -> DataFrame:
    """One row per time slice (and key) that has events."""
    aggs = list(aggs) or [F.count("*").alias("n")]
    start = slice_start(slice, ts)
    return df.groupBy(start.alias("slice_start"), *by).agg(*aggs)


# Registers of a distinct-count sketch: 2 ** SKETCH_BITS, for a standard error of 0.8 % in 16 KB at most.
SKETCH_BITS = 14


def distinct_sketches(df: DataFrame, slice: str, column: str, by: Sequence[str] = ()) -> DataFrame:
    """A mergeable sketch of the distinct values per slice (and key), to be stored.

    The distinct count of any range of slices follows from these rows without
    another look at the events.
    """
    return by_slice(df, slice, by, [F.hll_sketch_agg(column, SKETCH_BITS).alias("sketch"), F.count("*").alias("n")])


def distinct_over(sketches: DataFrame, window: TimeWindow, by: Sequence[str] = (), name: str = "distinct") -> DataFrame:
    """Distinct values over the slices that start in ``window``, from stored sketches; within 2.5 % nearly always."""
    scoped = within(sketches, window, "slice_start")
    merged = scoped.groupBy(*by).agg(F.hll_union_agg("sketch").alias("_all"))
    return merged.select(*by, F.coalesce(F.hll_sketch_estimate("_all"), F.lit(0)).alias(name))


# Slots generated from one row at a time.
SLOT_BLOCK = 10_000


def dense_slices(
    series: DataFrame,
    window: TimeWindow,
    slice: str,
    by: Sequence[str] = (),
    fill: Sequence[str] = ("n",),
) -> DataFrame:
    """Add the empty slices of ``window`` to a sliced series, with zeros.

    The slots of each key are generated next to the key, in blocks, so there is
    no join of keys with slots and no long array.  A keyed series is needed
    twice, for its keys and for its values: it is written to the scratch folder
    first, so that the events behind it are scanned once.
    """
    spark = series.sparkSession
    step = slice_length(slice)
    first = align_down(window.start, step)
    count = max(0, -((first - window.end) // step))
    origin = ts_literal(series, first, "slice_start")
    start = F.timestamp_add("MICROSECOND", F.col("_slot") * (step // MICROSECOND), origin)
    if by:
        series = materialize(series)
        blocks = F.sequence(F.lit(0).cast("bigint"), F.lit(max(count - 1, 0)).cast("bigint"), F.lit(SLOT_BLOCK).cast("bigint"))
        keys = series.select(*by).distinct().select(*by, F.explode(blocks).alias("_block"))
        last = F.least(F.col("_block") + SLOT_BLOCK, F.lit(count)) - 1
        slots = keys.select(*by, F.explode(F.sequence("_block", last)).alias("_slot"))
        slots = slots.filter(F.col("_slot") < count)
    else:
        slots = spark.range(count).select(F.col("id").alias("_slot"))
    grid = slots.select(*by, start.alias("slice_start"))
    same = F.col("l.slice_start") == F.col("r.slice_start")
    for k in by:
        same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    values = [
        (F.coalesce(F.col(f"r.{c}"), F.lit(0)) if c in fill else F.col(f"r.{c}")).alias(c)
        for c in series.columns
        if c not in by and c != "slice_start"
    ]
    joined = grid.alias("l").join(series.alias("r"), same, "left")
    return joined.select("l.slice_start", *[F.col(f"l.{k}") for k in by], *values)


# Bits of a value looked at by the first scan (sign, exponent, start of the fraction) and by each further one.
FIRST_BITS, NEXT_BITS = 20, 16
# Rows of a chosen bucket whose values may be ranked one by one.
RANKED_ROWS = 1_000_000


def percentiles(
    df: DataFrame,
    by: Sequence[str],
    column: str,
    points: dict[str, float],
    aggs: Sequence[Column] = (),
    method: str = "narrowed",
    accuracy: int = 10_000,
    weight: str | None = None,
) -> DataFrame:
    """Percentiles (points on 0-100) of ``column`` per group, linearly interpolated.

    * ``narrowed``: exact for groups of any size, see ``_narrowed``.  ``weight``
      names a column that says how often a row counts.
    * ``exact``: the same by Spark's ``percentile``, in one pass, which holds a
      group's distinct values in one task; for groups known to be small.
    * ``approx``: one pass, ``percentile_approx`` with the given accuracy.
    """
    if any(not 0 <= p <= 100 for p in points.values()):
        raise ValueError("percentile points lie between 0 and 100")
    if method == "narrowed":
        return _narrowed(df, list(by), column, points, list(aggs), weight)
    if weight is not None:
        raise ValueError("weights need the narrowed method")
    if method == "exact":
        found = [F.percentile(column, p / 100).alias(name) for name, p in points.items()]
        return df.groupBy(*by).agg(*aggs, *found)
    if method == "approx":
        found = [F.percentile_approx(column, p / 100, accuracy).alias(name) for name, p in points.items()]
        return df.groupBy(*by).agg(*aggs, *found)
    raise ValueError(f"unknown method {method!r}")


def sortable(value: Column) -> Column:
    """A 64-bit integer in the order of a double; both zeros are 0 and NaN is the largest.

    It is the exponent and the fraction of the double put side by side.  All
    steps are exact: only powers of two are divided by and multiplied with.
    """
    size = F.abs(value)
    guess = F.greatest(F.floor(F.log2(size)), F.lit(-1022)).cast("int")
    power = F.pow(F.lit(2.0), guess)
    # The logarithm may be rounded across a power of two.
    exponent = guess - (size < power).cast("int") + (size / 2 >= power).cast("int")
    fraction = size / F.pow(F.lit(2.0), exponent) - 1
    whole, tiny = F.lit(float(2**52)), F.lit(float(2**537))
    bits = (
        F.when(size == 0, F.lit(0).cast("bigint"))
        .when(F.isnan(size), F.lit((2047 << 52) + 1).cast("bigint"))
        .when(size == float("inf"), F.lit(2047 << 52).cast("bigint"))
        .when(size < 2.0**-1022, (size * tiny * tiny).cast("bigint"))
        .otherwise((exponent + 1023).cast("bigint") * (1 << 52) + (fraction * whole).cast("bigint"))
    )
    return F.when(value < 0, -bits).otherwise(bits)


def _same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return same


def _chosen(counted: DataFrame, group: Sequence[str], targets: Column) -> DataFrame:
    """The bucket of ``counted`` (``_at``, ``_c``, ``_least``, ``_most``) that holds each target, and its rank in there."""
    running = Window.partitionBy(*group).orderBy("_at")
    upto = F.sum("_c").over(running.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rank = F.col("_upto") - F.col("_c")
    hits = F.filter("_targets", lambda t: (t["_rank"] >= rank) & (t["_rank"] < F.col("_upto")))
    moved = F.transform(
        hits, lambda t: F.struct(t["_target"].alias("_target"), (t["_rank"] - rank).alias("_rank"), t["_share"].alias("_share"))
    )
    placed = counted.withColumns({"_upto": upto, "_targets": targets})
    kept = [c for c in counted.columns if c != "_targets"]
    return placed.select(*kept, F.inline(moved))


def _narrowed(
    df: DataFrame, by: list[str], column: str, points: dict[str, float], aggs: list[Column], weight: str | None
) -> DataFrame:
    """Exact percentiles by radix selection, without bringing a group into one task.

    A value is read as a 64-bit integer of the same order.  The first scan counts
    the rows of each group by the leading bits, combined map-side, and the wanted
    ranks are located on the running counts.  Every further scan looks at the
    rows inside the chosen buckets only and counts them by the next bits; a
    bucket of few rows is counted by all its bits at once, and a bucket of a
    single value is done.  So there are four scans at most, two as a rule, and
    no task sees more than the counts of 2 ** ``NEXT_BITS`` buckets or
    ``RANKED_ROWS`` values of a group (the first scan: those of its exponents).
    """
    single = not by
    if single:
        df, by = df.withColumn("_all", F.lit(0)), ["_all"]
    others = df.groupBy(*by).agg(*(aggs or [F.count("*").alias("_rows")]))
    # NULL is not a value; NaN is one, the largest, as Spark orders it.
    value = F.col(column).cast("double")
    times = F.lit(1) if weight is None else F.col(weight)
    rows = df.select(*by, value.alias("_v"), times.cast("bigint").alias("_w")).filter(F.col("_v").isNotNull())
    key = sortable(F.col("_v"))
    measures = [F.sum("_w").alias("_c"), F.min("_v").alias("_least"), F.max("_v").alias("_most")]
    shift = 64 - FIRST_BITS
    counted = rows.groupBy(*by, F.shiftright(key, shift).alias("_at")).agg(*measures)
    n = F.sum("_c").over(Window.partitionBy(*by))
    wanted = []
    for i, p in enumerate(points.values()):
        position = F.lit(p / 100) * (n - 1)
        share = position - F.floor(position)
        for j, rank in enumerate((F.floor(position), F.ceil(position))):
            wanted.append(F.struct(F.lit(2 * i + j).alias("_target"), rank.alias("_rank"), share.alias("_share")))
    found = materialize(_chosen(counted, by, F.array(*wanted)))
    alone = F.col("_least") == F.col("_most")
    done = found.filter(alone)
    while True:
        most = found.filter(~alone).agg(F.max("_c")).first()[0]
        if most is None:
            break
        after = 0 if most <= RANKED_ROWS else max(0, shift - NEXT_BITS)
        target = F.struct("_target", "_rank", "_share")
        buckets = found.filter(~alone).groupBy(*by, F.col("_at").alias("_in")).agg(F.collect_list(target).alias("_targets"))
        inside = (
            rows.withColumn("_key", key)
            .alias("l")
            .join(buckets.alias("r"), _same_keys("l", "r", by) & (F.shiftright("l._key", shift) == F.col("r._in")))
            .select("l.*", "r._in", "r._targets")
        )
        finer = inside.groupBy(*by, "_in", F.shiftright("_key", after).alias("_at"))
        counted = finer.agg(*measures, F.first("_targets").alias("_targets"))
        found = _chosen(counted, [*by, "_in"], F.col("_targets")).drop("_in")
        shift = after
        if shift == 0:
            done = done.unionByName(found)
            break
        found = materialize(found)
        done = done.unionByName(found.filter(alone))
    values = {2 * i + j: f"_{i}_{j}" for i in range(len(points)) for j in range(2)}
    ends = done.groupBy(*by).agg(
        *[F.max(F.when(F.col("_target") == t, F.col("_least"))).alias(name) for t, name in values.items()],
        *[F.max(F.when(F.col("_target") == 2 * i, F.col("_share"))).alias(f"_{i}") for i in range(len(points))],
    )
    joined = others.alias("l").join(ends.alias("r"), _same_keys("l", "r", by), "left")

    def between(i: int) -> Column:
        low, high = F.col(f"r._{i}_0"), F.col(f"r._{i}_1")
        return F.when(low == high, low).otherwise(low + (high - low) * F.col(f"r._{i}"))

    return joined.select("l.*", *[between(i).alias(name) for i, name in enumerate(points)]).drop("_all", "_rows")
