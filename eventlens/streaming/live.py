"""The event operators on live streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventlens.functions.pii import Redactor
from eventlens.functions.timerange import interval, slice_length
from eventlens.operators.aggregates import percentiles
from eventlens.operators.redact import redact
from eventlens.session import materialize, temporary_scratch
from eventlens.streaming.daily import DailyTable


def with_watermark(stream: DataFrame, delay: str, ts: str = "ts") -> DataFrame:
    """Event time with a bound on lateness; naive timestamps are taken as UTC.

    Needs a session in UTC for naive timestamps, as ``build_session`` makes it.
    """
    if isinstance(stream.schema[ts].dataType, T.TimestampNTZType):
        stream = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return stream.withWatermark(ts, interval(slice_length(delay)))


def live_slices(
    stream: DataFrame,
    slice: str,
    watermark: str,
    by: Sequence[str] = (),
    aggs: Sequence[Column] = (),
    slide: str | None = None,
) -> DataFrame:
    """Time slices of a stream; rows later than the watermark are dropped.

    In append mode each slice comes out once, when the watermark has passed its
    end.  State per key is one partial aggregate per open slice.
    """
    step = interval(slice_length(slide)) if slide else None
    window = F.window("ts", interval(slice_length(slice)), step)
    aggs = list(aggs) or [F.count("*").alias("n")]
    grouped = with_watermark(stream, watermark).groupBy(window.alias("_window"), *by).agg(*aggs)
    return grouped.select(
        F.col("_window.start").alias("slice_start"),
        F.col("_window.end").alias("slice_end"),
        *[c for c in grouped.columns if c != "_window"],
    )


def dedup(stream: DataFrame, watermark: str, keys: Sequence[str] = ("event_id",)) -> DataFrame:
    """Drop repeated deliveries; state holds the ids of the watermark span only."""
    return with_watermark(stream, watermark).dropDuplicatesWithinWatermark(list(keys))


def live_redaction(stream: DataFrame, redactor: Redactor = Redactor(), **options: Sequence[str]) -> DataFrame:
    """Redaction is stateless, so the batch operator applies as it is."""
    return redact(stream, redactor, **options)


def append_to(stream: DataFrame, path: str, checkpoint: str, by_day: str | None = None, **trigger) -> StreamingQuery:
    """Exactly-once parquet sink; ``by_day`` names a timestamp to partition by."""
    writer = stream
    if by_day is not None:
        writer = stream.withColumn("event_date", F.to_date(by_day))
    sink = writer.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if by_day is not None:
        sink = sink.partitionBy("event_date")
    return sink.outputMode("append").trigger(**(trigger or {"availableNow": True})).start()


def live_percentiles(
    stream: DataFrame,
    slice: str,
    watermark: str,
    column: str,
    points: dict[str, float],
    path: str,
    checkpoint: str,
    by: Sequence[str] = (),
    slide: str | None = None,
    **trigger,
) -> StreamingQuery:
    """Exact percentiles of each slice, written to ``path`` once the watermark has closed it.

    The state holds one count per slice, key and value, spread over all tasks; no
    row of it grows with the slice.  The counts of a closed slice come out in one
    micro-batch, in which the ranks are found by the batch operator, so a slice
    is never in one task either.  A batch that is retried replaces its own files.
    ``closed_slices`` reads the result: slice_start, slice_end, the keys, ``n``
    (all events) and the points (NULL without a value).
    """
    values = stream.select("ts", *by, F.col(column).cast("double").alias("_value"))
    counted = live_slices(values, slice, watermark, [*by, "_value"], slide=slide)
    group = ["slice_start", "slice_end", *by]

    def save(batch: DataFrame, batch_id: int) -> None:
        with temporary_scratch(batch.sparkSession):
            # The rank selection reads the counts several times; the stream must run once.
            closed = materialize(batch)
            if not closed.isEmpty():
                found = percentiles(closed, group, "_value", points, [F.sum("n").alias("n")], weight="n")
                _closed(batch.sparkSession, path, group).save(found, batch_id)

    return (
        counted.writeStream.outputMode("append")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _closed(spark: SparkSession, path: str, keys: Sequence[str]) -> DailyTable:
    return DailyTable(spark, path, "slice_start", keys)


def closed_slices(spark: SparkSession, path: str, points: Sequence[str], by: dict[str, str] | None = None) -> DataFrame:
    """The slices ``live_percentiles`` has written; ``by`` gives the types of its keys."""
    by = by or {}
    fields = [T.StructField("slice_start", T.TimestampType()), T.StructField("slice_end", T.TimestampType())]
    fields += [T.StructField(k, T.DataType.fromDDL(kind)) for k, kind in by.items()]
    fields += [T.StructField("n", T.LongType()), *[T.StructField(p, T.DoubleType()) for p in points]]
    return _closed(spark, path, ["slice_start", "slice_end", *by]).read(T.StructType(fields))
