"""Reading and writing event tables, dimension tables, JSON results and log files."""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlens.functions.text import access_level, lenient_long, log_line, mask_url_query
from eventlens.schema import EVENTS
from eventlens.session import materialize, scratch_dir

TEXT_FORMATS = ("json", "csv", "xml")
PROBE_PATHS = ("/healthz",)


def read_events(
    spark: SparkSession, path: str, format: str = "parquet", schema: T.StructType | None = None, **options: str
) -> DataFrame:
    """An event table.

    Text formats get the declared schema, never an inferred one: inference would
    read everything once more, and a stray value could change a column's type.
    CSV has no nested columns; there they are JSON text.
    """
    reader = spark.read.format(format).options(**options)
    if schema is not None or format in TEXT_FORMATS:
        wanted = schema or EVENTS
        flat = _flat(wanted) if format == "csv" else wanted
        return _unfold(reader.schema(flat).load(path), flat, wanted)
    return reader.load(path)


def _nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ArrayType, T.MapType, T.StructType))


def _flat(schema: T.StructType) -> T.StructType:
    """``schema`` with text in place of nested columns."""
    return T.StructType(
        [T.StructField(f.name, T.StringType() if _nested(f.dataType) else f.dataType, f.nullable) for f in schema.fields]
    )


def _unfold(df: DataFrame, flat: T.StructType, wanted: T.StructType) -> DataFrame:
    if flat == wanted:
        return df
    return df.withColumns(
        {f.name: F.from_json(F.col(f.name), f.dataType) for f in wanted.fields if _nested(f.dataType)}
    )


def stream_events(
    spark: SparkSession, path: str, format: str = "parquet", schema: T.StructType | None = None, **options: str
) -> DataFrame:
    """The same table as a stream of newly arriving files."""
    wanted = schema or EVENTS
    flat = _flat(wanted) if format == "csv" else wanted
    return _unfold(spark.readStream.format(format).schema(flat).options(**options).load(path), flat, wanted)


def map_events(raw: DataFrame, columns: dict[str, Column], schema: T.StructType = EVENTS) -> DataFrame:
    """Project a foreign table to the event schema.

    ``columns`` gives the expression of each known column; the others are typed
    NULLs.  Catalyst drops whatever a query does not use, so the mapping costs
    nothing for unused columns.
    """
    unknown = set(columns) - set(schema.fieldNames())
    if unknown:
        raise ValueError(f"not in the event schema: {', '.join(sorted(unknown))}")
    return raw.select(
        *[
            columns[f.name].alias(f.name) if f.name in columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


# Aimed size of a stored file, and rows written to find out how wide a row is.
FILE_BYTES = 256 << 20
SAMPLE_ROWS = 20_000
# Rows in memory that a task sorts for a file; stored, they may take a twentieth of that.
SORT_BYTES = 256 << 20


def stored_bytes(spark: SparkSession, path: str) -> int:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()


def row_bytes(df: DataFrame, rows: int = SAMPLE_ROWS) -> float:
    """Stored bytes per row, measured on a written sample; 0 for an empty table."""
    sample = materialize(df.limit(rows).coalesce(1))
    n = sample.count()
    return stored_bytes(df.sparkSession, sample.inputFiles()[0]) / n if n else 0.0


def sorted_bytes(df: DataFrame) -> Column:
    """What a row takes in a sort: eight bytes a column and some for the row, then its texts and nested values."""
    width = F.lit(8 * (len(df.columns) + 4))
    for field in df.schema.fields:
        value = F.to_json(F.struct(field.name)) if _nested(field.dataType) else F.col(field.name)
        if _nested(field.dataType) or isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(value), F.lit(0))
    return width.cast("long")


def write_events(
    df: DataFrame, path: str, ts: str = "ts", mode: str = "append", files: int | None = None, file_bytes: int = FILE_BYTES
) -> None:
    """Store events by day, in time order, in files of about ``file_bytes``, or of what ``SORT_BYTES`` of rows take.

    Rows are range-partitioned by time, not hashed by day: a day that holds a
    third of all events is spread over as many files as its share, and the
    min/max statistics of each file cover a narrow stretch of time.  The number of
    files follows from the rows, their width in a written sample and their size
    in memory, unless ``files`` says it: a task sorts a file's rows, so however
    well they compress, it never holds more than ``SORT_BYTES`` or so.  A bloom
    filter on the id lets a cursor lookup skip the row groups without it.
    """
    dated = df.withColumn("event_date", F.to_date(ts))
    if files is None:
        rows, size = dated.agg(F.count("*"), F.sum(sorted_bytes(dated))).first()
        files = max(1, math.ceil(rows * row_bytes(df) / file_bytes), math.ceil((size or 0) / SORT_BYTES))
    _write_days(dated.repartitionByRange(files, ts), path, ts, mode)


def _write_days(dated: DataFrame, path: str, ts: str, mode: str, **options: str) -> None:
    # In the order of the folders first, so that the writer has no need to sort the rows once more.
    writer = dated.sortWithinPartitions("event_date", ts).write.mode(mode).partitionBy("event_date").options(**options)
    writer.option("parquet.bloom.filter.enabled#event_id", "true").parquet(path)


def compact_events(
    spark: SparkSession, path: str, ts: str = "ts", file_bytes: int = FILE_BYTES, least_files: int = 2
) -> list[str]:
    """Rewrite the days that have more files than their size calls for; gives these days.

    A stream or many small deliveries leave many small files.  A day is rewritten
    if it has ``least_files`` files or more and twice the number that files of
    ``file_bytes``, or of ``SORT_BYTES`` of rows, would be.  The new files are written beside the table and swap
    in by day, so a run that is cut off leaves the old ones; readers that listed
    them before may have to start anew.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[date, tuple[int, int]] = {}
    for day in store.listStatus(root):
        name = day.getPath().getName()
        if name.startswith("event_date="):
            sizes = [f.getLen() for f in store.listStatus(day.getPath()) if f.getPath().getName().endswith(".parquet")]
            needed = max(1, math.ceil(sum(sizes) / file_bytes))
            if len(sizes) >= least_files and len(sizes) >= 2 * needed:
                found[date.fromisoformat(name.removeprefix("event_date="))] = len(sizes), needed
    if not found:
        return []
    table = spark.read.parquet(path)
    days = table.filter(F.col("event_date").isin(list(found)))
    wanted: dict[date, int] = {}
    for day, size in days.groupBy("event_date").agg(F.sum(sorted_bytes(days))).collect():
        files, needed = found[day]
        needed = max(needed, math.ceil(size / SORT_BYTES))
        if files >= 2 * needed:
            wanted[day] = needed
    if not wanted:
        return []
    aside = materialize(table.filter(F.col("event_date").isin(list(wanted))))
    # The rewritten rows replace exactly the partitions they came from.
    ranges = aside.repartitionByRange(sum(wanted.values()), ts)
    _write_days(ranges, path, ts, "overwrite", partitionOverwriteMode="dynamic")
    return sorted(map(str, wanted))


def to_json_rows(df: DataFrame, column: str = "json") -> DataFrame:
    """One compact JSON object per row, NULL fields included."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(column))


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Result sink: one JSON object per line."""
    to_json_rows(df, "value").write.mode(mode).text(path)


def log_lines(df: DataFrame, name: str, level: str, message: str, fields: list[str], ts: str = "ts") -> DataFrame:
    """Events as text log lines; ``fields`` become the JSON at the end of the line."""
    extra = F.struct(*fields) if fields else None
    return df.select(log_line(F.col(ts), name, F.col(level), F.col(message), extra).alias("value"))


def write_log(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Log sink: text files with one line per event."""
    lines.select("value").write.mode(mode).text(path)


def access_log(
    requests: DataFrame,
    method: str = "method",
    url: str = "url",
    status: str = "status",
    size: str = "content_length",
    millis: str = "ms",
    skip: tuple[str, ...] = PROBE_PATHS,
) -> DataFrame:
    """Access-log records: parameter values masked, level by status, probes dropped."""
    probe = F.coalesce(F.substring_index(F.col(url), "?", 1).isin(*skip), F.lit(False))
    real = requests.filter(~probe)
    return real.select(
        access_level(F.col(status)).alias("level"),
        F.col(method).alias("method"),
        mask_url_query(F.col(url)).alias("path"),
        F.col(status).alias("status"),
        lenient_long(F.col(size)).alias("bytes"),
        F.col(millis).alias("ms"),
    )
