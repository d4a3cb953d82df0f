"""A table of versioned rows by day, written by micro-batches and kept small.

Every batch writes the rows it changed under its number, so a retried batch
replaces its own files.  A row is told from others by its keys, and the version
of the latest batch counts.  When a day has collected many batches they are
merged: the latest versions are written aside, and what they replace is deleted
only after that.  Readers may meet a version twice, never none.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Rows of a merged file, about.
MERGED_ROWS = 2_000_000


class DailyTable:
    def __init__(self, spark: SparkSession, path: str, at: str, keys: Sequence[str]) -> None:
        """``at`` is the timestamp whose UTC day a row belongs to; ``keys`` tell rows apart and include it."""
        self.spark, self.path, self.at, self.keys = spark, path.rstrip("/"), at, list(keys)

    def _folder(self, kind: str, day: str | None = None, version: int | None = None) -> str:
        parts = [self.path, kind]
        parts += [] if day is None else [f"day={day}"]
        parts += [] if version is None else [f"version={version}"]
        return "/".join(parts)

    def _listed(self, folder: str) -> list[str]:
        """Names in a folder; none if it is missing."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        store = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [f.getPath().getName() for f in store.listStatus(place)] if store.exists(place) else []

    def _deleted(self, folder: str) -> None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)

    def days(self, kind: str) -> list[str]:
        return sorted(name[4:] for name in self._listed(self._folder(kind)) if name.startswith("day="))

    def versions(self, kind: str, day: str) -> list[int]:
        """Finished versions of a day, oldest first."""
        found = [int(n[8:]) for n in self._listed(self._folder(kind, day)) if n.startswith("version=")]
        if kind == "merged":
            found = [v for v in found if "_SUCCESS" in self._listed(self._folder(kind, day, v))]
        return sorted(found)

    def save(
        self, rows: DataFrame, batch_id: int, merge_after: int | None = None, keep: timedelta | None = None
    ) -> None:
        """Write the rows of a batch.

        Days with ``merge_after`` batches or more are merged, and days that end
        ``keep`` or more before the newest day are deleted.
        """
        day = F.date_format(self.at, "yyyy-MM-dd")
        versioned = rows.withColumns({"day": day, "version": F.lit(batch_id).cast("bigint")})
        (
            versioned.repartition("day")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day", "version")
            .parquet(self._folder("recent"))
        )
        if merge_after is not None:
            for name in self.days("recent"):
                if len(self.versions("recent", name)) >= merge_after:
                    self.merge(name, rows.schema, batch_id)
        if keep is not None:
            known = sorted({*self.days("recent"), *self.days("merged")})
            for name in known:
                if date.fromisoformat(known[-1]) - date.fromisoformat(name) > keep:
                    self._deleted(self._folder("recent", name))
                    self._deleted(self._folder("merged", name))

    def merge(self, day: str, schema: T.StructType, version: int) -> None:
        """Write the latest versions of a day's rows in one place and delete what they replace."""
        if version not in self.versions("merged", day):
            latest = self.read(schema, day, day)
            files = 1 + latest.count() // MERGED_ROWS
            latest.repartition(files, *self.keys).write.mode("overwrite").parquet(self._folder("merged", day, version))
        for kind, below in (("recent", version + 1), ("merged", version)):
            for old in self.versions(kind, day):
                if old < below:
                    self._deleted(self._folder(kind, day, old))

    def read(
        self, schema: T.StructType, first: str | date | datetime | None = None, last: str | date | datetime | None = None
    ) -> DataFrame:
        """The latest version of every row of the days from ``first`` to ``last``; other days are not even listed."""
        low, high = (None if d is None else str(d)[:10] for d in (first, last))
        whole = T.StructType([*schema.fields, T.StructField("day", T.StringType()), T.StructField("version", T.LongType())])
        found = self.spark.createDataFrame([], whole)
        for kind in ("merged", "recent"):
            days = [d for d in self.days(kind) if (low is None or d >= low) and (high is None or d <= high)]
            folders = [self._folder(kind, d, v) for d in days for v in self.versions(kind, d)]
            if folders:
                rows = self.spark.read.schema(whole).option("basePath", self._folder(kind)).parquet(*folders)
                found = found.unionByName(rows)
        others = [c for c in schema.names if c not in self.keys]
        if not others:
            return found.select(*schema.names).distinct()
        newest = found.groupBy(*self.keys).agg(F.max_by(F.struct(*others), "version").alias("_row"))
        return newest.select(*[c if c in self.keys else F.col("_row")[c].alias(c) for c in schema.names])
