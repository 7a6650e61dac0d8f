"""Landed days rewritten for reading: few files, in the order of a key, with Bloom filters."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import files
from .tables import row_count

#: Bytes and rows of a compacted file, about. One task sorts a file's rows, which take some nine times its bytes in memory.
FILE_BYTES = 64 * 1024 * 1024
FILE_ROWS = 4_000_000
#: Keys up to this number are looked up one by one, which Bloom filters answer; more by their range.
LOOKUP_KEYS = 10


@dataclass(frozen=True)
class CompactedDays:
    """A landing folder with a folder per day, and beside it the days that have been rewritten.

    The landing itself is left as it is, since a stream may still be reading it. A day counts
    as rewritten once its folder is complete, and from then on is read from there alone. So
    only days to which nothing more is landed may be compacted.
    """

    spark: SparkSession
    landing: str
    path: str
    key: str = "id"
    tie: tuple[str, ...] = ("kafka_partition", "kafka_offset")
    day: str = "ingest_date"

    def days(self) -> list[str]:
        """Rewritten days."""
        folders = files.child_names(self.spark, self.path)
        return [f.split("=", 1)[1] for f in folders if f.startswith("day=") and files.exists(self.spark, f"{self.path}/{f}/_SUCCESS")]

    def compact(self, before: date | None = None, file_bytes: int = FILE_BYTES, file_rows: int = FILE_ROWS) -> list[str]:
        """Rewrite the days before ``before`` that are not yet; returns them.

        The default leaves today and yesterday alone: a batch that began before midnight may end
        after it. Files are ranges of the key; a key with very many rows is split by the tie columns.
        A lost run leaves days complete or not counted, and the next one makes up for it.
        """
        before = before or date.today() - timedelta(days=1)
        prefix, done = f"{self.day}=", self.days()
        landed = [f[len(prefix) :] for f in files.child_names(self.spark, self.landing) if f.startswith(prefix)]
        chosen = [day for day in landed if day < before.isoformat() and day not in done]
        for day in chosen:
            rows = self.spark.read.parquet(self.landing).where(F.col(self.day) == F.lit(day).cast("date")).drop(self.day)
            folder = f"{self.landing}/{prefix}{day}"
            width = max(1, -(-files.size(self.spark, folder) // file_bytes), -(-row_count(self.spark, folder) // file_rows))
            ordered = rows.repartitionByRange(width, self.key, *self.tie).sortWithinPartitions(self.key, *self.tie)
            ordered.write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{self.key}", "true").parquet(f"{self.path}/day={day}")
        return chosen

    def read(self) -> DataFrame:
        """All rows, each once, with the columns of the landing."""
        landed, done = self.spark.read.parquet(self.landing), self.days()
        if not done:
            return landed
        rest = landed.where(~F.col(self.day).isin([date.fromisoformat(day) for day in done]))
        schema = landed.drop(self.day).schema
        rewritten = self.spark.read.schema(schema.add("day", "date")).option("basePath", self.path).parquet(*[f"{self.path}/day={day}" for day in done])
        return rest.unionByName(rewritten.withColumnRenamed("day", self.day).select(landed.columns))


def near(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` that may hold one of ``keys``: a filter that Parquet answers from statistics and Bloom filters.

    It keeps rows of other keys too and is meant to go before a join. Only ``LOOKUP_KEYS`` + 1
    keys at most and the least and greatest one come to the driver.
    """
    low, high = keys.agg(F.min(key), F.max(key)).first()
    if low is None:
        return rows.where("false")
    few = [row[0] for row in keys.where(F.col(key).isNotNull()).select(key).distinct().limit(LOOKUP_KEYS + 1).collect()]
    return rows.where(F.col(key).isin(few) if len(few) <= LOOKUP_KEYS else F.col(key).between(low, high))
