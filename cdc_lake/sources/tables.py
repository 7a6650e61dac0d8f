"""Tables kept as whole Parquet versions; the newest complete one is the table."""

from __future__ import annotations

import hashlib
import re
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from . import files

_VERSION = re.compile(r"version-(\d{10})\.([\w-]+)\.(\d+)")
_APPLIED = re.compile(r"([\w-]+)\.(\d+)")
_DONE = "_SUCCESS"
_SOURCE = "_built_from"


@dataclass(frozen=True, order=True)
class Version:
    number: int
    run: str
    batch_id: int

    def __post_init__(self):
        if not _VERSION.fullmatch(self.folder):
            raise ValueError(f"a run name has letters, digits, _ and - only: '{self.run}'")

    @property
    def folder(self) -> str:
        return f"version-{self.number:010d}.{self.run}.{self.batch_id}"


@dataclass(frozen=True)
class SnapshotTable:
    """One writer, any number of readers. A version counts once Spark has committed it.

    ``bucket_by=(n, column)`` stores each version in ``n`` buckets, so a merge on that
    column shuffles the changes only and never the table. ``keep`` versions stay for
    readers that started earlier. Which batches were applied is known for good: before a
    version goes, its batch is noted in ``_applied``.
    """

    spark: SparkSession
    path: str
    bucket_by: tuple[int, str] | None = None
    keep: int = 3

    def versions(self) -> list[Version]:
        found = (_VERSION.fullmatch(name) for name in files.child_names(self.spark, self.path))
        every = [Version(int(m[1]), m[2], int(m[3])) for m in found if m]
        return sorted(v for v in every if files.exists(self.spark, f"{self.path}/{v.folder}/{_DONE}"))

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self) -> DataFrame | None:
        versions = self.versions()
        return self._load(versions[-1]) if versions else None

    def applied(self, run: str, batch_id: int) -> bool:
        """Whether this batch of this run is in the table. A restarted batch must not be applied twice."""
        batches = [v.batch_id for v in self.versions() if v.run == run] + self._noted(run)
        if batches and max(batches) > batch_id:
            raise ValueError(
                f"batch {batch_id} of run '{run}' comes after batch {max(batches)} in {self.path}: "
                "a new checkpoint needs a new run name"
            )
        return batch_id in batches

    def _noted(self, run: str) -> list[int]:
        notes = (_APPLIED.fullmatch(name) for name in files.child_names(self.spark, f"{self.path}/_applied"))
        return [int(m[2]) for m in notes if m and m[1] == run]

    def _note(self, version: Version) -> None:
        """Note the version's batch, and forget earlier ones of its run: the highest is what counts."""
        earlier = self._noted(version.run)
        if version.batch_id > max(earlier, default=-1):
            files.write_text(self.spark, f"{self.path}/_applied/{version.run}.{version.batch_id}", "")
            for batch in earlier:
                files.remove(self.spark, f"{self.path}/_applied/{version.run}.{batch}")

    def source(self) -> str | None:
        """What the newest version was built from, as its writer said; nothing if that is not known."""
        versions = self.versions()
        return files.read_text(self.spark, f"{self.path}/{versions[-1].folder}/{_SOURCE}") if versions else None

    def state(self) -> str:
        """A name for the table's present content, for ``built_from`` of what is made of it."""
        versions = self.versions()
        return versions[-1].folder if versions else "none"

    def stored_bytes(self) -> int:
        """Bytes of the newest version; 0 if there is none."""
        return files.size(self.spark, f"{self.path}/{self.state()}")

    def align(self, df: DataFrame) -> DataFrame:
        """Partition rows the way the buckets are, for a first load or the change side of a merge."""
        return df.repartition(*self.bucket_by) if self.bucket_by else df

    def write(
        self, df: DataFrame, run: str = "adhoc", batch_id: int | None = None, built_from: str | None = None,
        **metrics: Column,
    ) -> dict[str, int]:
        """Write the next version. Returns its ``rows`` and the given metrics, measured by the write itself.

        ``built_from`` is noted once the version is complete: a writer that is lost before
        that leaves a version of unknown source, which its next run replaces.
        """
        versions = self.versions()
        number = versions[-1].number + 1 if versions else 0
        version = Version(number, run, number if batch_id is None else batch_id)
        target = f"{self.path}/{version.folder}"
        counted = Observation()
        measures = [F.count(F.lit(1)).alias("rows"), *(m.alias(name) for name, m in metrics.items())]
        writer = df.observe(counted, *measures).write.mode("overwrite")
        if self.bucket_by:
            buckets, column = self.bucket_by
            writer.bucketBy(buckets, column).sortBy(column).format("parquet").option("path", target).saveAsTable(
                self._catalog_name(version)
            )
        else:
            writer.parquet(target)
        if built_from is not None:
            files.write_text(self.spark, f"{target}/{_SOURCE}", built_from)
        for old in versions[: max(0, len(versions) + 1 - self.keep)]:
            self._note(old)
            self._drop(old)
        return counted.get

    def _catalog_name(self, version: Version) -> str:
        return f"snapshot_{hashlib.md5(f'{self.path}/{version.folder}'.encode()).hexdigest()}"

    def _load(self, version: Version) -> DataFrame:
        target = f"{self.path}/{version.folder}"
        if not self.bucket_by:
            return self.spark.read.parquet(target)
        # Buckets are catalog metadata: a session that did not write the version declares it.
        name = self._catalog_name(version)
        if not self.spark.catalog.tableExists(name):
            buckets, column = self.bucket_by
            fields = self.spark.read.parquet(target).schema.fields
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet "
                f"CLUSTERED BY (`{column}`) SORTED BY (`{column}`) INTO {buckets} BUCKETS LOCATION '{target}'"
            )
        return self.spark.table(name)

    def _drop(self, version: Version) -> None:
        if self.bucket_by:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._catalog_name(version)}")
        files.remove(self.spark, f"{self.path}/{version.folder}")


@dataclass(frozen=True)
class BatchLog:
    """Append-only history with one folder per batch; writing a batch again replaces its folder."""

    spark: SparkSession
    path: str

    def write(self, df: DataFrame, run: str, batch_id: int) -> int:
        """Returns the rows written; a batch without rows leaves no folder."""
        return self.measured_write(df, run, batch_id)["rows"]

    def batch(self, run: str, batch_id: int) -> DataFrame | None:
        """What one batch has written, if it is not merged into a segment yet; nothing if it wrote no rows."""
        folder = f"{self.path}/run={run}/batch_id={batch_id}"
        return self.spark.read.parquet(folder) if files.exists(self.spark, folder) else None

    def measured_write(self, df: DataFrame, run: str, batch_id: int, **metrics: Column) -> dict[str, int]:
        """The same; returns ``rows`` and the given metrics, measured by the write itself."""
        folder = f"{self.path}/run={run}/batch_id={batch_id}"
        counted = Observation()
        rows = df.observe(counted, F.count(F.lit(1)).alias("rows"), *(m.alias(name) for name, m in metrics.items()))
        rows.write.mode("overwrite").parquet(folder)
        if counted.get["rows"] == 0:
            files.remove(self.spark, folder)
        return counted.get

    def read(self) -> DataFrame | None:
        """Everything written so far; columns that appeared later are null in earlier batches."""
        segments = self._segments()
        live = [f"{self.path}/run={run}/batch_id={n}" for run in self._runs() for n in self._batches(run) if n > self._compacted_to(segments, run)]
        if not segments and not live:
            return None
        source = self.spark.read.option("mergeSchema", "true")
        parts = [source.option("basePath", self.path).parquet(*live)] if live else []
        if segments:
            parts.append(self.spark.read.option("mergeSchema", "true").parquet(*[f"{self._store}/run={run}/to={n}" for run, n in segments]))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def compact(self, file_bytes: int = 256 * 1024 * 1024) -> int:
        """Merge the folders of batches into one segment per run, all but the last one of the run; returns how many.

        A stream may repeat its last batch, and only that: its folder must stay replaceable. A
        segment counts once it is complete and then stands for its batches, whose folders are
        removed; segments are not written again. Call it once a day: then a read lists the
        segments of days and the batches of one.
        """
        merged, segments = 0, self._segments()
        for run in self._runs():
            start, batches = self._compacted_to(segments, run), self._batches(run)
            folders = {n: f"{self.path}/run={run}/batch_id={n}" for n in batches[:-1]}
            fresh = {n: folder for n, folder in folders.items() if n > start}
            if fresh:
                width = max(1, -(-sum(files.size(self.spark, folder) for folder in fresh.values()) // file_bytes))
                rows = self.spark.read.option("mergeSchema", "true").option("basePath", self.path).parquet(*fresh.values())
                rows.coalesce(width).write.mode("overwrite").parquet(f"{self._store}/run={run}/to={max(fresh)}")
            for folder in folders.values():
                files.remove(self.spark, folder)
            merged += len(fresh)
        return merged

    @property
    def _store(self) -> str:
        return f"{self.path}/_compacted"

    def _runs(self) -> list[str]:
        return [name[4:] for name in files.child_names(self.spark, self.path) if name.startswith("run=")]

    def _batches(self, run: str) -> list[int]:
        names = files.child_names(self.spark, f"{self.path}/run={run}")
        return sorted(int(name[9:]) for name in names if name.startswith("batch_id="))

    def _segments(self) -> list[tuple[str, int]]:
        """Complete segments: the run, and the last batch that a segment holds."""
        found = []
        for run in files.child_names(self.spark, self._store):
            ends = [int(name[3:]) for name in files.child_names(self.spark, f"{self._store}/{run}")]
            found += [(run[4:], n) for n in sorted(ends) if files.exists(self.spark, f"{self._store}/{run}/to={n}/_SUCCESS")]
        return found

    @staticmethod
    def _compacted_to(segments: list[tuple[str, int]], run: str) -> int:
        return max((n for of, n in segments if of == run), default=-1)


_FOOTER_CONF = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}


@contextmanager
def footer_reads(spark: SparkSession):
    """Inside, Parquet counts (and least and greatest values of numbers) come from the footers, and no data page is read."""
    before = {key: spark.conf.get(key, None) for key in _FOOTER_CONF}
    for key, value in _FOOTER_CONF.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def counted(spark: SparkSession, path: str) -> DataFrame:
    """``records`` of a Parquet folder; call it, and run it, inside ``footer_reads``."""
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("records"))


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet folder, from its footers; -1 if it is missing or cannot be read."""
    try:
        with footer_reads(spark):
            return counted(spark, path).first()[0] or 0  # no footer, no count
    except Exception:
        return -1


def has_rows(spark: SparkSession, path: str) -> bool:
    """Whether there is a row; false if the folder is missing or cannot be read."""
    try:
        return not spark.read.parquet(path).isEmpty()
    except Exception:
        return False


def export_parquet(df: DataFrame, path: str) -> None:
    """Replace a Parquet export."""
    df.write.mode("overwrite").parquet(path)
