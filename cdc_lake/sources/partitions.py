"""A keyed table in hash partitions, of which a merge replaces only those that it changes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import unsorted_folders
from . import files
from .tables import _DONE, _VERSION, Version

#: The stored partition number; it is no column of the table.
PART = "hash_part"
#: Columns that a merge stages for ``summary`` and that the table doesn't keep.
BEFORE, MOVED = "_before", "_moved"
#: Partitions that a task of a commit writes side by side without sorting its rows.
OPEN_FILES = 8


@dataclass(frozen=True)
class PartitionedTable:
    """One writer. A merge reads and writes the partitions of the changed keys, and leaves the files of the others.

    A merge is staged first: the new rows of the changed partitions, whole. From there Spark's
    dynamic partition overwrite puts them in place, and a marker in ``_log`` makes them count.
    A writer that is lost before the staging is complete has changed nothing; one that is lost
    later left all that is needed, and the next call finishes its work. In between, a reader may
    miss a partition, so read after ``recover``, in the job that writes.

    ``summary`` turns staged rows into a small table of what they change, kept per commit in
    ``_changes`` (``keep`` of them), for views that are maintained from changes.
    """

    spark: SparkSession
    path: str
    key: str
    partitions: int
    summary: Callable[[DataFrame], DataFrame] | None = None
    keep: int = 16

    def __post_init__(self):
        written = files.read_text(self.spark, f"{self.path}/_layout")
        if written and int(written) != self.partitions:
            raise ValueError(f"{self.path} is stored in {written} partitions, not {self.partitions}")

    # -- state -----------------------------------------------------------------

    def _named(self, folder: str) -> list[Version]:
        found = (_VERSION.fullmatch(name) for name in files.child_names(self.spark, f"{self.path}/{folder}"))
        return sorted(Version(int(m[1]), m[2], int(m[3])) for m in found if m)

    def versions(self) -> list[Version]:
        """Commits whose markers are kept: the last one, and the last of each run."""
        return self._named("_log")

    def exists(self) -> bool:
        return bool(self.versions())

    def state(self) -> str:
        versions = self.versions()
        return versions[-1].folder if versions else "none"

    def applied(self, run: str, batch_id: int) -> bool:
        """Whether this batch of this run is in the table. A restarted batch must not be applied twice."""
        batches = [v.batch_id for v in self.versions() if v.run == run]
        if batches and max(batches) > batch_id:
            raise ValueError(
                f"batch {batch_id} of run '{run}' comes after batch {max(batches)} in {self.path}: "
                "a new checkpoint needs a new run name"
            )
        return batch_id in batches

    # -- reading ---------------------------------------------------------------

    def stored_bytes(self) -> int:
        """Bytes of the table with what is kept beside it; 0 if there is none."""
        return files.size(self.spark, self.path)

    def part_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.partitions)).cast("int")

    def _stored(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def read(self) -> DataFrame | None:
        return self._stored().drop(PART) if self.exists() else None

    def changes_since(self, state: str | None) -> DataFrame | None:
        """Summaries of all commits after ``state`` up to now; nothing if one of them is no longer kept."""
        since, now = _VERSION.fullmatch(state or ""), self.versions()
        if not since or not now or self.summary is None:
            return None
        wanted = range(int(since[1]) + 1, now[-1].number + 1)
        paths = [f"{self.path}/_changes/{number:010d}" for number in wanted]
        if not paths or not all(files.exists(self.spark, f"{p}/{_DONE}") for p in paths):
            return None
        return self.spark.read.parquet(*paths)

    # -- writing ---------------------------------------------------------------

    def merge(
        self, changes: DataFrame, apply: Callable[[DataFrame | None, DataFrame], DataFrame], run: str, batch_id: int | None = None
    ) -> dict[str, int]:
        """Apply ``changes``; ``apply`` gives the new rows of the partitions from their old rows.

        Returns the rows written and the partitions touched, measured by the staging job. The
        driver learns the numbers of the touched partitions, ``partitions`` of them at most.
        """
        self.recover()
        dealt = changes.withColumn(PART, self.part_of(F.col(self.key)))
        old = None
        if self.exists():
            touched = [row[0] for row in dealt.select(PART).distinct().collect()]
            if not touched:
                return {"rows": 0, "touched": 0}
            old = self._stored().where(F.col(PART).isin(touched)).drop(PART)
        return self._commit(apply(old, changes), run, batch_id)

    def write(self, df: DataFrame, run: str = "adhoc", batch_id: int | None = None) -> dict[str, int]:
        """Replace the whole table. Views built from changes have to start anew."""
        self.recover()
        for name in files.child_names(self.spark, self.path):
            if name.startswith(f"{PART}="):
                files.remove(self.spark, f"{self.path}/{name}")
        files.remove(self.spark, f"{self.path}/_changes")
        return self._commit(df, run, batch_id, summarise=False)

    def recover(self) -> None:
        """Finish the commit of a writer that was lost; drop what one had not staged in full."""
        for version in self._named("_staged"):
            if files.exists(self.spark, f"{self.path}/_staged/{version.folder}/{_DONE}"):
                self._publish(version)
            files.remove(self.spark, f"{self.path}/_staged/{version.folder}")

    def _commit(self, rows: DataFrame, run: str, batch_id: int | None, summarise: bool = True) -> dict[str, int]:
        versions = self.versions()
        number = versions[-1].number + 1 if versions else 0
        version = Version(number, run, number if batch_id is None else batch_id)
        if not versions:
            files.write_text(self.spark, f"{self.path}/_layout", str(self.partitions))
        staged = f"{self.path}/_staged/{version.folder}"
        dealt = rows.withColumn(PART, self.part_of(F.col(self.key)))
        # One task per partition, so that a partition is one file and not one per task.
        dealt.repartition(self.partitions, PART).write.mode("overwrite").partitionBy(PART).parquet(staged)
        self._publish(version, summarise)
        files.remove(self.spark, staged)
        every = self.spark.read.parquet(f"{self.path}/_log/{version.folder}")
        return every.first().asDict()

    def _publish(self, version: Version, summarise: bool = True) -> None:
        """Every step may be repeated; the marker comes last."""
        staged = self.spark.read.parquet(f"{self.path}/_staged/{version.folder}")
        if self.summary is not None and summarise and MOVED in staged.columns:
            target = f"{self.path}/_changes/{version.number:010d}"
            self.summary(staged).write.mode("overwrite").parquet(target)
        # Staged partitions are files already: a task copies some of them, and nothing is shuffled again.
        with unsorted_folders(self.spark, OPEN_FILES):
            staged.drop(BEFORE, MOVED).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(self.path)
        marker = staged.agg(F.count("*").alias("rows"), F.countDistinct(PART).alias("touched"))
        marker.write.mode("overwrite").parquet(f"{self.path}/_log/{version.folder}")
        for old in self._named("_log"):
            if old.number < version.number and old.run == version.run:
                files.remove(self.spark, f"{self.path}/_log/{old.folder}")
        for name in files.child_names(self.spark, f"{self.path}/_changes"):
            if int(name) <= version.number - self.keep:
                files.remove(self.spark, f"{self.path}/_changes/{name}")
