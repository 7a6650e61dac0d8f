"""Where the tables are, and the choices that hold for all of them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators.cdc import current_rows
from ..operators.eligibility import stat_changes
from ..sources.landed import CompactedDays
from ..sources.partitions import PartitionedTable
from ..sources.tables import BatchLog, SnapshotTable


@dataclass(frozen=True)
class Options:
    """``null_safe``: see ``apply_changes``. ``exempt_deletes``: see ``tag_violations``.

    ``dedup_first`` keeps the newest version of a key before validation instead of after, so
    a broken newest version removes the key from the batch rather than falling back to an
    older one; superseded versions are then neither valid nor rejected, and rows without an
    id, which supersede nothing, are all rejected. ``republished_within`` ("10 minutes") lands a
    topic position once, however often it is delivered within that time. ``key_type`` widens the ids of the feed
    and of the reference files.
    """

    null_safe: bool = True
    exempt_deletes: bool = False
    dedup_first: bool = False
    drop_tombstones: bool = False
    republished_within: str | None = None
    key_type: str = "int"


class CurrentTable(SnapshotTable):
    """A table kept in order of arrival: ``read`` shows its rows, ``history`` delete markers and arrival too."""

    def read(self) -> DataFrame | None:
        rows = self.history()
        return None if rows is None else current_rows(rows)

    def history(self) -> DataFrame | None:
        return super().read()


class CurrentPartitions(PartitionedTable):
    """The same, in hash partitions."""

    def read(self) -> DataFrame | None:
        rows = self.history()
        return None if rows is None else current_rows(rows)

    def history(self) -> DataFrame | None:
        return super().read()


@dataclass(frozen=True)
class Lake:
    """``partitions``: keep Silver in so many hash partitions, of which a merge writes the changed
    ones, and Gold's totals up to date from the changes. ``buckets``: store Silver's versions in buckets.
    """

    spark: SparkSession
    root: str
    run: str = "main"
    buckets: int | None = None
    options: Options = field(default_factory=Options)
    partitions: int | None = None

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def bronze_path(self) -> str:
        return self.path("bronze/activities")

    @property
    def reference(self) -> SnapshotTable:
        return SnapshotTable(self.spark, self.path("reference"))

    @property
    def reference_quarantine(self) -> SnapshotTable:
        """Lines of the reference files with cells that could not be read."""
        return SnapshotTable(self.spark, self.path("quarantine/reference"))

    @property
    def malformed_path(self) -> str:
        return self.path("quarantine/malformed")

    @property
    def activities(self) -> CurrentTable | CurrentPartitions:
        if self.partitions:
            return CurrentPartitions(self.spark, self.path("silver/activities"), "id", self.partitions, stat_changes)
        bucket_by = (self.buckets, "id") if self.buckets else None
        return CurrentTable(self.spark, self.path("silver/activities"), bucket_by)

    @property
    def employees(self) -> SnapshotTable:
        return SnapshotTable(self.spark, self.path("silver/employees"))

    @property
    def totals(self) -> SnapshotTable:
        """Totals per employee, kept up to date from Silver's changes."""
        return SnapshotTable(self.spark, self.path("gold/totals"))

    @property
    def gold(self) -> SnapshotTable:
        return SnapshotTable(self.spark, self.path("gold/employee_eligibility"))

    @property
    def quarantine(self) -> BatchLog:
        return BatchLog(self.spark, self.path("quarantine/activities"))

    @property
    def replayed(self) -> BatchLog:
        """Topic positions of the orphans that were admitted."""
        return BatchLog(self.spark, self.path("quarantine/replayed"))

    @property
    def admissions(self) -> SnapshotTable:
        """The last replay of orphans: when it was, and which employees it knew."""
        return SnapshotTable(self.spark, self.path("quarantine/admissions"))

    @property
    def reports(self) -> BatchLog:
        """A row per applied batch: rejects per rule, and the rows that Silver's write measured."""
        return BatchLog(self.spark, self.path("reports"))

    @property
    def notifications(self) -> BatchLog:
        return BatchLog(self.spark, self.path("notifications"))

    def checkpoint(self, name: str) -> str:
        return self.path(f"checkpoints/{self.run}/{name}")

    @property
    def changes(self) -> BatchLog:
        """Changes that superseded earlier ones, as the keyed state let them through."""
        return BatchLog(self.spark, self.path("silver/changes"))

    @property
    def logs(self) -> dict[str, BatchLog]:
        """All histories that are written batch by batch."""
        return {name: getattr(self, name) for name in ("quarantine", "replayed", "reports", "notifications", "changes")}

    @property
    def landed(self) -> CompactedDays:
        return CompactedDays(self.spark, self.bronze_path, self.path("bronze/compacted"))

    def bronze(self) -> DataFrame:
        """All landed rows; compacted days from their compacted files."""
        return self.landed.read()
