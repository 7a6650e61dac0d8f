"""The latest version of each key inside the stream, by keyed state."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.rules import is_active
from ..operators.cdc import ARRIVAL, to_silver
from ..operators.quality import valid_rows, with_known_key
from ..plans.lake import Lake
from ..plans.medallion import merge_activities
from ..schemas import bronze_ddl
from ..sources import files

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Newest(StatefulProcessor):
    """Keeps, per key, when its newest change arrived; lets a change through that is newer.

    Deleted keys are kept apart: their markers may expire, those of living keys never do.
    """

    _ORDER = "at bigint, place int, position bigint"

    def __init__(self, columns: list[str], forget_ms: int):
        self._columns, self._forget_ms = columns, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._living = handle.getValueState("living", self._ORDER)
        self._deleted = handle.getValueState("deleted", self._ORDER, self._forget_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self._living.get() or self._deleted.get()
        order, newest = tuple(held) if held else None, None
        for row in rows:  # one at a time: a hot key needs no more memory
            arrived = (row["_at"], row["_place"], row["_position"])
            if order is None or arrived > order:
                order, newest = arrived, row
        if newest is None:
            return
        now, before = (self._living, self._deleted) if newest["_active"] else (self._deleted, self._living)
        before.clear()
        now.update(order)
        yield Row(**{c: newest[c] for c in self._columns})

    def close(self) -> None:
        pass


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB: on executor disks, not in their heaps."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def newest_changes(changes: DataFrame, key: str = "id", flag: str = "__deleted", forget_deletes_ms: int | None = None) -> DataFrame:
    """Of a stream of changes with their arrival, those that supersede what came before; one per key and batch.

    Late and repeated changes are not newer than the state and vanish. The state is a streaming
    aggregate: the newest change of each key, delete markers among them, for good.
    ``forget_deletes_ms`` bounds the state of deleted keys: a change that is delivered later than
    that after the delete of its key passes for a new one. State that expires for some keys only
    takes a processor, which is Python per key.
    """
    at, place, position = ARRIVAL
    arrived = [F.unix_micros(at).alias("_at"), F.col(place).cast("int").alias("_place"), F.col(position).cast("long").alias("_position")]
    if forget_deletes_ms is None:
        return _newest_of_aggregate(changes, key, arrived)
    keyed = changes.select("*", *arrived, is_active(flag).alias("_active"))
    step = _Newest(changes.columns, forget_deletes_ms)
    return keyed.groupBy(key).transformWithState(step, changes.schema, "Update", "ProcessingTime")


def _newest_of_aggregate(changes: DataFrame, key: str, arrived: list[Column]) -> DataFrame:
    """The newest change per key where this batch brought it.

    An aggregate gives out a key whenever a change of it comes. The time of the batch, which a
    repeated batch keeps, tells whether the newest one is of this batch; of equal arrivals the
    first batch's stands, so repeated changes don't count as news.
    """
    batch = F.unix_micros(F.current_timestamp())
    timed = changes.select("*", *arrived, batch.alias("_batch"), F.col(key).alias("_key"))
    row = F.struct(*changes.columns, "_batch")
    order = F.struct("_at", "_place", "_position", -F.col("_batch"))
    newest = timed.groupBy("_key").agg(F.max_by(row, order).alias("_newest"))
    return newest.where(F.col("_newest._batch") == batch).select("_newest.*").drop("_batch")


def start_newest(
    lake: Lake, forget_deletes_ms: int | None = None, limit: int | None = None, merge: bool = False, **trigger
) -> StreamingQuery:
    """Valid changes of Bronze that supersede earlier ones, kept batch by batch in ``lake.changes``.

    A lost batch is repeated and replaces its folder. The employees are those known at the start.
    ``merge`` keeps Silver up to date from the changes: from their folder, since running the batch
    twice would run its state twice, and once per batch, since Silver knows what it has applied.
    Rejects are not kept in this mode, so its orphans are not admitted later.
    With ``forget_deletes_ms`` the stream needs an interval (``processingTime="1 minute"``): it runs
    batches without news to clear its state, so one that drains its source would never end.
    """
    if forget_deletes_ms is not None and "processingTime" not in trigger:
        raise ValueError("forgetting deletes needs a processingTime trigger")
    files.make_folder(lake.spark, lake.bronze_path)
    source = lake.spark.readStream.schema(bronze_ddl(lake.options.key_type))
    bronze = (source if limit is None else source.option("maxFilesPerTrigger", limit)).parquet(lake.bronze_path)
    valid, employees = valid_rows(bronze), lake.employees.read()
    valid = valid if employees is None else with_known_key(valid, employees)
    newest = newest_changes(to_silver(valid, ARRIVAL), forget_deletes_ms=forget_deletes_ms)

    def keep(batch: DataFrame, batch_id: int) -> None:
        lake.changes.write(batch, lake.run, batch_id)
        run = f"{lake.run}-newest"
        written = lake.changes.batch(lake.run, batch_id) if merge else None
        if written is not None and not lake.activities.applied(run, batch_id):
            merge_activities(lake, written, run, batch_id, datetime.now(timezone.utc))

    with rocksdb_state(lake.spark):
        return (
            newest.writeStream.trigger(**(trigger or {"availableNow": True}))
            .outputMode("update")
            .foreachBatch(keep)
            .option("checkpointLocation", lake.checkpoint("newest"))
            .queryName("Silver - Newest changes")
            .start()
        )
