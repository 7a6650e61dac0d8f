"""Compacted landing days, merged batch folders, and the latest version by keyed state."""

from __future__ import annotations

import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cdc_lake.__main__ import main
from cdc_lake.plans.lake import Lake
from cdc_lake.plans.upkeep import upkeep
from cdc_lake.schemas import bronze_ddl
from cdc_lake.sources import files
from cdc_lake.sources.landed import CompactedDays, near
from cdc_lake.sources.tables import BatchLog
from cdc_lake.streaming.latest import start_newest

from .conftest import rows

TODAY = date.today()


def landing(spark, root, days, n=4000):
    frame = spark.range(n).selectExpr("cast(id * 7919 % 100000 as int) id", "cast(id % 3 as int) kafka_partition", "id kafka_offset", "id % 2 = 0 AS even")
    for back in days:
        frame.withColumn("ingest_date", F.lit(TODAY - timedelta(days=back))).write.mode("append").partitionBy("ingest_date").parquet(f"{root}/landing")
    return CompactedDays(spark, f"{root}/landing", f"{root}/compacted")


def test_closed_days_are_compacted_once(spark, lake_root):
    days = landing(spark, lake_root, (0, 1, 2, 9))
    before = rows(days.read())
    assert days.compact() == sorted((TODAY - timedelta(days=n)).isoformat() for n in (2, 9))
    assert days.compact() == [] and len(days.days()) == 2
    assert rows(days.read()) == before
    assert days.read().schema == spark.read.parquet(days.landing).schema
    files.remove(spark, f"{days.path}/day={days.days()[0]}/_SUCCESS")  # as if a writer had been lost
    assert rows(days.read()) == before and len(days.compact()) == 1 and rows(days.read()) == before


def test_a_lookup_reads_few_of_the_compacted_rows(spark, lake_root):
    days = landing(spark, lake_root, (5,))
    days.compact(file_bytes=4000)
    assert len(days.read().inputFiles()) > 3

    def rows_read(frame):
        frame.collect()
        nodes, found = [frame._jdf.queryExecution().executedPlan()], 0
        while nodes:
            node = nodes.pop()
            nodes += [node.children().apply(i) for i in range(node.children().size())]
            nodes += [node.executedPlan()] if hasattr(node, "executedPlan") and "AdaptiveSparkPlan" in node.nodeName() else []
            if "Scan" in node.nodeName():
                found += node.metrics().get("numOutputRows").get().value()
        return found

    keys = spark.createDataFrame([(7919,), (None,), (15838,)], "id int")
    picked = near(days.read(), keys, "id")
    assert {r.id for r in picked.collect()} == {7919, 15838}
    assert rows_read(picked) < rows_read(days.read()) / 2
    assert near(days.read(), keys.where("false"), "id").isEmpty()
    many = days.read().where("id BETWEEN 500 AND 900").select("id")
    assert rows(many.join(near(days.read(), many, "id"), "id", "left_semi")) == rows(many)


def test_batches_merge_into_segments_and_the_last_stays_replaceable(spark, lake_root):
    log = BatchLog(spark, f"{lake_root}/log")
    frame = lambda text: spark.createDataFrame([(text,)], "v string")
    assert log.read() is None and log.compact() == 0
    for n in range(4):
        log.write(frame(f"a{n}"), "main", n)
    log.write(frame("b0").withColumn("later", F.lit(1)), "other", 0)
    assert log.compact() == 3 and log.compact() == 0
    assert files.child_names(spark, f"{log.path}/run=main") == ["batch_id=3"]
    log.write(frame("a3 again"), "main", 3)
    log.write(frame("a4").withColumn("later", F.lit(2)), "main", 4)
    seen = [("a0", "main", 0, None), ("a1", "main", 1, None), ("a2", "main", 2, None), ("a3 again", "main", 3, None), ("a4", "main", 4, 2), ("b0", "other", 0, 1)]
    assert rows(log.read(), "v", "run", "batch_id", "later") == seen
    assert log.compact() == 1 and rows(log.read(), "v", "run", "batch_id", "later") == seen
    frame("a2").write.parquet(f"{log.path}/run=main/batch_id=2")  # a merged folder that a lost job left behind
    assert rows(log.read(), "v", "run", "batch_id", "later") == seen
    log.compact()
    assert files.child_names(spark, f"{log.path}/run=main") == ["batch_id=4"]


def bronze(spark, lake, *changes):
    """Changes as (id, arrival, details, deleted)."""
    made = [(i, 1, 1, "Tennis", 5, 60, d, x, "2024-01-01 00:00:00", datetime(2024, 1, 1, 0, 0, n), 0, n, TODAY) for i, n, d, x in changes]
    names = "id, employee_id, start_timestamp, sport_type, distance, elapsed_time, details, __deleted, start_datetime, ingested_at, kafka_partition, kafka_offset, ingest_date"
    frame = spark.createDataFrame(made, ", ".join(f"{n} {t}" for n, t in zip(names.split(", "), "int int bigint string int int string string string timestamp int bigint date".split())))
    frame.select(spark.createDataFrame([], bronze_ddl()).columns).coalesce(1).write.mode("append").parquet(lake.bronze_path)


def test_newest_changes_survive_late_and_repeated_ones_and_a_restart(spark, lake_root):
    lake = Lake(spark, lake_root)
    seen = []

    def step(*changes):
        bronze(spark, lake, *changes)
        start_newest(lake).awaitTermination()  # each call goes on from the checkpoint
        now = rows(lake.changes.read(), "id", "details", "__deleted")
        new = [r for r in now if r not in seen]
        seen[:] = now
        return new

    assert step((1, 1, "a", None), (1, 3, "c", None), (1, 2, "b", None), (2, 1, "x", "false")) == [(1, "c", None), (2, "x", "false")]
    assert step((1, 2, "late", None), (2, 1, "again", None)) == []
    assert step((1, 5, "gone", "true"), (3, 1, "y", None)) == [(1, "gone", "true"), (3, "y", None)]
    assert step((1, 4, "older than its delete", None)) == []
    assert step((1, 6, "back", None), (None, 9, "no key", None)) == [(1, "back", None)]


def test_delete_markers_may_be_forgotten(spark, lake_root):
    lake = Lake(spark, lake_root)
    with pytest.raises(ValueError):
        start_newest(lake, forget_deletes_ms=1)
    bronze(spark, lake, (1, 5, "kept", None), (2, 5, "gone", "true"))
    stream = start_newest(lake, forget_deletes_ms=1, processingTime="1 second")

    def kept():
        try:
            return lake.changes.read().count()
        except (AttributeError, AnalysisException):  # nothing yet, or the folder of a batch without news
            return 0

    def wait_for(count):
        until = time.time() + 60
        while kept() < count and time.time() < until:
            time.sleep(1)

    try:
        wait_for(2)
        bronze(spark, lake, (1, 4, "late", None), (2, 4, "taken for new", None))
        wait_for(3)
    finally:
        stream.stop()
    assert rows(lake.changes.read(), "id", "details") == [(1, "kept"), (2, "gone"), (2, "taken for new")]


@pytest.mark.parametrize("partitions", [None, 4])
def test_silver_from_the_keyed_state(spark, lake_root, partitions):
    lake = Lake(spark, lake_root, partitions=partitions)
    started = ["newest", "--root", lake_root, "--merge", *(["--partitions", "4"] if partitions else [])]

    def step(*changes):
        bronze(spark, lake, *changes)
        assert main(started) == 0
        return rows(lake.activities.read(), "id", "details")

    assert step((1, 1, "a", None), (1, 3, "c", None), (2, 1, "x", None)) == [(1, "c"), (2, "x")]
    before = lake.activities.versions()
    assert step((1, 2, "late", None), (2, 1, "again", None)) == [(1, "c"), (2, "x")]
    assert lake.activities.versions() == before  # a batch without news writes nothing
    assert step((1, 5, "gone", "true"), (3, 2, "y", None)) == [(2, "x"), (3, "y")]
    assert step((1, 4, "older than its delete", None), (2, 9, "z", None)) == [(2, "z"), (3, "y")]


def test_a_merge_that_was_lost_is_made_up_for(spark, lake_root, monkeypatch):
    from cdc_lake.streaming import latest

    lake = Lake(spark, lake_root)
    bronze(spark, lake, (1, 1, "a", None))
    with monkeypatch.context() as patch:
        patch.setattr(latest, "merge_activities", lambda *_: 1 / 0)
        with pytest.raises(Exception, match="division by zero"):
            start_newest(lake, merge=True).awaitTermination()
    assert lake.activities.read() is None and lake.changes.read().count() == 1
    bronze(spark, lake, (1, 2, "b", None))
    start_newest(lake, merge=True).awaitTermination()
    assert rows(lake.activities.read(), "id", "details") == [(1, "b")]


def test_the_upkeep_job(spark, lake_root, capsys):
    lake = Lake(spark, lake_root)
    assert upkeep(lake) == {"bronze": 0, "quarantine": 0, "replayed": 0, "reports": 0, "notifications": 0, "changes": 0}
    old = spark.range(50).selectExpr("cast(id as int) id", "0 kafka_partition", "id kafka_offset").withColumn("ingest_date", F.lit(TODAY - timedelta(days=5)))
    old.write.partitionBy("ingest_date").parquet(lake.bronze_path)
    for n in range(3):
        lake.quarantine.write(spark.range(n + 1), "main", n)
        lake.notifications.write(spark.range(1), "main", n)
    before = rows(lake.bronze()), rows(lake.quarantine.read()), rows(lake.notifications.read())
    assert main(["upkeep", "--root", lake_root, "--before", (TODAY - timedelta(days=5)).isoformat()]) == 0
    assert main(["upkeep", "--root", lake_root]) == 0
    first, second = [eval(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]
    assert (first["bronze"], first["quarantine"], first["notifications"]) == (0, 2, 2)
    assert (second["bronze"], second["quarantine"]) == (1, 0)
    assert (rows(lake.bronze()), rows(lake.quarantine.read()), rows(lake.notifications.read())) == before
