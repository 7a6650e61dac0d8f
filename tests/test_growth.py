"""What must not grow with the tables: Python per key, rows of one task, sorts of a landed batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from cdc_lake.operators.quality import REASON, rule_metrics
from cdc_lake.plans import queries
from cdc_lake.plans.lake import Lake
from cdc_lake.session import _WRITERS, SCALE_CONF, sized_shuffles, unsorted_folders
from cdc_lake.sources.landed import FILE_ROWS
from cdc_lake.sources.partitions import PartitionedTable
from cdc_lake.streaming.latest import start_newest

from .conftest import rows
from .test_upkeep import bronze, landing


def test_the_newest_changes_take_no_python_per_key(spark, lake_root):
    lake = Lake(spark, lake_root)

    def step(*changes):
        bronze(spark, lake, *changes)
        stream = start_newest(lake)
        stream.awaitTermination()
        return [o["operatorName"] for p in stream.recentProgress for o in p["stateOperators"]]

    assert set(step((1, 3, "c", None), (1, 2, "b", None), (2, 1, "x", None), (3, 1, "y", "true"))) == {"stateStoreSave"}
    first = lake.changes.read().count()
    step((1, 3, "c", None), (3, 1, "y", "true"))  # the same changes again are no news
    assert (first, lake.changes.read().count()) == (3, 3)
    step((1, 3, "c", None), (1, 4, "d", "true"), (2, 1, "x", None))
    assert rows(lake.changes.read().where("batch_id = 2"), "id", "details", "__deleted") == [(1, "d", "true")]


def test_a_compacted_file_holds_no_more_rows_than_a_task_sorts_in_memory(spark, lake_root):
    def compacted(days):
        return [f for f in days.read().inputFiles() if "/compacted/" in f]

    days = landing(spark, lake_root, (5,), n=FILE_ROWS + 500_000)
    days.compact()
    assert len(compacted(days)) == 2
    few = landing(spark, f"{lake_root}/few", (5,))
    before = rows(few.read())
    few.compact(file_rows=1000)
    assert len(compacted(few)) == 4 and rows(few.read()) == before


def test_deliveries_land_without_a_sort_by_day(spark, lake_root, sf_dir, monkeypatch):
    lake, seen, started = Lake(spark, lake_root), [], queries.start_landing
    before = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, "0")  # a session that was not built here

    class Spied:
        def __init__(self, *args, **trigger):
            self.stream = started(*args, **trigger)

        def awaitTermination(self):
            self.stream.awaitTermination()
            seen.append(spark.conf.get(_WRITERS))  # the sink asks the session whenever it writes

    monkeypatch.setattr(queries, "start_landing", Spied)
    try:
        queries._deliver(spark, sf_dir, lake, 0)
        assert seen == [SCALE_CONF[_WRITERS]] and spark.conf.get(_WRITERS) == "0"
    finally:
        spark.conf.set(_WRITERS, before)


def test_merges_spread_over_the_cores(spark):
    first, least = "parallelismFirst", "minPartitionSize"
    conf = lambda name: spark.conf.get(f"spark.sql.adaptive.coalescePartitions.{name}", None)
    before = conf(first), conf(least)
    with sized_shuffles(spark, 1):
        assert (conf(first), conf(least)) == ("true", "8m")
    assert (conf(first), conf(least)) == before


def test_more_folders_than_open_files_keep_every_row(spark, lake_root):
    frame = spark.range(1000).selectExpr("id", "id % 7 AS folder")
    with unsorted_folders(spark, 2):
        frame.write.partitionBy("folder").parquet(lake_root)
    assert rows(spark.read.parquet(lake_root).select("id", F.col("folder").cast("long"))) == rows(frame)


def test_reasons_are_counted_by_whole_names(spark):
    reasons = ["employee_id_null", "id_null, employee_id_null", "id_null", "", None, "no_rule", "distance_outlier_vélo, id_null"]
    frame = spark.createDataFrame([(r,) for r in reasons], f"{REASON} string")
    counts = frame.agg(*[metric.alias(name) for name, metric in rule_metrics().items()]).first().asDict()
    assert {name: n for name, n in counts.items() if n} == {"id_null": 3, "employee_id_null": 2, "distance_outlier_vélo": 1}
    assert "split(" not in str(list(rule_metrics().values()))


def test_a_commit_shuffles_its_rows_once(spark, lake_root, monkeypatch):
    calls, made = [], type(spark.range(1)).repartition

    def counted(frame, *args):
        calls.append(args)
        return made(frame, *args)

    monkeypatch.setattr(type(spark.range(1)), "repartition", counted)
    table = PartitionedTable(spark, lake_root, "id", 4)
    table.write(spark.range(1000).toDF("id"))
    assert len(calls) == 1 and len(table.read().inputFiles()) == 4
    assert rows(table.read()) == rows(spark.range(1000))
