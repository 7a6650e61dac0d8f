"""Physical plans: what must reach the scan, and what must not be shuffled or held in one task."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from cdc_lake.operators.cdc import apply_changes, initial_rows, latest_version, to_silver
from cdc_lake.operators.eligibility import activity_stats, add_stats
from cdc_lake.operators.quality import tag_orphans, tag_violations, valid_rows, with_known_key
from cdc_lake.plans import driver_tables as tables
from cdc_lake.plans.medallion import silver_changes
from cdc_lake.sources.tables import SnapshotTable


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture
def bronze(spark, sf_dir, tmp_path):
    path = str(tmp_path / "bronze")
    tables.bronze(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


@contextlib.contextmanager
def conf(spark, **settings):
    keys = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_rules_reach_the_scan(bronze):
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan(valid_rows(bronze)))[1]
    for part in ("IsNotNull(id)", "IsNotNull(employee_id)", "GreaterThan(elapsed_time,0)",
                 "IsNotNull(start_datetime)", "Not(EqualTo(sport_type,))", "GreaterThanOrEqual(distance,0)"):
        assert part in pushed


def test_unused_columns_stay_on_disk(bronze):
    totals = activity_stats(initial_rows(silver_changes(bronze, None, order=["kafka_offset"])))
    read = re.search(r"ReadSchema: struct<(.*?)>", plan(totals))[1]
    assert "details" not in read and "start_timestamp" not in read


def test_latest_version_is_limited_before_the_shuffle(bronze):
    text = plan(latest_version(bronze, order=["kafka_offset"]))
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")
    assert len(re.findall(r"\(\d+\) Exchange", text)) == 1


def test_merge_shuffles_each_side_once_and_reuses_the_sort(bronze):
    target = initial_rows(to_silver(latest_version(bronze, order=["kafka_offset"])))
    changes = to_silver(latest_version(bronze, order=["kafka_offset"]))
    text = plan(apply_changes(target, changes))
    assert len(re.findall(r"\(\d+\) Exchange", text)) == 2


def test_bucketed_target_is_not_shuffled(spark, bronze, lake_root):
    table = SnapshotTable(spark, lake_root, bucket_by=(4, "id"))
    changes = to_silver(latest_version(bronze, order=["kafka_offset"]))
    table.write(initial_rows(table.align(changes)))
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        merged = apply_changes(table.read(), table.align(changes), check_source=False)
        text = plan(merged)
    # The change side moves twice: to find the latest version, then onto the buckets.
    assert len(re.findall(r"\(\d+\) Exchange", text)) == 2
    assert "SelectedBucketsCount: 4 out of 4" in text
    table.write(merged)
    files = [f for f in table.read().inputFiles()]
    assert len(files) <= 4


SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "200KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "100KB",
}


@pytest.fixture
def hot(spark):
    """A third of the rows belongs to one employee."""
    rows = spark.range(120_000).repartition(8)
    return rows.select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).cast("int").alias("employee_id"),
        F.lit("Tennis").alias("sport_type"),
        F.lit(60).alias("elapsed_time"),
        F.lit("2024-01-01 00:00:00").alias("start_datetime"),
        F.lit(5).alias("distance"),
        F.uuid().alias("details"),
        F.lit("false").alias("__deleted"),
    )


@pytest.fixture
def staff(spark):
    return spark.range(4000).select(F.col("id").cast("int").alias("employee_id"))


def executed_plan(df):
    """The plan after AQE has seen the real sizes."""
    df.collect()
    return plan(df)


def test_key_check_splits_a_hot_key(spark, hot, staff):
    with conf(spark, **SKEW):
        assert "skew=true" in executed_plan(with_known_key(hot, staff))
        assert "skew=true" in executed_plan(tag_orphans(tag_violations(hot), staff))


def test_totals_join_splits_a_hot_key(spark, hot):
    people = hot.select("employee_id", "details")
    stats = activity_stats(hot.withColumn("is_commute", F.lit(True)))
    with conf(spark, **SKEW):
        assert "skew=true" in executed_plan(add_stats(people, stats))


def test_latest_version_of_a_hot_id(hot):
    one_id = hot.withColumn("kafka_offset", F.col("id")).withColumn("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")))
    newest = latest_version(one_id, order=["kafka_offset"])
    assert newest.count() == 80_001
    assert newest.where("id = -1").first()["kafka_offset"] == 119_997
