"""Parsing, latest version, merge."""

from __future__ import annotations

import json
import random
from datetime import datetime, timezone

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cdc_lake.functions.timestamps import epoch_text, epoch_timestamp
from cdc_lake.operators.cdc import (
    apply_changes,
    initial_rows,
    latest_version,
    parse_changes,
    require_one_version,
    skip_tombstones,
    to_bronze,
    to_silver,
)
from cdc_lake.schemas import CHANGE_COLUMNS

from .conftest import rows

MESSAGE = "value string, partition int, offset bigint"
FULL = {"id": 1, "employee_id": 10, "start_timestamp": 1704096000123456, "sport_type": "Tennis",
        "distance": 5, "elapsed_time": 60, "details": "x", "__deleted": "false"}


def test_parse(spark):
    sent = [json.dumps(FULL), None, "not json", json.dumps({**FULL, "distance": "far"}), json.dumps({"id": 2, "other": 1})]
    df = spark.createDataFrame([(v, 0, i) for i, v in enumerate(sent)], MESSAGE)
    parsed = parse_changes(df, keep=["offset"])
    assert parsed.columns == [*CHANGE_COLUMNS, "offset"]
    got = {r["offset"]: tuple(r)[:-1] for r in parsed.collect()}
    assert got[0] == tuple(FULL.values())
    assert got[1] == got[2] == (None,) * 8
    assert got[3] == tuple({**FULL, "distance": None}.values())
    assert got[4] == (2, *[None] * 7)
    assert skip_tombstones(df).count() == 4


def test_bronze_columns(spark):
    df = spark.createDataFrame([(json.dumps(FULL).encode(), 3, 7), (None, 3, 8)], "value binary, partition int, offset bigint")
    bronze = to_bronze(df)
    assert bronze.columns == [*CHANGE_COLUMNS, "start_datetime", "ingested_at", "kafka_partition", "kafka_offset", "ingest_date"]
    assert rows(bronze, "id", "start_datetime", "kafka_offset") == [(1, "2024-01-01 08:00:00", 7), (None, None, 8)]
    assert bronze.select("ingested_at").distinct().count() == 1
    assert rows(to_bronze(df, drop_tombstones=True), "id") == [(1,)]


def test_epoch(spark):
    df = spark.createDataFrame([(0,), (-1_500_000,), (1_999_999,), (None,)], "us bigint")
    assert [r[0] for r in df.select(epoch_text("us")).collect()] == [
        "1970-01-01 00:00:00", "1969-12-31 23:59:59", "1970-01-01 00:00:01", None
    ]
    shown = df.select(epoch_timestamp("us").cast("string")).collect()
    assert [r[0] for r in shown] == [None, "1969-12-31 23:59:58.5", "1970-01-01 00:00:01.999999", None]


def test_latest_breaks_ties_by_topic_position(spark):
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    df = spark.createDataFrame(
        [(1, "old", at, 0, 5), (1, "new", at, 0, 6), (2, "only", None, 0, 1), (None, "a", at, 0, 1), (None, "b", at, 0, 2)],
        "id int, details string, ingested_at timestamp, kafka_partition int, kafka_offset bigint",
    )
    assert rows(latest_version(df), "id", "details") == [(1, "new"), (2, "only"), (None, "b")]


TARGET = "id int, v int, d int, updated_at timestamp"
CHANGE = "id int, v int, d int, __deleted string"
OLD, NEW = datetime(2024, 1, 1, tzinfo=timezone.utc), datetime(2024, 2, 2, tzinfo=timezone.utc)


@pytest.fixture
def merge_frames(spark):
    target = [(1, 10, None), (2, 20, 5), (3, 30, 1), (6, 60, None), (7, 70, 7)]
    changes = [(1, 10, 7, None), (2, 20, 5, "false"), (3, None, None, "true"), (4, 40, 1, None), (5, 50, 1, "true"), (6, 61, None, None)]
    return (spark.createDataFrame([(*t, OLD) for t in target], TARGET), spark.createDataFrame(changes, CHANGE))


@pytest.mark.parametrize("null_safe, first", [(False, (1, 10, None, False)), (True, (1, 10, 7, True))])
def test_merge_clauses(merge_frames, null_safe, first):
    merged = apply_changes(*merge_frames, null_safe=null_safe, at=NEW)
    assert merged.columns == ["id", "v", "d", "updated_at"]
    got = rows(merged.select("id", "v", "d", F.col("updated_at") == F.lit(NEW)))
    assert got == [first, (2, 20, 5, False), (4, 40, 1, True), (6, 61, None, True), (7, 70, 7, False)]


def test_merge_twice_changes_nothing(merge_frames):
    target, changes = merge_frames
    once = apply_changes(target, changes, at=OLD)
    assert rows(apply_changes(once, changes, at=NEW)) == rows(once)


def test_merge_with_empty_sides(merge_frames):
    target, changes = merge_frames
    assert rows(apply_changes(target, changes.limit(0))) == rows(target)
    started = apply_changes(target.limit(0), changes, at=NEW)
    assert rows(started) == rows(initial_rows(changes, at=NEW))


def test_two_changes_of_one_key_are_refused(merge_frames):
    target, changes = merge_frames
    with pytest.raises(PySparkException, match="more than one change for id = 2"):
        apply_changes(target, changes.unionByName(changes.where("id = 2"))).collect()
    assert rows(require_one_version(changes)) == rows(changes)


@pytest.mark.parametrize("seed", range(3))
def test_batches_in_turn_equal_all_at_once(spark, seed):
    """Against a plain replay, too."""
    pick = random.Random(seed)
    events = [
        (pick.randrange(40), pick.choice([None, 1, 2]), pick.choice(["Tennis", "Commute to work"]), pick.choice([None, "x", "y"]),
         pick.choice([None, "false", "true"]), n)
        for n in range(200)
    ]
    ddl = "id int, distance int, sport_type string, details string, __deleted string, kafka_offset bigint"
    feed = (
        spark.createDataFrame(events, ddl)
        .withColumn("employee_id", F.col("id") + 100)
        .withColumn("elapsed_time", F.lit(60))
        .withColumn("start_datetime", F.lit("2024-01-01 00:00:00"))
    )

    def changes(part):
        return to_silver(latest_version(part, order=["kafka_offset"]))

    state = initial_rows(changes(feed.where("kafka_offset < 50")), at=OLD)
    for start in (50, 100, 150):
        part = feed.where(f"kafka_offset >= {start} AND kafka_offset < {start + 50}")
        state = apply_changes(state, changes(part), at=NEW)
    alive = {}
    for ident, distance, sport, details, deleted, _ in events:
        alive.pop(ident, None)
        if deleted != "true":
            alive[ident] = (ident, distance, sport, details)
    got = rows(state, "id", "distance", "sport_type", "details")
    assert got == sorted(alive.values(), key=repr)
    assert got == rows(initial_rows(changes(feed)), "id", "distance", "sport_type", "details")
