"""Key checks by bitmaps of ids."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cdc_lake.operators.bitmaps import id_bitmaps, with_id_in, with_id_not_in

from .conftest import rows

KNOWN = [0, 1, -1, 7, 8, 32767, 32768, 32769, -32768, -32767, 65536, 2**40, 2**62, -(2**62), 1, 1, None]
ASKED = KNOWN + [2, -2, 9, 32766, 32770, 65535, 65537, 2**40 + 1, 2**62 - 1, None, -32769, 7]


@pytest.fixture
def bitmaps(spark, lake_root):
    id_bitmaps(spark.createDataFrame([(i,) for i in KNOWN], "k bigint"), "k").write.parquet(lake_root)
    return spark.read.parquet(lake_root)


def test_lookup_is_exact(spark, bitmaps):
    asked = spark.createDataFrame([(i, n, "x") for n, i in enumerate(ASKED)], "k bigint, n int, _bucket string")
    inside = [(n, i) for n, i in enumerate(ASKED) if i is not None and i in KNOWN]
    assert rows(with_id_in(asked, bitmaps, "k"), "n", "k") == sorted(inside, key=repr)
    assert rows(with_id_not_in(asked, bitmaps, "k"), "n") == sorted([(n,) for n in range(len(ASKED)) if (n, ASKED[n]) not in inside], key=repr)


def test_ids_of_another_type(spark, bitmaps):
    asked = spark.range(-40_000, 70_000).select(F.col("id").cast("int").alias("k"))
    assert rows(with_id_in(asked, bitmaps, "k")) == sorted([(i,) for i in set(KNOWN) - {None} if -40_000 <= i < 70_000], key=repr)


def test_facts_are_not_shuffled(spark, bitmaps):
    plan = with_id_in(spark.range(100).withColumnRenamed("id", "k"), bitmaps, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_empty_set(spark):
    none = id_bitmaps(spark.createDataFrame([], "k bigint"), "k")
    asked = spark.range(3).withColumnRenamed("id", "k")
    assert with_id_in(asked, none, "k").isEmpty() and with_id_not_in(asked, none, "k").count() == 3
