"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Folders of days that a task may write side by side without sorting its rows: a batch has one day, or two around midnight.
OPEN_DAYS = 4
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"

SCALE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    _WRITERS: str(OPEN_DAYS),
}

_WIDTH = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_PARTITION_BYTES = 256 * 1024 * 1024
#: AQE merges partitions as far as every core keeps one, and none of less than 8 MB is left.
_SPREAD = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "8m",
}


def build_session(app_name: str = "cdc_lake", **conf: str) -> SparkSession:
    """A session with ``SCALE_CONF``; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shuffle_width(input_bytes: int) -> int:
    return -(-input_bytes // _PARTITION_BYTES)


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int):
    """Let shuffles of the jobs inside start wide enough for ``input_bytes``.

    AQE merges small partitions but splits only skewed joins, so the width it starts from
    must fit the input: 200 partitions of 100 TB would be 500 GB each. The session's own
    setting is raised where it is too small, never lowered, and comes back afterwards. What
    AQE merges is spread over the cores: partitions of the advisory size would leave a job
    of some hundred MB to one or two tasks.
    """
    width = shuffle_width(input_bytes)
    chosen = dict(_SPREAD)
    if width > int(spark.conf.get(_WIDTH, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        chosen[_WIDTH] = str(width)
    with _settings(spark, chosen):
        yield


@contextmanager
def unsorted_folders(spark: SparkSession, open_files: int):
    """Writes into folders (``partitionBy``) that run inside keep so many files open, and sort rows by folder only beyond that."""
    with _settings(spark, {_WRITERS: str(open_files)}):
        yield


@contextmanager
def _settings(spark: SparkSession, chosen: dict[str, str]):
    before = {key: spark.conf.get(key, None) for key in chosen}
    for key, value in chosen.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder every executor can reach.

    The folder is the cluster's ``spark.checkpoint.dir``. A machine-local folder is
    only used in local mode, where driver and executors are one process.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="cdc_lake-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
