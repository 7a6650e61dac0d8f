"""A few calls on the Hadoop file system of a path, whichever store that is."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _locate(spark: SparkSession, path: str):
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    system, location = _locate(spark, path)
    return system.exists(location)


def child_names(spark: SparkSession, path: str) -> list[str]:
    system, location = _locate(spark, path)
    if not system.exists(location):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(location))


def size(spark: SparkSession, path: str) -> int:
    """Bytes in a file or folder; 0 if there is none."""
    system, location = _locate(spark, path)
    return system.getContentSummary(location).getLength() if system.exists(location) else 0


def make_folder(spark: SparkSession, path: str) -> None:
    system, location = _locate(spark, path)
    system.mkdirs(location)


def remove(spark: SparkSession, path: str) -> None:
    system, location = _locate(spark, path)
    system.delete(location, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, or nothing if there is none."""
    system, location = _locate(spark, path)
    if not system.exists(location):
        return None
    stream = system.open(location)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    system, location = _locate(spark, path)
    stream = system.create(location, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
