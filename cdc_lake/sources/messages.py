"""Change messages as a stream: Kafka, or files with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import MESSAGE_DDL


def kafka_messages(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest", **options: str
) -> DataFrame:
    """Subscribe to one topic. Extra options go to the source, for example ``maxOffsetsPerTrigger``."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
        .load()
    )


def file_messages(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Messages that something else lands as Parquet files."""
    return spark.readStream.schema(MESSAGE_DDL).options(**options).parquet(path)
