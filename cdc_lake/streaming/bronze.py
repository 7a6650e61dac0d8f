"""Land change messages in Bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.cdc import to_bronze
from ..operators.payloads import malformed_payloads
from ..plans.lake import Lake
from ..schemas import change_ddl
from ..sources.reference_csv import load_reference

# -- fixed values: pace, preview size, query names --

LANDING_INTERVAL = "30 seconds"
PREVIEW_ROWS = 50
LANDING_NAME = "Bronze - Activities"
PREVIEW_NAME = "Bronze Console Monitor"
MALFORMED_NAME = "Bronze - Malformed payloads"

# -- end of fixed values --


def bronze_rows(lake: Lake, messages: DataFrame) -> DataFrame:
    """Rows to land. With ``republished_within`` the stream remembers topic positions for that long.

    The clock is that of the landing, not of the messages: no message is ever too late, so none is lost.
    """
    if lake.options.republished_within:
        timed = messages.withColumn("_landed", F.current_timestamp()).withWatermark("_landed", lake.options.republished_within)
        messages = timed.dropDuplicatesWithinWatermark(["topic", "partition", "offset"]).drop("_landed")
    return to_bronze(messages, change_ddl(lake.options.key_type), lake.options.drop_tombstones)


def start_landing(lake: Lake, messages: DataFrame, **trigger) -> StreamingQuery:
    """Append to Bronze, one folder per day. ``availableNow=True`` drains the source and ends.

    Its tasks sort by day unless the session lets them keep some files open (``SCALE_CONF``,
    ``unsorted_folders``): the sink asks the session whenever a batch is written, not at the start.
    """
    return (
        bronze_rows(lake, messages)
        .writeStream.trigger(**(trigger or {"processingTime": LANDING_INTERVAL}))
        .outputMode("append")
        .format("parquet")
        .option("checkpointLocation", lake.checkpoint("bronze"))
        .option("path", lake.bronze_path)
        .partitionBy("ingest_date")
        .queryName(LANDING_NAME)
        .start()
    )


def start_malformed(lake: Lake, messages: DataFrame, **trigger) -> StreamingQuery:
    """Keep the text of payloads that are no JSON object. Its own query, so it never holds up the landing."""
    return (
        malformed_payloads(messages)
        .withColumn("rejected_at", F.current_timestamp())
        .writeStream.trigger(**(trigger or {"processingTime": LANDING_INTERVAL}))
        .format("parquet")
        .option("checkpointLocation", lake.checkpoint("malformed"))
        .option("path", lake.malformed_path)
        .queryName(MALFORMED_NAME)
        .start()
    )


def start_preview(lake: Lake, messages: DataFrame, **trigger) -> StreamingQuery:
    """Print some rows of each batch. Its own query and checkpoint, so it never holds up the landing."""
    writer = (
        bronze_rows(lake, messages)
        .writeStream.outputMode("append")
        .format("console")
        .option("truncate", "false")
        .option("numRows", PREVIEW_ROWS)
        .option("checkpointLocation", lake.checkpoint("bronze_preview"))
        .queryName(PREVIEW_NAME)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def run_bronze(
    lake: Lake, messages: DataFrame, employees_path: str, sports_path: str, preview: bool = True
) -> None:
    """Load the reference files if that was never done, then land until a query ends."""
    load_reference(
        lake.spark, employees_path, sports_path, lake.reference, key_type=lake.options.key_type, quarantine=lake.reference_quarantine
    )
    start_landing(lake, messages)
    start_malformed(lake, messages)
    if preview:
        start_preview(lake, messages)
    lake.spark.streams.awaitAnyTermination()
