"""Notify about the last change of each batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.notify import batch_latest, notifications, with_message
from ..plans.lake import Lake
from ..schemas import change_ddl

# -- fixed values: pace --

NOTIFY_INTERVAL = "300 seconds"

# -- end of fixed values --


def notify_batch(lake: Lake, messages: DataFrame, batch_id: int) -> None:
    """Write the message of one batch; a repeated batch replaces its own message."""
    rows = notifications(messages, change_ddl(lake.options.key_type))
    message = with_message(batch_latest(rows))
    lake.notifications.write(message, lake.run, batch_id)


def start_notifications(lake: Lake, messages: DataFrame, **trigger) -> StreamingQuery:
    return (
        messages.writeStream.trigger(**(trigger or {"processingTime": NOTIFY_INTERVAL}))
        .foreachBatch(lambda batch, batch_id: notify_batch(lake, batch, batch_id))
        .option("checkpointLocation", lake.checkpoint("notifications"))
        .queryName("Notifications")
        .start()
    )
