"""Notifications: change rows to readable rows, the latest of a batch, its message."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import text
from ..functions.rules import is_deleted
from ..functions.timestamps import epoch_timestamp
from ..schemas import CHANGE_DDL
from .cdc import parse_changes, skip_tombstones

MESSAGE_ORDER = ("timestamp", "partition", "offset")


def notification_rows(changes: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return changes.select(
        F.col("id").alias("activity_id"),
        "employee_id",
        "sport_type",
        "distance",
        "elapsed_time",
        epoch_timestamp("start_timestamp").alias("start_timestamp"),
        "details",
        is_deleted().alias("is_deleted"),
        *keep,
    )


def notifications(messages: DataFrame, ddl: str = CHANGE_DDL) -> DataFrame:
    """Messages to notification rows, tombstones left out, arrival columns kept."""
    changes = parse_changes(skip_tombstones(messages), ddl, keep=MESSAGE_ORDER)
    return notification_rows(changes, keep=MESSAGE_ORDER)


def batch_latest(rows: DataFrame, order: Sequence[str] = MESSAGE_ORDER) -> DataFrame:
    """The last row and ``total_in_batch``; no row for an empty batch.

    Each task sends one row and one count, however large the batch.
    """
    rest = [c for c in rows.columns if c not in order]
    whole = ", ".join([*order, *rest])
    return (
        rows.agg(F.expr(f"max(struct({whole})) AS _last"), F.expr("count(*) AS total_in_batch"))
        .where("total_in_batch > 0")
        .selectExpr(*(f"_last.{c} AS {c}" for c in rest), "total_in_batch")
    )


def with_message(rows: DataFrame) -> DataFrame:
    """Add title, color, description and the JSON body. Needs ``total_in_batch``."""
    lines = ", '\\n', ".join([
        f"'**Sport :** ', {text.shown('sport_type')}",
        f"'**Date :** ', {text.date_text('start_timestamp')}",
        "'**Distance :** ', coalesce(distance, 0), ' m'",
        f"'**Durée :** ', {text.minutes_text('elapsed_time')}, ' min'",
        f"'**Détails :** ', {text.shown('details')}",
    ])
    note = f"IF(total_in_batch > 1, concat('\\n', format_string('{text.BATCH_NOTE}', total_in_batch)), '')"
    title = f"concat(IF(is_deleted, '{text.TITLE_DELETED}', '{text.TITLE_LATEST}'), {text.shown('employee_id')})"
    return rows.selectExpr(
        "*",
        f"{title} AS title",
        # Null for a delete by way of a null part: inside a branch of IF the repeated parts
        # of the duration would not be computed once and shared.
        f"concat(IF(is_deleted, NULL, ''), {lines}, {note}) AS description",
        f"IF(is_deleted, {text.COLOR_DELETED}, {text.COLOR_LATEST}) AS color",
    ).selectExpr("*", "to_json(struct(array(struct(title, description, color)) AS embeds)) AS body")
