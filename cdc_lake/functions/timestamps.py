"""Epoch microseconds to text and to timestamps."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, functions as F

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def epoch_text(micros: str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in the session time zone; the part below a second is cut toward zero."""
    return F.expr(f"from_unixtime(`{micros}` div 1000000)")


def epoch_timestamp(micros: str) -> Column:
    """A timestamp; null and 0 both mean that no time is known."""
    return F.expr(f"timestamp_micros(nullif(`{micros}`, 0))")


def stamp_sql(at: datetime | None = None) -> str:
    """The given moment, which must carry its time zone, or the start of the query."""
    if at is None:
        return "current_timestamp()"
    if at.tzinfo is None:
        raise ValueError("a moment needs a time zone")
    return f"timestamp_micros({(at - _EPOCH) // timedelta(microseconds=1)})"


def stamp(at: datetime | None = None) -> Column:
    return F.expr(stamp_sql(at))
