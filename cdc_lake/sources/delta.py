"""Merge into a Delta table where the session has Delta. It rewrites touched files only."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def merge_sql(
    target: str, source: str, columns: list[str], key: str = "id", flag: str = "__deleted",
    stamp: str = "updated_at", null_safe: bool = True,
) -> str:
    """``MERGE INTO`` with the clauses of ``apply_changes``."""
    values = [c for c in columns if c not in (key, stamp)]
    live = f"NOT (s.{flag} <=> 'true')"
    differs = " OR ".join(f"NOT (t.{c} <=> s.{c})" if null_safe else f"t.{c} <> s.{c}" for c in values)
    updates = ", ".join([*(f"t.{c} = s.{c}" for c in values), f"t.{stamp} = current_timestamp()"])
    names = ", ".join([key, *values, stamp])
    inserted = ", ".join([*(f"s.{c}" for c in (key, *values)), "current_timestamp()"])
    return (
        f"MERGE INTO {target} t USING {source} s ON t.{key} = s.{key} "
        f"WHEN MATCHED AND s.{flag} = 'true' THEN DELETE "
        f"WHEN MATCHED AND {live} AND ({differs}) THEN UPDATE SET {updates} "
        f"WHEN NOT MATCHED AND {live} THEN INSERT ({names}) VALUES ({inserted})"
    )


def merge_into_delta(changes: DataFrame, path: str, columns: list[str], **options) -> None:
    view = f"delta_changes_{uuid.uuid4().hex}"
    changes.createOrReplaceTempView(view)
    try:
        changes.sparkSession.sql(merge_sql(f"delta.`{path}`", view, columns, **options))
    finally:
        changes.sparkSession.catalog.dropTempView(view)
