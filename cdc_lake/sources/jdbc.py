"""Insert activities into a relational table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame

# -- fixed values: inserted columns, in order --

INSERT_COLUMNS = ("employee_id", "start_timestamp", "sport_type", "distance", "elapsed_time", "details")

# -- end of fixed values --


def insert_activities(
    df: DataFrame,
    url: str,
    connect: Callable[[], object],
    table: str = "activities",
    properties: dict[str, str] | None = None,
    clean_before_insert: bool = True,
) -> bool:
    """Append the six columns to ``table``, all or nothing; optionally empty it first.

    Spark commits a JDBC write per partition. So the executors write a staging table in
    parallel, and one transaction inside the database moves it over; no row passes the
    driver. ``connect`` opens a DB-API connection for that. Returns false, and does
    nothing, for an empty frame.
    """
    if df.isEmpty():
        return False
    staging = f"{table}_staging_{uuid.uuid4().hex[:12]}"  # of its own: runs may overlap
    columns = ", ".join(INSERT_COLUMNS)
    df.select(*INSERT_COLUMNS).write.mode("overwrite").jdbc(url, staging, properties=properties or {})
    connection = connect()
    try:
        cursor = connection.cursor()
        if clean_before_insert:
            cursor.execute(f"TRUNCATE TABLE {table} RESTART IDENTITY")
        cursor.execute(f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staging}")
        cursor.execute(f"DROP TABLE {staging}")
        connection.commit()
    except Exception:
        connection.rollback()
        connection.cursor().execute(f"DROP TABLE {staging}")
        connection.commit()
        raise
    finally:
        connection.close()
    return True
