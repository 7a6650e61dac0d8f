"""Change feed: parse, pick the latest version per key, apply to a keyed table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ..functions.rules import is_active, is_commute
from ..functions.timestamps import epoch_text, stamp, stamp as stamp_at, stamp_sql
from ..schemas import CHANGE_DDL

# Arrival order. The two Kafka columns make it total: all changes of one
# micro-batch carry the same ingestion time.
ARRIVAL = ("ingested_at", "kafka_partition", "kafka_offset")

SILVER_COLUMNS = (
    "id",
    "employee_id",
    "start_datetime",
    "sport_type",
    "distance",
    "elapsed_time",
    "details",
    "is_commute",
)


def skip_tombstones(messages: DataFrame) -> DataFrame:
    return messages.where(F.isnotnull("value"))


def parse_changes(messages: DataFrame, ddl: str = CHANGE_DDL, keep: Sequence[str] = ()) -> DataFrame:
    """The fields of the JSON in ``value``, next to the message columns named in ``keep``.

    A null or malformed value gives a row of nulls; a mistyped field is null by itself.
    """
    payload = F.from_json(F.col("value").cast("string"), ddl)
    return messages.select(payload.alias("_payload"), *keep).select("_payload.*", *keep)


def with_start_datetime(changes: DataFrame) -> DataFrame:
    return changes.withColumn("start_datetime", epoch_text("start_timestamp"))


def to_bronze(messages: DataFrame, ddl: str = CHANGE_DDL, drop_tombstones: bool = False) -> DataFrame:
    """Messages to Bronze rows. Narrow: no shuffle, so it keeps pace with the source."""
    source = skip_tombstones(messages) if drop_tombstones else messages
    parsed = parse_changes(source, ddl, keep=["partition", "offset"])
    changes = [c for c in parsed.columns if c not in ("partition", "offset")]
    return with_start_datetime(parsed).selectExpr(
        *(f"`{c}`" for c in changes),
        "start_datetime",
        "current_timestamp() AS ingested_at",
        "partition AS kafka_partition",
        "offset AS kafka_offset",
        "current_date() AS ingest_date",
    )


def latest_version(changes: DataFrame, key: str = "id", order: Sequence[str] = ARRIVAL) -> DataFrame:
    """One row per key: the last by ``order``.

    Spark limits each key to one row before the shuffle as well as after it, so a key with a
    third of all versions costs the shuffle one row per map task. Unlike an aggregate of
    whole rows, this leaves unused columns to be pruned at the scan.
    """
    newest_first = ", ".join(f"{c} DESC" for c in order)
    nth = F.expr(f"row_number() OVER (PARTITION BY {key} ORDER BY {newest_first})")
    return changes.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def latest_or_keyless(changes: DataFrame, key: str = "id", order: Sequence[str] = ARRIVAL) -> DataFrame:
    """The last row per key, and every row without a key: those are no versions of each other."""
    newest = latest_version(changes.where(f"{key} IS NOT NULL"), key, order)
    return newest.unionByName(changes.where(f"{key} IS NULL"))


def to_silver(changes: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Silver columns, with the delete flag still there for the merge, and the columns to ``keep``."""
    return changes.withColumn("is_commute", is_commute()).select(*SILVER_COLUMNS, "__deleted", *keep)


def active_rows(changes: DataFrame, flag: str = "__deleted") -> DataFrame:
    return changes.where(is_active(flag))


def initial_rows(changes: DataFrame, flag: str = "__deleted", at: datetime | None = None) -> DataFrame:
    """First load of a keyed table: the active rows, stamped."""
    return active_rows(changes, flag).drop(flag).withColumn("updated_at", stamp(at))


def require_one_version(changes: DataFrame, key: str = "id") -> DataFrame:
    """The same rows; the job fails if a key comes twice.

    The window is on the merge key, so the merge join reuses its shuffle and its sort.
    """
    message = f"concat('more than one change for {key} = ', {key})"
    return (
        changes.withColumn("_nth", F.expr(f"row_number() OVER (PARTITION BY {key} ORDER BY {key})"))
        .where(f"IF(_nth > 1, raise_error({message}), true)")
        .drop("_nth")
    )


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    key: str = "id",
    flag: str = "__deleted",
    stamp: str = "updated_at",
    null_safe: bool = True,
    check_source: bool = True,
    at: datetime | None = None,
) -> DataFrame:
    """The next state of ``target``: one full outer join, one shuffle per side at most.

    matched and deleted: gone; matched, active and different: updated and stamped; only in
    ``changes`` and active: inserted; only in ``changes`` and deleted: nothing; all else
    stays. ``null_safe=False`` compares with plain ``<>``, which overlooks a change from or
    to null.
    """
    values = [c for c in target.columns if c not in (key, stamp)]
    source = require_one_version(changes, key) if check_source else changes
    old = target.selectExpr("*", "true AS here").alias("old")
    new = source.selectExpr(key, *values, f"NOT ({flag} <=> 'true') AS active", "true AS here").alias("new")

    unlike = "NOT (old.{0} <=> new.{0})" if null_safe else "old.{0} <> new.{0}"
    changed = " OR ".join(unlike.format(c) for c in values)
    take_new = f"new.here IS NOT NULL AND (old.here IS NULL OR coalesce({changed}, false))"
    result = {
        key: f"coalesce(old.{key}, new.{key})",
        **{c: f"IF(take_new, new.{c}, old.{c})" for c in values},
        stamp: f"IF(take_new, {stamp_sql(at)}, old.{stamp})",
    }
    return (
        old.join(new, F.expr(f"old.{key} = new.{key}"), "full_outer")
        .where("new.here IS NULL OR new.active")
        .withColumn("take_new", F.expr(take_new))
        .selectExpr(*(f"{result[c]} AS {c}" for c in target.columns))
    )


def apply_in_order(
    target: DataFrame | None,
    changes: DataFrame,
    key: str = "id",
    flag: str = "__deleted",
    stamp: str = "updated_at",
    order: Sequence[str] = ARRIVAL,
    null_safe: bool = True,
    at: datetime | None = None,
    before: bool = False,
) -> DataFrame:
    """The next state of a table that knows when each row arrived. One full outer join.

    A change wins only over an older row, so batches may come twice, late or in parts. The
    table keeps ``order`` and ``flag``: a deleted key stays as a marker that older changes
    don't pass (``current_rows`` leaves markers out). A row that lacks them, from a plain
    first load, counts as older than any change. ``stamp`` moves only if a value does.

    ``before`` adds ``_moved``, whether the row is another than before, and ``_before``, the
    values and ``flag`` it had (null for a new key).
    """
    if target is None:
        first = changes.withColumn(stamp, stamp_at(at))
        if not before:
            return first
        kept = [f"`{c}` {kind}" for c, kind in changes.dtypes if c not in (key, *order)]
        return first.withColumn("_moved", F.lit(True)).withColumn("_before", F.lit(None).cast(f"struct<{', '.join(kept).replace('` ', '`:')}>"))
    for name, kind in changes.select(flag, *order).dtypes:
        target = target if name in target.columns else target.withColumn(name, F.lit(None).cast(kind))
    values = [c for c in changes.columns if c not in (key, flag, *order)]
    old, new = target.selectExpr("*", "true AS here").alias("old"), changes.selectExpr("*", "true AS here").alias("new")

    # Arrival as a tuple: the first part that differs decides; a missing arrival is the oldest.
    later, same = "false", "true"
    for c in order:
        later += f" OR ({same} AND (old.{c} IS NULL AND new.{c} IS NOT NULL OR coalesce(new.{c} > old.{c}, false)))"
        same += f" AND old.{c} <=> new.{c}"
    unlike = "NOT (old.{0} <=> new.{0})" if null_safe else "old.{0} <> new.{0}"
    dead = "({0}.{1} <=> 'true')"
    changed = " OR ".join([*(unlike.format(c) for c in values), f"{dead.format('old', flag)} <> {dead.format('new', flag)}"])
    result = {
        key: f"coalesce(old.{key}, new.{key})",
        **{c: f"IF(moved, new.{c}, old.{c})" for c in values},
        **{c: f"IF(newer, new.{c}, old.{c})" for c in (flag, *order)},
        stamp: f"IF(moved, {stamp_sql(at)}, old.{stamp})",
    }
    output = [f"{result[c]} AS {c}" for c in (key, *values, flag, *order, stamp)]
    if before:
        image = ", ".join(f"'{c}', old.{c}" for c in changes.columns if c not in (key, *order))
        output += ["moved AS _moved", f"IF(moved AND old.here IS NOT NULL, named_struct({image}), NULL) AS _before"]
    return (
        old.join(new, F.expr(f"old.{key} = new.{key}"), "full_outer")
        .withColumn("newer", F.expr(f"new.here IS NOT NULL AND (old.here IS NULL OR {later})"))
        .withColumn("moved", F.expr(f"newer AND (old.here IS NULL OR coalesce({changed}, false))"))
        .selectExpr(*output)
    )


def current_rows(table: DataFrame, flag: str = "__deleted", order: Sequence[str] = ARRIVAL) -> DataFrame:
    """A table kept by ``apply_in_order`` without delete markers and arrival columns."""
    return active_rows(table, flag).drop(flag, *order) if flag in table.columns else table
