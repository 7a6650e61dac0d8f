"""Bronze to Silver to Gold."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, functions as F

from ..functions.rules import ORPHAN_REASON
from ..operators.cdc import ARRIVAL, apply_in_order, latest_or_keyless, latest_version, to_silver
from ..operators.eligibility import FLAGS, activity_stats, add_stat_changes, gold_eligibility, gold_from_stats
from ..operators.quality import (
    REASON,
    clean_rows,
    rejected_rows,
    rule_metrics,
    tag_orphans,
    tag_violations,
    valid_rows,
    with_known_key,
)
from ..operators.reference import silver_employees
from ..session import sized_shuffles
from ..sources import files
from ..sources.landed import near
from ..sources.tables import export_parquet
from .lake import Lake, Options


def tag_all(
    bronze: DataFrame, employees: DataFrame | None, options: Options = Options(), order: Sequence[str] = ARRIVAL
) -> DataFrame:
    """Bronze rows with every reason against them, rules and key check, in one pass."""
    rows = latest_or_keyless(bronze, order=order) if options.dedup_first else bronze
    tagged = tag_violations(rows, exempt_deletes=options.exempt_deletes)
    return tag_orphans(tagged, employees, exempt_deletes=options.exempt_deletes)


def silver_changes(
    bronze: DataFrame, employees: DataFrame | None, options: Options = Options(), order: Sequence[str] = ARRIVAL,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One change per key, ready to merge, with the columns to ``keep`` besides Silver's.

    Where only the valid rows are wanted, rules become scan filters and the key check a
    semi join; nothing is tagged.
    """
    if options.exempt_deletes:
        valid = clean_rows(tag_all(bronze, employees, options, order))
    else:
        rows = latest_version(bronze, order=order) if options.dedup_first else bronze
        valid = valid_rows(rows)
        valid = valid if employees is None else with_known_key(valid, employees)
    return to_silver(valid if options.dedup_first else latest_version(valid, order=order), keep)


def build_employees(lake: Lake, at: datetime | None = None) -> dict[str, int]:
    """Silver employees from the reference table. Returns rows and null keys, measured by the write."""
    reference = lake.reference.read()
    if reference is None:
        raise ValueError(f"no reference table in {lake.reference.path}")
    source = lake.reference.state()
    return lake.employees.write(
        silver_employees(reference, at), lake.run, built_from=source, null_keys=F.count_if(F.isnull("employee_id"))
    )


def ensure_employees(lake: Lake) -> dict[str, int] | None:
    """Silver employees anew if the reference table is not the one they were built from."""
    if lake.employees.exists() and lake.employees.source() == lake.reference.state():
        return None
    return build_employees(lake)


def merge_activities(lake: Lake, changes: DataFrame, run: str, batch_id: int | None, at: datetime) -> int:
    """Merge one-per-key changes into Silver, or load it the first time. Returns the rows of the new version.

    A change wins over older rows only, so the same batch twice, or batches out of order,
    leave the same Silver. The rows counted include delete markers. In hash partitions only
    those of the changed keys are read and written, and counted. Shuffles are as wide as Silver needs.
    """
    table = lake.activities
    with sized_shuffles(lake.spark, table.stored_bytes()):
        if lake.partitions:
            step = partial(apply_in_order, null_safe=lake.options.null_safe, at=at, before=True)
            return table.merge(changes, step, run, batch_id)["rows"]
        merged = apply_in_order(table.history(), table.align(changes), null_safe=lake.options.null_safe, at=at)
        return table.write(merged, run, batch_id)["rows"]


def apply_batch(lake: Lake, batch: DataFrame, batch_id: int) -> None:
    """One increment of Bronze. Safe to repeat: quarantine is replaced per batch, Silver applied once.

    The batch is read twice, once for the rejects and once for the changes. Holding it
    tagged in between would write all of it to executor disks, which a backlog of any size
    must not depend on. Given as files, it is read with the rules as scan filters.
    """
    at = datetime.now(timezone.utc)
    employees = lake.employees.read()
    if lake.partitions:
        lake.activities.recover()
    rejects = rejected_rows(tag_all(batch, employees, lake.options), at)
    found, written = lake.quarantine.measured_write(rejects, lake.run, batch_id, **rule_metrics()), None
    if not lake.activities.applied(lake.run, batch_id):
        changes = silver_changes(batch, employees, lake.options, keep=ARRIVAL)
        written = merge_activities(lake, changes, lake.run, batch_id, at)
    report_batch(lake, batch_id, found, written, at)


REPORT_DDL = "reported_at timestamp, rejected bigint, rejects_by_rule map<string,bigint>, silver_rows bigint"


def report_batch(lake: Lake, batch_id: int, found: dict[str, int], written: int | None, at: datetime) -> None:
    """One row about a batch, from what its writes measured; a repeated batch replaces its row.

    ``silver_rows``: rows that the merge wrote, null if an earlier attempt had merged the batch.
    Null ids and employees are the rules of that name.
    """
    by_rule = {rule: n for rule, n in found.items() if rule != "rows" and n}
    row = lake.spark.createDataFrame([(at, found["rows"], by_rule, written)], REPORT_DDL)
    lake.reports.write(row, lake.run, batch_id)


def rebuild_silver(lake: Lake, at: datetime | None = None) -> dict[str, int]:
    """Silver and quarantine anew from all of Bronze, whatever Silver holds now."""
    at = at or datetime.now(timezone.utc)
    bronze, employees = lake.bronze(), lake.employees.read()
    with sized_shuffles(lake.spark, files.size(lake.spark, lake.bronze_path)):
        rejected = lake.quarantine.write(
            rejected_rows(tag_all(bronze, employees, lake.options), at), f"{lake.run}-rebuild", 0
        )
        changes = silver_changes(bronze, employees, lake.options, keep=ARRIVAL)
        changes = changes if lake.partitions else lake.activities.align(changes)
        rows = lake.activities.write(apply_in_order(None, changes, at=at), f"{lake.run}-rebuild")["rows"]
    return {"rows": rows, "rejected": rejected}


def replay_orphans(lake: Lake, at: datetime | None = None) -> int:
    """Admit rows that were orphans once and whose employee is known now.

    Keys with such a row are worked out afresh from all their Bronze rows, so a newer
    version or delete that came in the meantime still wins. Their topic positions are
    logged once they are in, so that a replay without news writes nothing. Run it after the
    stream has caught up with Bronze. Returns the rows of the new Silver version, -1 if there
    is none.
    """
    history, employees = lake.quarantine.read(), lake.employees.read()
    if history is None or employees is None:
        return -1
    position = ["kafka_partition", "kafka_offset"]
    orphans = history.where(f"{REASON} = '{ORPHAN_REASON}'").select("id", "employee_id", *position)
    done = lake.replayed.read()
    if done is not None:
        orphans = orphans.join(done.select(*position), position, "left_anti")
    admitted = with_known_key(orphans, employees)
    if admitted.isEmpty():
        return -1
    affected = with_known_key(near(lake.bronze(), admitted, "id"), admitted.select("id"), "id")
    changes = silver_changes(affected, employees, lake.options, keep=ARRIVAL)
    rows = merge_activities(lake, changes, f"{lake.run}-replay", None, at or datetime.now(timezone.utc))
    lake.replayed.write(admitted.select("id", *position).distinct(), lake.run, lake.activities.versions()[-1].number)
    return rows


def ensure_admitted(lake: Lake, at: datetime | None = None) -> int:
    """Replay the orphans if the employees are not those of the last replay. Returns what ``replay_orphans`` does.

    Rows are checked against the employees known when they come, so an orphan can only be
    admitted after those have changed. The employees are noted once the replay is done: one
    that was lost half way is made up for by the next call.
    """
    known = lake.employees.state()
    if lake.admissions.source() == known:
        return -1
    at = at or datetime.now(timezone.utc)
    rows = replay_orphans(lake, at)
    note = lake.spark.createDataFrame([(at, rows)], "replayed_at timestamp, silver_rows bigint")
    lake.admissions.write(note, lake.run, built_from=known)
    return rows


def ensure_totals(lake: Lake) -> str:
    """Totals per employee up to Silver's present state. Returns how: ``kept``, ``changes`` or ``rebuilt``.

    The totals say which state of Silver they hold. All commits since then are added in one
    go, so a lost job, or several commits without one, are made up for; Silver itself is
    read only if there are no totals yet or a commit's changes are no longer kept.
    """
    table, state, held = lake.activities, lake.activities.state(), lake.totals.source()
    if held == state:
        return "kept"
    changes = table.changes_since(held)
    if changes is None:
        lake.totals.write(activity_stats(table.read()), lake.run, built_from=state)
        return "rebuilt"
    lake.totals.write(add_stat_changes(lake.totals.read(), changes), lake.run, built_from=state)
    return "changes"


def gold_source(lake: Lake) -> str:
    return f"{lake.activities.state()} {lake.employees.state()}"


def ensure_gold(lake: Lake, export_to: str | None = None) -> dict[str, int] | None:
    """Gold anew if Silver or the employees are not what it was built from: after news, or a lost Gold job."""
    if not lake.activities.exists() or lake.gold.source() == gold_source(lake):
        return None
    return build_gold(lake, export_to)


def build_gold(lake: Lake, export_to: str | None = None, at: datetime | None = None) -> dict[str, int]:
    """Gold, its report, and on request the two Parquet exports."""
    activities, employees = lake.activities.read(), lake.employees.read()
    if activities is None or employees is None:
        raise ValueError("Gold needs Silver activities and Silver employees")
    source = gold_source(lake)
    with sized_shuffles(lake.spark, lake.activities.stored_bytes()):
        if lake.partitions:
            ensure_totals(lake)
            gold = gold_from_stats(employees, lake.totals.read(), at)
        else:
            gold = gold_eligibility(employees, activities, at)
        report = lake.gold.write(
            gold,
            lake.run,
            built_from=source,
            eligible_prime=F.count_if(FLAGS[0]),
            eligible_wellness=F.count_if(FLAGS[1]),
        )
    if export_to:
        export_parquet(lake.gold.read(), f"{export_to}/employee_eligibility.parquet")
        export_parquet(activities, f"{export_to}/activities.parquet")
    return report
