"""Data quality: tag, split, check keys against reference data, report."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.rules import ORPHAN_REASON, REASON_SEPARATOR, Rule, activity_rules, delete_rules, sql_text
from ..functions.timestamps import stamp
from .joins import lookup_join

REASON = "rejection_reason"


def _reason(rules: Sequence[Rule]) -> str:
    names = ", ".join(f"IF({rule.broken}, {sql_text(rule.name)}, NULL)" for rule in rules)
    return f"concat_ws('{REASON_SEPARATOR}', {names})"


def _valid(rules: Sequence[Rule]) -> str:
    return " AND ".join(f"NOT ({rule.broken})" for rule in rules)


def tag_violations(df: DataFrame, rules: Sequence[Rule] | None = None, exempt_deletes: bool = False) -> DataFrame:
    """Add the names of all broken rules in rule order; empty text means valid.

    ``exempt_deletes`` asks of a delete event no more than its key, for sources that send
    deletes without the other columns.
    """
    reason = _reason(activity_rules() if rules is None else rules)
    if exempt_deletes:
        reason = f"IF(__deleted <=> 'true', {_reason(delete_rules())}, {reason})"
    return df.withColumn(REASON, F.expr(reason))


def valid_rows(df: DataFrame, rules: Sequence[Rule] | None = None, exempt_deletes: bool = False) -> DataFrame:
    """Rows that break no rule, without tagging: a plain conjunction that reaches the scan."""
    valid = _valid(activity_rules() if rules is None else rules)
    if exempt_deletes:
        valid = f"IF(__deleted <=> 'true', {_valid(delete_rules())}, {valid})"
    return df.where(valid)


def clean_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(f"{REASON} = ''").drop(REASON)


def rejected_rows(tagged: DataFrame, at: datetime | None = None) -> DataFrame:
    return tagged.where(f"{REASON} <> ''").withColumn("rejected_at", stamp(at))


def split_tagged(tagged: DataFrame, at: datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """Clean rows and rejects: disjoint, and together everything."""
    return clean_rows(tagged), rejected_rows(tagged, at)


def distinct_keys(reference: DataFrame, key: str = "employee_id") -> DataFrame:
    return reference.select(key).distinct()


def with_known_key(df: DataFrame, reference: DataFrame, key: str = "employee_id") -> DataFrame:
    """Rows whose key is in the reference, each once.

    A key that fills a third of either side is harmless: repeats in the reference are
    merged before they are shuffled, and AQE splits the rows.
    """
    return lookup_join(df, distinct_keys(reference, key), key, "left_semi")


def with_unknown_key(
    df: DataFrame, reference: DataFrame | None, key: str = "employee_id", at: datetime | None = None
) -> DataFrame:
    """Rows whose key is not in the reference, with the reason; none if there is no reference."""
    if reference is None:
        missing = df.limit(0)
    else:
        missing = lookup_join(df, distinct_keys(reference, key), key, "left_anti")
    return missing.select(*df.columns, F.lit(ORPHAN_REASON).alias(REASON), stamp(at).alias("rejected_at"))


def check_keys(
    df: DataFrame, reference: DataFrame | None, key: str = "employee_id", at: datetime | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows with a known key, and orphans. Without a reference table every row passes."""
    valid = df if reference is None else with_known_key(df, reference, key)
    return valid, with_unknown_key(df, reference, key, at)


def tag_orphans(
    tagged: DataFrame, reference: DataFrame | None, key: str = "employee_id", exempt_deletes: bool = False
) -> DataFrame:
    """Put the orphan reason on rows that broke no rule but whose key is unknown.

    One join gives both outputs of the key check; use it where both are needed.
    """
    if reference is None:
        return tagged
    known = distinct_keys(reference, key).where(f"{key} IS NOT NULL").withColumn("_known", F.lit(True))
    orphan = f"{REASON} = '' AND _known IS NULL" + (" AND NOT (__deleted <=> 'true')" if exempt_deletes else "")
    reason = F.expr(f"IF({orphan}, '{ORPHAN_REASON}', {REASON})")
    return lookup_join(tagged, known, key).withColumn(REASON, reason).drop("_known")


def union_rejects(*parts: DataFrame) -> DataFrame:
    """All rejects as one frame; a column that a part lacks is null."""
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result


def rejection_summary(rejected: DataFrame) -> DataFrame:
    """Records per rule, most frequent first.

    Reasons are counted before they are split: few distinct reasons reach the explode,
    however many rows were rejected.
    """
    return (
        rejected.groupBy(REASON)
        .agg(F.expr("count(*) AS records"))
        .selectExpr(f"explode(split({REASON}, '{REASON_SEPARATOR}')) AS rule", "records")
        .groupBy("rule")
        .agg(F.expr("sum(records) AS records"))
        .orderBy(F.desc("records"), "rule")
    )


def rule_metrics() -> dict[str, Column]:
    """Rejects per rule as metrics of a write of rejected rows: no scan of their own, and no reason is split."""
    names = [*(rule.name for rule in activity_rules()), ORPHAN_REASON]
    edge = F.lit(REASON_SEPARATOR)
    return {name: F.count_if(F.contains(F.concat(edge, REASON, edge), F.concat(edge, F.lit(name), edge))) for name in names}


def bronze_profile(df: DataFrame) -> DataFrame:
    """Rows, rows without id, rows without employee: one pass."""
    return df.agg(
        F.expr("count(*) AS records"),
        F.expr("count_if(id IS NULL) AS null_ids"),
        F.expr("count_if(employee_id IS NULL) AS null_employees"),
    )


def null_key_count(df: DataFrame, key: str = "employee_id") -> DataFrame:
    return df.agg(F.expr("count(*) AS records"), F.expr(f"count_if({key} IS NULL) AS null_keys"))


def null_key_sample(df: DataFrame, key: str = "employee_id", rows: int = 10) -> DataFrame:
    """A few offenders to look at. A preview, not a filter: no row is dropped from the data."""
    return df.where(f"{key} IS NULL").limit(rows)
