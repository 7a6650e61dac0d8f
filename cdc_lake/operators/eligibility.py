"""Gold: totals per employee and the two eligibility flags."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ..functions.rules import earns_prime, earns_wellness, is_active
from ..functions.timestamps import stamp
from .joins import lookup_join

# -- fixed values: output columns, in order --

TOTALS = (
    "total_activities",
    "total_commute_activities",
    "total_external_activities",
    "total_distance_m",
    "total_elapsed_time_s",
)
EMPLOYEE_FACTS = (
    "employee_id",
    "nom",
    "prenom",
    "bu",
    "type_de_contrat",
    "transport_mode",
    "external_sport",
    "salaire_brut",
)
FLAGS = ("is_eligible_prime_sportive", "is_eligible_journees_bien_etre")

# -- end of fixed values --


def activity_stats(activities: DataFrame) -> DataFrame:
    """Totals per employee. All five combine map-side, so a hot employee is one row per task."""
    count, commutes, externals, distance, elapsed = TOTALS
    return activities.groupBy("employee_id").agg(
        F.expr(f"count(*) AS {count}"),
        F.expr(f"count_if(is_commute) AS {commutes}"),
        F.expr(f"count_if(NOT is_commute) AS {externals}"),
        F.expr(f"coalesce(sum(distance), 0L) AS {distance}"),
        F.expr(f"coalesce(sum(elapsed_time), 0L) AS {elapsed}"),
    )


def stat_changes(moved: DataFrame, flag: str = "__deleted") -> DataFrame:
    """What merged rows (``apply_in_order`` with ``before``) add to and take from the totals per employee.

    A row that is now another counts once with its old values, as minus, and once with its
    new ones, as plus, each only if not deleted. Sums combine map-side, and no row that
    stayed as it was takes part.
    """
    facts = ("employee_id", "is_commute", "distance", "elapsed_time", flag)
    image = lambda prefix, sign: F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in facts], F.lit(sign).alias("sign"))
    both = F.array(image("", 1), F.when(F.isnotnull("_before"), image("_before.", -1)))
    rows = moved.where("_moved").select(F.explode(both).alias("r")).where("r IS NOT NULL").select("r.*")
    count, commutes, externals, distance, elapsed = TOTALS
    sums = rows.where(is_active(flag)).groupBy("employee_id").agg(
        F.expr(f"sum(CAST(sign AS bigint)) AS {count}"),
        F.expr(f"sum(IF(is_commute, sign, 0)) AS {commutes}"),
        F.expr(f"sum(IF(NOT is_commute, sign, 0)) AS {externals}"),
        F.expr(f"sum(sign * coalesce(CAST(distance AS bigint), 0)) AS {distance}"),
        F.expr(f"sum(sign * coalesce(CAST(elapsed_time AS bigint), 0)) AS {elapsed}"),
    )
    return sums.where(" OR ".join(f"{total} <> 0" for total in TOTALS))


def add_stat_changes(stats: DataFrame, changes: DataFrame) -> DataFrame:
    """Totals after the changes: sums per employee. Employees without an activity left are dropped."""
    every = stats.select("employee_id", *TOTALS).unionByName(changes.select("employee_id", *TOTALS))
    sums = every.groupBy("employee_id").agg(*[F.sum(total).alias(total) for total in TOTALS])
    return sums.where(f"{TOTALS[0]} <> 0")


def add_stats(employees: DataFrame, stats: DataFrame) -> DataFrame:
    """Every employee once more, with totals; 0 where there is no activity."""
    return lookup_join(employees, stats, "employee_id").fillna(0, subset=list(TOTALS))


def flag_prime(df: DataFrame) -> DataFrame:
    return df.withColumn(FLAGS[0], earns_prime())


def flag_wellness(df: DataFrame) -> DataFrame:
    return df.withColumn(FLAGS[1], earns_wellness())


def gold_eligibility(employees: DataFrame, activities: DataFrame, at: datetime | None = None) -> DataFrame:
    return gold_from_stats(employees, activity_stats(activities), at)


def gold_from_stats(employees: DataFrame, stats: DataFrame, at: datetime | None = None) -> DataFrame:
    facts = employees.select(*EMPLOYEE_FACTS)
    flagged = flag_wellness(flag_prime(add_stats(facts, stats)))
    return flagged.select(*EMPLOYEE_FACTS, *TOTALS, *FLAGS, stamp(at).alias("computed_at"))


def gold_report(gold: DataFrame) -> DataFrame:
    """Employees and eligible employees: one pass."""
    return gold.agg(
        F.expr("count(*) AS employees"),
        F.expr(f"count_if({FLAGS[0]}) AS eligible_prime"),
        F.expr(f"count_if({FLAGS[1]}) AS eligible_wellness"),
    )
