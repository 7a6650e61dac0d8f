"""The employee cohort run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.cohorts import NONE, cohort_shares, eligible_employees, validate_employees, with_cohort
from ..sources.reference_csv import load_employee_data


@dataclass(frozen=True)
class RunSummary:
    total_employees: int = 0
    eligible_employees: int = 0
    rows_written: int = 0
    success: bool = True
    error: str | None = None
    shares: dict[str, float | None] = field(default_factory=dict)


def run_cohorting(
    spark: SparkSession,
    employees_path: str,
    sports_path: str,
    sink: Callable[[DataFrame], int] | None = None,
    key_type: str = "int",
) -> RunSummary:
    """Load, validate, report, drop the non-eligible, label, write. A failure becomes the summary's error."""
    try:
        people = validate_employees(load_employee_data(spark, employees_path, sports_path), key_type)
        report = cohort_shares(people).collect()  # four rows
        total = sum(row["employees"] for row in report)
        outside = sum(row["employees"] for row in report if row["cohort"] == NONE)
        written = sink(with_cohort(eligible_employees(people))) if sink else 0
        return RunSummary(
            total_employees=total,
            eligible_employees=total - outside,
            rows_written=written,
            shares={row["cohort"]: row["share_pct"] for row in report},
        )
    except Exception as failure:
        return RunSummary(success=False, error=str(failure))


def summary_frame(spark: SparkSession, summary: RunSummary) -> DataFrame:
    """The summary as one row."""
    return spark.range(1).select(
        F.lit(summary.total_employees).cast("bigint").alias("total_employees"),
        F.lit(summary.eligible_employees).cast("bigint").alias("eligible_employees"),
        F.lit(summary.rows_written).cast("bigint").alias("rows_written"),
        F.lit(summary.success).alias("success"),
        F.lit(summary.error).cast("string").alias("error"),
    )
