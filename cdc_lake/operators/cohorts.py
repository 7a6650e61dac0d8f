"""Employee cohorts: validate, label, split, shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.rules import uses_sport_transport

SPORT_ONLY, TRANSPORT_ONLY, BOTH, NONE = "sport_only", "transport_only", "both", "none"
COHORTS = (TRANSPORT_ONLY, BOTH, SPORT_ONLY, NONE)

# -- fixed values: raw column names --

RAW = {
    "employee_id": "ID salarié",
    "transport_mode": "Moyen de déplacement",
    "sport_practice": "Pratique d'un sport",
}

# -- end of fixed values --


def _employee_id(df: DataFrame, column: str, key_type: str) -> Column:
    raw = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, T.IntegralType):
        return raw.try_cast(key_type)
    number = raw.try_cast("decimal(38,9)")  # exact for every whole number that fits
    return F.when(number == F.floor(number), number.try_cast(key_type))


def tag_employees(df: DataFrame, key_type: str = "int") -> DataFrame:
    """The three cohort fields, cast, and ``invalid``: which required field is missing or unusable."""
    raw = {name: (column if column in df.columns else name) for name, column in RAW.items()}
    sport = F.col(f"`{raw['sport_practice']}`")
    fields = df.select(
        _employee_id(df, raw["employee_id"], key_type).alias("employee_id"),
        F.col(f"`{raw['transport_mode']}`").alias("transport_mode"),
        F.when(F.trim(sport) != "", sport).alias("sport_practice"),
    )
    bad_id = F.coalesce(F.col("employee_id") == 0, F.lit(True))
    return fields.withColumn(
        "invalid",
        F.concat_ws(", ", F.when(bad_id, "employee_id"), F.when(F.isnull("transport_mode"), "transport_mode")),
    )


def validate_employees(df: DataFrame, key_type: str = "int") -> DataFrame:
    """Strict validation: any bad row stops the run. One counting job, nothing collected."""
    tagged = tag_employees(df, key_type)
    bad = tagged.agg(F.count_if(F.col("invalid") != "").alias("bad")).first()["bad"]
    if bad:
        raise ValueError(f"{bad} employee record(s) without a usable employee_id or transport_mode")
    return tagged.drop("invalid")


def split_employees(df: DataFrame, key_type: str = "int") -> tuple[DataFrame, DataFrame]:
    """Lenient validation: valid rows, and bad rows with what is wrong. An id that doesn't fit is a bad row."""
    tagged = tag_employees(df, key_type)
    return tagged.where(F.col("invalid") == "").drop("invalid"), tagged.where(F.col("invalid") != "")


def cohort(sport: str = "sport_practice", mode: str = "transport_mode") -> Column:
    plays, moves = F.isnotnull(sport), uses_sport_transport(mode)
    return F.when(plays & moves, BOTH).when(plays, SPORT_ONLY).when(moves, TRANSPORT_ONLY).otherwise(NONE)


def with_cohort(df: DataFrame, sport: str = "sport_practice") -> DataFrame:
    return df.withColumn("cohort", cohort(sport))


def eligible_employees(df: DataFrame, sport: str = "sport_practice") -> DataFrame:
    """Without those who neither play a sport nor move to work by one."""
    return df.where(F.isnotnull(sport) | uses_sport_transport())


def split_by_eligibility(df: DataFrame, sport: str = "sport_practice") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sport only, transport only, both: disjoint."""
    labelled = with_cohort(df, sport)
    return tuple(labelled.where(F.col("cohort") == name).drop("cohort") for name in (SPORT_ONLY, TRANSPORT_ONLY, BOTH))


def cohort_shares(df: DataFrame, sport: str = "sport_practice") -> DataFrame:
    """Employees and percentage per cohort, cohorts without employees included; null shares if there are none."""
    counts = ", ".join(f"struct('{name}' AS cohort, count_if(cohort = '{name}') AS employees)" for name in COHORTS)
    totals = with_cohort(df, sport).agg(F.expr("count(*) AS total"), F.expr(f"array({counts}) AS counts"))
    return totals.selectExpr("total", "inline(counts)").selectExpr(
        "cohort", "employees", "try_divide(employees * 100.0D, total) AS share_pct"
    )
