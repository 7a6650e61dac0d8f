"""Reference data: people joined with their sport, names made canonical."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ..functions.names import normalize_columns
from ..functions.timestamps import stamp

# -- fixed values: key and renamed columns --

REFERENCE_KEY = "ID salarié"
CANONICAL = {
    "id_salarie": "employee_id",
    "moyen_de_deplacement": "transport_mode",
    "pratique_d_un_sport": "external_sport",
}

# -- end of fixed values --


def join_reference(employees: DataFrame, sports: DataFrame, key: str = REFERENCE_KEY) -> DataFrame:
    """Left join that keeps one key column. Both sides come straight from a scan, so AQE can split hot keys."""
    return employees.join(sports, key, "left")


def reference_table(employees: DataFrame, sports: DataFrame) -> DataFrame:
    return normalize_columns(join_reference(employees, sports))


def silver_employees(reference: DataFrame, at: datetime | None = None) -> DataFrame:
    return normalize_columns(reference).withColumnsRenamed(CANONICAL).withColumn("updated_at", stamp(at))


def missing_columns(df: DataFrame, required: set[str]) -> set[str]:
    return required - set(df.columns)


def require_columns(df: DataFrame, required: set[str], name: str) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"{name} lacks columns {sorted(missing)}")
    return df

