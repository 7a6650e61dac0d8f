"""The two reference CSV files."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.rules import sql_text
from ..operators.reference import join_reference, reference_table, require_columns
from ..schemas import employees_ddl, sports_ddl
from . import files
from .tables import SnapshotTable

# -- fixed values: file dialect and required columns --

CSV_OPTIONS = {"header": "true", "encoding": "UTF-8", "quote": '"', "escape": '"'}
REQUIRED_EMPLOYEES = {"ID salarié", "Moyen de déplacement"}
REQUIRED_SPORTS = {"ID salarié", "Pratique d'un sport"}
# Cell texts that mean "no value" in the untyped load.
NO_VALUE = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# -- end of fixed values --

_CORRUPT = "_corrupt_line"
log = logging.getLogger(__name__)


def read_employees(spark: SparkSession, path: str, key_type: str = "int") -> DataFrame:
    return spark.read.schema(employees_ddl(key_type)).options(**CSV_OPTIONS).csv(path)


def read_sports(spark: SparkSession, path: str, key_type: str = "int") -> DataFrame:
    return spark.read.schema(sports_ddl(key_type)).options(**CSV_OPTIONS).csv(path)


def broken_lines(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """``line, columns``: lines of a file that don't fit its schema, and the names of the cells that don't.

    A line with too many or too few cells names no column. The typed load keeps such lines,
    with null for what it can't read.
    """
    wanted = T.StructType.fromDDL(ddl)
    typed = spark.read.schema(wanted.add(_CORRUPT, "string")).options(**CSV_OPTIONS, columnNameOfCorruptRecord=_CORRUPT, columnPruning="false").csv(path)
    # Spark refuses a query that asks for the line alone, so the filter names a cell too.
    line = typed.where(F.coalesce(F.col(_CORRUPT), F.lit("")) != "").where(F.coalesce(F.col(f"`{wanted.fields[0].name}`").cast("string"), F.col(_CORRUPT)).isNotNull())
    texts = ", ".join(f"`{f.name}` string" for f in wanted.fields if f.name != _CORRUPT)
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
    cells = line.withColumn("_cells", F.from_csv(_CORRUPT, texts, options))
    unread = [
        F.when(F.col(f"_cells.`{f.name}`").isNotNull() & F.col(f"`{f.name}`").isNull(), F.lit(f.name))
        for f in wanted.fields if f.dataType != T.StringType()
    ]
    return cells.select(F.col(_CORRUPT).alias("line"), F.array_compact(F.array(*unread)).alias("columns"))


def load_reference(
    spark: SparkSession, employees_path: str, sports_path: str, table: SnapshotTable, refresh: bool = False,
    key_type: str = "int", quarantine: SnapshotTable | None = None,
) -> bool:
    """Write the joined reference table if there is none yet, or on ``refresh``. Returns whether it wrote.

    ``quarantine`` takes the broken lines of both files.
    """
    if table.exists() and not refresh:
        return False
    if quarantine is not None:
        parts = [
            broken_lines(spark, path, ddl(key_type)).withColumn("file", F.lit(name))
            for name, path, ddl in (("employees", employees_path, employees_ddl), ("sports", sports_path, sports_ddl))
        ]
        quarantine.write(parts[0].unionByName(parts[1]))
    employees, sports = read_employees(spark, employees_path, key_type), read_sports(spark, sports_path, key_type)
    table.write(reference_table(employees, sports))
    return True


def load_employee_data(spark: SparkSession, employees_path: str, sports_path: str) -> DataFrame:
    """Join of the two files as they are, all text, after checking that both have what is needed."""
    for path in (employees_path, sports_path):
        if not files.exists(spark, path):
            raise FileNotFoundError(path)
    employees, sports = _read_untyped(spark, employees_path), _read_untyped(spark, sports_path)
    require_columns(employees, REQUIRED_EMPLOYEES, "employees file")
    require_columns(sports, REQUIRED_SPORTS, "sports file")
    joined = join_reference(employees, sports)
    if joined.isEmpty():
        log.warning("no employee in %s", employees_path)
    return joined


def _read_untyped(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.options(**CSV_OPTIONS).csv(path)
    markers = ", ".join(sql_text(marker) for marker in NO_VALUE)
    return raw.selectExpr(*(f"IF(`{c}` IN ({markers}), NULL, `{c}`) AS `{c}`" for c in raw.columns))
