"""Fixed table schemas, as DDL."""

from __future__ import annotations

# -- fixed values: field names and types of the change feed and of the two reference files --

_CHANGE_FIELDS = (
    ("id", None),
    ("employee_id", None),
    ("start_timestamp", "bigint"),
    ("sport_type", "string"),
    ("distance", "int"),
    ("elapsed_time", "int"),
    ("details", "string"),
    ("__deleted", "string"),
)

_EMPLOYEES_DDL = """
    `ID salarié` {key},
    `Nom` string,
    `Prénom` string,
    `Date de naissance` string,
    `BU` string,
    `Date d'embauche` string,
    `Salaire brut` int,
    `Type de contrat` string,
    `Nombre de jours de CP` int,
    `Adresse du domicile` string,
    `Moyen de déplacement` string
"""

_SPORTS_DDL = "`ID salarié` {key}, `Pratique d'un sport` string"

# -- end of fixed values --


def change_ddl(key_type: str = "int") -> str:
    """Change payload. ``key_type="bigint"`` is for feeds with more ids than an int holds."""
    return ", ".join(f"`{name}` {kind or key_type}" for name, kind in _CHANGE_FIELDS)


def employees_ddl(key_type: str = "int") -> str:
    return _EMPLOYEES_DDL.format(key=key_type)


def sports_ddl(key_type: str = "int") -> str:
    return _SPORTS_DDL.format(key=key_type)


CHANGE_DDL = change_ddl()
CHANGE_COLUMNS = [name for name, _ in _CHANGE_FIELDS]

# What a message source must offer; the names are Spark's Kafka source columns.
MESSAGE_DDL = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"


def bronze_ddl(key_type: str = "int") -> str:
    return (
        f"{change_ddl(key_type)}, start_datetime string, ingested_at timestamp, "
        "kafka_partition int, kafka_offset bigint, ingest_date date"
    )
