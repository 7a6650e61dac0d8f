"""The change feed and the employees, read out of the driver's tables.

``events`` is the feed: three versions per id, every rule broken somewhere, and some changes
of employees that nobody knows. ``customer`` is the staff, all of it. The ids stay
``bigint``, since at 100 TB there are more of them than an ``int`` holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.timestamps import epoch_text
from ..schemas import CHANGE_COLUMNS, change_ddl

FEED_DDL = change_ddl("bigint")
WAVES = 3

_FEED = {
    "id": "CASE WHEN event_id % 97 <> 0 THEN event_id div 3 END",
    "employee_id": "CASE WHEN event_id % 89 <> 0 THEN IF(event_id % 13 = 5, -1 - user_id, user_id) END",
    "start_timestamp": "CASE WHEN event_id % 83 <> 0 THEN unix_micros(CAST(ts AS timestamp)) END",
    "sport_type": """CASE
        WHEN event_type = 'click' THEN 'Commute to work - Marche/running'
        WHEN event_type = 'view' THEN 'Commute to work - Vélo/Trottinette/Autres'
        WHEN event_type = 'purchase' THEN 'Runing'
        WHEN event_type = 'signup' THEN 'Tennis'
        WHEN event_id % 5 = 0 THEN ''
        WHEN event_id % 5 > 1 THEN 'Natation' END""",
    "distance": "CASE WHEN event_type <> 'signup' THEN CAST(floor(value * 300) AS int) - 100 END",
    "elapsed_time": "CAST((event_id % 60) * 63 AS int)",
    "details": "props",
    "__deleted": "CASE WHEN event_id % 7 = 6 THEN 'true' WHEN event_id % 7 <> 5 THEN 'false' END",
    "kafka_partition": "CAST((CASE WHEN event_id % 97 <> 0 THEN event_id div 3 ELSE event_id END) % 8 AS int)",
    "kafka_offset": "event_id * 2",
    "wave": f"CAST(event_id % {WAVES} AS int)",
}

_TRANSPORT = """CASE c_mktsegment
    WHEN 'MACHINERY' THEN 'Marche/running'
    WHEN 'BUILDING' THEN 'Vélo/Trottinette/Autres'
    WHEN 'AUTOMOBILE' THEN 'véhicule thermique/électrique'
    WHEN 'FURNITURE' THEN NULL
    ELSE 'Transports en commun' END"""
_SPORT = "CASE c_nationkey % 3 WHEN 1 THEN 'Runing' WHEN 2 THEN 'Tennis' END"
_CONTRACT = "IF(c_acctbal > 5000, 'CDI', 'CDD')"
_SALARY = "CAST(floor(c_acctbal) AS int)"
_FIRST_NAME = "concat('P', c_nationkey)"

_EMPLOYEE = {
    "employee_id": "c_custkey",
    "nom": "c_name",
    "prenom": _FIRST_NAME,
    "bu": "c_mktsegment",
    "type_de_contrat": _CONTRACT,
    "transport_mode": _TRANSPORT,
    "external_sport": _SPORT,
    "salaire_brut": _SALARY,
}

_EMPLOYEE_FILE = {
    "ID salarié": "c_custkey",
    "Nom": "c_name",
    "Prénom": _FIRST_NAME,
    "Date de naissance": "'1990-07-06'",
    "BU": "c_mktsegment",
    "Date d'embauche": "'2020-12-14'",
    "Salaire brut": _SALARY,
    "Type de contrat": _CONTRACT,
    "Nombre de jours de CP": "c_nationkey",
    "Adresse du domicile": """concat(c_nationkey, ' rue "du Port", 34000')""",
    "Moyen de déplacement": _TRANSPORT,
}


def _project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*(f"{expression} AS `{name}`" for name, expression in columns.items()))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes with their place in the topic, and ``wave``: the how-manieth version of its id a change is."""
    return _project(table(spark, sf_dir, "events"), _FEED)


def bronze(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    timed = feed(spark, sf_dir).withColumn("start_datetime", epoch_text("start_timestamp"))
    return timed.select(*CHANGE_COLUMNS, "start_datetime", "kafka_partition", "kafka_offset", *extra)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as Kafka delivers it: JSON values, and an empty message after every delete."""
    change = f"to_json(struct({', '.join(CHANGE_COLUMNS)}))"
    sent = feed(spark, sf_dir).selectExpr(
        "id", "kafka_partition", "kafka_offset", "wave",
        f"posexplode(IF(__deleted <=> 'true', array({change}, NULL), array({change}))) AS (step, value)",
    )
    return sent.selectExpr(
        "CAST(CAST(id AS string) AS binary) AS key",
        "CAST(value AS binary) AS value",
        "'activities' AS topic",
        "kafka_partition AS partition",
        "kafka_offset + step AS offset",
        "timestamp_micros(kafka_offset * 1000000) AS timestamp",
        "wave",
    )


def faulty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with payloads cut short, a field that the schema lacks, and a number sent as text."""
    fields = ", ".join(CHANGE_COLUMNS)
    as_text = ", ".join(f"CAST({c} AS string) AS {c}" if c == "distance" else c for c in CHANGE_COLUMNS)
    value = f"""CASE
        WHEN kafka_offset div 2 % 11 = 3 THEN concat('{{"id":', kafka_offset, ',"elapsed')
        WHEN kafka_offset div 2 % 11 = 4 THEN '[1, 2]'
        WHEN kafka_offset div 2 % 13 = 1 THEN to_json(struct({fields}, kafka_offset AS shoe_size))
        WHEN kafka_offset div 2 % 17 = 2 THEN to_json(struct({as_text}))
        ELSE to_json(struct({fields})) END"""
    return feed(spark, sf_dir).selectExpr(f"CAST({value} AS binary) AS value", "kafka_partition AS partition", "kafka_offset AS offset", "wave")


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "customer"), _EMPLOYEE)


def raw_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staff under the names of the employees file."""
    return _project(table(spark, sf_dir, "customer"), _EMPLOYEE_FILE)


def raw_sports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sports file: one segment's ids match nobody, and some of the others have no sport."""
    key = "IF(c_mktsegment = 'HOUSEHOLD', -1 - c_custkey, c_custkey)"
    return _project(table(spark, sf_dir, "customer"), {"ID salarié": key, "Pratique d'un sport": _SPORT})
