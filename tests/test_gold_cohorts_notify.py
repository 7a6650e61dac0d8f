"""Gold, cohorts, notification text."""

from __future__ import annotations

import json
from datetime import datetime, timezone

import pytest

from cdc_lake.functions.text import minutes_text
from cdc_lake.operators.cohorts import (
    cohort_shares,
    eligible_employees,
    split_by_eligibility,
    split_employees,
    validate_employees,
    with_cohort,
)
from cdc_lake.operators.eligibility import EMPLOYEE_FACTS, FLAGS, TOTALS, activity_stats, gold_eligibility, gold_report
from cdc_lake.operators.notify import batch_latest, notifications, with_message

from .conftest import rows

STAFF = ("employee_id int, nom string, prenom string, bu string, type_de_contrat string, transport_mode string, "
         "external_sport string, salaire_brut int")
ACTIVITY = "employee_id int, is_commute boolean, distance int, elapsed_time int"


def test_gold(spark):
    staff = spark.createDataFrame(
        [(i, "n", "p", "b", "CDI", mode, None, 1000)
         for i, mode in [(1, "Marche/running"), (2, None), (3, "Marche/running"), (None, "Marche/running")]], STAFF)
    activities = spark.createDataFrame(
        [(1, True, None, 60), (1, False, 5, None)] + [(2, False, 10, 1)] * 15 + [(9, True, 1, 1)], ACTIVITY)
    gold = gold_eligibility(staff, activities, at=datetime(2024, 1, 1, tzinfo=timezone.utc))
    assert gold.columns == [*EMPLOYEE_FACTS, *TOTALS, *FLAGS, "computed_at"]
    assert rows(gold, "employee_id", *TOTALS, *FLAGS) == [
        (1, 2, 1, 1, 5, 60, True, False),
        (2, 15, 0, 15, 150, 15, False, True),
        (3, 0, 0, 0, 0, 0, False, False),
        (None, 0, 0, 0, 0, 0, False, False),
    ]
    assert rows(gold_report(gold)) == [(4, 1, 1)]
    assert dict(gold.dtypes)["total_distance_m"] == "bigint"


def test_stats_of_missing_measures(spark):
    only_nulls = spark.createDataFrame([(1, True, None, None)], ACTIVITY)
    assert rows(activity_stats(only_nulls)) == [(1, 1, 1, 0, 0, 0)]


PEOPLE = "employee_id int, sport_practice string, transport_mode string"


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [(1, "Tennis", "Transports en commun"), (2, None, "Marche/running"), (3, "Runing", "Vélo/Trottinette/Autres"),
         (4, None, "véhicule thermique/électrique"), (5, None, None), (6, "Tennis", None)], PEOPLE)


def test_cohorts(people):
    assert rows(with_cohort(people), "employee_id", "cohort") == [
        (1, "sport_only"), (2, "transport_only"), (3, "both"), (4, "none"), (5, "none"), (6, "sport_only")]
    assert rows(eligible_employees(people), "employee_id") == [(1,), (2,), (3,), (6,)]
    parts = [rows(part, "employee_id") for part in split_by_eligibility(people)]
    assert parts == [[(1,), (6,)], [(2,)], [(3,)]]
    shares = {r["cohort"]: (r["employees"], round(r["share_pct"], 2)) for r in cohort_shares(people).collect()}
    assert shares == {"sport_only": (2, 33.33), "transport_only": (1, 16.67), "both": (1, 16.67), "none": (2, 33.33)}


def test_shares_of_nobody(people):
    assert rows(cohort_shares(people.limit(0)), "employees", "share_pct") == [(0, None)] * 4


RAW = "`ID salarié` string, `Moyen de déplacement` string, `Pratique d'un sport` string"


def test_validation(spark):
    df = spark.createDataFrame(
        [("1", "Marche/running", "Tennis"), ("2.0", "x", "  "), ("0", "x", None), ("abc", "x", None),
         (None, "x", None), ("3", None, "Tennis"), ("4.5", None, None), ("-6", "", None)], RAW)
    valid, bad = split_employees(df)
    assert rows(valid) == [(-6, "", None), (1, "Marche/running", "Tennis"), (2, "x", None)]
    assert rows(bad, "invalid") == [("employee_id",)] * 3 + [("employee_id, transport_mode",), ("transport_mode",)]
    with pytest.raises(ValueError, match="5 employee record"):
        validate_employees(df)
    assert validate_employees(df.where("`ID salarié` IN ('1', '2.0')")).count() == 2


def test_minutes_round_like_the_exact_quotient(spark):
    values = [*range(-100, 40_000), 2**31 - 1, 2**31 - 5, 999_999_999, 1_234_567_893]
    df = spark.createDataFrame([(v,) for v in values], "s int")
    got = df.selectExpr("s", f"{minutes_text('s')} AS m").collect()
    assert [(r.s, r.m) for r in got if r.m != f"{r.s / 60:.1f}"] == []
    assert spark.createDataFrame([(None,)], "s int").selectExpr(minutes_text("s")).first()[0] == "0.0"


MESSAGE = "value string, timestamp timestamp, partition int, offset bigint"


def _send(spark, *changes):
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    return spark.createDataFrame(
        [(None if c is None else json.dumps(c), at, 0, i) for i, c in enumerate(changes)], MESSAGE)


NORMAL = {"id": 77, "employee_id": 1309, "start_timestamp": 1704096000000000, "sport_type": "Aviron", "distance": 8230,
          "elapsed_time": 2745, "details": "Vent de face", "__deleted": "false"}


def _message(spark, *changes):
    return with_message(batch_latest(notifications(_send(spark, *changes)))).first()


def test_message(spark):
    got = _message(spark, NORMAL)
    assert got["title"] == "Dernière activité sportive — Employé 1309" and got["color"] == 3066993
    assert got["description"] == ("**Sport :** Aviron\n**Date :** 01/01/2024 à 08:00\n**Distance :** 8230 m\n"
                                  "**Durée :** 45.8 min\n**Détails :** Vent de face")
    assert json.loads(got["body"]) == {"embeds": [{k: got[k] for k in ("title", "description", "color")}]}


def test_message_of_a_delete(spark):
    got = _message(spark, NORMAL, {"id": 77, "employee_id": 1309, "__deleted": "true"}, None)
    assert got["title"] == "Activité supprimée — Employé 1309" and got["color"] == 15158332
    assert got["description"] is None and got["total_in_batch"] == 2
    assert json.loads(got["body"]) == {"embeds": [{"title": got["title"], "color": 15158332}]}


def test_message_without_values(spark):
    got = _message(spark, {"id": 1}, {"id": 2, "start_timestamp": 0})
    assert got["title"].endswith("None")
    assert got["description"] == ("**Sport :** None\n**Date :** date inconnue\n**Distance :** 0 m\n**Durée :** 0.0 min\n"
                                  "**Détails :** None\n*(2 activité(s) dans ce lot)*")


def test_notification_fields(spark):
    df = notifications(_send(spark, NORMAL, None))
    assert df.columns[:8] == ["activity_id", "employee_id", "sport_type", "distance", "elapsed_time", "start_timestamp",
                              "details", "is_deleted"]
    assert df.count() == 1
    assert batch_latest(df.limit(0)).isEmpty()
