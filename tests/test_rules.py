"""Rules and flags at their boundaries."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cdc_lake.functions.names import normalize_columns, normalize_name
from cdc_lake.functions.rules import (
    Rule,
    activity_rules,
    earns_prime,
    earns_wellness,
    is_active,
    is_commute,
    is_deleted,
)
from cdc_lake.operators.quality import (
    bronze_profile,
    check_keys,
    clean_rows,
    null_key_count,
    null_key_sample,
    rejected_rows,
    rejection_summary,
    split_tagged,
    tag_orphans,
    tag_violations,
    union_rejects,
    valid_rows,
    with_unknown_key,
)

from .conftest import rows

DDL = "id int, employee_id int, sport_type string, elapsed_time int, start_datetime string, distance int, __deleted string"
WALK, BIKE = "Commute to work - Marche/running", "Commute to work - Vélo/Trottinette/Autres"
AT = "2024-01-01 08:00:00"

CASES = [
    ((1, 10, "Tennis", 60, AT, None), ""),
    ((None, 10, "Tennis", 60, AT, 5), "id_null"),
    ((1, None, "Tennis", 60, AT, 5), "employee_id_null"),
    ((1, 10, None, 60, AT, 5), "sport_type_null"),
    ((1, 10, "", 60, AT, 5), "sport_type_null"),
    ((1, 10, "  ", 60, AT, 5), ""),
    ((1, 10, "Tennis", None, AT, 5), "elapsed_time_invalid"),
    ((1, 10, "Tennis", 0, AT, 5), "elapsed_time_invalid"),
    ((1, 10, "Tennis", -1, AT, 5), "elapsed_time_invalid"),
    ((1, 10, "Tennis", 1, AT, 5), ""),
    ((1, 10, "Tennis", 60, None, 5), "start_datetime_null"),
    ((1, 10, "Tennis", 60, AT, -1), "distance_negative"),
    ((1, 10, "Tennis", 60, AT, 0), ""),
    ((1, 10, WALK, 60, AT, 15_000), ""),
    ((1, 10, WALK, 60, AT, 15_001), "distance_outlier_marche"),
    ((1, 10, BIKE, 60, AT, 25_000), ""),
    ((1, 10, BIKE, 60, AT, 25_001), "distance_outlier_vélo"),
    ((1, 10, "Tennis", 60, AT, 99_999), ""),
    ((1, 10, None, 60, AT, 99_999), "sport_type_null"),
    (
        (None, None, "", 0, None, -5),
        "id_null, employee_id_null, sport_type_null, elapsed_time_invalid, start_datetime_null, distance_negative",
    ),
]


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame([(*case, "false") for case, _ in CASES], DDL)


def test_reasons_in_rule_order(records):
    got = [row[0] for row in tag_violations(records).select("rejection_reason").collect()]
    assert got == [reason for _, reason in CASES]


def test_rules_are_never_null(records):
    flags = records.selectExpr(*(f"{rule.broken} AS `{rule.name}`" for rule in activity_rules()))
    assert all(value is not None for row in flags.collect() for value in row)


def test_split_is_disjoint_and_whole(records):
    clean, rejected = split_tagged(tag_violations(records))
    assert clean.columns == records.columns
    assert clean.count() + rejected.count() == len(CASES)
    assert rows(clean) == rows(valid_rows(records)) == rows(clean_rows(tag_violations(records)))
    assert rejected.where("rejected_at IS NULL OR rejection_reason = ''").isEmpty()


def test_own_rules(spark):
    rules = [Rule("odd", "id % 2 = 1"), *activity_rules({"Golf ball/x'y\\z": 3})[-1:]]
    assert rules[-1].name == "distance_outlier_golf_ball"
    df = spark.createDataFrame([(1, "Golf ball/x'y\\z", 4), (2, "Golf ball/x'y\\z", 3)], "id int, sport_type string, distance int")
    assert rows(tag_violations(df, rules), "id", "rejection_reason") == [(1, "odd, distance_outlier_golf_ball"), (2, "")]


def test_deletes_may_carry_only_a_key(spark):
    df = spark.createDataFrame([(1, *[None] * 5, "true"), (None, *[None] * 5, "true"), (2, *[None] * 5, None)], DDL)
    tagged = tag_violations(df, exempt_deletes=True)
    reasons = [r[0] for r in tagged.select("rejection_reason").collect()]
    assert reasons[:2] == ["", "id_null"] and reasons[2].startswith("employee_id_null")
    assert rows(valid_rows(df, exempt_deletes=True), "id") == [(1,)]


def test_delete_flag(spark):
    df = spark.createDataFrame([(None,), ("true",), ("false",), ("True",), ("",)], "__deleted string")
    got = df.select("__deleted", is_deleted(), is_active()).collect()
    assert [(r[1], r[2]) for r in got] == [(False, True), (True, False), (False, True), (False, True), (False, True)]


def test_commute(spark):
    df = spark.createDataFrame([(None,), ("",), ("Commute to work",), (WALK,), ("commute to work",), ("x " + WALK,)],
                               "sport_type string")
    assert [r[0] for r in df.select(is_commute()).collect()] == [False, False, True, True, False, False]


def test_eligibility(spark):
    df = spark.createDataFrame(
        [("Vélo/Trottinette/Autres", 1, 14), ("Marche/running", 31, 15), ("Marche/running", None, 16), ("Vélo/Trottinette/Autres", 0, None),
         ("marche/running", 8, 240), ("", 2, 15), (None, 12, 0)],
        "transport_mode string, total_commute_activities bigint, total_external_activities bigint",
    )
    got = df.select(earns_prime(), earns_wellness()).collect()
    assert [r[0] for r in got] == [True, True, False, False, False, False, False]
    assert [r[1] for r in got] == [False, True, True, False, True, True, False]


@pytest.mark.parametrize("raw, name", [
    ("ID salarié", "id_salarie"),
    ("Prénom", "prenom"),
    ("Moyen de déplacement", "moyen_de_deplacement"),
    ("Pratique d'un sport", "pratique_d_un_sport"),
    ("Date d'embauche", "date_d_embauche"),
    ("Nombre de jours de CP", "nombre_de_jours_de_cp"),
    ("BU", "bu"),
])
def test_names(raw, name):
    assert normalize_name(raw) == name


def test_colliding_names(spark):
    with pytest.raises(ValueError, match="prenom"):
        normalize_columns(spark.createDataFrame([(1, 2)], "`Prénom` int, prenom int"))


def test_key_check(spark):
    df = spark.createDataFrame([(1, 10), (2, 11), (3, 99), (4, None)], "id int, employee_id int")
    staff = spark.createDataFrame([(10,), (10,), (11,), (None,)], "employee_id int")
    valid, orphans = check_keys(df, staff)
    assert rows(valid) == [(1, 10), (2, 11)]
    assert rows(orphans, "id", "rejection_reason") == [(i, "employee_id_not_in_reference") for i in (3, 4)]
    tagged = tag_orphans(df.withColumn("rejection_reason", F.lit("")), staff)
    assert rows(clean_rows(tagged)) == rows(valid)
    assert rows(rejected_rows(tagged), "id") == rows(orphans, "id")


def test_key_check_on_text_keys(spark):
    df = spark.createDataFrame([(1, "a", ""), (2, "b", ""), (3, None, "id_null")], "id int, k string, rejection_reason string")
    staff = spark.createDataFrame([("a",), ("a",)], "k string")
    assert rows(tag_orphans(df, staff, "k"), "id", "rejection_reason") == [
        (1, ""), (2, "employee_id_not_in_reference"), (3, "id_null")
    ]


def test_without_reference_all_pass(records):
    valid, orphans = check_keys(records, None)
    assert valid.count() == len(CASES) and orphans.isEmpty()
    assert orphans.columns == [*records.columns, "rejection_reason", "rejected_at"]
    tagged = tag_violations(records)
    assert rows(tag_orphans(tagged, None)) == rows(tagged)


def test_summary_counts_a_record_once_per_rule(records):
    rejected = rejected_rows(tag_violations(records))
    got = [tuple(r) for r in rejection_summary(rejected).collect()]
    assert got[:2] == [("elapsed_time_invalid", 4), ("sport_type_null", 4)]
    assert dict(got)["distance_outlier_vélo"] == 1
    assert [n for _, n in got] == sorted((n for _, n in got), reverse=True)


def test_union_fills_missing_columns(spark, records):
    rejected = rejected_rows(tag_violations(records))
    orphans = with_unknown_key(valid_rows(records), spark.createDataFrame([(1,)], "employee_id int")).drop("distance")
    both = union_rejects(rejected, orphans)
    assert both.count() == len(CASES)
    assert both.where("rejection_reason = 'employee_id_not_in_reference' AND distance IS NOT NULL").isEmpty()


def test_profiles(records):
    assert rows(bronze_profile(records)) == [(20, 2, 2)]
    assert rows(null_key_count(records)) == [(20, 2)]
    assert null_key_sample(records).count() == 2
    empty = records.limit(0)
    assert rows(bronze_profile(empty)) == [(0, 0, 0)]
    assert rejection_summary(rejected_rows(tag_violations(empty))).isEmpty()
