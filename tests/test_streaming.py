"""The jobs end to end, on files with Kafka's columns."""

from __future__ import annotations

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from cdc_lake.__main__ import main
from cdc_lake.plans.lake import Lake, Options
from cdc_lake.plans.medallion import apply_batch, rebuild_silver, replay_orphans
from cdc_lake.schemas import MESSAGE_DDL
from cdc_lake.sources.messages import file_messages
from cdc_lake.sources.reference_csv import load_reference
from cdc_lake.sources.tables import row_count
from cdc_lake.streaming.bronze import bronze_rows, start_landing, start_preview
from cdc_lake.streaming.notifications import start_notifications
from cdc_lake.streaming.silver import refresh, start_silver, start_watch

from .conftest import rows

MICROS = 1704096000000000


def change(ident, employee=1, sport="Tennis", distance=5, elapsed=60, details="x", deleted="false"):
    return {"id": ident, "employee_id": employee, "start_timestamp": MICROS, "sport_type": sport, "distance": distance,
            "elapsed_time": elapsed, "details": details, "__deleted": deleted}


class Topic:
    """Sends batches of messages into a folder, with rising offsets."""

    def __init__(self, lake):
        self.lake, self.next = lake, 0

    def send(self, *changes):
        sent = []
        for c in changes:
            value = None if c is None else json.dumps(c).encode()
            sent.append((None, value, "t", 0, self.next, None))
            self.next += 1
        self.lake.spark.createDataFrame(sent, MESSAGE_DDL).coalesce(1).write.mode("append").parquet(self.lake.path("feed"))

    def messages(self):
        return file_messages(self.lake.spark, self.lake.path("feed"))

    def land(self, *changes):
        self.send(*changes)
        start_landing(self.lake, self.messages(), availableNow=True).awaitTermination()


REFERENCE = ("id_salarie int, nom string, prenom string, bu string, type_de_contrat string, moyen_de_deplacement string, "
             "pratique_d_un_sport string, salaire_brut int")


def staff(spark, *idents):
    return spark.createDataFrame([(i, "n", "p", "b", "CDI", "Marche/running", None, 1) for i in idents], REFERENCE)


@pytest.fixture
def lake(spark, lake_root):
    lake = Lake(spark, lake_root)
    lake.reference.write(staff(spark, 1, 2))
    return lake


def silver(lake):
    return rows(lake.activities.read(), "id", "employee_id", "details")


def test_landing_keeps_everything_once(lake):
    topic = Topic(lake)
    topic.land(change(1), None, change(1, details="y"))
    topic.land(change(2, deleted="true"))
    assert rows(lake.bronze(), "id", "details", "kafka_offset") == [(1, "x", 0), (1, "y", 2), (2, "x", 3), (None, None, 1)]
    assert row_count(lake.spark, lake.bronze_path) == 4
    assert "ingest_date" in lake.bronze().columns


def test_preview_runs_beside_the_landing(lake):
    topic = Topic(lake)
    topic.land(change(1, details="seen"))
    preview = start_preview(lake, topic.messages(), availableNow=True)
    preview.awaitTermination()
    assert row_count(lake.spark, lake.bronze_path) == 1
    assert (preview.name, preview.lastProgress["numInputRows"]) == ("Bronze Console Monitor", 1)


def test_refresh_end_to_end(lake):
    assert refresh(lake) is None
    topic = Topic(lake)
    topic.land(change(1, sport="Commute to work - Marche/running"), change(2, 2), change(3, 99), change(4, elapsed=0), None)
    report = refresh(lake, export_to=lake.path("export"))
    assert report == {"rows": 2, "eligible_prime": 1, "eligible_wellness": 0}
    assert silver(lake) == [(1, 1, "x"), (2, 2, "x")]
    reasons = rows(lake.quarantine.read(), "rejection_reason")
    assert ("employee_id_not_in_reference",) in reasons and ("elapsed_time_invalid",) in reasons and len(reasons) == 3
    assert lake.spark.read.parquet(lake.path("export/activities.parquet")).count() == 2
    assert lake.spark.read.parquet(lake.path("export/employee_eligibility.parquet")).count() == 2

    before = lake.gold.versions(), lake.employees.versions()
    assert refresh(lake) is None and (lake.gold.versions(), lake.employees.versions()) == before

    topic.land(change(1, deleted="true"), change(2, 2, details="newer"), change(5, 2))
    assert refresh(lake)["eligible_prime"] == 0
    assert silver(lake) == [(2, 2, "newer"), (5, 2, "x")]
    assert lake.quarantine.read().count() == 3


def test_repeated_batch_changes_nothing(lake):
    from cdc_lake.plans.medallion import build_employees

    build_employees(lake)
    topic = Topic(lake)
    topic.land(change(1), change(2, 99))
    apply_batch(lake, lake.bronze(), 0)
    versions = lake.activities.versions()
    apply_batch(lake, lake.bronze(), 0)
    assert lake.activities.versions() == versions
    assert lake.quarantine.read().count() == 1


def test_updated_at_moves_with_real_changes_only(lake):
    topic = Topic(lake)
    topic.land(change(1), change(2, 2, distance=None))
    refresh(lake)
    first = dict(rows(lake.activities.read(), "id", "updated_at"))
    topic.land(change(1), change(2, 2, distance=7))
    refresh(lake)
    second = dict(rows(lake.activities.read(), "id", "updated_at"))
    assert second[1] == first[1] and second[2] > first[2]


def test_increments_equal_rebuild(spark, lake_root, lake):
    topic = Topic(lake)
    steps = [
        [change(i, 1 + i % 2, details=f"a{i}") for i in range(20)],
        [change(i, 1, details=f"b{i}", deleted="true" if i % 5 == 0 else None) for i in range(0, 20, 2)] + [None],
        [change(3, 1, elapsed=-1), change(4, 2, distance=None, details=None), change(0, 2, details="back")],
    ]
    for step in steps:
        topic.land(*step)
        refresh(lake)
    grown = silver(lake)
    rejected = rows(lake.quarantine.read(), "id", "rejection_reason")
    other = Lake(spark, lake_root, run="again")
    rebuild_silver(other)
    assert silver(other) == grown and len(grown) == 19
    rebuilt = lake.quarantine.read().where("run = 'again-rebuild'")
    assert rows(rebuilt, "id", "rejection_reason") == rejected


def test_bucketed_lake(spark, lake_root):
    lake = Lake(spark, lake_root, buckets=4)
    lake.reference.write(staff(spark, 1, 2))
    topic = Topic(lake)
    topic.land(*(change(i) for i in range(30)))
    refresh(lake)
    topic.land(*(change(i, deleted="true") for i in range(10)), change(11, details="new"))
    refresh(lake)
    assert len(silver(lake)) == 20 and (11, 1, "new") in silver(lake)
    assert len(lake.activities.read().inputFiles()) <= 4


def test_orphans_are_admitted_later(spark, lake):
    topic = Topic(lake)
    topic.land(change(1, 1, details="v1"), change(7, 50, details="only"), change(8, 50, details="gone"))
    refresh(lake)
    topic.land(change(1, 50, details="v2"), change(8, 1, deleted="true"))
    refresh(lake)
    assert silver(lake) == [(1, 1, "v1")]
    assert replay_orphans(lake) == -1
    lake.reference.write(staff(spark, 1, 2, 50))
    refresh(lake, replay=True)
    assert silver(lake) == [(1, 50, "v2"), (7, 50, "only")]


def test_a_second_replay_writes_nothing(spark, lake):
    topic = Topic(lake)
    topic.land(change(1, 50), change(2, 1))
    refresh(lake)
    lake.reference.write(staff(spark, 1, 2, 50))
    assert refresh(lake, replay=True) is not None
    assert {r[0] for r in silver(lake)} == {1, 2}
    before = lake.activities.versions(), lake.gold.versions()
    assert refresh(lake, replay=True) is None and replay_orphans(lake) == -1
    assert (lake.activities.versions(), lake.gold.versions()) == before


def test_orphans_are_admitted_unasked_once_staff_has_changed(spark, lake, monkeypatch):
    from cdc_lake.streaming import silver as jobs

    topic = Topic(lake)
    topic.land(change(1, 50), change(2, 1))
    refresh(lake)
    refresh(lake)
    assert silver(lake) == [(2, 1, "x")]
    assert [v.number for v in lake.admissions.versions()] == [0]
    lake.reference.write(staff(spark, 1, 2, 50))
    refresh(lake, replay=False)
    assert silver(lake) == [(2, 1, "x")]
    with monkeypatch.context() as patch:  # a replay that is lost is made up for
        patch.setattr(jobs, "ensure_admitted", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh(lake)
    assert refresh(lake)["rows"] == 3 and silver(lake) == [(1, 50, "x"), (2, 1, "x")]
    before = lake.activities.versions(), lake.admissions.versions()
    assert refresh(lake) is None and (lake.activities.versions(), lake.admissions.versions()) == before


def test_the_jobs_size_their_shuffles(spark, lake, monkeypatch):
    """A merge is as wide as Silver needs, Gold too; the session's setting is left as it was."""
    from cdc_lake import session
    from cdc_lake.plans import medallion

    widths = {}

    def noting(name, function):
        def noted(*given, **named):
            widths[name] = int(spark.conf.get(session._WIDTH, "0"))
            return function(*given, **named)

        return noted

    for name in ("apply_in_order", "gold_eligibility", "silver_changes"):
        monkeypatch.setattr(medallion, name, noting(name, getattr(medallion, name)))
    monkeypatch.setattr(session, "_PARTITION_BYTES", 100)
    topic = Topic(lake)
    topic.land(*(change(i) for i in range(40)))
    refresh(lake)
    bytes_held = lake.activities.stored_bytes()
    assert widths["silver_changes"] > 8  # by the files of the batch: Silver holds nothing yet
    assert widths["gold_eligibility"] == session.shuffle_width(bytes_held) > 8
    topic.land(change(41))
    refresh(lake)
    assert widths["apply_in_order"] >= session.shuffle_width(bytes_held)
    assert spark.conf.get(session._WIDTH, None) is None


def test_a_lost_gold_job_is_made_up_for(lake, monkeypatch):
    from cdc_lake.plans import medallion

    topic = Topic(lake)
    topic.land(change(1))
    refresh(lake)
    topic.land(change(2, 2))
    with monkeypatch.context() as patch:
        patch.setattr(medallion, "gold_eligibility", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh(lake)
    assert len(silver(lake)) == 2
    assert refresh(lake) is not None and refresh(lake) is None
    assert sum(r[0] for r in rows(lake.gold.read(), "total_activities")) == 2


def test_new_staff_without_new_activities(spark, lake):
    Topic(lake).land(change(1))
    refresh(lake)
    staffed = lake.gold.read().count()
    lake.reference.write(staff(spark, 1, 2, 3, 4, 5, 6))
    assert refresh(lake)["rows"] == 6 > staffed
    assert refresh(lake) is None


def test_batches_may_come_late_twice_and_in_parts(lake):
    from cdc_lake.plans.medallion import build_employees, merge_activities, silver_changes
    from cdc_lake.operators.cdc import ARRIVAL

    build_employees(lake)
    topic = Topic(lake)
    topic.land(change(1), change(2, 2))
    topic.land(change(1, details="new"), change(2, 2, deleted="true"), change(3))
    topic.land(change(2, 2, details="again"), change(3, deleted="true"))
    bronze, at = lake.bronze(), datetime.now(timezone.utc)
    days = [r[0] for r in rows(bronze.select("ingested_at").distinct())]
    assert len(days) == 3
    for number, day in enumerate([days[2], days[0], days[1], days[0], days[2]]):
        batch = bronze.where(F.col("ingested_at") == F.lit(day))
        merge_activities(lake, silver_changes(batch, lake.employees.read(), keep=ARRIVAL), "parts", number, at)
        assert lake.activities.read().where("id = 3").isEmpty()
    assert silver(lake) == [(1, 1, "new"), (2, 2, "again")]


def test_employees_of_a_wide_id_reach_gold(spark, lake_root, tmp_path):
    from cdc_lake.operators.cohorts import split_employees
    from cdc_lake.sources.reference_csv import load_employee_data, load_reference

    wide = 5_000_000_000
    (tmp_path / "e.csv").write_text(f"ID salarié,Moyen de déplacement\n{wide},Marche/running\n{wide}.0,x\n{2**60 + 1},x\n1.5,x\n")
    (tmp_path / "s.csv").write_text(f"ID salarié,Pratique d'un sport\n{wide},Tennis\n")
    joined = load_employee_data(spark, str(tmp_path / "e.csv"), str(tmp_path / "s.csv"))
    valid, invalid = split_employees(joined, "bigint")
    assert rows(valid, "employee_id") == [(2**60 + 1,), (wide,), (wide,)] and invalid.count() == 1
    header = "ID salarié,Nom,Prénom,Date de naissance,BU,Date d'embauche,Salaire brut,Type de contrat,Nombre de jours de CP,Adresse du domicile,Moyen de déplacement"
    (tmp_path / "e.csv").write_text(f"{header}\n{wide},N,P,,,,1,,1,,Marche/running\n")
    lake = Lake(spark, lake_root, options=Options(key_type="bigint"))
    load_reference(spark, str(tmp_path / "e.csv"), str(tmp_path / "s.csv"), lake.reference, key_type="bigint")
    Topic(lake).land(change(7, wide))
    refresh(lake)
    assert rows(lake.gold.read(), "employee_id", "total_activities") == [(wide, 1)]


def test_options(spark, lake_root):
    feed = [change(1), change(1, elapsed=0), change(2), {"id": 2, "__deleted": "true"}]
    results = {}
    for name, options in [("plain", Options()), ("exempt", Options(exempt_deletes=True)), ("dedup", Options(dedup_first=True)),
                          ("quiet", Options(drop_tombstones=True))]:
        lake = Lake(spark, f"{lake_root}/{name}", options=options)
        lake.reference.write(staff(spark, 1))
        Topic(lake).land(*feed, None)
        refresh(lake)
        results[name] = [r[0] for r in silver(lake)] if lake.activities.exists() else None, lake.bronze().count()
    assert results == {"plain": ([1, 2], 5), "exempt": ([1], 5), "dedup": ([], 5), "quiet": ([1, 2], 4)}


def test_backlog_is_applied_in_arrival_order(lake):
    """One key in several files of one landing batch, and in several landing batches."""
    topic = Topic(lake)
    for last in ("c", "f"):
        for text in ("a", "b", last):
            topic.send(change(1, details=text))
        start_landing(lake, topic.messages(), availableNow=True).awaitTermination()
        refresh(lake)
        assert silver(lake) == [(1, 1, last)]
    for text in ("g", "h"):
        topic.land(change(1, details=text))
    refresh(lake)
    assert silver(lake) == [(1, 1, "h")]


def test_notifications_one_per_batch(lake):
    topic = Topic(lake)
    for changes in ([change(1), change(2, 2), None], [change(3, deleted="true")], [None]):
        topic.send(*changes)
        start_notifications(lake, topic.messages(), availableNow=True).awaitTermination()
    sent = lake.notifications.read().orderBy("batch_id")
    assert [(r["activity_id"], r["total_in_batch"], r["is_deleted"]) for r in sent.collect()] == [(2, 2, False), (3, 1, True)]


def test_every_batch_leaves_a_report(lake):
    topic = Topic(lake)
    topic.land(change(1), change(2, 99), change(3, elapsed=0, sport=None), change(None))
    refresh(lake)
    topic.land(change(4))
    refresh(lake)
    rules = {"employee_id_not_in_reference": 1, "elapsed_time_invalid": 1, "sport_type_null": 1, "id_null": 1}
    assert rows(lake.reports.read(), "batch_id", "rejected", "rejects_by_rule", "silver_rows") == [(0, 3, rules, 1), (1, 0, {}, 2)]
    apply_batch(lake, lake.bronze().where("kafka_offset < 4"), 1)  # repeated: its row is replaced
    assert lake.reports.read().count() == 2


def test_bronze_rows_is_narrow(lake, spark):
    empty = spark.createDataFrame([], MESSAGE_DDL)
    assert bronze_rows(lake, empty).select(F.count("*")).first()[0] == 0


def test_wide_ids(spark, lake_root):
    lake = Lake(spark, lake_root, options=Options(key_type="bigint"))
    lake.reference.write(staff(spark, 1))
    Topic(lake).land(change(5_000_000_000))
    refresh(lake)
    assert silver(lake) == [(5_000_000_000, 1, "x")]


def test_silver_stream_can_keep_running(lake):
    topic = Topic(lake)
    topic.land(change(1))
    lake.employees.write(staff(lake.spark, 1).withColumnRenamed("id_salarie", "employee_id"))
    query = start_silver(lake, processingTime="1 second")
    query.processAllAvailable()
    query.stop()
    assert silver(lake) == [(1, 1, "x")]


def test_watch_waits_for_data_and_builds_gold(lake):
    query = start_watch(lake, interval="1 second")
    query.processAllAvailable()
    assert not lake.gold.exists() and not lake.employees.exists()
    Topic(lake).land(change(1), change(2, 2))
    query.processAllAvailable()
    query.stop()
    assert lake.gold.read().count() == 2 and len(silver(lake)) == 2


CSV = {"employees": "ID salarié,Nom,Prénom,Date de naissance,BU,Date d'embauche,Salaire brut,Type de contrat,"
                    "Nombre de jours de CP,Adresse du domicile,Moyen de déplacement\n"
                    "1,N,P,1990-01-01,B,2020-01-01,1,CDI,25,x,Marche/running\n",
       "sports": "ID salarié,Pratique d'un sport\n1,Tennis\n"}


def test_jobs_from_the_command_line(spark, lake_root, tmp_path, capsys):
    lake, inputs = Lake(spark, lake_root), []
    for name, text in CSV.items():
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
        inputs += [f"--{name}", str(tmp_path / f"{name}.csv")]
    assert main(["cohorts", "--root", lake_root, *inputs]) == 0
    assert spark.read.parquet(lake.path("cohorts")).first()["cohort"] == "both"
    assert main(["cohorts", "--root", lake_root, "--employees", "/none", *inputs[2:]]) == 1
    load_reference(spark, inputs[1], inputs[3], lake.reference)
    Topic(lake).land(change(1))
    assert main(["medallion", "--root", lake_root]) == 0
    assert main(["medallion", "--root", lake_root]) == 0
    assert main(["report", "--root", lake_root]) == 0
    shown = capsys.readouterr().out
    assert "'rows': 1" in shown and "nothing new" in shown and "Bronze rows: 1" in shown
