"""Snapshots, batch history, CSV, JDBC, merge statement, scratch folder."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from cdc_lake.plans.cohorting import RunSummary, run_cohorting, summary_frame
from cdc_lake.session import scratch_dir, shuffle_width, sized_shuffles
from cdc_lake.sources import files, jdbc
from cdc_lake.sources.delta import merge_sql
from cdc_lake.sources.messages import kafka_messages
from cdc_lake.sources.reference_csv import load_employee_data, load_reference, read_employees, read_sports
from cdc_lake.sources.tables import BatchLog, SnapshotTable, export_parquet, has_rows, row_count

from .conftest import rows


def test_snapshot_versions(spark, lake_root):
    table = SnapshotTable(spark, lake_root, keep=2)
    assert table.read() is None and not table.exists()
    assert table.write(spark.range(3))["rows"] == 3
    report = table.write(table.read().withColumn("x", F.lit(1)), evens=F.count_if(F.col("id") % 2 == 0))
    assert report == {"rows": 3, "evens": 2}
    table.write(table.read().where("id > 0"))
    assert [v.number for v in table.versions()] == [1, 2]
    assert rows(table.read()) == [(1, 1), (2, 1)]


def test_unfinished_version_is_ignored_and_replaced(spark, lake_root):
    table = SnapshotTable(spark, lake_root)
    table.write(spark.range(3), "main", 0)
    table.write(spark.range(5), "main", 1)
    os.remove(f"{lake_root}/{table.versions()[-1].folder}/_SUCCESS")
    assert table.read().count() == 3 and not table.applied("main", 1)
    table.write(spark.range(4), "main", 1)
    assert table.read().count() == 4


def test_batches_apply_once_and_in_order(spark, lake_root):
    table = SnapshotTable(spark, lake_root)
    table.write(spark.range(1), "main", 4)
    table.write(spark.range(1), "other", 0)
    assert table.applied("main", 4) and not table.applied("main", 5) and not table.applied("third", 0)
    with pytest.raises(ValueError, match="new run name"):
        table.applied("main", 3)


def test_bucketed_snapshot_read_by_another_session(spark, lake_root):
    table = SnapshotTable(spark, lake_root, bucket_by=(3, "id"))
    table.write(table.align(spark.range(100).withColumn("text", F.lit("é"))))
    for entry in spark.catalog.listTables():
        if entry.name.startswith("snapshot_"):
            spark.sql(f"DROP TABLE {entry.name}")
    again = SnapshotTable(spark, lake_root, bucket_by=(3, "id"))
    assert again.read().count() == 100 and len(again.read().inputFiles()) == 3
    again.write(again.read().where("id < 10"))
    assert again.read().count() == 10


def test_batch_log_replaces_a_batch(spark, lake_root):
    log = BatchLog(spark, lake_root)
    assert log.read() is None
    log.write(spark.range(5), "main", 0)
    log.write(spark.range(2).withColumn("late", F.lit("x")), "main", 1)
    assert log.write(spark.range(3), "main", 0) == 3
    assert rows(log.read().groupBy("batch_id").agg(F.count("*"), F.count("late"))) == [(0, 3, 0), (1, 2, 2)]


def test_bronze_probes(spark, lake_root):
    assert row_count(spark, lake_root) == -1 and not has_rows(spark, lake_root)
    export_parquet(spark.range(0), lake_root)
    assert row_count(spark, lake_root) == 0 and not has_rows(spark, lake_root)
    export_parquet(spark.range(2), lake_root)
    assert row_count(spark, lake_root) == 2 and has_rows(spark, lake_root)


EMPLOYEES = '''ID salarié,Nom,Prénom,Date de naissance,BU,Date d'embauche,Salaire brut,Type de contrat,Nombre de jours de CP,Adresse du domicile,Moyen de déplacement
1,Été,Zoé,1990-01-01,R&D,2020-01-01,30000,CDI,25,"1 rue ""A"", 34000 Sète",Marche/running
2,N,P,1990-01-01,BU,2020-01-01,oops,CDD,25,x,Transports en commun
3,N,P,1990-01-01,BU,2020-01-01,1,CDD,25,x,véhicule thermique/électrique
'''
SPORTS = "ID salarié,Pratique d'un sport\n1,Tennis\n1,Runing\n2,\n"


@pytest.fixture
def csv_files(tmp_path):
    (tmp_path / "employees.csv").write_text(EMPLOYEES, encoding="utf-8")
    (tmp_path / "sports.csv").write_text(SPORTS, encoding="utf-8")
    return str(tmp_path / "employees.csv"), str(tmp_path / "sports.csv")


def test_csv(spark, csv_files):
    people = read_employees(spark, csv_files[0])
    assert rows(people, "`ID salarié`", "Salaire brut") == [(1, 30000), (2, None), (3, 1)]
    assert people.first()["Adresse du domicile"] == '1 rue "A", 34000 Sète'
    assert rows(read_sports(spark, csv_files[1])) == [(1, "Runing"), (1, "Tennis"), (2, None)]


def test_reference_is_loaded_once(spark, csv_files, lake_root):
    table = SnapshotTable(spark, lake_root)
    assert load_reference(spark, *csv_files, table)
    assert not load_reference(spark, *csv_files, table)
    assert load_reference(spark, *csv_files, table, refresh=True)
    assert table.read().columns == [
        "id_salarie", "nom", "prenom", "date_de_naissance", "bu", "date_d_embauche", "salaire_brut", "type_de_contrat",
        "nombre_de_jours_de_cp", "adresse_du_domicile", "moyen_de_deplacement", "pratique_d_un_sport"]
    assert rows(table.read(), "id_salarie", "pratique_d_un_sport") == [(1, "Runing"), (1, "Tennis"), (2, None), (3, None)]


def test_load_employee_data_checks_its_input(spark, csv_files, tmp_path):
    assert load_employee_data(spark, *csv_files).count() == 4
    with pytest.raises(FileNotFoundError):
        load_employee_data(spark, str(tmp_path / "none.csv"), csv_files[1])
    with pytest.raises(ValueError, match="Pratique d'un sport"):
        load_employee_data(spark, csv_files[0], csv_files[0])


def test_cells_without_value(spark, csv_files, tmp_path, caplog):
    (tmp_path / "sports.csv").write_text("ID salarié,Pratique d'un sport\n1,N/A\n2,None\n3,Tennis\n", encoding="utf-8")
    people = load_employee_data(spark, *csv_files)
    assert rows(people, "`ID salarié`", "`Pratique d'un sport`") == [("1", None), ("2", None), ("3", "Tennis")]
    assert not caplog.records
    (tmp_path / "employees.csv").write_text(EMPLOYEES.splitlines()[0] + "\n", encoding="utf-8")
    assert load_employee_data(spark, *csv_files).isEmpty()
    assert "no employee" in caplog.text


def test_cohort_run(spark, csv_files):
    kept = []
    summary = run_cohorting(spark, *csv_files, sink=lambda df: kept.extend(rows(df)) or len(kept))
    assert (summary.total_employees, summary.eligible_employees, summary.rows_written) == (4, 2, 2)
    assert summary.success and summary.shares == {"transport_only": 0.0, "both": 50.0, "sport_only": 0.0, "none": 50.0}
    assert kept == [(1, "Marche/running", "Runing", "both"), (1, "Marche/running", "Tennis", "both")]
    assert rows(summary_frame(spark, summary)) == [(4, 2, 2, True, None)]


def test_cohort_run_reports_failure(spark, csv_files):
    summary = run_cohorting(spark, "/nowhere.csv", csv_files[1])
    assert summary == RunSummary(success=False, error="/nowhere.csv")


class FakeConnection:
    def __init__(self, fail_on=None):
        self.log, self.fail_on = [], fail_on

    def cursor(self):
        return self

    def execute(self, statement):
        self.log.append(statement)
        if self.fail_on and self.fail_on in statement:
            raise RuntimeError("refused")

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


@pytest.fixture
def staged(monkeypatch):
    """No database in tests: note what Spark would write."""
    calls = []

    def write(self, url, table, properties=None):
        calls.append((url, table, properties))

    monkeypatch.setattr(DataFrameWriter, "jdbc", write)
    return calls


ACTIVITIES = "id int, employee_id int, start_timestamp timestamp, sport_type string, distance int, elapsed_time int, details string"


def test_insert_is_one_transaction(spark, staged):
    df = spark.createDataFrame([(1, 2, None, "a", 1, 1, "d")], ACTIVITIES)
    connection = FakeConnection()
    assert jdbc.insert_activities(df, "jdbc:x", lambda: connection)
    staging = staged[0][1]
    assert staged == [("jdbc:x", staging, {})] and staging.startswith("activities_staging_")
    columns = "employee_id, start_timestamp, sport_type, distance, elapsed_time, details"
    assert connection.log == [
        "TRUNCATE TABLE activities RESTART IDENTITY",
        f"INSERT INTO activities ({columns}) SELECT {columns} FROM {staging}",
        f"DROP TABLE {staging}", "commit", "close"]


def test_insert_rolls_back(spark, staged):
    df = spark.createDataFrame([(1, 2, None, "a", 1, 1, "d")], ACTIVITIES)
    connection = FakeConnection(fail_on="INSERT")
    with pytest.raises(RuntimeError):
        jdbc.insert_activities(df, "jdbc:x", lambda: connection, clean_before_insert=False)
    assert connection.log[0].startswith("INSERT") and connection.log[1:] == [
        "rollback", f"DROP TABLE {staged[0][1]}", "commit", "close"]


def test_insert_of_nothing(spark, staged):
    empty = spark.createDataFrame([], ACTIVITIES)
    assert not jdbc.insert_activities(empty, "jdbc:x", lambda: pytest.fail("connected"))
    assert staged == []


def test_merge_statement():
    text = merge_sql("t1", "s1", ["id", "v", "updated_at"])
    assert text.startswith("MERGE INTO t1 t USING s1 s ON t.id = s.id WHEN MATCHED AND s.__deleted = 'true' THEN DELETE")
    assert "NOT (t.v <=> s.v)" in text and "INSERT (id, v, updated_at) VALUES (s.id, s.v, current_timestamp())" in text
    assert "t.v <> s.v" in merge_sql("t1", "s1", ["id", "v", "updated_at"], null_safe=False)


def test_kafka_needs_its_package(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_messages(spark, "localhost:1", "topic", maxOffsetsPerTrigger="10")


def test_scratch_is_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two and one.startswith(f"{shared}/x-")


def test_shuffle_width_follows_the_input(spark, lake_root):
    assert (shuffle_width(2**40), shuffle_width(100 * 2**40)) == (4096, 409_600)
    assert files.size(spark, lake_root) == 0
    export_parquet(spark.range(1000), lake_root)
    assert files.size(spark, lake_root) > 1000


def test_wide_inputs_raise_the_width_for_their_jobs(spark):
    width = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    with sized_shuffles(spark, 1000):
        assert spark.conf.get(width, None) is None
    with sized_shuffles(spark, 60 * 2**30):
        assert spark.conf.get(width) == "240"
    assert spark.conf.get(width, None) is None
    spark.conf.set(width, "999")
    with sized_shuffles(spark, 60 * 2**30):
        assert spark.conf.get(width) == "999"
    assert spark.conf.get(width) == "999"
    spark.conf.unset(width)


def test_applied_batches_are_known_after_their_version_is_gone(spark, lake_root):
    table = SnapshotTable(spark, lake_root, keep=2)
    for batch in range(3):
        table.write(spark.range(batch + 1), "main", batch)
    for _ in range(4):
        table.write(spark.range(9), "replay")
    assert [v.run for v in table.versions()] == ["replay", "replay"]
    assert table.applied("main", 2) and not table.applied("main", 3)
    with pytest.raises(ValueError, match="new run name"):
        table.applied("main", 1)


def test_source_of_a_version(spark, lake_root):
    table = SnapshotTable(spark, lake_root)
    assert table.source() is None and table.state() == "none"
    table.write(spark.range(1), built_from="a 1")
    assert table.source() == "a 1"
    table.write(spark.range(1))
    assert table.source() is None and table.state() == table.versions()[-1].folder


def test_run_names_must_be_plain(spark, lake_root):
    with pytest.raises(ValueError, match="run name"):
        SnapshotTable(spark, lake_root).write(spark.range(1), "a.b", 0)
