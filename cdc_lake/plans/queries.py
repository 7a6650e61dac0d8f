"""The registered queries: each operator over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.rules import activity_rules, is_commute
from ..functions.timestamps import epoch_text
from ..operators import cdc, cohorts, eligibility, notify, payloads, quality, reference
from ..operators.bitmaps import id_bitmaps, with_id_in, with_id_not_in
from ..operators.cdc import ARRIVAL
from ..schemas import CHANGE_COLUMNS, employees_ddl
from ..session import OPEN_DAYS, scratch_dir, unsorted_folders
from ..sources.reference_csv import CSV_OPTIONS, broken_lines, load_employee_data, load_reference
from ..sources.tables import BatchLog, SnapshotTable, export_parquet, has_rows, row_count
from ..streaming.bronze import start_landing
from ..streaming.latest import start_newest
from ..streaming.notifications import start_notifications
from ..streaming.silver import refresh, start_silver
from ..sources.messages import file_messages
from . import driver_tables as tables
from .lake import Lake, Options
from .cohorting import run_cohorting, summary_frame
from .medallion import build_gold, ensure_employees, merge_activities, silver_changes, tag_all
from .upkeep import upkeep

Query = Callable[[SparkSession, str], DataFrame]

# One topic position orders the derived feed; there is no ingestion time to sort by first.
FEED_ORDER = ("kafka_offset",)

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def pinned(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, sf_dir)

    QUERIES[function.__name__] = pinned
    return pinned


def _changes(spark, sf_dir, options=Options(), staff=None) -> DataFrame:
    staff = staff or tables.employees(spark, sf_dir)
    return silver_changes(tables.bronze(spark, sf_dir), staff, options, FEED_ORDER)


def _silver(spark, sf_dir, staff=None) -> DataFrame:
    return cdc.initial_rows(_changes(spark, sf_dir, staff=staff))


# -- Gold ------------------------------------------------------------------


@query
def gold_eligibility(spark, sf_dir):
    staff = tables.employees(spark, sf_dir)
    return eligibility.gold_eligibility(staff, _silver(spark, sf_dir, staff)).drop("computed_at")


@query
def activity_stats(spark, sf_dir):
    return eligibility.activity_stats(_silver(spark, sf_dir))


def _with_stats(spark, sf_dir):
    staff = tables.employees(spark, sf_dir)
    return eligibility.add_stats(staff, eligibility.activity_stats(_silver(spark, sf_dir, staff)))


@query
def employee_totals(spark, sf_dir):
    return _with_stats(spark, sf_dir).select("employee_id", *eligibility.TOTALS)


@query
def prime_flag(spark, sf_dir):
    flagged = eligibility.flag_prime(_with_stats(spark, sf_dir))
    return flagged.select("employee_id", "transport_mode", "total_commute_activities", "is_eligible_prime_sportive")


@query
def wellness_flag(spark, sf_dir):
    flagged = eligibility.flag_wellness(_with_stats(spark, sf_dir))
    return flagged.select("employee_id", "total_external_activities", "is_eligible_journees_bien_etre")


@query
def gold_report(spark, sf_dir):
    return eligibility.gold_report(gold_eligibility(spark, sf_dir))


@query
def gold_publish(spark, sf_dir):
    """Gold through the tables: Silver written, Gold built from it, its export read back."""
    lake = Lake(spark, scratch_dir(spark, "gold"))
    staff = tables.employees(spark, sf_dir)
    lake.employees.write(staff)
    lake.activities.write(_silver(spark, sf_dir, staff))
    build_gold(lake, export_to=lake.path("export"))
    return spark.read.parquet(lake.path("export/employee_eligibility.parquet")).drop("computed_at")


# -- data quality ----------------------------------------------------------


@query
def dq_rule_flags(spark, sf_dir):
    flags = [f"{rule.broken} AS `{rule.name}`" for rule in activity_rules()]
    return tables.bronze(spark, sf_dir).selectExpr("kafka_offset", *flags)


@query
def dq_tagged(spark, sf_dir):
    tagged = quality.tag_violations(tables.bronze(spark, sf_dir))
    return tagged.select("id", "employee_id", "kafka_offset", "rejection_reason")


@query
def dq_clean(spark, sf_dir):
    return quality.valid_rows(tables.bronze(spark, sf_dir))


@query
def dq_quarantine(spark, sf_dir):
    return quality.rejected_rows(quality.tag_violations(tables.bronze(spark, sf_dir))).drop("rejected_at")


@query
def dq_rule_summary(spark, sf_dir):
    return quality.rejection_summary(quality.rejected_rows(quality.tag_violations(tables.bronze(spark, sf_dir))))


@query
def fk_valid(spark, sf_dir):
    return quality.with_known_key(dq_clean(spark, sf_dir), tables.employees(spark, sf_dir))


@query
def fk_orphans(spark, sf_dir):
    orphans = quality.with_unknown_key(dq_clean(spark, sf_dir), tables.employees(spark, sf_dir))
    return orphans.drop("rejected_at")


def _staff_bitmaps(spark, sf_dir):
    path = scratch_dir(spark, "bitmaps")
    id_bitmaps(tables.employees(spark, sf_dir), "employee_id").write.parquet(path)
    return spark.read.parquet(path)


@query
def fk_valid_bitmap(spark, sf_dir):
    """The key check by bitmaps of the known ids."""
    return with_id_in(dq_clean(spark, sf_dir), _staff_bitmaps(spark, sf_dir), "employee_id")


@query
def fk_orphans_bitmap(spark, sf_dir):
    return with_id_not_in(dq_clean(spark, sf_dir), _staff_bitmaps(spark, sf_dir), "employee_id")


@query
def all_rejected(spark, sf_dir):
    tagged = tag_all(tables.bronze(spark, sf_dir), tables.employees(spark, sf_dir))
    return quality.rejected_rows(tagged).drop("rejected_at")


@query
def rejects_union(spark, sf_dir):
    bronze = tables.bronze(spark, sf_dir)
    quarantine = quality.rejected_rows(quality.tag_violations(bronze))
    orphans = quality.with_unknown_key(quality.valid_rows(bronze), tables.employees(spark, sf_dir))
    union = quality.union_rejects(quarantine, orphans.drop("details"))
    return union.select("id", "kafka_offset", "details", "rejection_reason")


@query
def quarantine_history(spark, sf_dir):
    """Rejects appended batch by batch, one batch written twice, read back as one table."""
    log = BatchLog(spark, scratch_dir(spark, "quarantine"))
    feed = tables.bronze(spark, sf_dir, "wave")
    tagged = tag_all(feed, tables.employees(spark, sf_dir))
    for wave in [0, 1, 1, 2]:
        log.write(quality.rejected_rows(tagged.where(f"wave = {wave}")).drop("wave"), "main", wave)
    return log.read().select("id", "employee_id", "kafka_offset", "rejection_reason", "batch_id")


@query
def quarantine_dedup_first(spark, sf_dir):
    """Rejects when the newest version is chosen before validation: rows without an id all count."""
    tagged = tag_all(
        tables.bronze(spark, sf_dir), tables.employees(spark, sf_dir), Options(dedup_first=True), FEED_ORDER
    )
    return quality.rejected_rows(tagged).select("id", "employee_id", "kafka_offset", "rejection_reason")


@query
def no_reference_keys(spark, sf_dir):
    """The key check before there is a reference table: everything passes."""
    valid, orphans = quality.check_keys(dq_clean(spark, sf_dir), None)
    count = lambda frame, part: frame.agg(F.count("*").alias("records")).withColumn("part", F.lit(part))
    return count(valid, "passed").unionByName(count(orphans, "orphans"))


@query
def null_key_offenders(spark, sf_dir):
    """The preview of rows without an employee: how many it shows, and that all are offenders."""
    sample = quality.null_key_sample(tables.bronze(spark, sf_dir))
    return sample.agg(F.count("*").alias("shown"), F.coalesce(F.bool_and(F.isnull("employee_id")), F.lit(False)).alias("all_null"))


@query
def write_counts(spark, sf_dir):
    """Rows that each overwrite reports, next to the rows that a reader finds."""
    table, silver, found = SnapshotTable(spark, scratch_dir(spark, "counts")), _silver(spark, sf_dir), []
    for step, rows in enumerate([silver, silver.where("is_commute")], 1):
        found.append((step, table.write(rows)["rows"], table.read().count()))
    return spark.createDataFrame(found, "step int, reported bigint, found bigint")


@query
def bronze_profile(spark, sf_dir):
    return quality.bronze_profile(tables.bronze(spark, sf_dir))


@query
def null_key_report(spark, sf_dir):
    return quality.null_key_count(tables.bronze(spark, sf_dir))


@query
def known_keys(spark, sf_dir):
    return quality.distinct_keys(tables.bronze(spark, sf_dir))


# -- change feed -----------------------------------------------------------


@query
def epoch_datetime(spark, sf_dir):
    return tables.feed(spark, sf_dir).select(
        "kafka_offset", "start_timestamp", epoch_text("start_timestamp").alias("start_datetime")
    )


@query
def commute_flag(spark, sf_dir):
    return tables.feed(spark, sf_dir).select("kafka_offset", "sport_type", is_commute().alias("is_commute"))


@query
def cdc_parse_json(spark, sf_dir):
    parsed = cdc.parse_changes(tables.messages(spark, sf_dir), tables.FEED_DDL, keep=["partition", "offset"])
    return cdc.with_start_datetime(parsed)


@query
def cdc_latest(spark, sf_dir):
    return cdc.latest_version(tables.bronze(spark, sf_dir), order=FEED_ORDER)


@query
def cdc_active(spark, sf_dir):
    return cdc.active_rows(tables.bronze(spark, sf_dir))


@query
def silver_projection(spark, sf_dir):
    return _changes(spark, sf_dir)


@query
def silver_initial(spark, sf_dir):
    return _silver(spark, sf_dir).drop("updated_at")


@query
def silver_exempt_deletes(spark, sf_dir):
    return cdc.initial_rows(_changes(spark, sf_dir, Options(exempt_deletes=True))).drop("updated_at")


@query
def silver_dedup_first(spark, sf_dir):
    return cdc.initial_rows(_changes(spark, sf_dir, Options(dedup_first=True))).drop("updated_at")


def _merged(spark, sf_dir, null_safe):
    """First versions are the table, all later ones the changes."""
    staff = tables.employees(spark, sf_dir)
    feed = tables.bronze(spark, sf_dir, "wave")
    first, later = feed.where("wave = 0"), feed.where("wave > 0")
    target = cdc.initial_rows(silver_changes(first, staff, order=FEED_ORDER))
    changes = silver_changes(later, staff, order=FEED_ORDER)
    return cdc.apply_changes(target, changes, null_safe=null_safe).drop("updated_at")


@query
def silver_merge_parity(spark, sf_dir):
    return _merged(spark, sf_dir, null_safe=False)


@query
def silver_merge_nullsafe(spark, sf_dir):
    return _merged(spark, sf_dir, null_safe=True)


# -- reference data and cohorts --------------------------------------------


@query
def reference_join(spark, sf_dir):
    joined = reference.join_reference(tables.raw_employees(spark, sf_dir), tables.raw_sports(spark, sf_dir))
    return reference.silver_employees(joined).drop("updated_at")


@query
def reference_csv(spark, sf_dir):
    """The same through CSV files and the create-once reference table."""
    root = _staff_files(spark, sf_dir)
    table = SnapshotTable(spark, f"{root}/table")
    for _ in range(2):
        load_reference(spark, f"{root}/employees.csv", f"{root}/sports.csv", table, key_type="bigint")
    return reference.silver_employees(table.read()).drop("updated_at")


def _staff_files(spark, sf_dir, sound=False) -> str:
    """A folder with the two reference files; ``sound``: with every required field filled in."""
    root = scratch_dir(spark, "reference")
    for name, frame in [("employees", tables.raw_employees), ("sports", tables.raw_sports)]:
        rows = frame(spark, sf_dir)
        if sound:  # ids from 1 on, and a way to work for everybody
            rows = rows.withColumn("ID salarié", F.col("ID salarié") + 1)
            mode = "Moyen de déplacement"
            rows = rows.withColumn(mode, F.coalesce(mode, F.lit("Transports en commun"))) if mode in rows.columns else rows
        rows.write.options(**CSV_OPTIONS).csv(f"{root}/{name}.csv")
    return root


@query
def staff_files(spark, sf_dir):
    """The two files as they are, after the check that both have what is needed."""
    root = _staff_files(spark, sf_dir)
    joined = load_employee_data(spark, f"{root}/employees.csv", f"{root}/sports.csv")
    return joined.select(*(F.col(f"`{raw}`").alias(name) for name, raw in cohorts.RAW.items()))


@query
def cohort_run(spark, sf_dir):
    """The summary of the cohort run under strict validation."""
    root = _staff_files(spark, sf_dir, sound=True)

    def sink(rows):
        export_parquet(rows, f"{root}/cohorts")
        return row_count(spark, f"{root}/cohorts")

    return summary_frame(spark, run_cohorting(spark, f"{root}/employees.csv", f"{root}/sports.csv", sink, "bigint"))




def _people(spark, sf_dir):
    joined = reference.join_reference(tables.raw_employees(spark, sf_dir), tables.raw_sports(spark, sf_dir))
    return cohorts.split_employees(joined, "bigint")


@query
def cohort_frames(spark, sf_dir):
    """The three frames of the split, put together again with their names."""
    names = (cohorts.SPORT_ONLY, cohorts.TRANSPORT_ONLY, cohorts.BOTH)
    frames = cohorts.split_by_eligibility(_people(spark, sf_dir)[0])
    labelled = [frame.select("employee_id", F.lit(name).alias("frame")) for name, frame in zip(names, frames)]
    return labelled[0].unionByName(labelled[1]).unionByName(labelled[2])


@query
def employees_valid(spark, sf_dir):
    return _people(spark, sf_dir)[0]


@query
def employees_invalid(spark, sf_dir):
    return _people(spark, sf_dir)[1].select("employee_id", "sport_practice", "invalid")


@query
def eligible_employees(spark, sf_dir):
    return cohorts.eligible_employees(_people(spark, sf_dir)[0])


@query
def cohort_split(spark, sf_dir):
    return cohorts.with_cohort(_people(spark, sf_dir)[0]).select("employee_id", "cohort")


@query
def cohort_shares(spark, sf_dir):
    return cohorts.cohort_shares(_people(spark, sf_dir)[0])


# -- notifications ---------------------------------------------------------


def _shown(rows):
    return rows.withColumn("start_timestamp", F.date_format("start_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query
def notify_rows(spark, sf_dir):
    rows = notify.notifications(tables.messages(spark, sf_dir), tables.FEED_DDL)
    return _shown(rows.drop("timestamp", "partition"))


@query
def notify_latest(spark, sf_dir):
    rows = notify.notifications(tables.messages(spark, sf_dir), tables.FEED_DDL)
    return _shown(notify.with_message(notify.batch_latest(rows)))


@query
def notify_payload(spark, sf_dir):
    """The message of every change, as if each came alone."""
    rows = notify.notification_rows(tables.feed(spark, sf_dir), keep=["kafka_offset"])
    messages = notify.with_message(rows.withColumn("total_in_batch", F.lit(1)))
    return messages.select("kafka_offset", "title", "description", "color", "body")


# -- streaming -------------------------------------------------------------


def _deliver(spark, sf_dir, lake, wave):
    sent = tables.messages(spark, sf_dir).where(f"wave = {wave}").drop("wave")
    sent.write.mode("append").parquet(lake.path("feed"))
    with unsorted_folders(spark, OPEN_DAYS):
        start_landing(lake, file_messages(spark, lake.path("feed")), availableNow=True).awaitTermination()


@query
def bronze_stream(spark, sf_dir):
    """Messages landed in three deliveries."""
    lake = Lake(spark, scratch_dir(spark, "bronze"), options=Options(key_type="bigint"))
    for wave in range(tables.WAVES):
        _deliver(spark, sf_dir, lake, wave)
    return lake.bronze().select(*CHANGE_COLUMNS, "start_datetime", "kafka_partition", "kafka_offset")


@query
def silver_incremental(spark, sf_dir):
    """Landed and merged delivery by delivery; equals Silver from all of the feed at once."""
    lake = Lake(spark, scratch_dir(spark, "silver"), options=Options(key_type="bigint"))
    lake.employees.write(tables.employees(spark, sf_dir))
    for wave in range(tables.WAVES):
        _deliver(spark, sf_dir, lake, wave)
        start_silver(lake).awaitTermination()
    return lake.activities.read().drop("updated_at")


@query
def notification_stream(spark, sf_dir):
    """One delivery of everything, so one message: about the last change."""
    lake = Lake(spark, scratch_dir(spark, "notify"), options=Options(key_type="bigint"))
    tables.messages(spark, sf_dir).drop("wave").write.parquet(lake.path("feed"))
    start_notifications(lake, file_messages(spark, lake.path("feed")), availableNow=True).awaitTermination()
    return lake.notifications.read().select("activity_id", "total_in_batch", "title", "color", "body")


@query
def silver_replayed_batches(spark, sf_dir):
    """The three deliveries merged out of order and twice, the table's old versions long gone."""
    lake = Lake(spark, scratch_dir(spark, "replayed"), options=Options(key_type="bigint"))
    staff, feed = tables.employees(spark, sf_dir), tables.bronze(spark, sf_dir, "wave")
    feed = feed.withColumn("ingested_at", F.timestamp_micros(F.col("kafka_offset")))
    for number, wave in enumerate([2, 0, 1, 0, 2]):
        changes = silver_changes(feed.where(f"wave = {wave}"), staff, keep=ARRIVAL)
        merge_activities(lake, changes, "waves", number, datetime.now(timezone.utc))
    return lake.activities.read().drop("updated_at")


@query
def silver_merge_buckets(spark, sf_dir):
    """Delivered and merged with Silver in buckets."""
    lake = Lake(spark, scratch_dir(spark, "buckets"), buckets=8, options=Options(key_type="bigint"))
    lake.employees.write(tables.employees(spark, sf_dir))
    for wave in range(tables.WAVES):
        _deliver(spark, sf_dir, lake, wave)
        start_silver(lake).awaitTermination()
    return lake.activities.read().drop("updated_at")


@query
def medallion_refresh(spark, sf_dir):
    """Landed and refreshed delivery by delivery, a lost Gold job in between; equals Gold at once."""
    lake = Lake(spark, scratch_dir(spark, "medallion"), options=Options(key_type="bigint"))
    root = _staff_files(spark, sf_dir)
    load_reference(spark, f"{root}/employees.csv", f"{root}/sports.csv", lake.reference, key_type="bigint")
    for wave in range(tables.WAVES):
        _deliver(spark, sf_dir, lake, wave)
        if wave == 1:  # only Silver: the next pass has to make up for Gold
            ensure_employees(lake)
            start_silver(lake).awaitTermination()
        else:
            refresh(lake)
    return lake.gold.read().drop("computed_at")


@query
def bronze_status(spark, sf_dir):
    """Rows of landed Bronze, and of a folder that is not there."""
    lake = Lake(spark, scratch_dir(spark, "status"), options=Options(key_type="bigint"))
    for wave in range(tables.WAVES):
        _deliver(spark, sf_dir, lake, wave)
    places = {"landed": lake.bronze_path, "missing": lake.path("nowhere")}
    found = [(name, row_count(spark, path), has_rows(spark, path)) for name, path in places.items()]
    return spark.createDataFrame(found, "place string, records bigint, has_data boolean")


@query
def ingest_stamps(spark, sf_dir):
    """Every landed row carries a stamp, one for each delivery."""
    lake = Lake(spark, scratch_dir(spark, "stamps"), options=Options(key_type="bigint"))
    for wave in range(tables.WAVES):
        _deliver(spark, sf_dir, lake, wave)
    return lake.bronze().agg(
        F.count("*").alias("records"),
        F.count_if(F.isnull("ingested_at")).cast("int").alias("unstamped"),
        (F.countDistinct("ingested_at") == tables.WAVES).alias("one_stamp_per_delivery"),
    )


@query
def silver_merge_partitions(spark, sf_dir):
    """Delivered and merged with Silver in hash partitions."""
    lake = Lake(spark, scratch_dir(spark, "partitions"), options=Options(key_type="bigint"), partitions=16)
    lake.employees.write(tables.employees(spark, sf_dir))
    for wave in range(tables.WAVES):
        _deliver(spark, sf_dir, lake, wave)
        start_silver(lake).awaitTermination()
    return lake.activities.read().drop("updated_at")


@query
def gold_incremental(spark, sf_dir):
    """Gold from totals that follow Silver's changes, delivery by delivery; equals Gold at once."""
    lake = Lake(spark, scratch_dir(spark, "totals"), options=Options(key_type="bigint"), partitions=16)
    lake.employees.write(tables.employees(spark, sf_dir))
    for wave in range(tables.WAVES):
        _deliver(spark, sf_dir, lake, wave)
        start_silver(lake).awaitTermination()
        build_gold(lake)
    return lake.gold.read().drop("computed_at")


# -- payloads, deliveries sent twice, footers, broken cells ------------------


@query
def payload_malformed(spark, sf_dir):
    """Payloads that are no JSON object, with their text."""
    return payloads.malformed_payloads(tables.faulty_messages(spark, sf_dir))


@query
def payload_fields(spark, sf_dir):
    """The fields of each delivery, the types they come in, and whether the schema knows them."""
    return payloads.payload_fields(tables.faulty_messages(spark, sf_dir), CHANGE_COLUMNS, per=["wave"])


@query
def bronze_republished(spark, sf_dir):
    """Two deliveries of the whole feed, landed once."""
    options = Options(key_type="bigint", republished_within="1 hour")
    lake = Lake(spark, scratch_dir(spark, "republished"), options=options)
    for _ in range(2):
        tables.messages(spark, sf_dir).drop("wave").write.mode("append").parquet(lake.path("feed"))
        start_landing(lake, file_messages(spark, lake.path("feed")), availableNow=True).awaitTermination()
    return lake.bronze().select(*CHANGE_COLUMNS, "start_datetime", "kafka_partition", "kafka_offset")


@query
def table_counts(spark, sf_dir):
    """Rows of the tables, from their footers; -1 for one that is missing."""
    names = ("events", "customer", "orders", "lineitem", "nowhere")
    found = [(name, row_count(spark, f"{sf_dir}/{name}.parquet")) for name in names]
    return spark.createDataFrame(found, "name string, records bigint")


@query
def reference_broken(spark, sf_dir):
    """Lines of the employees file with a cell that is no number, and which cells."""
    path = scratch_dir(spark, "broken")
    text = {f.name: F.col(f"`{f.name}`").cast("string") for f in tables.raw_employees(spark, sf_dir).schema.fields}
    ident, salary = F.col("`ID salarié`"), "Salaire brut"
    text["ID salarié"] = F.when(ident % 19 == 3, F.concat(F.lit("no. "), ident)).otherwise(text["ID salarié"])
    text[salary] = F.when(ident % 7 == 3, F.lit("n/a")).otherwise(text[salary])
    tables.raw_employees(spark, sf_dir).select(*[c.alias(name) for name, c in text.items()]).write.options(**CSV_OPTIONS).csv(path)
    broken = broken_lines(spark, path, employees_ddl("bigint"))
    return broken.select(F.split("line", ",")[0].alias("id_text"), F.array_join("columns", ", ").alias("columns"))


@query
def batch_reports(spark, sf_dir):
    """Rejects per rule that the job reported for each delivery, measured while writing."""
    lake = Lake(spark, scratch_dir(spark, "reports"), options=Options(key_type="bigint"))
    lake.employees.write(tables.employees(spark, sf_dir))
    for wave in range(tables.WAVES):
        _deliver(spark, sf_dir, lake, wave)
        start_silver(lake).awaitTermination()
    return lake.reports.read().select("batch_id", F.explode("rejects_by_rule").alias("rule", "records"))


# -- upkeep and keyed state ------------------------------------------------


@query
def bronze_compacted(spark, sf_dir):
    """Landed in three deliveries and compacted: read from the compacted day, equals what was landed."""
    lake = Lake(spark, scratch_dir(spark, "compacted"), options=Options(key_type="bigint"))
    for wave in range(tables.WAVES):
        _deliver(spark, sf_dir, lake, wave)
    lake.landed.compact(date.today() + timedelta(days=2))  # nothing more is landed here
    return lake.bronze().select(*CHANGE_COLUMNS, "start_datetime", "kafka_partition", "kafka_offset")


@query
def quarantine_compacted(spark, sf_dir):
    """The history of rejects with its finished batches merged into a segment, the last one written again."""
    log = BatchLog(spark, scratch_dir(spark, "segments"))
    tagged = tag_all(tables.bronze(spark, sf_dir, "wave"), tables.employees(spark, sf_dir))
    for wave in [0, 1, 2, 2]:
        log.write(quality.rejected_rows(tagged.where(f"wave = {wave}")).drop("wave"), "main", wave)
        if wave:
            log.compact()
    return log.read().select("id", "employee_id", "kafka_offset", "rejection_reason", "batch_id")


@query
def silver_newest(spark, sf_dir):
    """Silver from the changes that the keyed state lets through, delivered late, out of order and twice."""
    lake = Lake(spark, scratch_dir(spark, "newest"), options=Options(key_type="bigint"))
    lake.employees.write(tables.employees(spark, sf_dir))
    feed = tables.bronze(spark, sf_dir, "wave").withColumn("ingested_at", F.timestamp_micros(F.col("kafka_offset")))
    for wave in (2, 0, 1, 0):
        feed.where(f"wave = {wave}").drop("wave").withColumn("ingest_date", F.current_date()).write.mode("append").parquet(lake.bronze_path)
        start_newest(lake).awaitTermination()
    newest = cdc.latest_version(lake.changes.read())
    return cdc.active_rows(newest).select(*cdc.SILVER_COLUMNS)


@query
def silver_newest_merged(spark, sf_dir):
    """Silver in hash partitions, kept by the stream with keyed state over late and repeated deliveries."""
    lake = Lake(spark, scratch_dir(spark, "newest_merged"), options=Options(key_type="bigint"), partitions=8)
    lake.employees.write(tables.employees(spark, sf_dir))
    feed = tables.bronze(spark, sf_dir, "wave").withColumn("ingested_at", F.timestamp_micros(F.col("kafka_offset")))
    for wave in (2, 0, 1, 0):
        feed.where(f"wave = {wave}").drop("wave").withColumn("ingest_date", F.current_date()).write.mode("append").parquet(lake.bronze_path)
        start_newest(lake, merge=True).awaitTermination()
    return lake.activities.read().drop("updated_at")


@query
def silver_late_staff(spark, sf_dir):
    """A third of the employees comes with the last delivery: their orphans are admitted unasked, after upkeep."""
    lake = Lake(spark, scratch_dir(spark, "late_staff"), options=Options(key_type="bigint"))
    root = _staff_files(spark, sf_dir)
    everybody = SnapshotTable(spark, lake.path("everybody"))
    load_reference(spark, f"{root}/employees.csv", f"{root}/sports.csv", everybody, key_type="bigint")
    lake.reference.write(everybody.read().where("id_salarie % 3 <> 0"))
    for wave in range(tables.WAVES):
        _deliver(spark, sf_dir, lake, wave)
        if wave == tables.WAVES - 1:
            lake.reference.write(everybody.read())
        refresh(lake)
        upkeep(lake)
    return lake.activities.read().drop("updated_at")
