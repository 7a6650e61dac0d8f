"""``spark-submit``-able jobs: ``python -m cdc_lake <job> --help``."""

from __future__ import annotations

import argparse
import sys
from datetime import date

from .operators.eligibility import gold_report
from .operators.quality import rejection_summary
from .plans.cohorting import run_cohorting
from .plans.lake import Lake, Options
from .plans.upkeep import upkeep
from .session import build_session
from .sources.messages import file_messages, kafka_messages
from .sources.reference_csv import load_reference
from .sources.tables import export_parquet, row_count
from .streaming.bronze import run_bronze
from .streaming.latest import start_newest
from .streaming.notifications import NOTIFY_INTERVAL, start_notifications
from .streaming.silver import refresh, start_watch


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="cdc_lake")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str) -> argparse.ArgumentParser:
        added = jobs.add_parser(name, help=text)
        added.add_argument("--root", required=True, help="folder of the lake")
        added.add_argument("--run", default="main", help="name of the checkpoints; a new one starts over")
        added.add_argument("--key-type", choices=["int", "bigint"], default="int")
        return added

    def with_source(added: argparse.ArgumentParser) -> None:
        added.add_argument("--servers", help="Kafka servers")
        added.add_argument("--topic", help="Kafka topic")
        added.add_argument("--starting", default="earliest")
        added.add_argument("--messages", help="folder of message files, instead of Kafka")
        added.add_argument("--offsets-per-batch", help="Kafka's maxOffsetsPerTrigger")
        added.add_argument("--min-partitions", help="Kafka's minPartitions")

    def with_reference(added: argparse.ArgumentParser) -> None:
        added.add_argument("--employees", required=True)
        added.add_argument("--sports", required=True)

    def with_layout(added: argparse.ArgumentParser) -> None:
        added.add_argument("--buckets", type=int, help="store Silver in so many buckets")
        added.add_argument("--partitions", type=int, help="keep Silver in so many hash partitions, Gold's totals from changes")

    bronze = job("bronze", "land change messages")
    with_source(bronze)
    with_reference(bronze)
    bronze.add_argument("--no-preview", action="store_true")
    bronze.add_argument("--drop-tombstones", action="store_true")
    bronze.add_argument("--republished-within", help="land a topic position once within this time, such as '10 minutes'")

    silver = job("medallion", "Silver and Gold from what Bronze gained")
    silver.add_argument("--mode", choices=["single", "watch"], default="single")
    silver.add_argument("--interval", type=int, default=60, help="seconds between passes in watch mode")
    silver.add_argument("--export-to")
    orphans = silver.add_mutually_exclusive_group()
    orphans.add_argument("--replay-orphans", action="store_true", default=None, help="look for orphans to admit in every pass, not only after new employees")
    orphans.add_argument("--keep-orphans", dest="replay_orphans", action="store_false", help="never admit orphans")
    silver.add_argument("--files-per-batch", type=int, help="Bronze files of one batch at most")
    with_layout(silver)
    silver.add_argument("--employees", help="load the reference files again first, with --sports")
    silver.add_argument("--sports")
    for flag in ("plain-compare", "exempt-deletes", "dedup-first"):
        silver.add_argument(f"--{flag}", action="store_true")

    notify = job("notify", "a message about the last change of each batch")
    with_source(notify)
    notify.add_argument("--interval", default=NOTIFY_INTERVAL)

    newest = job("newest", "changes that supersede earlier ones, by keyed state")
    newest.add_argument("--merge", action="store_true", help="keep Silver up to date from them; instead of the medallion job")
    newest.add_argument("--interval", type=int, help="seconds between batches; without it one pass")
    newest.add_argument("--forget-deletes", type=int, metavar="HOURS", help="forget deleted keys after so long; needs --interval")
    newest.add_argument("--files-per-batch", type=int, help="Bronze files of one batch at most")
    with_layout(newest)

    tidy = job("upkeep", "rewrite closed days of Bronze, merge finished batch folders")
    tidy.add_argument("--before", type=date.fromisoformat, help="days before this one; by default all before yesterday")

    job("report", "rows of Bronze, rejects per rule, Gold figures")
    with_reference(job("cohorts", "employee cohorts, written to <root>/cohorts"))
    return parser


def report(lake: Lake) -> None:
    rejected, gold = lake.quarantine.read(), lake.gold.read()
    print(f"Bronze rows: {row_count(lake.spark, lake.bronze_path)}")
    if rejected is not None:
        rejection_summary(rejected).show(truncate=False)
    if lake.reports.read() is not None:
        lake.reports.read().orderBy("reported_at").show(truncate=False)
    if gold is not None:
        gold_report(gold).show()


def main(argv: list[str] | None = None) -> int:
    given = arguments().parse_args(argv)
    spark = build_session(f"cdc_lake {given.job}")
    options = Options(
        null_safe=not getattr(given, "plain_compare", False),
        exempt_deletes=getattr(given, "exempt_deletes", False),
        dedup_first=getattr(given, "dedup_first", False),
        drop_tombstones=getattr(given, "drop_tombstones", False),
        republished_within=getattr(given, "republished_within", None),
        key_type=given.key_type,
    )
    lake = Lake(spark, given.root, given.run, getattr(given, "buckets", None), options, getattr(given, "partitions", None))

    def messages():
        if given.messages:
            return file_messages(spark, given.messages)
        limits = {"maxOffsetsPerTrigger": given.offsets_per_batch, "minPartitions": given.min_partitions}
        return kafka_messages(spark, given.servers, given.topic, given.starting, **{k: v for k, v in limits.items() if v})

    if given.job == "medallion" and given.employees and given.sports:
        load_reference(spark, given.employees, given.sports, lake.reference, refresh=True, key_type=given.key_type, quarantine=lake.reference_quarantine)
    if given.job == "bronze":
        run_bronze(lake, messages(), given.employees, given.sports, not given.no_preview)
    elif given.job == "medallion" and given.mode == "watch":
        interval = f"{given.interval} seconds"
        start_watch(lake, given.export_to, interval, given.replay_orphans, given.files_per_batch).awaitTermination()
    elif given.job == "medallion":
        print(refresh(lake, given.export_to, given.replay_orphans, given.files_per_batch) or "nothing new")
    elif given.job == "notify":
        start_notifications(lake, messages(), processingTime=given.interval).awaitTermination()
    elif given.job == "newest":
        trigger = {"processingTime": f"{given.interval} seconds"} if given.interval else {}
        forget = given.forget_deletes and given.forget_deletes * 3_600_000
        start_newest(lake, forget, given.files_per_batch, given.merge, **trigger).awaitTermination()
    elif given.job == "upkeep":
        print(upkeep(lake, given.before))
    elif given.job == "report":
        report(lake)
    else:
        def sink(frame):
            export_parquet(frame, lake.path("cohorts"))
            return row_count(spark, lake.path("cohorts"))

        summary = run_cohorting(spark, given.employees, given.sports, sink, given.key_type)
        print(summary)
        return 0 if summary.success else 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
