"""Keep Silver up to date from new Bronze rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.lake import Lake
from ..plans.medallion import apply_batch, ensure_admitted, ensure_employees, ensure_gold, replay_orphans
from ..schemas import bronze_ddl
from ..session import sized_shuffles
from ..sources import files
from ..sources.tables import has_rows


def start_silver(lake: Lake, limit: int | None = None, **trigger) -> StreamingQuery:
    """Apply Bronze increments. The checkpoint knows what is new, and no news runs no batch.

    Silver knows when each row arrived and lets newer rows win only, so increments may be cut
    anywhere: ``limit`` (files per trigger) keeps a long backlog in batches of bounded size.
    """
    return _start(lake, partial(apply_batch, lake), limit, **(trigger or {"availableNow": True}))


def _start(lake: Lake, step: Callable[[DataFrame, int], None], limit: int | None = None, **trigger) -> StreamingQuery:
    """The stream itself reads no column: it tells which files are new, and a batch job reads those.

    So rules and columns reach the scan, as often as the step reads the increment, and the
    shuffles of the step are as wide as the files need.
    """
    files.make_folder(lake.spark, lake.bronze_path)  # wait for the first landing rather than fail
    schema = bronze_ddl(lake.options.key_type)
    source = lake.spark.readStream.schema(schema)
    stream = (source if limit is None else source.option("maxFilesPerTrigger", limit)).parquet(lake.bronze_path)

    def batch_of_files(batch: DataFrame, batch_id: int) -> None:
        sizes = {unquote(row[0]): row[1] for row in batch.distinct().collect()}
        if sizes:
            with sized_shuffles(lake.spark, sum(sizes.values())):
                step(lake.spark.read.schema(schema).option("basePath", lake.bronze_path).parquet(*sizes), batch_id)

    return (
        stream.select("_metadata.file_path", "_metadata.file_size").writeStream.trigger(**trigger)
        .foreachBatch(batch_of_files)
        .option("checkpointLocation", lake.checkpoint("silver"))
        .queryName("Silver - Activities")
        .start()
    )


def start_watch(
    lake: Lake, export_to: str | None = None, interval: str = "60 seconds", replay: bool | None = None,
    limit: int | None = None,
) -> StreamingQuery:
    """Silver and Gold after every interval that brought something new; ``replay`` as in ``refresh``."""

    def step(batch, batch_id):
        ensure_employees(lake)
        apply_batch(lake, batch, batch_id)
        _admit(lake, replay)
        ensure_gold(lake, export_to)

    return _start(lake, step, limit, processingTime=interval)


def _admit(lake: Lake, replay: bool | None) -> None:
    if replay is None:
        ensure_admitted(lake)
    elif replay:
        replay_orphans(lake)


def refresh(
    lake: Lake, export_to: str | None = None, replay: bool | None = None, limit: int | None = None
) -> dict[str, int] | None:
    """One pass: employees, then the new activities checked against them, then Gold.

    Each table is built anew if what it is made of has changed, so a pass also makes up for
    one that was lost half way, and for new reference data. Without news no table is
    written. Earlier orphans are admitted once the employees have changed; ``replay`` true
    looks for them in any case, false never. Returns the report of Gold, or nothing.
    """
    if not has_rows(lake.spark, lake.bronze_path):
        return None
    ensure_employees(lake)
    start_silver(lake, limit).awaitTermination()
    _admit(lake, replay)
    return ensure_gold(lake, export_to)
