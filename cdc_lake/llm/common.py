"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_dir
from ..sources import files

#: White space of the word contracts: space and the control characters from tab to carriage return.
SPACE_RUN = r"[\x20\x09-\x0D]+"
#: Bytes of rows that a Python worker gets at once, about; a longer row comes alone.
BATCH_BYTES = 4 << 20
_BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written to the shared folder and read again: the lineage ends there."""
    path = scratch_dir(frame.sparkSession, label)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def dropped(*frames: DataFrame) -> None:
    """Remove what ``stored`` wrote, once nothing that is still to be computed reads it."""
    for frame in frames:
        for folder in {name.rsplit("/", 1)[0] for name in frame.inputFiles()}:
            files.remove(frame.sparkSession, folder)


def map_texts(rows: DataFrame, function, schema) -> DataFrame:
    """``rows.mapInArrow(function, schema)``, in batches of about ``BATCH_BYTES``.

    Spark's batches are up to 64 MB, and an executor holds several copies of one per task: in the
    JVM before and after, in the worker as Arrow and as Python strings. The setting stays in the
    session, as the frame runs later; one that the session has been given is left as it is.
    """
    conf = rows.sparkSession.conf
    if _BATCHES not in conf.getAll:
        conf.set(_BATCHES, str(BATCH_BYTES))
    return rows.mapInArrow(function, schema)


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def total(values: Column) -> Column:
    """Sum of an array of numbers, as long."""
    return F.aggregate(values, F.lit(0).cast("long"), lambda sum_, x: sum_ + x)


def running(values: Column, add) -> Column:
    """Running ``add`` (associative) of an array of ints, an int per element.

    An append copies its array. So runs are formed in blocks of about the square root of the
    length, and each block then goes on from the one before it.
    """
    empty = F.array().cast("array<int>")

    def run(block):
        step = lambda done, x: F.array_append(done, F.when(F.size(done) > 0, add(F.element_at(done, -1), x)).otherwise(x))
        return F.aggregate(block, empty, step)

    def joined(blocks):
        ends = run(F.transform(blocks, lambda block: F.element_at(block, -1)))
        goes_on = lambda block, ends, i: F.transform(block, lambda x: add(F.get(ends, i - 1), x))
        return let(ends, lambda e: F.flatten(F.transform(blocks, lambda block, i: F.when(i == 0, block).otherwise(goes_on(block, e, i)))))

    def cut(pair):
        starts = F.sequence(F.lit(1), F.size(pair["values"]), pair["width"])
        return let(F.transform(starts, lambda at: run(F.slice(pair["values"], at, pair["width"]))), joined)

    def whole(array):
        width = F.ceil(F.sqrt(F.size(array))).cast("int")
        return F.when(F.size(array) == 0, empty).otherwise(let(F.struct(array.alias("values"), width.alias("width")), cut))

    return let(values, whole)


def below(sorted_values: Column, bound: Column) -> Column:
    """How many numbers of an ascending array lie below ``bound``, by halving."""

    def halve(state, _):
        middle = F.shiftright(state["low"] + state["high"], 1)
        less = F.get(sorted_values, middle) < bound
        return (
            F.when(state["low"] >= state["high"], state)
            .when(less, F.struct((middle + 1).alias("low"), state["high"].alias("high")))
            .otherwise(F.struct(state["low"].alias("low"), middle.alias("high")))
        )

    size = F.size(sorted_values)
    start = F.struct(F.lit(0).alias("low"), size.alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.length(F.bin(size))), start, halve)["low"]


def renamed(frame: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``frame`` with columns under names that no operator uses inside, and these by the old names."""
    names = {name: f"in_{place}__" for place, name in enumerate(frame.columns)}
    return frame.toDF(*names.values()), names


def restored(names: dict[str, str], made: list[str]) -> list[Column]:
    """The columns that ``renamed`` renamed, under their old names; those named like a column in ``made`` give way to it."""
    taken = {name.lower() for name in made}
    return [F.col(inner).alias(name) for name, inner in names.items() if name.lower() not in taken]


def partition_count(frame: DataFrame) -> int:
    """Tasks of ``frame``. No job runs if it is read or projected only; shuffles in it run to be counted."""
    return frame._jdf.queryExecution().toRdd().getNumPartitions()
