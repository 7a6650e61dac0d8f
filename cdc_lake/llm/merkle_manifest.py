"""Merkle manifest of a table of documents, by lag and lead windows.

Leaves are numbered inside their group without a task that holds a group: rows are put in
ranges of (group, id), and a running number inside a range is added to the counts of the
ranges before it. Then windows climb ``HEIGHT`` levels at a time. A window holds one block of
8 ** HEIGHT neighbours, which starts at a multiple of that, so no run of siblings crosses its
edge. Level k is read at fixed offsets of j * 8 ** k rows, j from 1 to 7, masked by the slot
and by the length of the run: that gives the siblings, and the first child's row hashes the
parent. Blocks are the leaves of the next tier. Only digests move, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.joins import lookup_join
from .common import stored

ARITY = 8
#: Levels that one window climbs: a block of 4,096 rows stays in a window's memory.
HEIGHT = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ROOT_GROUP = ""


def _hash(text: Column) -> Column:
    return F.sha2(text, 256)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: list[Column]) -> Column:
    """Digest of a row: each value as ``-`` if null, else its bytes, a colon and itself."""
    return _hash(F.concat(*[_field(value) for value in values]))


def group_key(group: Column) -> Column:
    """A text that is never null and sorts as the group does, null first, then bytewise."""
    return F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group.cast("string")))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``idx``, their place in their ``group`` by ``order``, and ``size``, the rows in it.

    Equal rows are told apart by their place in the stored table, so that a repeated row
    spreads over ranges too. The ranges are written: their numbers don't change when a task is
    run again. The driver sees nothing.
    """
    keys = ["group", *order, "_place"]
    ranged = rows.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged = stored(ranged.drop("_place").withColumn("_seq", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_seq", 33)  # the upper bits number the partition
    held = ranged.groupBy("group", part.alias("part")).agg(F.min("_seq").alias("first"), F.count("*").alias("held"))
    of_group = Window.partitionBy("group")
    before = F.sum("held").over(of_group.orderBy("part")) - F.col("held")
    places = held.select(
        F.concat_ws("|", "part", "group").alias("_range"), (before - F.col("first")).alias("_shift"), F.sum("held").over(of_group).alias("size")
    )
    moved = lookup_join(ranged.withColumn("_range", F.concat_ws("|", part, "group")), stored(places, "places"), "_range", "inner")
    return moved.withColumn("idx", F.col("_seq") + F.col("_shift")).drop("_range", "_seq", "_shift")


def _width(level: int) -> int:
    return ARITY**level


def _nodes_at(level: int) -> Column:
    """Nodes of the group at a level: ``size`` at level 0."""
    return F.ceil(F.col("size") / _width(level))


def _in_blocks(nodes: DataFrame):
    blocked = nodes.withColumn("block", F.floor(F.col("idx") / _width(HEIGHT)))
    return blocked, Window.partitionBy("group", "block").orderBy("idx")


def _level(rows: DataFrame, level: int, window) -> DataFrame:
    """``left`` and ``right`` siblings of each node of a level, and in ``node`` its parent instead.

    Nodes stand in the row of their first leaf; other rows have null. Where one node is left,
    it climbs unchanged and has no sides.
    """
    width = _width(level)
    position = F.floor(F.col("idx") / width)
    slot = F.pmod(position, F.lit(ARITY))
    run = F.least(F.lit(ARITY), _nodes_at(level) - position + slot)
    lags = [F.lag("node", j * width).over(window).alias(f"_lag{j}") for j in range(1, ARITY)]
    leads = [F.lead("node", j * width).over(window).alias(f"_lead{j}") for j in range(1, ARITY)]
    near = rows.select("*", slot.alias("_slot"), run.alias("_run"), *lags, *leads)
    left = F.concat(*[F.when(F.col("_slot") >= j, F.col(f"_lag{j}")).otherwise(F.lit("")) for j in range(ARITY - 1, 0, -1)])
    right = F.concat(*[F.when(F.col("_slot") + j < F.col("_run"), F.col(f"_lead{j}")).otherwise(F.lit("")) for j in range(1, ARITY)])
    climbs = F.col("node").isNotNull() & (_nodes_at(level) > 1)
    sided = near.withColumn("left", F.when(climbs, left)).withColumn("right", F.when(climbs, right))
    first = F.pmod(F.col("idx"), F.lit(_width(level + 1))) == 0
    parent = F.when(_nodes_at(level) > 1, _hash(F.concat("left", "node", "right"))).otherwise(F.col("node"))
    return sided.withColumn("node", F.when(first, parent)).drop("_slot", "_run", *[f"_lag{j}" for j in range(1, ARITY)], *[f"_lead{j}" for j in range(1, ARITY)])


def block_roots(nodes: DataFrame) -> DataFrame:
    """``group, idx, size, digest`` of the nodes ``HEIGHT`` levels up."""
    rows, window = _in_blocks(nodes.select("group", "idx", "size", F.col("digest").alias("node")))
    for level in range(HEIGHT):
        rows = _level(rows, level, window).drop("left", "right")
    up = rows.where("node IS NOT NULL")
    return up.select("group", F.col("block").alias("idx"), _nodes_at(HEIGHT).alias("size"), F.col("node").alias("digest"))


def with_paths(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``block`` and ``path``: the siblings (left, right) of each level of the block."""
    rows, window = _in_blocks(nodes.withColumn("node", F.col("digest")))
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for level in range(HEIGHT):
        rows = _level(rows, level, window).withColumn("_sides", F.when(F.col("left").isNotNull(), F.struct("left", "right"))).drop("left", "right")
        # An ancestor's row comes first among those below it.
        rows = rows.withColumn(f"_sides{level}", F.last("_sides", ignorenulls=True).over(so_far)).drop("_sides")
    path = F.filter(F.array(*[f"_sides{level}" for level in range(HEIGHT)]), lambda sides: sides.isNotNull())
    return rows.withColumn("path", path).drop("node", *[f"_sides{level}" for level in range(HEIGHT)])


def tiers(nodes: DataFrame) -> list[DataFrame]:
    """``nodes``, then the nodes ``HEIGHT`` levels up, and so on to one node per group.

    The driver learns the size of the largest group.
    """
    every, largest = [nodes], nodes.agg(F.max("size")).first()[0] or 0
    while largest > 1:
        every.append(stored(block_roots(every[-1]), "blocks"))
        largest = -(-largest // _width(HEIGHT))
    return every


def _joined(below: DataFrame, above: DataFrame) -> DataFrame:
    """``below`` with paths that go on with those of ``above``, and what else ``above`` knows."""
    upper = above.withColumnRenamed("path", "_up").withColumnRenamed("idx", "block").drop("size", "digest")
    joined = with_paths(below).join(upper, ["group", "block"])
    return joined.withColumn("path", F.concat("path", "_up")).drop("block", "_up")


def paths(every: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Rows of the lowest of the tiers with ``path`` to the root; ``tops``: that of each group's last node."""
    above = lookup_join(every[-1], tops, "group", "inner")
    for below in reversed(every[1:-1]):
        above = stored(_joined(below, above), "paths")
    return _joined(every[0], above) if len(every) > 1 else above


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of ``docs``: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    Leaves are ordered by ``key`` inside a group (null first; rows of equal key by their
    digest, repeated rows stay repeated), groups by name (null first). The proof is the
    hash of all siblings on the way to the root. ``folded_root`` is the root worked out from
    the proof and the leaf as it is found: where 3 divides the crc32 of the key's decimal
    digits, a leaf whose text had its A to Z lower-cased; a null key is never tampered with,
    and a null text stays. An empty table gives an empty result. Other columns are not read.
    """
    values = [docs[f] for f in fields]
    forged = [F.translate(docs[f], _UPPER, _LOWER) if f == text else docs[f] for f in fields]
    tampered = F.pmod(F.crc32(docs[key].cast("string").cast("binary")), F.lit(3)) == 0
    leaves = docs.select(
        docs[key].alias("doc_id"), group_key(docs[group]).alias("group"), leaf_digest(values).alias("digest"),
        F.when(tampered & docs[text].rlike("[A-Z]"), leaf_digest(forged)).alias("forged"),
    )
    every = tiers(numbered(stored(leaves, "leaves"), ["doc_id", "digest"]))
    subroots = every[-1].select(F.lit(_ROOT_GROUP).alias("group"), F.col("group").alias("name"), "digest")
    above = tiers(stored(numbered(stored(subroots, "subroots"), ["name"]), "names"))
    root = above[-1].select("group", F.col("digest").alias("root"), F.array().cast("array<struct<left:string,right:string>>").alias("path"))
    tops = paths(above, root).select(F.col("name").alias("group"), "root", "path", F.col("digest").alias("subroot"))
    proved = paths(every, stored(tops, "tops"))
    proof = F.array_join(F.transform("path", lambda sides: F.concat(sides["left"], sides["right"])), "")
    folded = F.aggregate("path", F.coalesce("forged", "digest"), lambda node, sides: _hash(F.concat(sides["left"], node, sides["right"])))
    result = proved.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", _hash(proof).alias("proof_sha256"), folded.alias("folded_root"))
    return result.withColumn("verified", F.col("folded_root") == F.col("root"))
