"""Joins against a lookup side that holds one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str, how: str = "left") -> DataFrame:
    """``rows`` joined left, semi or anti with ``lookup``, which must hold at most one row per key.

    Catalyst broadcasts ``lookup`` when its size is under the broadcast threshold. Beyond
    it, AQE splits the partitions of hot keys, but only where a shuffle feeds the join
    directly. ``lookup`` usually comes out of an aggregate on the same key, whose
    partitioning the join would reuse, leaving no shuffle to split. Joining on an
    expression of the key asks for a partitioning of its own: the lookup rows, one per key,
    move once more, and a key that holds a third of ``rows`` is spread over many tasks.
    """
    renamed = lookup.withColumnRenamed(key, "_lookup_key")
    return rows.join(renamed, _same(rows, rows[key], renamed["_lookup_key"], key), how).drop("_lookup_key")


def _same(rows: DataFrame, left: Column, right: Column, key: str) -> Column:
    if isinstance(rows.schema[key].dataType, T.IntegralType):
        # A one-to-one expression keeps a single integer key, which joins fastest.
        return F.bitwise_not(left) == F.bitwise_not(right)
    return (left == right) & (F.hash(left) == F.hash(right))
