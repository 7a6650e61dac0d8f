"""Exact sets of integer ids as bitmaps, for key checks that don't move the facts.

A bitmap covers 32,768 neighbouring ids in 4 KB, so the ids of a dense key take a bit each
instead of a row. A stored bitmap table is small enough for Catalyst to broadcast up to some
ten million ids; beyond its threshold the lookup is an ordinary join on the bucket number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_BUCKET, _BITS = "_bucket", "_bits_of_bucket"


def id_bitmaps(ids: DataFrame, key: str) -> DataFrame:
    """The distinct ids as bitmaps, a row per bucket. Combines map-side; null is no id."""
    known = ids.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("_id"))
    return known.groupBy(F.bitmap_bucket_number("_id").alias(_BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias(_BITS)
    )


def _bit(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def _known(df: DataFrame, bitmaps: DataFrame, key: str) -> Column:
    """Join condition: the bucket is there, and its bit is set."""
    ident = df[key].cast("bigint")
    return (F.bitmap_bucket_number(ident) == bitmaps[_BUCKET]) & _bit(bitmaps[_BITS], F.bitmap_bit_position(ident))


def with_id_in(df: DataFrame, bitmaps: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is in the set. All columns stay; a null key is in no set."""
    return df.join(bitmaps, _known(df, bitmaps, key), "left_semi")


def with_id_not_in(df: DataFrame, bitmaps: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is not in the set, null keys among them."""
    return df.join(bitmaps, _known(df, bitmaps, key), "left_anti")
