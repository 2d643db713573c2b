"""Exact distinct counts of long keys that add up: bitmaps per group and bucket of keys.

A bucket covers 32,768 consecutive keys and is one bitmap of 4 KB, so a table's
bitmaps are an eighth of a byte per possible key and group.  They are built in
one aggregate with no expand and no second exchange per distinct column, can be
kept per slice of a layer, and merge by ``or``: a slice that changes is the only
one that is counted again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET, BITS = "__bucket", "__bits"


def key_bitmaps(df: DataFrame, by: Sequence[str], keys: dict[str, str]) -> DataFrame:
    """``(by…, name, __bucket, __bits)``: the bitmaps of each ``name: key column`` of ``keys`` (whole numbers; nulls count nowhere).

    All keys of a row are looked at in one pass: a row becomes one per key, and
    rows of a group and bucket are combined before the shuffle.
    """
    each = df.select(*by, F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(c).cast("long").alias("key")) for n, c in keys.items()])).alias("__k"))
    known = each.where(F.col("__k.key").isNotNull())
    return known.groupBy(*by, F.col("__k.name").alias("name"), F.bitmap_bucket_number("__k.key").alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__k.key")).alias(BITS))


def merge_bitmaps(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """The bitmaps of coarser groups, or of several slices together."""
    return bitmaps.groupBy(*by, "name", BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def count_keys(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(by…, name, n_distinct)`` of bitmaps that have one row per group, name and bucket (``merge_bitmaps`` makes them so)."""
    return bitmaps.groupBy(*by, "name").agg(F.sum(F.bitmap_count(BITS)).alias("n_distinct"))
