"""Global order without a global window: rows range-sorted into slices.

``slices`` deals the rows to range partitions of a bounded expected size and
lands them in the shared folder, so the sampled range bounds are fixed and a
lost executor rereads a slice.  What crosses a slice's edge (a row number, a
running sum, the row before) is carried by one row per slice.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir

#: Rows a slice holds on average at most; one slice is one task of the passes over slices.
SLICE_ROWS = 1_000_000

SLICE, PLACE, TIE = "__slice", "__place", "__tie"

# Keys that are looked at as heavy at most: the sketch's length.
HEAVY_KEYS = 64


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def heavy_keys(df: DataFrame, key: str, partitions: int, nulls: bool = False) -> list:
    """Keys with more rows than a partition's share, by a frequency sketch: at
    most ``HEAVY_KEYS``, found in one pass that combines map-side.  The sketch
    never counts too few.  With ``nulls`` the null key is counted like any other."""
    null = F.col(key).isNull()
    found = df.agg(F.count_if(~null).alias("n"), F.count_if(null).alias("nulls"), F.expr(f"approx_top_k({key}, {HEAVY_KEYS}, {32 * HEAVY_KEYS})").alias("top")).first()
    n = found["n"] + (found["nulls"] if nulls else 0)
    heavy = [x["item"] for x in found["top"] or () if x["item"] is not None and x["count"] * partitions > n]
    return heavy + [None] * (nulls and found["nulls"] * partitions > n)


def _in_slice():
    return Window.partitionBy(SLICE).orderBy(PLACE)


def landed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lapsewise-slices/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(df: DataFrame, order: Sequence[str | Column], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``df`` plus ``__slice`` and ``__place``: the rows in ``order`` are those of slice 0, of slice 1 and so on.

    Rows equal in ``order`` are placed as they are read, and may lie in several
    slices: a hot key spreads like any other rows.  No rows give no rows.
    """
    n = max(partitions(df), -(-df.count() // slice_rows))
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = (df.withColumn(TIE, F.monotonically_increasing_id())
              .repartitionByRange(n, *keys, F.col(TIE)).sortWithinPartitions(*keys, TIE).drop(TIE)
              .withColumn(SLICE, F.spark_partition_id())
              .withColumn(PLACE, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    return landed(placed)


def carried(sliced: DataFrame, **sums: Column) -> DataFrame:
    """``(__slice, names…)``: what each of ``sums`` adds up to in all slices before; a row per slice, so its window is small."""
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    per = sliced.groupBy(SLICE).agg(*[F.sum(c).alias(k) for k, c in sums.items()])
    return per.select(SLICE, *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(k) for k in sums])


def ranked(df: DataFrame, order: Sequence[str | Column], name: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``df`` plus ``name``: the row's number from 0 in ``order`` (ties in any order)."""
    sliced = slices(df, order, slice_rows)
    return (sliced.join(carried(sliced, __before=F.lit(1)), SLICE)
            .withColumn(name, F.col("__before") + F.col(PLACE)).drop(SLICE, PLACE, "__before"))


def running(df: DataFrame, order: Sequence[str | Column], weight: str, name: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``df`` plus ``name``: the sum of ``weight`` over all rows before the row in ``order``."""
    sliced = slices(df, order, slice_rows)
    inside = F.coalesce(F.sum(weight).over(_in_slice().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (sliced.join(carried(sliced, __before=F.col(weight)), SLICE)
            .withColumn(name, F.col("__before") + inside).drop(SLICE, PLACE, "__before"))


def previous(df: DataFrame, key: str, order: Sequence[str | Column], columns: dict[str, str],
             slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``df`` plus, for each ``name: column`` of ``columns``, the column's value in the row before of the same ``key``.

    What ``lag(column) over (partition by key order by order)`` gives, rows
    equal in ``order`` in the order they are read.  That window is used, one
    shuffle and nothing landed, where no key holds more than a partition's share
    of the rows.  Else no key is a group: a slice is cut by row numbers, ``lag``
    runs inside slices, and a slice's first row takes the last row of the nearest
    slice before it that has rows.  Null keys are one key, as in a window; a
    first row gets null.
    """
    if not heavy_keys(df, key, partitions(df), nulls=True):
        tied = df.withColumn(TIE, F.monotonically_increasing_id())
        before = Window.partitionBy(key).orderBy(*order, TIE)
        return tied.withColumns({n: F.lag(c).over(before) for n, c in columns.items()}).drop(TIE)
    sliced = slices(df, [F.col(key).asc_nulls_first(), *order], slice_rows)
    held = F.struct(F.col(key).alias("__key"), *[F.col(c).alias(n) for n, c in columns.items()])
    last = sliced.groupBy(SLICE).agg(F.max_by(held, F.col(PLACE)).alias("__last"))
    edges = last.select(SLICE, F.lag("__last").over(Window.orderBy(SLICE)).alias("__edge"))
    seen = sliced.withColumn("__lag", F.lag(held).over(_in_slice())).join(edges, SLICE)
    before = F.when(F.col(PLACE) == 0, F.col("__edge")).otherwise(F.col("__lag"))
    same = before["__key"].eqNullSafe(F.col(key)) & before.isNotNull()
    return (seen.withColumns({n: F.when(same, before[n]) for n in columns})
            .drop(SLICE, PLACE, "__lag", "__edge"))
