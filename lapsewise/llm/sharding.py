"""Operator 11: documents cut into shards along a Hilbert curve over their metadata, with DataFrame functions only.

Each metadata column is quantised to equal-depth cells; a row's cell numbers
give its place on a Hilbert curve, so rows that are near in all columns lie
near in the order.  The rows are range-sorted by that place, written, and the
order is cut into runs of equal row counts.  A file then holds a small box of
the metadata space, and the files' min/max statistics prune in every column.

Layout: ``data/__slice=<n>``, the sorted rows in files; ``runs``, which places
of which slices form a shard; ``schema``, an empty table with the columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import ordered
from ..session import shared_dir
from .common import materialise

#: Bits of a cell number in one dimension; characters of a text column that are compared.
BITS, PREFIX = 5, 64


def _states(dims: int) -> tuple[list[tuple[int, int]], list[list[tuple[int, int]]]]:
    """The curve's orientations (entry corner, direction), and for each what a cell's corner label gives: its number, the orientation inside it.

    The orientation changes by the entry and direction of the sub-cube, which follow from the Gray code of its number.
    """
    side = (1 << dims) - 1

    def left(x, by):
        return ((x << by % dims) | (x >> (dims - by % dims))) & side

    def gray(i):
        return i ^ (i >> 1)

    def corner(w):  # entry of sub-cube w
        return 0 if w == 0 else gray((w - 1) & ~1)

    def axis(w):  # direction inside sub-cube w: trailing ones of w, or of the number before an even one
        x = w if w % 2 else max(w - 1, 0)
        return ((x ^ (x + 1)).bit_length() - 1) % dims

    number = {gray(w): w for w in range(side + 1)}
    states, steps = [(0, 0)], []
    for entry, turn in states:  # grows as it goes
        row = []
        for label in range(side + 1):
            w = number[left(label ^ entry, dims - (turn + 1) % dims)]
            after = (entry ^ left(corner(w), turn + 1), (turn + axis(w) + 1) % dims)
            if after not in states:
                states.append(after)
            row.append((w, states.index(after)))
        steps.append(row)
    return states, steps


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """Place on the Hilbert curve of a point given by ``bits``-bit cell numbers, one per dimension (at least two).

    One fold over the bit levels through a table of the curve's orientations.
    """
    dims = len(cells)
    _, steps = _states(dims)
    table = F.array(*[F.lit(w << 16 | s) for row in steps for w, s in row])
    points = F.array(*[c.cast("long") for c in cells])

    def step(acc, level):
        label = F.aggregate(points, F.lit(0).cast("long"), lambda a, x: a * 2 + F.call_function("shiftright", x, level).bitwiseAND(F.lit(1).cast("long")))
        got = F.element_at(table, (acc["state"] * (1 << dims) + label + 1).cast("int"))
        return F.struct((acc["place"] * (1 << dims) + F.shiftright(got, 16)).alias("place"), got.bitwiseAND(F.lit(0xFFFF)).cast("long").alias("state"))

    start = F.struct(F.lit(0).cast("long").alias("place"), F.lit(0).cast("long").alias("state"))
    return F.aggregate(F.array(*[F.lit(b) for b in reversed(range(bits))]), start, step)["place"]


def _key(df: DataFrame, column: str) -> Column:
    return F.left(F.col(column), F.lit(PREFIX)) if dict(df.dtypes)[column] == "string" else F.col(column)


def equal_depth_cuts(df: DataFrame, column: str, cells: int) -> list[tuple[object, int]]:
    """``(least value, cell)`` of every cell from 1 to ``cells`` that some value falls in; at most ``cells`` rows reach the driver.

    A value's cell is 1 + its number of smaller known values * ``cells`` // number of known values.
    """
    counts = materialise(df.select(_key(df, column).alias("v")).where("v is not null").groupBy("v").agg(F.count("*").alias("n")), "counts")
    below = ordered.running(counts, ["v"], "n", "below")
    total = below.agg(F.sum("n")).first()[0]
    if not total:
        return []
    cell = (F.lit(1) + F.expr(f"CAST(below * {cells}D / {total} AS BIGINT)")) if total * cells >= 1 << 63 else F.expr(f"1 + below * {cells} div {total}")
    return sorted((r["v"], int(r["c"])) for r in below.select("v", cell.alias("c")).groupBy("c").agg(F.min("v").alias("v")).collect())


def cell_of(df: DataFrame, column: str, cuts: list[tuple[object, int]]) -> Column:
    """The value's cell by the cuts; a null is in cell 0."""
    if not cuts:
        return F.lit(0)
    least = F.array(*[F.struct(F.lit(v).cast(df.select(_key(df, column)).dtypes[0][1]).alias("v"), F.lit(c).alias("c")) for v, c in cuts])
    value = _key(df, column)
    return F.coalesce(F.when(value.isNull(), F.lit(0)).otherwise(
        F.array_max(F.transform(F.filter(least, lambda x: x["v"] <= value), lambda x: x["c"]))), F.lit(0))


def write_shards(docs: DataFrame, path: str, dimensions: list[str], shards: int, tie: list[str], bits: int = BITS) -> None:
    """Write all rows and columns of ``docs`` to ``path`` in curve order, cut into ``shards`` runs whose row counts differ by one at most.

    ``dimensions``: two or more metadata columns; a null is a cell of its own.
    Rows of one place are in the order of the ``tie`` columns (nulls first; take
    short ones, for range bounds are sampled from them on the driver), and
    beyond that as they are read: equal rows may lie in several shards.
    No rows give empty shards.  Helper columns start with ``__``; columns of
    ``docs`` must not be named like them (``__slice``, ``__place``, ``__curve``,
    ``__tie``); ``shard`` and ``slot`` of ``docs`` are replaced on reading.
    """
    spark = docs.sparkSession
    cells = [cell_of(docs, c, equal_depth_cuts(docs, c, (1 << bits) - 1)) for c in dimensions]
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), shards)
    order = [F.col("__curve"), *[F.col(c).asc_nulls_first() for c in tie], F.col(ordered.TIE)]
    placed = (docs.withColumn("__curve", hilbert_index(cells, bits)).withColumn(ordered.TIE, F.monotonically_increasing_id())
              .repartitionByRange(n, *order).sortWithinPartitions(*order).drop(ordered.TIE)
              .withColumn(ordered.SLICE, F.spark_partition_id())
              .withColumn(ordered.PLACE, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    placed.write.partitionBy(ordered.SLICE).parquet(f"{path}/data")
    placed.limit(0).coalesce(1).write.parquet(f"{path}/schema")
    data = _data(spark, path)
    # a row per slice, and at most shards - 1 more where a slice is cut
    per = data.groupBy(ordered.SLICE).agg(F.count("*").alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(Window.orderBy(ordered.SLICE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) \
        .withColumn("total", F.sum("n").over(Window.partitionBy()))
    shard_of = f"CAST(CAST({{}} AS DECIMAL(38,0)) * {shards} div total AS INT)"
    spans = per.withColumn("shard", F.expr(f"explode(sequence({shard_of.format('before')}, {shard_of.format('(before + n - 1)')}))"))
    first = F.expr(f"CAST((CAST(total AS DECIMAL(38,0)) * shard + {shards - 1}) div {shards} AS BIGINT)")
    following = F.expr(f"CAST((CAST(total AS DECIMAL(38,0)) * (shard + 1) + {shards - 1}) div {shards} AS BIGINT)")
    runs = spans.withColumn("start", first).select(
        "shard", ordered.SLICE, F.greatest("before", "start").alias("__from"), F.col("before"),
        F.least(F.col("before") + F.col("n"), following).alias("__to"), "start")
    runs.select("shard", ordered.SLICE, (F.col("__from") - F.col("before")).alias("first_place"),
                (F.col("__to") - F.col("before")).alias("end_place"), (F.col("before") - F.col("start")).alias("slot_shift")) \
        .coalesce(1).write.parquet(f"{path}/runs")


def _data(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/schema").schema).parquet(f"{path}/data")


def read_shards(spark: SparkSession, path: str, shard: int | None = None) -> DataFrame:
    """All rows of a written folder, or one shard's, with ``shard`` and ``slot`` (from 0 in each shard, in curve order).

    One shard reads the slices of its run alone.
    """
    runs = spark.read.parquet(f"{path}/runs")
    data = _data(spark, path)
    if shard is not None:
        runs = runs.where(F.col("shard") == shard)
        wanted = [r[0] for r in runs.select(ordered.SLICE).collect()]  # a number per slice of the shard
        data = data.where(F.col(ordered.SLICE).isin(wanted) if wanted else F.lit(False))
    # runs has a row per slice and shard edge: Spark broadcasts it by its measured size
    inside = (F.col(ordered.PLACE) >= F.col("first_place")) & (F.col(ordered.PLACE) < F.col("end_place"))
    runs = runs.withColumnRenamed("shard", "__shard")
    joined = data.join(runs, ordered.SLICE).where(inside)
    return joined.select(*[c for c in data.columns if c.lower() not in (ordered.SLICE, ordered.PLACE, "shard", "slot")],
                         F.col("__shard").alias("shard"), (F.col(ordered.PLACE) + F.col("slot_shift")).cast("long").alias("slot"))


def shard_documents(docs: DataFrame, dimensions: list[str], shards: int, tie: list[str], bits: int = BITS) -> DataFrame:
    """Write ``docs`` to a fresh folder of the shared folder and read all shards back."""
    path = f"{shared_dir(docs.sparkSession)}/lapsewise-llm/shards-{uuid.uuid4().hex}"
    write_shards(docs, path, dimensions, shards, tie, bits)
    return read_shards(docs.sparkSession, path)
