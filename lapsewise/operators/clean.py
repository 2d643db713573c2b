"""Cleaning operators (stage 02).  Pure DataFrame → DataFrame functions with
column names as arguments; the insurance names live in ``plans.cleaning``."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as fx
from ..functions.columns import flag as _flag
from ..functions.columns import initcap_trim
from . import packed
from .joins import null_safe_on
from .ordered import heavy_keys, partitions
from .ordered import landed as _landed

# Values of a group that one task orders at most; steps of a group's sketch, whose rank error is 1 / SKETCH_ACCURACY.
FINISH_VALUES, GRID, SKETCH_ACCURACY = 100_000, 1_000, 10_000


def standardise_text(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """``initcap(trim(c))``; initcap splits on spaces only."""
    return df.withColumns({c: initcap_trim(c) for c in cols})


def _fill_from_groups(df: DataFrame, col: str, by: str, groups: DataFrame, fallback: Column | None = None) -> DataFrame:
    """Join a one-row-per-group fill value back (null group keys match each
    other, as in a window partition) and coalesce it into ``col``."""
    groups = groups.withColumnRenamed(by, "__by")
    joined = df.join(groups, null_safe_on(by, "__by"), "left")
    dtype = df.schema[col].dataType
    parts = [F.col(col), F.col("__fill")] + ([fallback] if fallback is not None else [])
    return joined.withColumn(col, F.coalesce(*parts).cast(dtype)).drop("__by", "__fill")


def group_median(df: DataFrame, col: str, by: str, finish: int = FINISH_VALUES) -> DataFrame:
    """``(by, __fill)``, the value of rank ceil(n / 2) among the
    non-null values of each group — exact at every size, for numbers and dates.

    Each group's median is first known to lie in an open interval, at the start
    without ends.  A round is one pass, combined map-side: per group it counts
    the values below, at the ends of and inside the interval, and sketches the
    inside at ``GRID`` steps.  Either an end is the median, or the two grid
    values around its rank, less the sketch's error, are the next interval,
    which holds at most about three steps' worth of the values inside.  When
    every open group has ``finish`` values inside or fewer, those alone are
    counted and ordered, so no task holds more values of a group, whatever its
    size.  Rounds: one, and one more per factor of ``GRID`` / 3 in the largest
    group above ``finish``.
    """
    known = df.select(F.col(by).alias("__by"), F.col(col).alias("__v")).where(F.col(col).isNotNull())
    state, settled = _landed(_sketched(known, None)), []
    while state.where(F.col("__fill").isNull() & (F.col("__inside") > finish)).take(1):
        settled.append(state.where("__fill IS NOT NULL").select("__by", "__fill"))
        # a group that is ready keeps its interval in the rounds that only others need
        keep = (F.col("__inside") <= finish) & F.col("__lo").isNotNull()
        state = _landed(_sketched(known, state.where("__fill IS NULL").select(
            F.col("__by").alias("__of"), "__rank", F.when(keep, F.col("__lo")).otherwise(F.col("__next_lo")).alias("__lo"),
            F.when(keep, F.col("__hi")).otherwise(F.col("__next_hi")).alias("__hi"))))
    settled.append(state.where("__fill IS NOT NULL").select("__by", "__fill"))
    last = state.where("__fill IS NULL").select(F.col("__by").alias("__of"), "__left", "__lo", "__hi")
    lo, hi, v = F.col("__lo"), F.col("__hi"), F.col("__v")
    left = known.join(last, null_safe_on("__by", "__of")).where((lo.isNull() | (v > lo)) & (hi.isNull() | (v < hi))) \
        .groupBy("__by", "__left", "__v").agg(F.count(F.lit(1)).alias("__c"))
    upto = F.sum("__c").over(Window.partitionBy("__by").orderBy("__v"))
    out = left.withColumn("__upto", upto).where(F.col("__upto") >= F.col("__left")).groupBy("__by").agg(F.min("__v").alias("__fill"))
    for part in settled:
        out = out.union(part)
    return out.withColumnRenamed("__by", by)


def _sketched(known: DataFrame, bounds: DataFrame | None) -> DataFrame:
    """A round of ``group_median``: one row per group with its counts, the
    median where an end is it (``__fill``), and the next interval."""
    v, lo, hi = F.col("__v"), F.col("__lo"), F.col("__hi")
    if bounds is None:
        null = F.lit(None).cast(known.schema["__v"].dataType.simpleString())
        seen = known.select("*", null.alias("__lo"), null.alias("__hi"), F.lit(None).cast("long").alias("__rank"))
        inside = F.lit(True)
    else:
        seen = known.join(bounds, null_safe_on("__by", "__of"))
        inside = (v > lo) & (v < hi)
    # an interval without ends has nothing outside: its comparisons are null
    got = seen.groupBy("__by", "__lo", "__hi", "__rank").agg(
        F.count_if(v <= lo).alias("__low"), F.count_if(inside).alias("__inside"),
        F.percentile_approx(F.when(inside, v), [i / GRID for i in range(GRID + 1)], SKETCH_ACCURACY).alias("__grid"))
    rank = F.coalesce(F.col("__rank"), fx.idiv(F.col("__inside") + 1, F.lit(2)))
    left = rank - F.col("__low")
    fill = F.when(left <= 0, lo).when(left > F.col("__inside"), hi)
    # the grid step of the rank, and one step to either side for the sketch's error
    step = F.floor((left - 1).cast("double") * GRID / F.greatest(F.col("__inside"), F.lit(1))).cast("int")
    edge = lambda i: F.element_at("__grid", F.least(F.greatest(i, F.lit(0)), F.lit(GRID)) + 1)
    return got.select("__by", rank.alias("__rank"), left.alias("__left"), "__inside", "__lo", "__hi", fill.alias("__fill"),
                      F.when(fill.isNull(), edge(step - 1)).alias("__next_lo"), F.when(fill.isNull(), edge(step + 2)).alias("__next_hi"))


def impute_group_median(df: DataFrame, col: str, by: str, global_fallback: bool = False) -> DataFrame:
    """Fill nulls of ``col`` with the median of its ``by`` group, and with
    the whole table's where a group has none and ``global_fallback`` is set.
    The medians are landed, so that their size is known before the join: few
    groups are broadcast and the rows are not dealt by the group, which may be
    one of three."""
    filled = _fill_from_groups(df, col, by, _landed(group_median(df, col, by)))
    if global_fallback:
        whole = filled.withColumn("__all", F.lit(0))
        filled = _fill_from_groups(whole, col, "__all", group_median(df.withColumn("__all", F.lit(0)), col, "__all")).drop("__all")
    return filled


def group_mode(df: DataFrame, col: str, by: str) -> DataFrame:
    """``(by, __fill)``, the most frequent non-null value of each
    group (ties → lowest): counts per (group, value), then one ``min_by``."""
    counts = df.where(F.col(col).isNotNull()).groupBy(by, col).agg(F.count(F.lit(1)).alias("__n"))
    return counts.groupBy(by).agg(F.min_by(col, F.struct(-F.col("__n"), F.col(col))).alias("__fill"))


def impute_group_mode(df: DataFrame, col: str, by: str, default=None) -> DataFrame:
    """Fill nulls with the most frequent value of the group (ties → lowest
    value), then with ``default``."""
    return _fill_from_groups(df, col, by, group_mode(df, col, by), None if default is None else F.lit(default))


def impute_const(df: DataFrame, values: dict) -> DataFrame:
    """C4: constant fill per column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in values.items()})


def impute_case(df: DataFrame, col: str, key: str, cases: Sequence[tuple], default) -> DataFrame:
    """Fill nulls of ``col`` by a rule on another column."""
    rule = None
    for k, v in cases:
        rule = F.when(F.col(key) == k, F.lit(v)) if rule is None else rule.when(F.col(key) == k, F.lit(v))
    rule = rule.otherwise(F.lit(default))
    return df.withColumn(col, F.coalesce(F.col(col), rule))


def add_flags(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rule flag columns; an unknown outcome is False."""
    return df.withColumns({name: _flag(pred) for name, pred in rules.items()})


def cast_flags(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """0/1 integers to booleans."""
    return df.withColumns({c: F.col(c).cast("boolean") for c in cols})


def drop_orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None, heavy: list | None = None) -> DataFrame:
    """Keep child rows whose key exists in the parent (left semi join).

    Keys that hold more than a partition's share of the child's rows are dealt
    over all partitions by a salt, and stand with every salt on the key side, a
    few rows each; the join is the same one shuffle for all rows, and no key is
    one task, whatever the session's skew handling does.  Which keys the sketch
    names changes the layout alone, never the rows; ``heavy`` names them where
    ``child`` is costly to make.  The salt is a hash of the row, so that a task
    run again deals alike; rows equal in all columns share it.
    """
    keys = parent.select(F.col(parent_key or key).alias("__key"))
    n = partitions(child)
    heavy = heavy_keys(child, key, n) if heavy is None else heavy
    if not heavy:
        return child.join(keys.withColumnRenamed("__key", key), key, "left_semi")
    salts = F.when(F.col("__key").isin(heavy), F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0)))
    spread = F.when(F.col(key).isin(heavy), F.pmod(F.xxhash64(*child.columns), F.lit(n)).cast("int")).otherwise(F.lit(0))
    salted = child.withColumn("__salt", F.coalesce(spread, F.lit(0)))
    keys = keys.select("__key", F.explode(salts).alias("__of"))
    return salted.join(keys, (F.col(key) == F.col("__key")) & (F.col("__salt") == F.col("__of")), "left_semi").drop("__salt")


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key, the one smallest in ``order`` and then in all its
    other columns, so the survivor never depends on the input's layout.

    Chosen as the smallest struct of the row, which holds every column once —
    partial aggregation, so a key holding a large share of the rows is combined
    map-side instead of landing in one task.  Packed rows (``packed``) bring
    nothing here: nearly every key is a row of its own, and on 7 million
    payments a long took as long as the struct, a wider decimal twice that.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    ranked = [*order, *[c for c in rest if c not in order]]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("__row"))
    return picked.select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])


def packed_rest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` as its ``keys`` and two longs, the columns of ``order`` and all
    others, and what reads such rows back: fewer bytes to shuffle.  The longs sort
    as the columns do.  Where the columns fit no long (``packed.fit``), ``df`` as it
    is, ``order`` first after the keys."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    columns = df.columns
    packings = {name: packed.fit(df, cols) for name, cols in (("__order", order), ("__rest", rest)) if cols}
    if not all(packings.values()):
        return df.select(*keys, *order, *rest), lambda rows: rows.select(*columns)
    values = {c: v for name, p in packings.items() for c, v in p.unpack(F.col(name)).items()}
    return (df.select(*keys, *[p.pack().alias(name) for name, p in packings.items()]),
            lambda rows: rows.select(*[F.col(c) if c in keys else values[c].alias(c) for c in columns]))


def newest(df: DataFrame, value: str, order: Sequence[str], fit_on: DataFrame | None = None) -> tuple[Column, Column]:
    """W1 for use in ``agg``: an aggregate column, and what reads the newest
    row's ``value`` from a column of its name ``__newest``.  Newest by
    ``order``, ties to the largest value.  Packed, a hash aggregate; else the
    largest struct.  The columns' ranges are read first, from ``fit_on`` if given:
    the rows of ``df`` and maybe more, where ``df`` itself is costly to make.
    """
    packing = packed.fit(df if fit_on is None else fit_on, [*order, value])
    if packing:
        return F.max(packing.pack()).alias("__newest"), packing.unpack(F.col("__newest"))[value]
    return F.max(F.struct(*order, value)).alias("__newest"), F.col("__newest")[value]


def latest_by(df: DataFrame, key: str, value: str, order: Sequence[str], alias: str | None = None,
              fit_on: DataFrame | None = None) -> DataFrame:
    """Value of the newest row per key (ties broken by the later
    order columns, then by the value) — one hash aggregate, no sort, no window."""
    found, read = newest(df, value, order, fit_on)
    return df.groupBy(key).agg(found).select(key, read.alias(alias or value))


def refresh_status(policies: DataFrame, latest: DataFrame, status_col: str, new_col: str, key: str,
                   default: str, keep_original: bool = False) -> DataFrame:
    """C11: overwrite the status with the newest event's status.  A policy
    without events gets null, then ``default``; ``keep_original`` keeps its
    old status instead."""
    joined = policies.join(latest, key, "left")
    base = [F.col(new_col)] + ([F.col(status_col)] if keep_original else []) + [F.lit(default)]
    return joined.withColumn(status_col, F.coalesce(*base)).drop(new_col)
