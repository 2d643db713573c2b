"""Profiling and validation operators (stages 01 and 03).

Each operator answers with a small long-form DataFrame; the many per-column
checks of one table run as a single aggregate (one scan), not one job each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType, StructType

from ..functions import columns as fx


def shape(df: DataFrame, name: str) -> DataFrame:
    """P1"""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).cast("long").alias("n_cols"))


def null_counts(df: DataFrame, name: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column, one pass."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return (wide.unpivot([], cols, "column_name", "null_count")
            .select(F.lit(name).alias("table_name"), "column_name", "null_count"))


def duplicate_count(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """P5: rows minus distinct keys, one job."""
    keys = list(keys)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(*[F.col(k) for k in keys]).alias("n_keys")).select(
        F.lit(name).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"), "n_rows", "n_keys",
        (F.col("n_rows") - F.col("n_keys")).alias("n_duplicates"))


def value_counts(df: DataFrame, col: str, sort: bool = False) -> DataFrame:
    """P6 / P6s"""
    out = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return out.orderBy(col) if sort else out


def value_counts_of(tables: dict[str, DataFrame], columns: dict[str, Sequence[str]]) -> DataFrame:
    """P6 over many columns: ``(table_name, column_name, value, n)``.  The
    columns of a table are unpivoted as text, so each table is scanned once."""
    parts = []
    for name, cols in columns.items():
        texts = tables[name].select(*[F.col(c).cast("string").alias(c) for c in cols])
        parts.append(texts.unpivot([], list(cols), "column_name", "value").groupBy("column_name", "value")
                     .agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "column_name", "value", "n"))
    return union_all(parts)


def describe(df: DataFrame, name: str, cols: Sequence[str], scale: int = 2) -> DataFrame:
    """Count, mean, stddev, min, max per numeric column, as DOUBLE, all
    columns in one aggregate.  Mean and deviation come from exact integer sums
    of the values and their squares, in units of the column's last decimal, so
    no order of merging changes them.  The mean is half-up to ``scale``
    decimals; the deviation is rounded to six.  A sum of squares above 38
    digits is an error, not a wrong number."""
    aggs, rows = [], []
    for i, c in enumerate(cols):
        x, kind = F.col(c), df.schema[c].dataType
        places = 0 if isinstance(kind, IntegralType) else kind.scale if isinstance(kind, DecimalType) else scale
        units = (x if places == 0 else x.cast(f"decimal(28,{places})") * (10**places)).cast("decimal(19,0)")
        aggs += [F.count(x).alias(f"n{i}"), F.sum(units.cast("decimal(28,0)")).alias(f"s{i}"), F.sum(units * units).alias(f"q{i}"),
                 F.min(x).cast("double").alias(f"min{i}"), F.max(x).cast("double").alias(f"max{i}")]
        n, total, squares = F.col(f"n{i}"), F.col(f"s{i}"), F.col(f"q{i}")
        rows.append(F.struct(F.lit(c).alias("column_name"), n.alias("n"),
                             fx.round_ratio(total, n * (10**places), scale).alias("mean"),
                             F.round(fx.deviation(n, total, squares) / float(10**places), 6).alias("stddev"),
                             F.col(f"min{i}").alias("min"), F.col(f"max{i}").alias("max")))
    return df.agg(*aggs).select(F.inline(F.array(*rows))).select(F.lit(name).alias("table_name"), "*")


def describe_text(df: DataFrame, name: str, cols: Sequence[str]) -> DataFrame:
    """P3 for text: count, smallest and largest value per column, all columns
    in one aggregate."""
    aggs, rows = [], []
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"n{i}"), F.min(c).alias(f"min{i}"), F.max(c).alias(f"max{i}")]
        rows.append(F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n"), F.col(f"min{i}").alias("min"),
                             F.col(f"max{i}").alias("max")))
    return df.agg(*aggs).select(F.inline(F.array(*rows))).select(F.lit(name).alias("table_name"), "*")


def violation_counts(df: DataFrame, name: str, rules: dict[str, Column]) -> DataFrame:
    """Rows breaking each rule, all rules in one pass."""
    wide = df.agg(*[fx.count_where(pred).alias(r) for r, pred in rules.items()])
    return (wide.unpivot([], list(rules), "rule_name", "n_violations")
            .select(F.lit(name).alias("table_name"), "rule_name", "n_violations"))


def flag_mismatch(df: DataFrame, name: str, flags: dict[str, Column]) -> DataFrame:
    """A flag must be set exactly where its rule holds.  ``n_missing`` =
    rule true but flag false (must be 0), ``n_spurious`` = the reverse."""
    aggs = []
    for f, pred in flags.items():
        aggs += [fx.count_where(~F.col(f) & pred).alias(f"{f}__m"), fx.count_where(F.col(f) & ~fx.flag(pred)).alias(f"{f}__s")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(f).alias("flag_name"), F.col(f"{f}__m").alias("n_missing"), F.col(f"{f}__s").alias("n_spurious"))
            for f in flags]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select(
        F.lit(name).alias("table_name"), "r.flag_name", "r.n_missing", "r.n_spurious")


def orphan_keys(child: DataFrame, parent: DataFrame, key: str, child_name: str, parent_name: str,
                parent_key: str | None = None) -> DataFrame:
    """Child rows whose key is missing in the parent (left anti join) —
    row count and distinct keys.  Rows are counted per key first, so a hot key
    enters the join as one row."""
    parent_key = parent_key or key
    counts = child.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    ghosts = counts.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")
    return ghosts.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n_orphan_rows"), F.count(key).alias("n_orphan_keys")).select(
        F.lit(child_name).alias("child_table"), F.lit(parent_name).alias("parent_table"), F.lit(key).alias("key_column"),
        "n_orphan_rows", "n_orphan_keys")


def status_pairs(events: DataFrame, predicate: Column) -> DataFrame:
    """P10: (previous, current) status pairs of the events matching a predicate."""
    return (events.filter(predicate).groupBy("previous_status", "current_status")
            .agg(F.count(F.lit(1)).alias("n_events")))


def schema_violations(df: DataFrame, name: str, contract: StructType) -> DataFrame:
    """The table's columns against a declared contract — one row per
    column with ``ok``, ``type_mismatch``, ``missing`` or ``unexpected``,
    and the column's non-null count (one aggregate over the table)."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    expected = {f.name: f.dataType.simpleString() for f in contract.fields}
    names = list(expected) + [c for c in actual if c not in expected]
    counts = df.agg(*[F.count(F.col(c)).alias(f"__n{i}") if c in actual else F.lit(None).cast("long").alias(f"__n{i}")
                      for i, c in enumerate(names)])
    rows = []
    for i, c in enumerate(names):
        e, a = expected.get(c), actual.get(c)
        status = "missing" if a is None else "unexpected" if e is None else "ok" if a == e else "type_mismatch"
        rows.append(F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
                             F.lit(e).cast("string").alias("expected_type"), F.lit(a).cast("string").alias("actual_type"),
                             F.lit(status).alias("status"), F.col(f"__n{i}").alias("n_non_null")))
    return counts.select(F.inline(F.array(*rows)))


def cast_failures(df: DataFrame, name: str, targets: dict[str, str]) -> DataFrame:
    """P2, data side: values present but not castable to the contract type
    (``try_cast`` gives null), per column, in one pass."""
    wide = df.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c)
                    for c, t in targets.items()])
    return (wide.unpivot([], list(targets), "column_name", "n_uncastable")
            .select(F.lit(name).alias("table_name"), "column_name", "n_uncastable"))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def as_report(df: DataFrame, check: str, table: str, column: Column, value: Column) -> DataFrame:
    return df.select(F.lit(check).alias("check_name"), table.alias("table_name") if isinstance(table, Column)
                     else F.lit(table).alias("table_name"), column.alias("column_name"), value.cast("long").alias("value"))
