"""Layers measured while they are written.

Row counts, nulls, flag sums and rule violations of a stage table are observed
on the write itself (``DataFrame.observe``), so validation costs no second scan.
The numbers, a few per column, are stored beside the layer as rows
``(check_name, table_name, column_name, value)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from ..functions import columns as fx
from .io import layer_path, write_layer

CHECKS = "check_name string, table_name string, column_name string, value long"


def table_checks(df: DataFrame, flags: dict[str, Column] | None = None,
                 rules: dict[str, Column] | None = None) -> dict[tuple[str, str | None], Column]:
    """The aggregates of one table, by (check, column).

    P1: ``row_count``.  P4: ``null_count`` of every column.  P7:
    ``rule_violations`` of each of ``rules``.  P8: ``flag_set`` of every boolean
    column, and for each of ``flags`` (a flag column and the rule it stands
    for) ``flag_missing``, rows where the rule holds and the flag doesn't say so.
    """
    checks: dict[tuple[str, str | None], Column] = {("row_count", None): F.count(F.lit(1))}
    checks |= {("null_count", c): F.count_if(F.col(c).isNull()) for c in df.columns}
    checks |= {("flag_set", f.name): fx.count_where(F.col(f.name)) for f in df.schema.fields if isinstance(f.dataType, BooleanType)}
    checks |= {("flag_missing", f): fx.count_where(~F.col(f) & rule) for f, rule in (flags or {}).items()}
    checks |= {("rule_violations", r): fx.count_where(rule) for r, rule in (rules or {}).items()}
    return checks


def write_measured(df: DataFrame, root: str, name: str, table: str | None = None, flags: dict[str, Column] | None = None,
                   rules: dict[str, Column] | None = None, **options) -> None:
    """``write_layer``, and the table's checks written to ``checks/<name>`` under the same root.

    ``table`` names the table in the checks' rows.  The observed node stands
    right below the write, after every shuffle, so a task that is run again
    counts once.
    """
    write_observed(df, root, name, table or name.rpartition("/")[2], table_checks(df, flags, rules), **options)


def write_observed(df: DataFrame, root: str, name: str, table: str, checks: dict[tuple[str, str | None], Column], **options) -> None:
    """``write_layer`` with aggregates observed on the way, stored as rows of ``CHECKS``."""
    spark, seen = df.sparkSession, Observation()
    columns = [c.cast("long").alias(f"m{i}") for i, c in enumerate(checks.values())]
    write_layer(df.observe(seen, *columns), root, name, **options)
    got = seen.get
    rows = [(check, table, column, got[f"m{i}"]) for i, (check, column) in enumerate(checks)]
    spark.createDataFrame(rows, CHECKS).coalesce(1).write.mode("overwrite").parquet(layer_path(root, f"checks/{name}"))


def read_checks(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    """The stored checks of some layers; a few rows per column of each."""
    return spark.read.schema(CHECKS).parquet(*[layer_path(root, f"checks/{n}") for n in names])
