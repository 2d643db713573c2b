"""Dashboard sheets of one table as one aggregate: GROUPING SETS over one scan.

All sheets that read a table are grouped in one expand; ``grouping_id`` tells
the sets apart.  Distinct counts are exact: their sets hold the key, which a
second, small aggregate counts, so rows are combined before they are shuffled
and no set pays for another's distinct key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Sheet:
    """One sheet: ``cells`` are (label, measure, value) over the table's sums; a null label stands for the group's."""

    name: str
    cells: tuple[tuple[str | None, str, Column], ...]
    by: str | None = None
    per_key: bool = False

    def columns(self, key: str) -> tuple[str, ...]:
        return (*([self.by] if self.by else []), *([key] if self.per_key else []))


#: Number of distinct keys of a group, for the cells of ``per_key`` sheets.
N_KEYS = "__n_keys"


def sheet_rows(df: DataFrame, dashboard: str, sheets: Sequence[Sheet], key: str, sums: dict[str, Column],
               per_key: dict[str, Column] | None = None) -> DataFrame:
    """``(dashboard, sheet, label, measure, value)`` of all ``sheets`` over ``df``, read once.

    ``sums``: aggregates that add up (counts, sums), by the names the cells use.
    ``per_key``: aggregates that hold once per key however often its rows repeat
    (a maximum of 0 and 1), added up over the keys of ``per_key`` sheets.  No
    rows give no sheets.
    """
    per_key = per_key or {}
    columns = sorted({c for s in sheets for c in s.columns(key)})
    sets = list(dict.fromkeys(s.columns(key) for s in sheets))
    if not columns:  # grouping sets want a column
        df, columns = df.withColumn("__all", F.lit(0)), ["__all"]

    def number(one: tuple[str, ...]) -> int:
        return sum(1 << i for i, c in enumerate(reversed(columns)) if c not in one)

    first = df.groupingSets([list(s) for s in sets], *columns).agg(
        F.grouping_id().cast("long").alias("__set"), *[c.alias(n) for n, c in {**sums, **per_key}.items()])
    label = F.lit(None).cast("string")
    for s in sets:
        of = [c for c in s if c != key]
        if of:
            label = F.when(F.col("__set") == number(s), F.col(of[0]).cast("string")).otherwise(label)
    keys = F.count(F.col(key)) if key in columns else F.lit(0)
    second = first.groupBy("__set", label.alias("__label")).agg(keys.alias(N_KEYS), *[F.sum(n).alias(n) for n in {**sums, **per_key}])
    cells = None
    for s in sets:
        rows = F.array(*[F.struct(F.lit(x.name).alias("sheet"), (F.col("__label") if name is None else F.lit(name)).alias("label"),
                                  F.lit(measure).alias("measure"), value.cast("double").alias("value"))
                         for x in sheets if x.columns(key) == s for name, measure, value in x.cells])
        cells = F.when(F.col("__set") == number(s), rows) if cells is None else cells.when(F.col("__set") == number(s), rows)
    return second.select(F.inline(cells)).select(F.lit(dashboard).alias("dashboard"), "*")
