"""Join helpers.  Lookups are plain joins: Spark and AQE broadcast a side by
its measured bytes, and otherwise shuffle and split skewed keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_safe_on(left_col: str, right_col: str) -> Column:
    return F.col(left_col).eqNullSafe(F.col(right_col))
