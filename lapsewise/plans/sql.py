"""SQL front: the feature layers as the temp views the analysis SQL is
written against (``policies``, ``customers``, ``events``), so existing
Spark SQL KPI statements run unchanged on the layered model."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources.io import register_views
from .pipeline import Model

VIEW_NAMES = {"policies": "policy_features", "customers": "customer_features", "events": "policy_events"}


def register_model_views(model: Model, prefix: str = "") -> dict[str, DataFrame]:
    """Register ``policies``, ``customers`` and ``events`` (optionally
    prefixed) over the model's layers and return them."""
    views = {prefix + v: model[t] for v, t in VIEW_NAMES.items()}
    register_views(model.spark, views)
    return views


def run_sql(model: Model, statement: str) -> DataFrame:
    """Run one SQL statement over the model's views."""
    register_model_views(model)
    return model.spark.sql(statement)
