"""Dashboards from one pass over each layer: the rows of the separate sheets, repeated and negative keys, and the scans of the plan."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lapsewise.operators import bi, kpi
from lapsewise.operators.sheets import N_KEYS, Sheet, sheet_rows
from lapsewise.plans.pipeline import materialize
from lapsewise.plans.queries import AS_OF, REGISTRY, _bi

from .conftest import SF001


def rows(df):
    return sorted((tuple(None if x is None else round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", ["Executive", "Retention", "Financial"])
@pytest.mark.parametrize("repeat", [1, 3])
def test_dashboard_equals_its_sheets(spark, name, repeat):
    m = materialize(spark, SF001, AS_OF)
    times = lambda df: df.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.lit(repeat)))).drop("__copy")
    policies, customers, extract = times(m.policies), times(m.customers), times(_bi(m))
    want = bi.dashboard_rows(bi.dashboard_tables(name, extract, policies, customers, m.events, AS_OF), name)
    assert rows(bi.dashboard(name, extract, customers, m.events, AS_OF)) == rows(want)


@pytest.mark.parametrize("name", ["executive", "retention", "financial"])
def test_each_layer_is_read_once(spark, name):
    leaves = REGISTRY[f"dashboard_{name}"](spark, SF001)._jdf.queryExecution().optimizedPlan().collectLeaves()
    read = [leaves.apply(i).relation().location().rootPaths().toString() for i in range(leaves.size())]
    for layer in ("features/policies", "features/customers", "clean/policy_events"):
        assert sum(layer in x for x in read) == (0 if layer != "features/policies" and name == "financial" or layer == "clean/policy_events" and name != "executive" else 1)


def test_distinct_keys_repeated_negative_null(spark):
    df = spark.createDataFrame([("a", -5, 1), ("a", -5, 1), ("a", 0, 2), ("b", -5, 3), (None, 7, 4), ("a", None, 5)], "g string, k long, v int")
    sheets = [Sheet("by", ((None, "keys", F.col(N_KEYS)), (None, "v", F.col("v"))), "g", per_key=True),
              Sheet("sum", ((None, "v", F.col("v")),), "g"), Sheet("all", (("total", "v", F.col("v")),)),
              Sheet("keys", (("distinct", "value", F.col(N_KEYS)), ("odd", "value", F.col("odd"))), per_key=True)]
    got = {(r["sheet"], r["label"], r["measure"]): r["value"] for r in sheet_rows(df, "d", sheets, "k", {"v": F.sum("v")}, {"odd": F.max(F.abs("k") % 2)}).collect()}
    assert got == {("by", "a", "keys"): 2, ("by", "b", "keys"): 1, ("by", None, "keys"): 1, ("by", "a", "v"): 9, ("by", "b", "v"): 3, ("by", None, "v"): 4,
                   ("sum", "a", "v"): 9, ("sum", "b", "v"): 3, ("sum", None, "v"): 4, ("all", "total", "v"): 16,
                   ("keys", "distinct", "value"): 3, ("keys", "odd", "value"): 2}


def test_top_segments_keep_ties(spark):
    df = spark.createDataFrame([(1, 5), (2, 9), (3, 9), (4, 7)], "channel_id int, n long")
    assert [r["channel_id"] for r in kpi.top_segments(df, "n", 1, "channel_id").collect()] == [2, 3]
    assert [r["channel_id"] for r in kpi.top_segments(df, "n", 3, "channel_id").collect()] == [2, 3, 4]


def test_unknown_dashboard(spark):
    with pytest.raises(ValueError):
        bi.dashboard("Other", None, None, None, dt.date(2000, 1, 1))
