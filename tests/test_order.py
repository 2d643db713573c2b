"""Descending order of the reports that sort by their measure."""

import pytest

from lapsewise.operators import kpi
from lapsewise.plans.queries import REGISTRY

from .conftest import SF001


@pytest.mark.parametrize("name, measure, tie", [
    ("channel_leakage_share", "leakage_amount", "channel_id"), ("lapse_by_product", "product_lapse_rate", "product_id"),
    ("acquisition_loss_by_channel", "acquisition_loss", "channel_name"), ("channel_comparison", "policies", "channel_name"),
    ("customer_status_distribution", "customers", "customer_latest_status"),
    ("expected_premium_by_product", "expected_premium", "product_name"),
    ("product_performance", "persistency_ratio", "product_name"), ("unrealised_by_product", "unrealised_premium", "product_name")])
def test_largest_first(spark, name, measure, tie):
    rows = [(r[measure], r[tie]) for r in REGISTRY[name](spark, SF001).collect()]
    assert rows == sorted(rows, key=lambda r: (-r[0], r[1])) and len(rows) > 1


def test_ties_and_nulls(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), (None, 1), ("z", None), ("y", 2)], "k string, m int")
    assert [tuple(r) for r in kpi.by_measure(df, "m", "k").collect()] == [("y", 2), (None, 1), ("a", 1), ("b", 1), ("z", None)]


def test_renewal_rate_counts_a_repeated_policy_once(spark):
    import datetime as dt
    day = dt.date(2000, 1, 1)
    pol = spark.createDataFrame([(1, "active", day), (1, "active", day), (2, "matured", day)], "policy_id long, latest_status string, expiry_date date")
    ev = spark.createDataFrame([(1, True), (1, True)], "policy_id long, is_renewed_event boolean")
    assert kpi.policy_renewal_rate(pol, ev, dt.date(2000, 6, 30)).first()[0] == 50.0
