"""SQL over the model's views: one small statement per SQL feature, on
hand-made rows whose answers are worked out by hand."""

import datetime as dt

import pytest

from lapsewise.plans.pipeline import Model
from lapsewise.plans.sql import run_sql


@pytest.fixture(scope="module")
def model(spark):
    policies = spark.createDataFrame([(1, 10, "red", 5.0), (2, 10, "blue", 7.0), (3, 11, "red", 1.0), (4, 12, "green", 2.0)],
                                     "policy_id long, customer_id long, latest_status string, cost_spent double")
    customers = spark.createDataFrame([(10, "old"), (11, "young"), (13, "young")], "customer_id long, age_bucket string")
    events = spark.createDataFrame([(1, True), (1, True), (2, False), (9, True)], "policy_id long, is_renewed_event boolean")
    return Model(spark, {"policy_features": policies, "customer_features": customers, "policy_events": events}, dt.date(2000, 1, 1))


def rows(model, statement):
    return [tuple(r) for r in run_sql(model, statement).collect()]


def test_double_equals(model):
    assert rows(model, "SELECT policy_id FROM policies WHERE latest_status == 'red' ORDER BY policy_id") == [(1,), (3,)]


def test_conditional_sum(model):
    assert rows(model, "SELECT sum(CASE WHEN latest_status = 'red' THEN cost_spent ELSE 0 END) FROM policies") == [(6.0,)]


def test_group_and_order_by_ordinal(model):
    assert rows(model, "SELECT latest_status, sum(cost_spent) FROM policies GROUP BY 1 ORDER BY 2 DESC") == [
        ("blue", 7.0), ("red", 6.0), ("green", 2.0)]


def test_left_join_with_a_condition_keeps_unmatched_rows(model):
    assert rows(model, "SELECT p.policy_id, count(e.policy_id) FROM policies p LEFT JOIN events e "
                       "ON e.policy_id = p.policy_id AND e.is_renewed_event GROUP BY p.policy_id ORDER BY 1") == [(1, 2), (2, 0), (3, 0), (4, 0)]


def test_inner_join_drops_customers_without_policies(model):
    assert rows(model, "SELECT age_bucket, count(*) FROM customers JOIN policies USING (customer_id) GROUP BY age_bucket ORDER BY 1") == [
        ("old", 2), ("young", 1)]


def test_division_by_zero_is_null(model):
    assert rows(model, "SELECT try_divide(count(*), 0) FROM events") == [(None,)]


def test_scalar_subquery(model):
    assert rows(model, "SELECT count(*) / (SELECT count(*) FROM policies) FROM policies WHERE latest_status = 'green'") == [(0.25,)]
