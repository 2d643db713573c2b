"""Feature tables (E25, E26) with their column contracts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as fx
from ..functions import constants as K
from ..operators import features as E

POLICY_FEATURE_COLUMNS = [
    "policy_id", "policy_number", "customer_id", "product_id", "channel_id", "agent_id", "latest_status",
    "is_current_policy", "issue_date", "expiry_date", "issue_year", "policy_tenure", "tenure_bucket",
    "policy_value", "policy_premium", "premium_bucket", "cost_spent", "expected_premium_value",
    "total_premium_received", "unrealised_premium_value", "total_time_in_grace", "is_graced",
    "payment_frequency", "is_unreliable_premium", "is_future_date", "is_invalid_date_range",
    "has_unrealised_value", "is_negative_unrealised", "is_loss_making_policy", "is_renewal_eligible",
    "has_lapsed_date", "is_early_defaulted", "is_lapsed_after_grace", "is_acquisition_at_risk",
]

CUSTOMER_FEATURE_COLUMNS = [
    "customer_id", "customer_name", "customer_age", "age_bucket", "customer_gender", "customer_city",
    "customer_occupation", "customer_income_bracket", "customer_latest_status", "no_of_policies",
    "expected_lifetime_value", "is_renewed_customer", "is_invalid_age",
]


def passes_through(columns: list[str]) -> bool:
    """Whether all ``columns`` of cleaned policies stand in the feature table as they are."""
    made = {name for name, _ in E.policy_feature_columns(K.FIXTURE_AS_OF)}
    return set(columns) <= set(POLICY_FEATURE_COLUMNS) - made


def build_policy_features(policies: DataFrame, payments: DataFrame, events: DataFrame, dates: DataFrame,
                          as_of: dt.date, fit_on: DataFrame | None = None) -> DataFrame:
    """Cleaned policies + two per-policy summaries, two joins on the
    policy key (the second reuses the first's partitioning).  ``fit_on`` as in
    ``payment_days``."""
    df = (policies
          .join(E.payment_summary(payments, dates, fit_on=fit_on), "policy_id", "left")
          .join(E.event_summary(events, dates), "policy_id", "left"))
    for name, expr in E.policy_feature_columns(as_of):
        df = df.withColumn(name, expr)
    return df.select(*POLICY_FEATURE_COLUMNS)


def build_customer_features(customers: DataFrame, policy_features: DataFrame, events: DataFrame) -> DataFrame:
    """Cleaned customers + event summary + policy summary (both one row
    per customer, so neither join fans out)."""
    df = (customers
          .join(E.customer_event_summary(events), "customer_id", "left")
          .join(E.customer_policy_summary(policy_features), "customer_id", "left"))
    df = df.withColumns({
        "customer_latest_status": F.coalesce(fx.initcap_trim("__last_status"), F.lit(K.NO_POLICY)),
        "no_of_policies": F.coalesce(F.col("__n_policies"), F.lit(0)).cast("long"),
        "expected_lifetime_value": F.coalesce(F.col("__ltv"), F.lit(0)).cast("decimal(32,2)"),
        "is_renewed_customer": F.coalesce(F.col("__renewed"), F.lit(False)),
        "age_bucket": fx.age_bucket(),
    })
    return df.select(*CUSTOMER_FEATURE_COLUMNS)
