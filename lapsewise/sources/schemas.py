"""Explicit schemas of the raw domain tables (CSV landing zone).

Reading with a declared schema avoids the extra inference pass over the data
that ``inferSchema=True`` costs; inference stays available in ``read_raw``
for profiling unknown files.
"""

from pyspark.sql.types import (BooleanType, DateType, DecimalType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType)

MONEY = DecimalType(18, 2)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


CUSTOMERS = _s(("customer_id", StringType()), ("customer_name", StringType()), ("customer_age", IntegerType()),
               ("customer_gender", StringType()), ("customer_city", StringType()),
               ("customer_occupation", StringType()), ("customer_income_bracket", StringType()))

POLICIES = _s(("policy_id", StringType()), ("policy_number", StringType()), ("customer_id", StringType()),
              ("product_id", IntegerType()), ("channel_id", IntegerType()), ("agent_id", StringType()),
              ("policy_value", MONEY), ("policy_tenure", IntegerType()), ("policy_premium", MONEY),
              ("latest_status", StringType()), ("issue_date", DateType()), ("expiry_date", DateType()),
              ("is_current", IntegerType()), ("cost_spent", MONEY), ("total_time_in_grace", IntegerType()),
              ("issue_year", IntegerType()))

PRODUCTS = _s(("product_id", IntegerType()), ("product_name", StringType()), ("product_category", StringType()))

CHANNELS = _s(("channel_id", IntegerType()), ("channel_name", StringType()), ("channel_type", StringType()))

AGENTS = _s(("agent_id", StringType()), ("agent_name", StringType()), ("agent_city", StringType()),
            ("agent_region", StringType()), ("channel_id", IntegerType()))

DATES = _s(("date_id", IntegerType()), ("date", DateType()), ("year", IntegerType()), ("is_weekday", IntegerType()))

POLICY_EVENTS = _s(("event_id", LongType()), ("policy_id", StringType()), ("customer_id", StringType()),
                   ("product_id", IntegerType()), ("channel_id", IntegerType()), ("date_id", IntegerType()),
                   ("previous_status", StringType()), ("current_status", StringType()),
                   ("is_renewed", BooleanType()))

PREMIUM_PAYMENTS = _s(("payment_id", LongType()), ("policy_id", StringType()), ("date_id", IntegerType()),
                      ("premium_amount", MONEY), ("payment_status", StringType()), ("is_missed", IntegerType()),
                      ("is_in_grace_period", IntegerType()))

RAW = {
    "customers": CUSTOMERS, "policies": POLICIES, "products": PRODUCTS, "channels": CHANNELS,
    "agents": AGENTS, "dates": DATES, "policy_events": POLICY_EVENTS, "premium_payments": PREMIUM_PAYMENTS,
}

# The same tables as the adapter derives them: numeric policy and customer
# keys, and the payments' survivor order.
_NUMERIC_KEYS = ("customer_id", "policy_id")
_SURVIVOR_ORDER = [("l_partkey", LongType()), ("l_suppkey", LongType()), ("l_shipdate", TimestampNTZType())]
ADAPTED = {
    name: _s(*[(f.name, LongType() if f.name in _NUMERIC_KEYS else f.dataType) for f in schema.fields],
             *(_SURVIVOR_ORDER if name == "premium_payments" else []))
    for name, schema in RAW.items()
}
