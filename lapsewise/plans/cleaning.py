"""Table-level cleaners (C13): compositions of the cleaning operators in the
order dimensions → events → policy status refresh → payments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.columns import date_lit
from ..operators import clean as C
from ..operators.ordered import heavy_keys, partitions

CUSTOMER_COLUMNS = ["customer_id", "customer_name", "customer_age", "customer_gender", "customer_city",
                    "customer_occupation", "customer_income_bracket", "is_invalid_age"]


def clean_customers(customers: DataFrame, global_age_fallback: bool = False) -> DataFrame:
    df = C.standardise_text(customers, ["customer_name", "customer_city"])
    # median age of the (raw) occupation group; the null occupation is a group
    df = C.impute_group_median(df, "customer_age", "customer_occupation", global_fallback=global_age_fallback)
    df = C.impute_const(df, {"customer_occupation": K.UNKNOWN_OCCUPATION})
    df = C.impute_group_mode(df, "customer_income_bracket", "customer_occupation", K.DEFAULT_INCOME_BRACKET)
    age = F.col("customer_age")
    df = C.add_flags(df, {"is_invalid_age": (age < K.MIN_VALID_AGE) | (age > K.MAX_VALID_AGE)})
    return df.select(*CUSTOMER_COLUMNS)


def clean_agents(agents: DataFrame) -> DataFrame:
    df = C.standardise_text(agents, ["agent_name", "agent_region", "agent_city"])
    return C.impute_const(df, {"channel_id": K.DEFAULT_AGENT_CHANNEL})


def clean_dates(dates: DataFrame) -> DataFrame:
    return C.cast_flags(dates, ["is_weekday"])


def policy_rules(as_of: dt.date, low_premium: float = K.UNRELIABLE_PREMIUM_BELOW) -> dict:
    p = F.col
    return {
        "is_loss_making_policy": p("cost_spent") > p("policy_value"),
        "is_unreliable_premium": p("policy_premium") < low_premium,
        "is_future_date": p("issue_date") > date_lit(as_of),
        "is_invalid_date_range": p("issue_date") > p("expiry_date"),
    }


def flag_rules(as_of: dt.date) -> dict[str, dict]:
    """The flag columns of the cleaned tables and the rules they stand for."""
    return {
        "policies": policy_rules(as_of),
        "customers": {"is_invalid_age": (F.col("customer_age") < K.MIN_VALID_AGE) | (F.col("customer_age") > K.MAX_VALID_AGE)},
        "policy_events": {"is_first_event": F.col("previous_status").isNull()},
        "premium_payments": {"is_invalid_amount": F.col("premium_amount") < 0},
    }


def clean_rules() -> dict[str, dict]:
    """Rules checked after cleaning that have no flag column: the agents of
    policies, as the validation writes them and as the exploration means them."""
    agent, own = F.col("agent_id"), F.col("channel_id") == K.DEFAULT_AGENT_CHANNEL
    return {"policies": {"agent_channel_without_agent": own & agent.isNull(),
                         "other_channel_without_agent": ~own & agent.isNull(),
                         "agent_on_other_channel": ~own & agent.isNotNull()}}


def clean_policies_base(policies: DataFrame, as_of: dt.date) -> DataFrame:
    """Policies cleaned up to (not including) the status refresh."""
    df = C.impute_case(policies, "agent_id", "channel_id", K.AGENT_BY_CHANNEL, K.UNKNOWN_AGENT)
    df = C.impute_group_median(df, "cost_spent", "channel_id")
    df = C.add_flags(df, policy_rules(as_of))
    df = df.withColumnRenamed("is_current", "is_current_policy")
    return C.cast_flags(df, ["is_current_policy"])


def clean_events(events: DataFrame, policies: DataFrame) -> DataFrame:
    df = C.add_flags(events, {"is_first_event": F.col("previous_status").isNull()})
    df, read = C.packed_rest(df, ["event_id", "policy_id"], ["date_id"])
    df = C.drop_orphans(df, policies, "policy_id")
    df = read(C.dedupe(df, ["event_id"], order=[df.columns[2], "policy_id"]))
    return df.withColumnRenamed("is_renewed", "is_renewed_event")


def latest_policy_status(events: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """Newest event status per policy (date, then event id breaks ties)."""
    return C.latest_by(events, "policy_id", "current_status", ["date_id", "event_id"], "__new_status", fit_on)


def refresh_policy_status(policies: DataFrame, events: DataFrame, keep_original: bool = False, fit_on: DataFrame | None = None) -> DataFrame:
    return C.refresh_status(policies, latest_policy_status(events, fit_on), "latest_status", "__new_status", "policy_id",
                            K.UNKNOWN_STATUS, keep_original)


PAYMENT_KEY = ["payment_id", "policy_id", "date_id"]
PAYMENT_ORDER = ["l_partkey", "l_suppkey", "l_shipdate"]


def clean_payments(payments: DataFrame, policies: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Orphans dropped and one row per key kept; the policy is part of the key,
    so the order of the two changes no result.  Where no policy holds more than
    a partition's share of the payments, the orphan join comes first and its
    exchange on the policy serves the de-duplication too; what isn't key crosses
    it as two longs where it fits them.  Else the key is made
    unique first: its exchange spreads a policy with many payments and combines
    a repeated one map-side.  Heavy policies are looked for in the payments as
    read, which shuffles nothing."""
    order = PAYMENT_ORDER if order is None else order
    heavy = heavy_keys(payments, "policy_id", partitions(payments))
    df = C.cast_flags(payments, ["is_missed", "is_in_grace_period"])
    df = df.withColumnRenamed("is_missed", "is_missed_premium")
    if heavy:
        df = C.dedupe(df, PAYMENT_KEY, order=[c for c in order if c in df.columns])
    else:
        df, read = C.packed_rest(df, PAYMENT_KEY, [c for c in order if c in df.columns])
        df = C.drop_orphans(df, policies, "policy_id", heavy=heavy)
        df = read(C.dedupe(df, PAYMENT_KEY, order=[c for c in df.columns if c not in PAYMENT_KEY]))
    df = df.drop(*[c for c in PAYMENT_ORDER if c in df.columns])
    df = C.add_flags(df, {"is_invalid_amount": F.col("premium_amount") < 0})
    return C.drop_orphans(df, policies, "policy_id", heavy=heavy) if heavy else df


def clean_all(raw: dict[str, DataFrame], as_of: dt.date) -> dict[str, DataFrame]:
    """All eight cleaned tables (lazy)."""
    base = clean_policies_base(raw["policies"], as_of)
    events = clean_events(raw["policy_events"], base)
    policies = refresh_policy_status(base, events, fit_on=raw["policy_events"])
    return {
        "customers": clean_customers(raw["customers"]),
        "agents": clean_agents(raw["agents"]),
        "channels": raw["channels"],
        "products": raw["products"],
        "dates": clean_dates(raw["dates"]),
        "policies": policies,
        "policy_events": events,
        "premium_payments": clean_payments(raw["premium_payments"], base),
    }
