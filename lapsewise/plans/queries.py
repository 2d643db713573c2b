"""Registered queries: one per operator of the inventory.

Each takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the driver
tables of ``sf_dir`` — raw (adapter) tables for the profiling operators, the
layered model (``pipeline.materialize``) for everything downstream.  Output
columns are aliased to the names the SQL oracle uses; money is DOUBLE.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..functions import columns as fx
from ..functions import constants as K
from ..operators import bi as B
from ..operators import clean as C
from ..operators import distinct as D
from ..operators import features as E
from ..operators import kpi as Q
from ..operators import profile as PR
from ..session import shared_dir
from ..sources import evolve, landing, schemas
from ..sources.io import layer_path, read_raw
from ..sources.measured import read_checks
from . import cleaning
from .features import POLICY_FEATURE_COLUMNS
from .pipeline import materialize, materialize_raw
from .sql import run_sql

AS_OF = K.FIXTURE_AS_OF
P = F.col

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def out(df: DataFrame) -> DataFrame:
    """Money (DECIMAL) columns become DOUBLE on output."""
    return df.select(*[P(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else P(f.name)
                       for f in df.schema.fields])


def raw(spark, sf_dir):
    return materialize_raw(spark, sf_dir)


def model(spark, sf_dir):
    return materialize(spark, sf_dir, AS_OF)


# ---------------------------------------------------------------- profiling (P)

RAW_KEYS = (("customers", ["customer_id"]), ("agents", ["agent_id"]), ("dates", ["date"]),
            ("policies", ["policy_id"]), ("policy_events", ["event_id"]),
            ("premium_payments", ["payment_id", "policy_id", "date_id"]))


@query
def profile_shape(spark, sf_dir):
    t = raw(spark, sf_dir)
    return PR.union_all([PR.shape(df, name) for name, df in t.items()])


@query
def null_counts(spark, sf_dir):
    t = raw(spark, sf_dir)
    return PR.union_all([PR.null_counts(t[n], n) for n in t])


@query
def duplicate_count(spark, sf_dir):
    t = raw(spark, sf_dir)
    return PR.union_all([PR.duplicate_count(t[n], n, keys) for n, keys in RAW_KEYS])


VALUE_COUNT_COLUMNS = {
    "customers": ["customer_gender", "customer_occupation", "customer_income_bracket", "customer_city"],
    "policies": ["latest_status", "policy_tenure", "product_id", "channel_id", "is_current", "total_time_in_grace"],
    "agents": ["agent_city", "agent_region", "channel_id"],
    "policy_events": ["current_status", "previous_status", "is_renewed"],
    "premium_payments": ["payment_status", "is_missed", "is_in_grace_period"],
    "dates": ["is_weekday"],
}
FEATURE_COUNT_COLUMNS = {
    "policy_features": ["tenure_bucket", "premium_bucket", "payment_frequency", "is_early_defaulted",
                        "is_lapsed_after_grace", "is_acquisition_at_risk", "is_negative_unrealised"],
    "customer_features": ["age_bucket", "customer_latest_status", "is_renewed_customer"],
}


@query
def value_counts_status(spark, sf_dir):
    t = raw(spark, sf_dir)
    return PR.value_counts_of(t, VALUE_COUNT_COLUMNS)


@query
def value_counts_features(spark, sf_dir):
    m = model(spark, sf_dir)
    return PR.value_counts_of({"policy_features": m.policies, "customer_features": m.customers}, FEATURE_COUNT_COLUMNS)


@query
def schema_check(spark, sf_dir):
    """Raw tables against the schemas declared for them, with each
    column's non-null count (one aggregate per table)."""
    t = raw(spark, sf_dir)
    return PR.union_all([PR.schema_violations(t[n], n, schemas.ADAPTED[n]) for n in schemas.ADAPTED])


@query
def cast_check(spark, sf_dir):
    """P2 data side: raw text columns whose values would not cast to a
    numeric or date type."""
    t = raw(spark, sf_dir)
    return PR.union_all([
        PR.cast_failures(t["policies"], "policies", {"policy_number": "int", "agent_id": "int"}),
        PR.cast_failures(t["customers"], "customers", {"customer_name": "int", "customer_city": "int"}),
        PR.cast_failures(t["policy_events"], "policy_events", {"current_status": "date"}),
    ])


@query
def policies_by_issue_year(spark, sf_dir):
    """P6s: value counts sorted by key — policies per issue year."""
    return PR.value_counts(raw(spark, sf_dir)["policies"], "issue_year", sort=True)


@query
def describe_premium(spark, sf_dir):
    return PR.describe(raw(spark, sf_dir)["policies"], "policies", ["policy_premium", "policy_value", "cost_spent"])


# columns whose summary statistics are profiled; *_features are the feature layers
DESCRIBED_NUMBERS = {
    "customers": ["customer_age"],
    "agents": ["channel_id"],
    "dates": ["date_id", "year", "is_weekday"],
    "policies": ["product_id", "channel_id", "policy_value", "policy_tenure", "policy_premium", "cost_spent",
                 "total_time_in_grace", "issue_year"],
    "policy_events": ["product_id", "channel_id", "date_id"],
    "premium_payments": ["date_id", "premium_amount", "is_missed", "is_in_grace_period"],
    "policy_features": ["expected_premium_value", "total_premium_received", "unrealised_premium_value"],
    "customer_features": ["no_of_policies", "expected_lifetime_value"],
}
DESCRIBED_TEXTS = {
    "customers": ["customer_name", "customer_gender", "customer_city", "customer_occupation", "customer_income_bracket"],
    "agents": ["agent_id", "agent_name", "agent_city", "agent_region"],
    "policies": ["policy_number", "agent_id", "latest_status"],
    "policy_events": ["previous_status", "current_status"],
    "premium_payments": ["payment_status"],
}


def profiled(spark, sf_dir):
    m = model(spark, sf_dir)
    return {**raw(spark, sf_dir), "policy_features": m.policies, "customer_features": m.customers}


@query
def describe_numbers(spark, sf_dir):
    """Every profiled numeric column, one aggregate per table."""
    t = profiled(spark, sf_dir)
    return PR.union_all([PR.describe(t[n], n, cols) for n, cols in DESCRIBED_NUMBERS.items()])


@query
def describe_texts(spark, sf_dir):
    """Every profiled text column, one aggregate per table."""
    t = profiled(spark, sf_dir)
    return PR.union_all([PR.describe_text(t[n], n, cols) for n, cols in DESCRIBED_TEXTS.items()])


def exploration_rules(t):
    p, c, pay = P, t["customers"], t["premium_payments"]
    return [
        ("customers", c, {"invalid_age": (p("customer_age") < K.MIN_VALID_AGE) | (p("customer_age") > 100)}),
        ("policies", t["policies"], {
            "agent_channel_without_agent": (p("channel_id") == 1) & p("agent_id").isNull(),
            "agent_on_other_channel": (p("channel_id") != 1) & p("agent_id").isNotNull(),
            "cost_above_value": p("policy_value") < p("cost_spent"),
            "low_premium": p("policy_premium") < K.EXPLORATION_LOW_PREMIUM_BELOW,
            "future_issue_date": p("issue_date") > fx.date_lit(AS_OF),
            "inverted_date_range": p("issue_date") > p("expiry_date")}),
        ("premium_payments", pay, {"negative_amount": p("premium_amount") < 0}),
        ("dates", t["dates"], {"future_date": p("date") > fx.date_lit(AS_OF)}),
    ]


@query
def rule_violations(spark, sf_dir):
    return PR.union_all([PR.violation_counts(df, n, rules) for n, df, rules in exploration_rules(raw(spark, sf_dir))])


def flag_rules(m):
    return [(n, m[n], rules) for n, rules in cleaning.flag_rules(AS_OF).items()]


@query
def flag_mismatch(spark, sf_dir):
    return PR.union_all([PR.flag_mismatch(df, n, rules) for n, df, rules in flag_rules(model(spark, sf_dir))])


def orphan_checks(t, stage):
    agents_used = t["policies"].filter(P("agent_id").isNotNull() & (P("channel_id") == 1))
    return [
        PR.orphan_keys(t["policy_events"], t["policies"], "policy_id", "policy_events", "policies"),
        PR.orphan_keys(t["premium_payments"], t["policies"], "policy_id", "premium_payments", "policies"),
        PR.orphan_keys(t["policies"], t["customers"], "customer_id", "policies", "customers"),
        PR.orphan_keys(agents_used, t["agents"], "agent_id", "policies", "agents"),
    ]


@query
def orphan_keys(spark, sf_dir):
    r = [o.select(F.lit("raw").alias("stage"), "*") for o in orphan_checks(raw(spark, sf_dir), "raw")]
    m = model(spark, sf_dir)
    c = [o.select(F.lit("clean").alias("stage"), "*") for o in orphan_checks(m.tables, "clean")]
    return PR.union_all(r + c)


@query
def status_pairs(spark, sf_dir):
    return PR.status_pairs(raw(spark, sf_dir)["policy_events"], P("is_renewed"))


@query
def quality_report(spark, sf_dir):
    """The post-cleaning validation as (check, table, column, value) rows.
    Row counts, nulls, flags and rules of all eight cleaned tables and both
    feature tables were measured by the writes of the layers and are only read
    here; key duplicates and orphans, which shuffle, are jobs of their own."""
    m = model(spark, sf_dir)
    rows = [m.checks]
    for n, keys in RAW_KEYS:
        rows.append(PR.as_report(PR.duplicate_count(m[n], n, keys), "duplicate_keys", n, P("key_columns"),
                                 P("n_duplicates")))
    for o in orphan_checks(m.tables, "clean"):
        rows.append(PR.as_report(o, "orphan_rows", P("child_table"), P("key_column"), P("n_orphan_rows")))
    return PR.union_all(rows)


POLICY_FEATURE_CHECKS = ["total_premium_received", "expected_premium_value", "unrealised_premium_value",
                         "is_negative_unrealised", "has_unrealised_value", "is_early_defaulted", "has_lapsed_date",
                         "is_lapsed_after_grace", "is_acquisition_at_risk", "payment_frequency"]
CUSTOMER_FEATURE_CHECKS = ["customer_latest_status", "no_of_policies", "is_renewed_customer",
                           "expected_lifetime_value", "age_bucket"]


@query
def feature_null_check(spark, sf_dir):
    """Nulls in the derived feature columns (all must be 0)."""
    m = model(spark, sf_dir)
    return PR.null_counts(m.policies, "policy_features", POLICY_FEATURE_CHECKS).unionByName(
        PR.null_counts(m.customers, "customer_features", CUSTOMER_FEATURE_CHECKS))


# ---------------------------------------------------------------- cleaning (C)

@query
def standardise_text(spark, sf_dir):
    c = C.standardise_text(raw(spark, sf_dir)["customers"], ["customer_name", "customer_city"])
    return c.select("customer_id", "customer_name", "customer_city")


@query
def impute_group_median(spark, sf_dir):
    c = C.impute_group_median(raw(spark, sf_dir)["customers"], "customer_age", "customer_occupation")
    return c.select("customer_id", "customer_age")


@query
def impute_cost_median(spark, sf_dir):
    p = C.impute_group_median(raw(spark, sf_dir)["policies"], "cost_spent", "channel_id")
    return out(p.select("policy_id", "cost_spent"))


@query
def impute_group_mode(spark, sf_dir):
    return model(spark, sf_dir)["customers"].select("customer_id", "customer_income_bracket")


@query
def impute_const(spark, sf_dir):
    return model(spark, sf_dir)["customers"].select("customer_id", "customer_occupation")


@query
def impute_case(spark, sf_dir):
    p = C.impute_case(raw(spark, sf_dir)["policies"], "agent_id", "channel_id", K.AGENT_BY_CHANNEL, K.UNKNOWN_AGENT)
    return p.select("policy_id", "agent_id")


@query
def rule_flags(spark, sf_dir):
    return model(spark, sf_dir)["policies"].select("policy_id", "is_loss_making_policy", "is_unreliable_premium",
                                                   "is_future_date", "is_invalid_date_range")


@query
def drop_orphans(spark, sf_dir):
    r, m = raw(spark, sf_dir), model(spark, sf_dir)
    parts = []
    for n in ("policy_events", "premium_payments"):
        before = r[n].agg(F.count(F.lit(1)).alias("rows_before"))
        kept = C.drop_orphans(r[n], r["policies"], "policy_id").agg(F.count(F.lit(1)).alias("rows_after_ghosts"))
        final = m[n].agg(F.count(F.lit(1)).alias("rows_after_dedupe"))
        parts.append(Q.side_by_side(Q.side_by_side(before, kept), final).select(F.lit(n).alias("table_name"), "*"))
    return PR.union_all(parts)


@query
def dedupe_payments(spark, sf_dir):
    return out(model(spark, sf_dir)["premium_payments"].select("payment_id", "policy_id", "date_id", "premium_amount"))


@query
def latest_status(spark, sf_dir):
    return model(spark, sf_dir)["policies"].select("policy_id", "latest_status")


@query
def clean_policies(spark, sf_dir):
    return out(model(spark, sf_dir)["policies"])


@query
def clean_customers(spark, sf_dir):
    return model(spark, sf_dir)["customers"]


@query
def clean_events(spark, sf_dir):
    return model(spark, sf_dir)["policy_events"]


@query
def clean_agents(spark, sf_dir):
    return model(spark, sf_dir)["agents"]


@query
def clean_payments(spark, sf_dir):
    return out(model(spark, sf_dir)["premium_payments"])


# ---------------------------------------------------------------- features (E)

def _pf(spark, sf_dir, *cols):
    return out(model(spark, sf_dir).policies.select("policy_id", *cols))


@query
def renewal_eligible(spark, sf_dir):
    return _pf(spark, sf_dir, "is_renewal_eligible")


@query
def premium_received(spark, sf_dir):
    return _pf(spark, sf_dir, "total_premium_received")


@query
def unrealised_premium(spark, sf_dir):
    return _pf(spark, sf_dir, "expected_premium_value", "unrealised_premium_value", "has_unrealised_value",
               "is_negative_unrealised")


@query
def tenure_bucket(spark, sf_dir):
    return _pf(spark, sf_dir, "policy_tenure", "tenure_bucket")


@query
def early_default(spark, sf_dir):
    return _pf(spark, sf_dir, "has_lapsed_date", "is_early_defaulted")


@query
def premium_bucket(spark, sf_dir):
    return _pf(spark, sf_dir, "policy_premium", "premium_bucket")


@query
def lapsed_after_grace(spark, sf_dir):
    return _pf(spark, sf_dir, "is_lapsed_after_grace")


@query
def acquisition_at_risk(spark, sf_dir):
    return _pf(spark, sf_dir, "is_graced", "is_acquisition_at_risk")


@query
def payment_gaps(spark, sf_dir):
    """Histogram of the gaps between consecutive payments (built from
    the per-day pre-aggregate; ``gap_rows`` is the per-row form)."""
    m = model(spark, sf_dir)
    return E.gap_histogram(m["premium_payments"], m["dates"])


@query
def payment_gap_rows(spark, sf_dir):
    """E16 with its inner calendar lookup (J7): the gap before every payment."""
    m = model(spark, sf_dir)
    return E.gap_rows(m["premium_payments"], m["dates"], tie="payment_id").select("payment_id", "policy_id", "payment_date", "payment_gap_days")


@query
def payment_frequency(spark, sf_dir):
    m = model(spark, sf_dir)
    s = E.payment_summary(m["premium_payments"], m["dates"]).select("policy_id", "avg_payment_gap")
    return m.policies.select("policy_id", "payment_frequency").join(s, "policy_id", "left")


@query
def transition_counts(spark, sf_dir):
    return E.transition_counts(model(spark, sf_dir).events)


@query
def customer_status(spark, sf_dir):
    return model(spark, sf_dir).customers.select("customer_id", "customer_latest_status", "is_renewed_customer")


@query
def customer_value(spark, sf_dir):
    return out(model(spark, sf_dir).customers.select("customer_id", "no_of_policies", "expected_lifetime_value"))


@query
def age_bucket(spark, sf_dir):
    return model(spark, sf_dir).customers.select("customer_id", "customer_age", "age_bucket")


@query
def policy_features(spark, sf_dir):
    return out(model(spark, sf_dir).policies)


@query
def customer_features(spark, sf_dir):
    return out(model(spark, sf_dir).customers)


# ---------------------------------------------------------------- KPIs (K)

@query
def persistency(spark, sf_dir):
    return Q.persistency(model(spark, sf_dir).policies)


@query
def customer_renewal_rate(spark, sf_dir):
    return Q.customer_renewal_rate(model(spark, sf_dir).customers)


@query
def policy_renewal_rate(spark, sf_dir):
    m = model(spark, sf_dir)
    return Q.policy_renewal_rate(m.policies, m.events, AS_OF)


@query
def customer_counts(spark, sf_dir):
    return Q.customer_counts(model(spark, sf_dir).customers)


@query
def policy_status_kpis(spark, sf_dir):
    return Q.policy_status_kpis(model(spark, sf_dir).policies)


@query
def renewed_policies(spark, sf_dir):
    return Q.renewed_policies(model(spark, sf_dir).events)


@query
def averages(spark, sf_dir):
    return Q.averages(model(spark, sf_dir).policies)


@query
def channel_sales(spark, sf_dir):
    return Q.channel_sales(model(spark, sf_dir).policies)


@query
def top_channel(spark, sf_dir):
    return Q.top_segments(Q.channel_sales(model(spark, sf_dir).policies), "total_policies_sold", 1, "channel_id")


@query
def channel_persistency(spark, sf_dir):
    return Q.channel_persistency(model(spark, sf_dir).policies)


@query
def channel_leakage_share(spark, sf_dir):
    return Q.channel_leakage_share(model(spark, sf_dir).policies)


@query
def channel_risk_pct(spark, sf_dir):
    return Q.channel_risk_pct(model(spark, sf_dir).policies)


@query
def financial_totals(spark, sf_dir):
    m = model(spark, sf_dir)
    return Q.financial_totals(m.policies, m.customers)


@query
def lapse_by_payment_frequency(spark, sf_dir):
    return Q.lapse_by(model(spark, sf_dir).policies, "payment_frequency", "lapsed_rate", "total_policies_lapsed")


@query
def early_lapse_rate(spark, sf_dir):
    return Q.early_lapse_rate(model(spark, sf_dir).policies)


@query
def lapse_by_age_bucket(spark, sf_dir):
    m = model(spark, sf_dir)
    return Q.customer_segment_rate(m.policies, m.customers, "age_bucket", "total_lapsed", "lapse_rate_by_age")


@query
def lapse_by_occupation(spark, sf_dir):
    m = model(spark, sf_dir)
    return Q.customer_segment_rate(m.policies, m.customers, "customer_occupation", "total_lapsed",
                                   "lapse_rate_by_profession")


@query
def lapse_after_grace(spark, sf_dir):
    return Q.lapse_after_grace(model(spark, sf_dir).policies)


@query
def lapse_by_product(spark, sf_dir):
    return Q.by_measure(Q.lapse_by(model(spark, sf_dir).policies, "product_id", "product_lapse_rate"), "product_lapse_rate", "product_id")


@query
def lapse_by_tenure(spark, sf_dir):
    return Q.lapse_by(model(spark, sf_dir).policies, "tenure_bucket", "lapse_rate_by_tenure")


@query
def lapse_by_premium_bucket(spark, sf_dir):
    return Q.lapse_by(model(spark, sf_dir).policies, "premium_bucket", "lapse_rate_by_premium_price")


@query
def lapse_by_category(spark, sf_dir):
    m = model(spark, sf_dir)
    return Q.lapse_by_category(m.policies, m["products"])


@query
def status_share(spark, sf_dir):
    return Q.status_share(model(spark, sf_dir).policies)


@query
def scorecard(spark, sf_dir):
    m = model(spark, sf_dir)
    return Q.scorecard(m.policies, m.customers, m.events, AS_OF)


@query
def premium_composition(spark, sf_dir):
    return Q.premium_composition(model(spark, sf_dir).policies)


# ---------------------------------------------------------------- dashboards (S, B)

def _bi(m):
    """The S6 extract, built (and its dimension sizes checked) once per model."""
    if "bi_policies" not in m.tables:
        m.tables["bi_policies"] = B.bi_policies(m.policies, m["channels"], m["products"])
    return m.tables["bi_policies"]


@query
def bi_policies(spark, sf_dir):
    return out(_bi(model(spark, sf_dir)))


@query
def bi_customers(spark, sf_dir):
    return out(B.bi_customers(model(spark, sf_dir).customers))


@query
def acquisition_loss_by_channel(spark, sf_dir):
    return B.acquisition_loss_by_channel(_bi(model(spark, sf_dir)))


@query
def acquisition_cost_by_channel(spark, sf_dir):
    return B.acquisition_cost_by_channel(_bi(model(spark, sf_dir)))


@query
def channel_comparison(spark, sf_dir):
    return B.channel_comparison(_bi(model(spark, sf_dir)))


@query
def customer_status_distribution(spark, sf_dir):
    return B.customer_status_distribution(model(spark, sf_dir).customers)


@query
def executive_kpis(spark, sf_dir):
    m = model(spark, sf_dir)
    return B.executive_tiles(m.policies, m.customers, m.events, AS_OF)


@query
def early_default_split(spark, sf_dir):
    return B.early_default_split(model(spark, sf_dir).policies)


@query
def expected_premium_by_product(spark, sf_dir):
    return B.sum_by(_bi(model(spark, sf_dir)), "product_name", "expected_premium_value", "expected_premium")


@query
def financial_kpis(spark, sf_dir):
    return B.financial_tiles(model(spark, sf_dir).policies)


@query
def lapse_by_customer_segment(spark, sf_dir):
    return B.lapse_by_customer_segment_all(model(spark, sf_dir).customers)


@query
def lapse_by_policy_segment(spark, sf_dir):
    return B.lapse_by_policy_segment_all(_bi(model(spark, sf_dir)))


@query
def policies_status_overview(spark, sf_dir):
    return B.policies_status_overview(model(spark, sf_dir).policies)


@query
def product_performance(spark, sf_dir):
    return B.product_performance(_bi(model(spark, sf_dir)))


@query
def retention_kpis(spark, sf_dir):
    m = model(spark, sf_dir)
    return B.retention_tiles(m.policies, m.customers)


@query
def unrealised_by_product(spark, sf_dir):
    return B.sum_by(_bi(model(spark, sf_dir)), "product_name", "unrealised_premium_value", "unrealised_premium")


@query
def product_measure(spark, sf_dir):
    return B.product_measure_all(_bi(model(spark, sf_dir)))


def _dashboard(spark, sf_dir, name):
    m = model(spark, sf_dir)
    return B.dashboard(name, _bi(m), m.customers, m.events, AS_OF)


@query
def dashboard_executive(spark, sf_dir):
    """B26"""
    return _dashboard(spark, sf_dir, "Executive")


@query
def dashboard_retention(spark, sf_dir):
    """B26"""
    return _dashboard(spark, sf_dir, "Retention")


@query
def dashboard_financial(spark, sf_dir):
    """B26"""
    return _dashboard(spark, sf_dir, "Financial")


@query
def csv_landing(spark, sf_dir):
    """The raw customers landed as CSV with a header in the shared folder
    and scanned back with their declared types."""
    customers = raw(spark, sf_dir)["customers"]
    path = f"{shared_dir(spark)}/lapsewise-csv/{uuid.uuid4().hex}"
    customers.write.option("header", True).csv(path, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return read_raw(spark, path, customers.schema)


# --- fixed values: rows that csv_quarantine spoils: what numbers them, and the values put in their columns
SPOILED_EVERY, SHORT_EVERY = (41, 3), (43, 5)
SPOILED = {
    "customers": ("customer_id", {"customer_age": "x"}),
    "policies": ("policy_id", {"policy_value": "1,2,3", "issue_date": "2020-13-40"}),
    "products": ("product_id + 1", {"product_id": "three"}),
    "channels": ("channel_id + 1", {"channel_id": "three"}),
    "agents": ("CAST(substr(agent_id, 2) AS BIGINT)", {"channel_id": "1.5"}),
    "dates": ("date_id", {"date": "tomorrow"}),
    "policy_events": ("event_id", {"date_id": "19950230x", "is_renewed": "maybe"}),
    "premium_payments": ("payment_id", {"premium_amount": "n/a"}),
}


@query
def csv_quarantine(spark, sf_dir):
    """All eight raw tables landed as CSV, some rows with values that
    don't parse and some without their last column, and scanned with the
    quarantine: rows landed, good and malformed, and values per typed column
    that their declared type can't take, as counted by the landing's writes."""
    t, root = raw(spark, sf_dir), f"{shared_dir(spark)}/lapsewise-csv/{uuid.uuid4().hex}"

    def land(name: str) -> None:
        (number, values), schema = SPOILED[name], schemas.RAW[name]
        place = F.expr(number)
        spoiled, short = (place % every == rest for every, rest in (SPOILED_EVERY, SHORT_EVERY))
        texts = [F.when(spoiled, values[f.name]).otherwise(P(f.name).cast(f.dataType).cast("string")).alias(f.name) if f.name in values
                 else P(f.name).cast(f.dataType).cast("string").alias(f.name) for f in schema.fields]
        short = F.coalesce(short, F.lit(False))
        t[name].where(~short).select(*texts).write.option("header", True).csv(f"{root}/{name}/whole")
        t[name].where(short).select(*texts[:-1]).write.option("header", True).csv(f"{root}/{name}/short")
        landing.land_csv(spark, [f"{root}/{name}/whole", f"{root}/{name}/short"], schema, root, f"landed/{name}")

    with ThreadPoolExecutor(max_workers=4) as pool:  # the tables' jobs share the executors
        list(pool.map(land, SPOILED))
    return read_checks(spark, root, [f"landed/{name}" for name in SPOILED])


# the feature layer as it was before its last two columns, and the year that is written anew
OLDER_COLUMNS, REWRITTEN_YEAR = POLICY_FEATURE_COLUMNS[:-2], 1996


@query
def layer_evolution(spark, sf_dir):
    """The policy features written by issue year with 32 columns and a
    narrower tenure, one year replaced with today's 34, and the whole layer
    read by today's contract."""
    features, root = model(spark, sf_dir).policies, f"{shared_dir(spark)}/lapsewise-layers/{uuid.uuid4().hex}"
    older = features.select(*OLDER_COLUMNS).withColumn("policy_tenure", P("policy_tenure").cast("smallint"))
    evolve.replace_slices(older, root, "features/policies", ["issue_year"])
    evolve.replace_slices(features.where(P("issue_year") == REWRITTEN_YEAR), root, "features/policies", ["issue_year"], features.schema)
    layer = evolve.read_evolved(spark, root, "features/policies", features.schema)
    added = [c for c in features.columns if c not in OLDER_COLUMNS]
    return layer.groupBy("issue_year").agg(
        F.count(F.lit(1)).alias("n_policies"), F.sum("policy_tenure").alias("sum_tenure"), F.sum("cost_spent").cast("double").alias("sum_cost"),
        *[F.count_if(P(c).isNull()).alias(f"n_null_{c}") for c in added], *[fx.count_where(P(c)).alias(f"n_{c}") for c in added])


@query
def distinct_by_channel(spark, sf_dir):
    """Distinct policies and customers per channel, from bitmaps kept per
    issue year (one folder each) and merged over the years."""
    features, root = model(spark, sf_dir).policies, f"{shared_dir(spark)}/lapsewise-layers/{uuid.uuid4().hex}"
    keys = {"policies": "policy_id", "customers": "customer_id"}
    evolve.replace_slices(D.key_bitmaps(features, ["issue_year", "channel_id"], keys), root, "bitmaps/policies", ["issue_year"])
    kept = spark.read.parquet(layer_path(root, "bitmaps/policies"))
    return D.count_keys(D.merge_bitmaps(kept, ["channel_id"]), ["channel_id"])


@query
def sql_views(spark, sf_dir):
    """One statement over the model's temp views, with ``==``."""
    return run_sql(model(spark, sf_dir), """
        SELECT channel_id, count(*) AS n_active FROM policies WHERE latest_status == 'active' GROUP BY channel_id""")
