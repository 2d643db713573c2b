"""KPI and segmentation queries (stage 05) as DataFrame operators.

Every KPI is one aggregate over the feature tables; counts are BIGINT,
percentages are ``rate`` (exact half-up to 2 decimals), money is summed as
DECIMAL and returned as DOUBLE.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as fx
from ..functions import constants as K

P = F.col


def is_status(s: str, c: str = "latest_status") -> Column:
    return P(c) == s


def lapsed_cost() -> Column:
    return F.when(is_status(K.LAPSED), P("cost_spent")).otherwise(F.lit(0))


# --- generic forms ---------------------------------------------------------------

def segment_rate(df: DataFrame, by: str | Sequence[str], event: Column, n_name: str, rate_name: str,
                 count_col: str = "policy_id") -> DataFrame:
    """Per segment: rows with the event, and their share of the segment's rows."""
    by = [by] if isinstance(by, str) else list(by)
    n = fx.count_where(event)
    return df.groupBy(*by).agg(n.alias(n_name), fx.rate(n, F.count(count_col)).alias(rate_name))


def by_measure(df: DataFrame, measure: str, tie_break: str) -> DataFrame:
    """O2: aggregated rows by a measure, largest first, nulls last; equal ones
    by ``tie_break``, nulls first."""
    return df.orderBy(F.desc_nulls_last(measure), F.asc_nulls_first(tie_break))


def share_of_total(grouped: DataFrame, measure: str, name: str, exact_cents: bool = False) -> DataFrame:
    """Adds each segment's percentage of the measure's total.  Runs on an
    already-aggregated frame (one row per segment), so the total window
    holds only segment rows."""
    total = F.sum(P(measure)).over(Window.partitionBy())
    if exact_cents:
        share = fx.rate(fx.cents(P(measure)), fx.cents(total))
    else:
        share = fx.rate(P(measure), total)
    return grouped.withColumn(name, share)


def customer_segment_rate(policies: DataFrame, customers: DataFrame, segment: str, n_name: str,
                          rate_name: str) -> DataFrame:
    """Lapse rate of policies by a customer attribute (inner join, as
    the workload writes it).  Policies are pre-aggregated per customer first,
    so the join is one-to-one and a customer owning many policies adds no
    skew; the final aggregate is over segments."""
    per_customer = policies.groupBy("customer_id").agg(
        fx.count_where(is_status(K.LAPSED)).alias("__lapsed"), F.count("policy_id").alias("__n"))
    joined = per_customer.join(customers.select("customer_id", segment), "customer_id", "inner")
    lapsed = F.sum("__lapsed")
    return joined.groupBy(segment).agg(lapsed.cast("long").alias(n_name),
                                       fx.rate(lapsed, F.sum("__n")).alias(rate_name))


# --- portfolio KPIs ----------------------------------------------------------------

def persistency_cols() -> list[Column]:
    return [fx.rate(fx.count_where(is_status(K.ACTIVE)), F.count("policy_id")).alias("persistency_ratio")]


def persistency(policies: DataFrame) -> DataFrame:
    """K1"""
    return policies.agg(*persistency_cols())


def customer_renewal_rate(customers: DataFrame) -> DataFrame:
    """K2"""
    return customers.agg(fx.rate(fx.count_where(P("is_renewed_customer")), F.count("customer_id"))
                         .alias("customer_renewal_rate"))


def renewed_policy_ids(events: DataFrame) -> DataFrame:
    return events.filter(P("is_renewed_event")).select("policy_id").distinct()


def renewal_due(as_of: dt.date) -> Column:
    return (P("expiry_date") <= fx.date_lit(as_of)) & fx.in_set("latest_status", K.RENEWAL_ELIGIBLE_STATUSES)


def policy_renewal_rate(policies: DataFrame, events: DataFrame, as_of: dt.date) -> DataFrame:
    """K3: renewed share of the renewal-eligible policies (expired by the as-of
    date, still active/matured/claimed); null when none is eligible.  Both
    sides are de-duplicated before the join, so the two distinct counts of the
    workload become plain conditional counts."""
    eligible = policies.filter(renewal_due(as_of))
    renewed = renewed_policy_ids(events).withColumn("__renewed", F.lit(True))
    j = eligible.select("policy_id").distinct().join(renewed, "policy_id", "left")
    return j.agg(fx.rate(fx.count_where(P("__renewed")), F.count("policy_id")).alias("policy_renewal_rate"))


def customer_counts(customers: DataFrame) -> DataFrame:
    """K4–K6 and K2 with its count."""
    return customers.agg(*customer_count_cols())


def customer_count_cols() -> list[Column]:
    n = F.count("customer_id")
    active = fx.count_where(is_status("Active", "customer_latest_status"))
    lapsed = fx.count_where(is_status("Lapsed", "customer_latest_status"))
    renewed = fx.count_where(P("is_renewed_customer"))
    return [
        n.alias("total_customers"),
        active.alias("total_active_customer"), fx.rate(active, n).alias("active_customer_rate"),
        lapsed.alias("total_lapsed_customer"), fx.rate(lapsed, n).alias("lapse_rate"),
        renewed.alias("total_renewed_customers"), fx.rate(renewed, n).alias("customer_renewal_rate")]


def policy_status_kpis(policies: DataFrame) -> DataFrame:
    """K7–K9, K11."""
    return policies.agg(*policy_status_cols())


def policy_status_cols() -> list[Column]:
    n = F.count("policy_id")
    cols = [n.alias("total_policies_issued")]
    for status, cnt, rt in ((K.LAPSED, "total_lapsed_policies", "lapse_rate"),
                            (K.CANCELLED, "total_cancelled_policies", "cancellation_rate"),
                            (K.CLAIMED, "total_claimed_policies", "claim_rate")):
        c = fx.count_where(is_status(status))
        cols += [c.alias(cnt), fx.rate(c, n).alias(rt)]
    return cols


def renewed_policies(events: DataFrame) -> DataFrame:
    """K10"""
    return events.filter(P("is_renewed_event")).agg(F.count_distinct("policy_id").alias("total_renewed_policies"))


def averages(policies: DataFrame) -> DataFrame:
    """K12 (reliable premiums only) and K13, half-up to 2 decimals."""
    return policies.agg(*average_cols())


def average_cols() -> list[Column]:
    reliable = ~P("is_unreliable_premium")
    prem_cents = F.sum(F.when(reliable, fx.cents(P("policy_premium"))))
    return [fx.round_ratio(prem_cents, fx.count_where(reliable & P("policy_premium").isNotNull()) * 100, 2)
            .alias("avg_premium_value"),
            fx.round_ratio(F.sum("policy_tenure"), F.count("policy_tenure"), 2).alias("avg_policy_tenure")]


# --- channel KPIs ------------------------------------------------------------------

def channel_sales(policies: DataFrame) -> DataFrame:
    """K14 policies per channel and K15 their rank (1 = top channel)."""
    g = policies.groupBy("channel_id").agg(F.count("policy_id").alias("total_policies_sold"))
    w = Window.orderBy(F.desc("total_policies_sold"))
    return g.withColumn("sales_rank", F.rank().over(w))


def top_segments(df: DataFrame, measure: str, k: int, tie_break: str) -> DataFrame:
    """The segments that share the k best places by a measure, best first;
    ties share a place, so none of them is dropped.  ``df`` has a row per
    segment, which is all that the window ranks."""
    place = F.rank().over(Window.orderBy(F.desc_nulls_last(measure)))
    return (df.withColumn("__place", place).where(P("__place") <= k).drop("__place")
            .orderBy(F.desc_nulls_last(measure), F.asc_nulls_first(tie_break)))


def channel_persistency(policies: DataFrame) -> DataFrame:
    """K16"""
    return segment_rate(policies, "channel_id", is_status(K.ACTIVE), "total_active", "persistency_ratio")


def channel_leakage_share(policies: DataFrame) -> DataFrame:
    """K17 + K18: acquisition cost of lapsed policies per channel, largest
    first, and its share of the (computed) total."""
    g = policies.groupBy("channel_id").agg(F.sum(lapsed_cost()).alias("__leak"))
    g = share_of_total(g, "__leak", "per_contribution_to_total_leak", exact_cents=True)
    g = g.select("channel_id", fx.money(P("__leak")).alias("leakage_amount"), "per_contribution_to_total_leak")
    return by_measure(g, "leakage_amount", "channel_id")


def channel_risk_pct(policies: DataFrame) -> DataFrame:
    """At-risk cost as a percentage of the channel's own cost spent."""
    leak = F.sum(lapsed_cost())
    spent = F.sum("cost_spent")
    return policies.groupBy("channel_id").agg(
        fx.money(leak).alias("total_acquisition_at_risk"),
        fx.rate(fx.cents(leak), fx.cents(spent)).alias("acquisition_at_risk_pct"))


# --- financial KPIs ------------------------------------------------------------------

def financial_totals(policies: DataFrame, customers: DataFrame) -> DataFrame:
    """K20–K24, K26 in one scan of each feature table."""
    p = policies.agg(*financial_policy_cols())
    c = customers.agg(*financial_customer_cols())
    return side_by_side(p, c)


def financial_customer_cols() -> list[Column]:
    return [fx.round_ratio(F.sum(fx.cents(P("expected_lifetime_value"))), F.count("expected_lifetime_value") * 100, 6)
            .alias("expected_customer_lifetime_value")]


def financial_policy_cols() -> list[Column]:
    leak = F.sum(lapsed_cost())
    spent = F.sum("cost_spent")
    return [
        fx.money(F.sum("total_premium_received")).alias("total_premium_received"),
        fx.money(spent).alias("total_acquisition_cost_spent"),
        fx.money(leak).alias("total_acquisition_at_risk"),
        fx.rate(fx.cents(leak), fx.cents(spent)).alias("total_acquisition_per_at_risk"),
        fx.money(F.sum(F.when(is_status(K.LAPSED), P("total_premium_received")))).alias("money_received_before_lapse"),
        fx.money(F.sum("unrealised_premium_value")).alias("total_ltv_loss"),
        fx.money(F.sum("expected_premium_value")).alias("total_expected_premium_value")]


def side_by_side(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two single-row aggregates as one row (equi-join on a constant key)."""
    k = F.lit(1).alias("__one")
    return a.select(k, "*").join(b.select(k, "*"), "__one").drop("__one")


# --- behaviour / product KPIs --------------------------------------------------------

def lapse_by(policies: DataFrame, by: str, rate_name: str, n_name: str = "total_lapsed") -> DataFrame:
    return segment_rate(policies, by, is_status(K.LAPSED), n_name, rate_name)


def early_lapse_rate(policies: DataFrame) -> DataFrame:
    """K27"""
    return policies.agg(*early_lapse_cols())


def early_lapse_cols() -> list[Column]:
    n = fx.count_where(is_status(K.LAPSED) & P("is_early_defaulted"))
    return [n.alias("total_early_lapsed"), fx.rate(n, F.count("policy_id")).alias("early_lapse_rate")]


def lapse_after_grace(policies: DataFrame, denom: str = "policies") -> DataFrame:
    """Of all policies (as the workload's SQL); ``denom="lapsed"`` gives
    the share of lapses its README describes."""
    return policies.agg(*lapse_after_grace_cols(denom))


def lapse_after_grace_cols(denom: str = "policies") -> list[Column]:
    n = fx.count_where(is_status(K.LAPSED) & P("is_lapsed_after_grace"))
    d = F.count("policy_id") if denom == "policies" else fx.count_where(is_status(K.LAPSED))
    return [n.alias("total_lapsed_after_grace"), fx.rate(n, d).alias("lapse_rate_after_grace")]


def lapse_by_category(policies: DataFrame, products: DataFrame) -> DataFrame:
    """K34 by the real product category (products is a small dimension)."""
    j = policies.select("policy_id", "product_id", "latest_status").join(
                   products.select("product_id", "product_category"), "product_id", "left")
    return lapse_by(j, "product_category", "lapse_rate_by_category")


def status_share(policies: DataFrame) -> DataFrame:
    """Share of each status among all policies."""
    g = policies.groupBy("latest_status").agg(F.count(F.lit(1)).alias("total_policies"))
    return share_of_total(g, "total_policies", "status_share_pct")


def premium_composition(policies: DataFrame) -> DataFrame:
    """Collected, unrealised and remaining-collectable premium."""
    a = policies.agg(F.sum("total_premium_received").alias("r"), F.sum("unrealised_premium_value").alias("u"),
                     F.sum("expected_premium_value").alias("e"))
    a = a.select(F.col("r").alias(K.PREMIUM_COLLECTED), F.col("u").alias(K.PREMIUM_UNREALISED),
                 (F.col("e") - F.col("r") - F.col("u")).alias(K.PREMIUM_REMAINING))
    names = [K.PREMIUM_COLLECTED, K.PREMIUM_UNREALISED, K.PREMIUM_REMAINING]
    a = a.select(*[F.col(f"`{n}`").cast("decimal(38,2)").alias(n) for n in names])
    long = a.unpivot([], names, "premium_status", "amount")
    return long.select("premium_status", fx.money(F.col("amount")).alias("amount"))


def scorecard(policies: DataFrame, customers: DataFrame, events: DataFrame, as_of: dt.date) -> DataFrame:
    """The headline KPIs as (kpi, value) rows — one aggregate per feature
    table, plus the two event-based counts."""
    pol = policies.agg(*persistency_cols(), *policy_status_cols(), *average_cols(), *financial_policy_cols(),
                       *early_lapse_cols(), *lapse_after_grace_cols())
    ccols = customer_count_cols()
    ccols[4] = ccols[4].alias("customer_lapse_rate")  # "lapse_rate" is the policy one here
    cust = customers.agg(*ccols, *financial_customer_cols())
    parts = [pol, cust, policy_renewal_rate(policies, events, as_of), renewed_policies(events)]
    wide = parts[0]
    for p in parts[1:]:
        wide = side_by_side(wide, p)
    order = ["persistency_ratio", "customer_renewal_rate", "policy_renewal_rate", "total_customers",
             "total_active_customer", "active_customer_rate", "total_lapsed_customer", "customer_lapse_rate",
             "total_renewed_customers", "total_policies_issued", "total_lapsed_policies", "lapse_rate",
             "total_cancelled_policies", "cancellation_rate", "total_claimed_policies", "claim_rate",
             "total_renewed_policies", "avg_premium_value", "avg_policy_tenure", "total_premium_received",
             "total_acquisition_cost_spent", "total_acquisition_at_risk", "total_acquisition_per_at_risk",
             "money_received_before_lapse", "total_ltv_loss", "total_expected_premium_value",
             "expected_customer_lifetime_value", "total_early_lapsed", "early_lapse_rate",
             "total_lapsed_after_grace", "lapse_rate_after_grace"]
    return wide.select(*[P(c).cast("double").alias(c) for c in order]).unpivot([], order, "kpi", "value")
