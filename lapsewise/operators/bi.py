"""Dashboard extracts and worksheet aggregates.

The workbook's calculated fields become aggregates over the feature tables;
its parameter-driven fields (segment and measure switches) become a
``choice`` argument mapped to a column.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as fx
from ..functions import constants as K
from . import kpi
from .sheets import N_KEYS, Sheet, sheet_rows

P = F.col

# --- fixed values: parameter members → columns ---------------------------------
CUSTOMER_SEGMENTS = (("Age Group", "age_bucket"), ("Occupation", "customer_occupation"),
                     ("City", "customer_city"), ("Income Group", "customer_income_bracket"))
POLICY_SEGMENTS = (("Product", "product_name"), ("Channel", "channel_name"),
                   ("Premium Bucket", "premium_bucket"), ("Tenure Bucket", "tenure_bucket"))
PRODUCT_MEASURES = (("Unrealised Premium", "unrealised_premium_value"),
                    ("Premium Received", "total_premium_received"))


def bi_policies(policies: DataFrame, channels: DataFrame, products: DataFrame) -> DataFrame:
    """Policy features + channel and product attributes (left joins, so a
    missing dimension row loses no policy)."""
    df = policies.join(channels.select("channel_id", "channel_name", "channel_type"), "channel_id", "left")
    return df.join(products.select("product_id", "product_name", "product_category"), "product_id", "left")


def bi_customers(customers: DataFrame) -> DataFrame:
    """S7"""
    return customers.select(
        "customer_id", "customer_name", "customer_age", "age_bucket", "customer_gender", "customer_city",
        "customer_occupation", "customer_income_bracket", "customer_latest_status", "no_of_policies",
        "expected_lifetime_value", "is_renewed_customer", "is_invalid_age")


def lapsed_count() -> Column:
    return fx.count_where(kpi.is_status(K.LAPSED))


def acquisition_loss_by_channel(bi: DataFrame) -> DataFrame:
    """B1, largest loss first"""
    g = bi.groupBy("channel_name").agg(fx.money(F.sum(kpi.lapsed_cost())).alias("acquisition_loss"))
    return kpi.by_measure(g, "acquisition_loss", "channel_name")


def acquisition_cost_by_channel(bi: DataFrame) -> DataFrame:
    """B2"""
    return bi.groupBy("channel_name").agg(fx.money(F.sum("cost_spent")).alias("acquisition_cost_spent"))


def channel_comparison(bi: DataFrame) -> DataFrame:
    """Distinct policies, persistency and acquisition loss per channel,
    most policies first."""
    return kpi.by_measure(bi.groupBy("channel_name").agg(
        F.count_distinct("policy_id").alias("policies"),
        fx.percent(fx.count_where(kpi.is_status(K.ACTIVE)), F.count("policy_id")).alias("persistency_ratio"),
        fx.money(F.sum(kpi.lapsed_cost())).alias("acquisition_loss")), "policies", "channel_name")


def customer_status_distribution(customers: DataFrame) -> DataFrame:
    """B4, most customers first"""
    g = customers.groupBy("customer_latest_status").agg(F.count_distinct("customer_id").alias("customers"))
    return kpi.by_measure(g, "customers", "customer_latest_status")


def early_default_label() -> Column:
    return F.when(P("is_early_defaulted"), K.EARLY_DEFAULTED).otherwise(K.NOT_EARLY_DEFAULT)


def early_default_split(policies: DataFrame) -> DataFrame:
    """Lapsed policies split by the early-default label."""
    return policies.groupBy(early_default_label().alias("early_default_status")).agg(lapsed_count().alias("total_lapsed_policies"))


def sum_by(bi: DataFrame, by: str, measure: str, name: str) -> DataFrame:
    """A money measure summed per dimension value, largest first."""
    return kpi.by_measure(bi.groupBy(by).agg(fx.money(F.sum(measure)).alias(name)), name, by)


def policies_status_overview(policies: DataFrame) -> DataFrame:
    """B17"""
    return policies.groupBy("latest_status").agg(F.count_distinct("policy_id").alias("policies"))


def product_performance(bi: DataFrame) -> DataFrame:
    """B19, highest persistency first"""
    n = F.count("policy_id")
    return kpi.by_measure(bi.groupBy("product_name").agg(
        fx.percent(fx.count_where(kpi.is_status(K.ACTIVE)), n).alias("persistency_ratio"),
        fx.percent(lapsed_count(), n).alias("lapse_rate")), "persistency_ratio", "product_name")


def _choice(pairs, choice: str) -> str:
    table = dict(pairs)
    if choice not in table:
        raise ValueError(f"unknown choice {choice!r}; expected one of {list(table)}")
    return table[choice]


def lapse_by_customer_segment(customers: DataFrame, choice: str = "Age Group") -> DataFrame:
    """Average of (status = Lapsed) over customers of each segment,
    highest first."""
    seg = _choice(CUSTOMER_SEGMENTS, choice)
    return kpi.by_measure(customers.groupBy(P(seg).alias("segment")).agg(
        fx.fraction(fx.count_where(kpi.is_status("Lapsed", "customer_latest_status")), F.count(F.lit(1)))
        .alias("lapse_rate")), "lapse_rate", "segment")


def lapse_by_policy_segment(bi: DataFrame, choice: str = "Tenure Bucket") -> DataFrame:
    """Lapse rate (percent) of policies per chosen segment."""
    seg = _choice(POLICY_SEGMENTS, choice)
    return bi.groupBy(P(seg).alias("segment")).agg(
        fx.percent(lapsed_count(), F.count("policy_id")).alias("lapse_rate"))


def product_measure(bi: DataFrame, choice: str = "Unrealised Premium") -> DataFrame:
    """B25"""
    m = _choice(PRODUCT_MEASURES, choice)
    return bi.groupBy("product_name").agg(fx.money(F.sum(m)).alias("product_measure"))


def each_choice(fn, df: DataFrame, pairs, key: str = "choice") -> DataFrame:
    """All parameter members of a switch in one long frame (one query per
    member, unioned) — the simple form; the ``*_all`` operators below do the
    same in one scan."""
    out = None
    for member, _ in pairs:
        part = fn(df, member).select(F.lit(member).alias(key), "*")
        out = part if out is None else out.unionByName(part)
    return out


def _members(pairs, value: Column | None = None) -> Column:
    """One (choice, segment[, value]) struct per parameter member."""
    fields = lambda m, c: [F.lit(m).alias("choice"), P(c).cast("string").alias("segment")] + (
        [] if value is None else [value.alias("value")])
    return F.explode(F.array(*[F.struct(*fields(m, c)) for m, c in pairs])).alias("__m")


def lapse_by_customer_segment_all(customers: DataFrame) -> DataFrame:
    """B15 for every member in one scan: each customer row is expanded to one
    row per member and a single grouped aggregate runs (partial aggregation
    collapses the expansion map-side)."""
    lapsed = fx.flag(kpi.is_status("Lapsed", "customer_latest_status"))
    x = customers.select(_members(CUSTOMER_SEGMENTS), lapsed.alias("__l"))
    return x.groupBy(P("__m.choice").alias("choice"), P("__m.segment").alias("segment")).agg(
        fx.fraction(F.count_if(P("__l")), F.count(F.lit(1))).alias("lapse_rate"))


def lapse_by_policy_segment_all(bi: DataFrame) -> DataFrame:
    """B16 for every member in one scan."""
    x = bi.select(_members(POLICY_SEGMENTS), fx.flag(kpi.is_status(K.LAPSED)).alias("__l"), "policy_id")
    return x.groupBy(P("__m.choice").alias("choice"), P("__m.segment").alias("segment")).agg(
        fx.percent(F.count_if(P("__l")), F.count("policy_id")).alias("lapse_rate"))


def product_measure_all(bi: DataFrame) -> DataFrame:
    """B25 for both members in one scan."""
    out = None
    structs = [F.struct(F.lit(m).alias("choice"), P(c).cast("decimal(38,2)").alias("value")) for m, c in PRODUCT_MEASURES]
    x = bi.select("product_name", F.explode(F.array(*structs)).alias("__m"))
    out = x.groupBy(P("__m.choice").alias("choice"), "product_name").agg(fx.money(F.sum("__m.value")).alias("product_measure"))
    return out


# --- KPI tiles ----------------------------------------------------------------------

def _tiles(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    wide = df.agg(*[c.cast("double").alias(n) for n, c in cols.items()])
    return wide.unpivot([], list(cols), "kpi", "value")


def executive_tiles(policies: DataFrame, customers: DataFrame, events: DataFrame, as_of: dt.date) -> DataFrame:
    """Customer renewal %, persistency %, policy renewal fraction,
    premium received in crore."""
    c = _tiles(customers, {"customer_renewal_rate": fx.percent(fx.count_where(P("is_renewed_customer")),
                                                               F.count("customer_id"))})
    p = _tiles(policies, {
        "persistency_ratio": fx.percent(fx.count_where(kpi.is_status(K.ACTIVE)), F.count("policy_id")),
        "total_premium_received_cr": fx.to_crore(F.sum("total_premium_received"))})
    r = kpi.policy_renewal_rate(policies, events, as_of).select(
        F.lit("policy_renewal_rate").alias("kpi"), (P("policy_renewal_rate") / 100).alias("value"))
    return c.unionByName(p).unionByName(r)


def financial_tiles(policies: DataFrame) -> DataFrame:
    """B11–B14 in crore."""
    e, r, u = F.sum("expected_premium_value"), F.sum("total_premium_received"), F.sum("unrealised_premium_value")
    return _tiles(policies, {
        "acquisition_cost_at_risk_cr": fx.to_crore(F.sum(F.when(kpi.is_status(K.LAPSED), P("cost_spent")))),
        "remaining_collectable_premium_cr": fx.to_crore(e - r - u),
        "total_expected_premium_cr": fx.to_crore(e),
        "total_unrealised_premium_cr": fx.to_crore(u)})


def retention_tiles(policies: DataFrame, customers: DataFrame) -> DataFrame:
    """Grace-period lapse %, early-default fraction, lapsed policies,
    active customers."""
    n = F.count("policy_id")
    lapsed = kpi.is_status(K.LAPSED)
    p = _tiles(policies, {
        "grace_period_lapse": fx.percent(fx.count_where(lapsed & P("is_lapsed_after_grace")), n),
        "early_default_rate": fx.fraction(fx.count_where(lapsed & P("is_early_defaulted")), n),
        "total_lapsed_policies": lapsed_count()})
    c = _tiles(customers, {"total_active_customers": fx.count_where(kpi.is_status("Active", "customer_latest_status"))})
    return p.unionByName(c)


def dashboard_rows(sheets: dict[str, DataFrame], name: str) -> DataFrame:
    """A dashboard as long rows ``(dashboard, sheet, label, measure,
    value)``; a sheet's text column is the label, its numbers are measures."""
    out = None
    for sheet, df in sheets.items():
        label = next((c for c, t in df.dtypes if t == "string"), None)
        measures = [c for c in df.columns if c != label]
        named = df.select((P(label) if label else F.lit(None).cast("string")).alias("label"),
                          *[P(c).cast("double").alias(c) for c in measures])
        rows = named.unpivot(["label"], measures, "measure", "value").select(
            F.lit(name).alias("dashboard"), F.lit(sheet).alias("sheet"), "label", "measure", "value")
        out = rows if out is None else out.unionByName(rows)
    return out


def dashboard_tables(name: str, bi: DataFrame, policies: DataFrame, customers: DataFrame, events: DataFrame,
                     as_of: dt.date) -> dict[str, DataFrame]:
    """The worksheets of one dashboard as frames of their own, by name;
    ``dashboard`` gives the same numbers from one pass over each layer."""
    if name == "Executive":
        return {"kpis": executive_tiles(policies, customers, events, as_of),
                "premium_composition": kpi.premium_composition(policies),
                "customer_status_distribution": customer_status_distribution(customers),
                "policies_status_overview": policies_status_overview(policies),
                "acquisition_loss_by_channel": acquisition_loss_by_channel(bi)}
    if name == "Retention":
        return {"kpis": retention_tiles(policies, customers),
                "lapse_by_policy_segment": lapse_by_policy_segment(bi),
                "product_performance": product_performance(bi),
                "lapse_by_customer_segment": lapse_by_customer_segment(customers),
                "early_default_split": early_default_split(policies)}
    if name == "Financial":
        return {"kpis": financial_tiles(policies),
                "channel_comparison": channel_comparison(bi),
                "expected_premium_by_product": sum_by(bi, "product_name", "expected_premium_value", "expected_premium"),
                "acquisition_cost_by_channel": acquisition_cost_by_channel(bi),
                "unrealised_by_product": sum_by(bi, "product_name", "unrealised_premium_value", "unrealised_premium")}
    raise ValueError(f"unknown dashboard {name!r}")


def _policy_sums() -> dict[str, Column]:
    """What the sheets over policies add up."""
    return {"n": F.count("policy_id"), "active": fx.count_where(kpi.is_status(K.ACTIVE)), "lapsed": lapsed_count(),
            "lapsed_after_grace": fx.count_where(kpi.is_status(K.LAPSED) & P("is_lapsed_after_grace")),
            "early_defaulted": fx.count_where(kpi.is_status(K.LAPSED) & P("is_early_defaulted")),
            "cost": F.sum("cost_spent"), "lapsed_cost": F.sum(kpi.lapsed_cost()),
            "cost_at_risk": F.sum(F.when(kpi.is_status(K.LAPSED), P("cost_spent"))),
            "received": F.sum("total_premium_received"), "expected": F.sum("expected_premium_value"),
            "unrealised": F.sum("unrealised_premium_value")}


def _tile(name: str, value: Column) -> tuple[str, str, Column]:
    return name, "value", value


def _customer_sums() -> dict[str, Column]:
    return {"n": F.count("customer_id"), "renewed": fx.count_where(P("is_renewed_customer")),
            "active": fx.count_where(kpi.is_status("Active", "customer_latest_status")), "rows": F.count(F.lit(1)),
            "lapsed": fx.count_where(kpi.is_status("Lapsed", "customer_latest_status"))}


def _share(part: str, whole: str = "n") -> Column:
    return fx.percent(P(part), P(whole))


def dashboard(name: str, bi: DataFrame, customers: DataFrame, events: DataFrame, as_of: dt.date) -> DataFrame:
    """The sheets of one dashboard as rows ``(dashboard, sheet, label,
    measure, value)``.  Each layer is read once: one grouping-sets aggregate
    over the policies and one over the customers; the renewal tile gets each
    policy's renewal from the events by a join on their distinct policies."""
    cells = lambda **measures: tuple((None, m, c) for m, c in measures.items())
    policy = lambda sheets, df=bi, **kw: sheet_rows(df, name, sheets, "policy_id", _policy_sums(), **kw)
    customer = lambda sheets: sheet_rows(customers, name, sheets, "customer_id", _customer_sums())
    remaining = P("expected") - P("received") - P("unrealised")
    if name == "Executive":
        renewed = kpi.renewed_policy_ids(events).select(P("policy_id").alias("__renewed_id"))
        known = bi.join(renewed, P("policy_id") == P("__renewed_id"), "left")
        due = kpi.renewal_due(as_of)
        rate = fx.rate(P("__due_renewed"), P("__due")) / 100
        return policy([
            Sheet("kpis", (_tile("persistency_ratio", _share("active")), _tile("total_premium_received_cr", fx.to_crore(P("received"))))),
            Sheet("kpis", (_tile("policy_renewal_rate", rate),), per_key=True),
            Sheet("premium_composition", ((K.PREMIUM_COLLECTED, "amount", fx.money(P("received"))),
                                          (K.PREMIUM_UNREALISED, "amount", fx.money(P("unrealised"))),
                                          (K.PREMIUM_REMAINING, "amount", fx.money(remaining)))),
            Sheet("policies_status_overview", cells(policies=P(N_KEYS)), "latest_status", per_key=True),
            Sheet("acquisition_loss_by_channel", cells(acquisition_loss=fx.money(P("lapsed_cost"))), "channel_name"),
        ], known, per_key={"__due": F.max(fx.flag(due).cast("int")),
                           "__due_renewed": F.max(fx.flag(due & P("__renewed_id").isNotNull()).cast("int"))}).unionByName(customer([
            Sheet("kpis", (_tile("customer_renewal_rate", _share("renewed")),)),
            Sheet("customer_status_distribution", cells(customers=P(N_KEYS)), "customer_latest_status", per_key=True)]))
    if name == "Retention":
        return policy([
            Sheet("kpis", (_tile("grace_period_lapse", _share("lapsed_after_grace")),
                           _tile("early_default_rate", fx.fraction(P("early_defaulted"), P("n"))),
                           _tile("total_lapsed_policies", P("lapsed")))),
            Sheet("lapse_by_policy_segment", cells(lapse_rate=_share("lapsed")), "tenure_bucket"),
            Sheet("product_performance", cells(persistency_ratio=_share("active"), lapse_rate=_share("lapsed")), "product_name"),
            Sheet("early_default_split", cells(total_lapsed_policies=P("lapsed")), "early_default_status"),
        ], bi.withColumn("early_default_status", early_default_label())).unionByName(customer([
            Sheet("kpis", (_tile("total_active_customers", P("active")),)),
            Sheet("lapse_by_customer_segment", cells(lapse_rate=fx.fraction(P("lapsed"), P("rows"))), "age_bucket")]))
    if name == "Financial":
        return policy([
            Sheet("kpis", (_tile("acquisition_cost_at_risk_cr", fx.to_crore(P("cost_at_risk"))),
                           _tile("remaining_collectable_premium_cr", fx.to_crore(remaining)),
                           _tile("total_expected_premium_cr", fx.to_crore(P("expected"))),
                           _tile("total_unrealised_premium_cr", fx.to_crore(P("unrealised"))))),
            Sheet("channel_comparison", cells(policies=P(N_KEYS), persistency_ratio=_share("active"),
                                              acquisition_loss=fx.money(P("lapsed_cost"))), "channel_name", per_key=True),
            Sheet("acquisition_cost_by_channel", cells(acquisition_cost_spent=fx.money(P("cost"))), "channel_name"),
            Sheet("expected_premium_by_product", cells(expected_premium=fx.money(P("expected"))), "product_name"),
            Sheet("unrealised_by_product", cells(unrealised_premium=fx.money(P("unrealised"))), "product_name"),
        ])
    raise ValueError(f"unknown dashboard {name!r}")
