"""Feature operators (stage 04).

Per-policy facts are computed as *one grouped aggregate per fact table*
(events → lapse date, grace lapse; payments → received amount, payment gap
median) and joined back once, instead of one window + join per feature.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as fx
from ..functions import constants as K
from . import ordered
from .clean import newest

MONEY = "decimal(22,2)"


# --- per-policy summaries -----------------------------------------------------

def event_summary(events: DataFrame, dates: DataFrame, key: str = "policy_id") -> DataFrame:
    """E8 + E14 in one aggregate: first calendar date of a lapse event (a lapse
    on a date missing from the calendar counts as no date) and whether any
    event went in_grace → lapsed."""
    cal = dates.select("date_id", F.col("date").alias("__event_date"))
    ev = events.select(key, "date_id", "previous_status", "current_status").join(cal, "date_id", "left")
    lapsed = F.col("current_status") == K.LAPSED
    after_grace = fx.flag((F.col("previous_status") == K.IN_GRACE) & lapsed)
    return ev.groupBy(key).agg(
        F.min(F.when(lapsed, F.col("__event_date"))).alias("first_lapsed_date"),
        F.max(after_grace).alias("is_lapsed_after_grace"),
    )


def payment_days(payments: DataFrame, dates: DataFrame, key: str = "policy_id", fit_on: DataFrame | None = None) -> DataFrame:
    """Payments combined per (policy, calendar day), with the gap in days to the
    policy's previous payment day.  Columns: key, ``__day`` (null when the
    date is missing from the calendar), ``__n`` payments, ``__amt`` valid
    amount, ``__gap``.

    The ordered window runs over distinct payment days only (bounded by the
    calendar).  Where no policy holds more than a partition's share of the
    payments, they are dealt by policy once, for the days, the window and what
    groups by policy after it.  Else a policy holding a large share is combined
    map-side first instead of becoming one huge sorted partition.  Heavy
    policies are looked for in ``fit_on`` if given: the rows of ``payments`` and
    maybe more, where ``payments`` itself is costly to make.
    """
    cal = dates.select("date_id", F.col("date").alias("__day"))
    p = payments.select(key, "date_id", "premium_amount", "is_invalid_amount").join(cal, "date_id", "left")
    p = p.select(key, "__day", F.when(~F.col("is_invalid_amount"), F.col("premium_amount")).alias("__valid"))
    if not ordered.heavy_keys(payments if fit_on is None else fit_on, key, ordered.partitions(payments), nulls=True):
        p = p.repartition(F.col(key))
    per_day = p.groupBy(key, "__day").agg(F.count(F.lit(1)).alias("__n"), F.sum("__valid").alias("__amt"))
    w = Window.partitionBy(key).orderBy("__day")
    return per_day.withColumn("__gap", F.datediff(F.col("__day"), F.lag("__day").over(w)))


def payment_summary(payments: DataFrame, dates: DataFrame, key: str = "policy_id", fit_on: DataFrame | None = None) -> DataFrame:
    """E2 + E16 + E17 in one pass.

    * ``total_premium_received`` — sum of amounts not flagged invalid.
    * ``avg_payment_gap`` — the lower median (rank ceil(n/2), as
      ``percentile_approx`` returns it) of the day gaps between consecutive
      payments of a policy ordered by payment date, invalid amounts included,
      payments whose date is missing from the calendar excluded.

    n payments on one day give n-1 gaps of 0 plus one gap to the previous
    day, so the median is read from the sorted day gaps and the zero count;
    the day-gap list is bounded by the calendar size.
    """
    s = payment_days(payments, dates, key, fit_on).groupBy(key).agg(
        F.sum("__amt").alias("__received"),
        F.sum(F.when(F.col("__day").isNotNull(), F.col("__n"))).alias("__rows"),
        F.count("__day").alias("__days"),
        F.sort_array(F.collect_list("__gap")).alias("__gaps"),
    )
    n_gaps = F.col("__rows") - 1
    rank = fx.idiv(n_gaps + 1, F.lit(2))
    zeros = F.col("__rows") - F.col("__days")
    median = (F.when(n_gaps.isNull() | (n_gaps < 1), F.lit(None))
              .when(rank <= zeros, F.lit(0))
              .otherwise(F.element_at("__gaps", (rank - zeros).cast("int"))))
    return s.select(key, F.col("__received").cast(MONEY).alias("total_premium_received"),
                    median.cast("int").alias("avg_payment_gap"))


def gap_histogram(payments: DataFrame, dates: DataFrame, key: str = "policy_id") -> DataFrame:
    """E16 summarised: how many consecutive-payment gaps have each length.
    Each payment day contributes its gap to the previous day (weight 1) and
    ``n - 1`` same-day zero gaps; one grouped sum over those weights."""
    d = payment_days(payments, dates, key).filter(F.col("__day").isNotNull())
    weighted = F.array(
        F.struct(F.col("__gap").alias("g"), F.lit(1).cast("long").alias("w")),
        F.struct(F.lit(0).alias("g"), (F.col("__n") - 1).cast("long").alias("w")))
    x = d.select(F.inline(weighted)).filter(F.col("g").isNotNull() & (F.col("w") > 0))
    return x.groupBy(F.col("g").alias("payment_gap_days")).agg(F.sum("w").alias("n_gaps"))


def gap_rows(payments: DataFrame, dates: DataFrame, key: str = "policy_id", tie: str | None = None) -> DataFrame:
    """E16 / J7 as rows: every payment whose date is in the calendar, with the
    days since the policy's payment before it (by date, then ``tie``: which of
    a day's payments has its gap to the day before).  No
    heavy policy is a group (``ordered.previous``)."""
    cal = dates.select("date_id", F.col("date").alias("payment_date"))
    seen = ordered.previous(payments.join(cal, "date_id", "inner"), key, ["payment_date", *([F.col(tie).asc_nulls_first()] if tie else [])],
                            {"__before": "payment_date"})
    return seen.withColumn("payment_gap_days", F.datediff("payment_date", "__before")).drop("__before")


# --- per-policy rule columns --------------------------------------------------

def renewal_eligible(as_of: dt.date) -> Column:
    """E1"""
    return fx.flag(fx.in_set("latest_status", K.RENEWAL_ELIGIBLE_STATUSES)
                   & (F.col("expiry_date") <= fx.date_lit(as_of)))


def expected_premium() -> Column:
    """Annual premium × tenure in years."""
    return (F.col("policy_premium") * F.col("policy_tenure")).cast(MONEY)


def unrealised_premium() -> Column:
    """Still-unpaid expected premium of lapsed/cancelled policies (may be
    negative when more was received than expected)."""
    return (F.when(fx.in_set("latest_status", K.UNREALISED_STATUSES),
                   F.col("expected_premium_value") - F.col("total_premium_received"))
            .otherwise(F.lit(0))).cast(MONEY)


def early_defaulted(months: int = K.EARLY_DEFAULT_MONTHS) -> Column:
    """E9 + E10: lapsed now and first lapsed within ``months`` of issue (a
    lapse dated before issue counts as early)."""
    m = F.months_between(F.col("first_lapsed_date"), F.col("issue_date"))
    return fx.flag((F.col("latest_status") == K.LAPSED) & (m <= months))


def policy_feature_columns(as_of: dt.date) -> list[tuple[str, Column]]:
    """E1, E3–E7, E9–E13, E15, E18 in dependency order."""
    st = F.col("latest_status")
    return [
        ("is_renewal_eligible", renewal_eligible(as_of)),
        ("total_premium_received", F.coalesce(F.col("total_premium_received"), F.lit(0)).cast(MONEY)),
        ("expected_premium_value", expected_premium()),
        ("unrealised_premium_value", unrealised_premium()),
        ("has_unrealised_value", fx.flag(fx.in_set(st, K.UNREALISED_STATUSES))),
        ("is_negative_unrealised", fx.flag(F.col("unrealised_premium_value") < 0)),
        ("tenure_bucket", fx.tenure_bucket()),
        ("is_early_defaulted", early_defaulted()),
        ("has_lapsed_date", F.col("first_lapsed_date").isNotNull()),
        ("is_graced", fx.flag(F.col("total_time_in_grace") > 0)),
        ("premium_bucket", fx.premium_bucket()),
        ("is_lapsed_after_grace", F.coalesce(F.col("is_lapsed_after_grace"), F.lit(False))),
        ("is_acquisition_at_risk", fx.flag((st == K.LAPSED) & (F.col("cost_spent") > F.col("total_premium_received")))),
        ("payment_frequency", fx.payment_frequency()),
    ]


def transition_counts(events: DataFrame) -> DataFrame:
    """E19 (and P10 with a filter): events per (previous, current) status."""
    return events.groupBy("previous_status", "current_status").agg(F.count(F.lit(1)).alias("n_events"))


# --- per-customer summaries ----------------------------------------------------

def customer_event_summary(events: DataFrame) -> DataFrame:
    """E20 + E22: newest event status over all the customer's policies (date,
    then event id) and whether any event was a renewal."""
    found, read = newest(events, "current_status", ["date_id", "event_id"])
    return events.groupBy("customer_id").agg(found, F.max(fx.flag(F.col("is_renewed_event"))).alias("__renewed")) \
        .select("customer_id", read.alias("__last_status"), "__renewed")


def customer_policy_summary(policy_features: DataFrame) -> DataFrame:
    """E21 + E23 in one aggregate."""
    return policy_features.groupBy("customer_id").agg(
        F.count("policy_id").alias("__n_policies"),
        F.sum("expected_premium_value").alias("__ltv"),
    )
