"""The two feature builders on hand-made cleaned rows: the edge cases the
test plan lists (no events, no payments, reinstated after a lapse, expiry on
the as-of date, customer without policies, ties on one day)."""

import datetime as dt
from decimal import Decimal

from lapsewise.functions import constants as K
from lapsewise.plans.features import (CUSTOMER_FEATURE_COLUMNS, POLICY_FEATURE_COLUMNS, build_customer_features,
                                      build_policy_features)

AS_OF = dt.date(2000, 6, 30)
D = dt.date


def did(d):
    return int(d.strftime("%Y%m%d"))


def test_feature_builders_edge_rows(spark):
    pol_schema = ("policy_id long, policy_number string, customer_id long, product_id int, channel_id int, "
                  "agent_id string, policy_value decimal(18,2), policy_tenure int, policy_premium decimal(18,2), "
                  "latest_status string, issue_date date, expiry_date date, is_current_policy boolean, "
                  "cost_spent decimal(18,2), total_time_in_grace int, issue_year int, is_loss_making_policy boolean, "
                  "is_unreliable_premium boolean, is_future_date boolean, is_invalid_date_range boolean")
    m = Decimal
    policies = spark.createDataFrame([
        # 1: no events, no payments, expires exactly on the as-of date
        (1, "P1", 10, 1, 1, "A1", m("1000"), 5, m("100"), "active", D(1995, 6, 30), AS_OF, True, m("50"), 0, 1995,
         False, True, False, False),
        # 2: lapsed after grace, first lapse exactly 12 months after issue, cost above what was received
        (2, "P2", 10, 2, 2, "x", m("5000"), 10, m("5000"), "lapsed", D(1999, 1, 15), D(2009, 1, 15), False, m("900"),
         7, 1999, False, False, False, False),
        # 3: lapsed once then reinstated (active now)
        (3, "P3", 11, 3, 3, "y", m("100"), 20, m("60000"), "active", D(1998, 1, 1), D(2018, 1, 1), True, m("10"), 0,
         1998, False, False, False, False),
    ], pol_schema)
    days = [D(1999, 1, 15), D(2000, 1, 15), D(2000, 1, 16), D(2000, 2, 15), D(1998, 6, 1), D(1999, 1, 1)]
    dates = spark.createDataFrame([(did(d), d) for d in days], "date_id int, date date")
    events = spark.createDataFrame([
        (1, 2, 10, did(D(1999, 1, 15)), None, "active", False),
        (2, 2, 10, did(D(2000, 1, 15)), "active", "in_grace", False),
        (3, 2, 10, did(D(2000, 1, 15)), "in_grace", "lapsed", False),     # same day as the previous event
        (4, 3, 11, did(D(1998, 6, 1)), None, "lapsed", False),
        (5, 3, 11, did(D(1999, 1, 1)), "lapsed", "active", True),
    ], "event_id long, policy_id long, customer_id long, date_id int, previous_status string, current_status string, "
       "is_renewed_event boolean")
    payments = spark.createDataFrame([
        (2, did(D(1999, 1, 15)), m("400.00"), False),
        (2, did(D(2000, 1, 15)), m("-50.00"), True),
        (3, did(D(2000, 2, 15)), m("7.00"), False),
    ], "policy_id long, date_id int, premium_amount decimal(18,2), is_invalid_amount boolean")

    pf = build_policy_features(policies, payments, events, dates, AS_OF)
    assert pf.columns == POLICY_FEATURE_COLUMNS
    p = {r["policy_id"]: r for r in pf.collect()}
    assert p[1]["total_premium_received"] == 0 and p[1]["payment_frequency"] == K.IRREGULAR
    assert p[1]["is_renewal_eligible"] is True and p[1]["has_lapsed_date"] is False
    assert p[2]["total_premium_received"] == m("400.00")          # the invalid amount is not received
    assert p[2]["payment_frequency"] == "Annual"                   # its 365-day gap still counts
    assert p[2]["is_early_defaulted"] is True                      # exactly 12 months
    assert p[2]["is_lapsed_after_grace"] is True and p[2]["is_acquisition_at_risk"] is True
    assert p[2]["unrealised_premium_value"] == m("49600.00") and p[2]["tenure_bucket"] == "Mid Term (10-15 Yrs)"
    assert p[3]["has_lapsed_date"] is True and p[3]["is_early_defaulted"] is False   # reinstated: active now
    assert p[3]["premium_bucket"] == K.PREMIUM_VERY_HIGH and p[3]["unrealised_premium_value"] == 0

    customers = spark.createDataFrame([
        (10, "A", 30, "F", "X", "O", "3L-30L", False), (11, "B", 95, "M", "Y", "O", ">30L", True),
        (12, "C", None, "F", "Z", "O", "<3L", False),
    ], "customer_id long, customer_name string, customer_age int, customer_gender string, customer_city string, "
       "customer_occupation string, customer_income_bracket string, is_invalid_age boolean")
    cf = build_customer_features(customers, pf, events)
    assert cf.columns == CUSTOMER_FEATURE_COLUMNS
    c = {r["customer_id"]: r for r in cf.collect()}
    assert c[10]["customer_latest_status"] == "Lapsed" and c[10]["no_of_policies"] == 2
    assert c[10]["expected_lifetime_value"] == m("50500.00") and c[10]["is_renewed_customer"] is False
    assert c[11]["customer_latest_status"] == "Active" and c[11]["is_renewed_customer"] is True
    assert c[11]["age_bucket"] == K.AGE_UNREALISTIC
    assert c[12]["customer_latest_status"] == K.NO_POLICY and c[12]["no_of_policies"] == 0
    assert c[12]["expected_lifetime_value"] == 0 and c[12]["age_bucket"] == K.AGE_UNKNOWN
