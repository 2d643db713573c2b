"""Fixed values of the retention domain.

These literals must equal the analysed workload's for results to match, so
they are stated here once, plainly, in their natural order.
"""

from __future__ import annotations

import datetime as _dt

# --- fixed values: policy status domain -----------------------------------
ACTIVE = "active"
IN_GRACE = "in_grace"
LAPSED = "lapsed"
CANCELLED = "cancelled"
CLAIMED = "claimed"
MATURED = "matured"
UNKNOWN_STATUS = "unknown status"
POLICY_STATUSES = (ACTIVE, IN_GRACE, LAPSED, CANCELLED, CLAIMED, MATURED, UNKNOWN_STATUS)

RENEWAL_ELIGIBLE_STATUSES = (ACTIVE, CLAIMED, MATURED)
UNREALISED_STATUSES = (LAPSED, CANCELLED)

# customer status = initcap of the newest event status, or this default
NO_POLICY = "No Policy"
CUSTOMER_STATUSES = ("Active", "In_grace", "Lapsed", "Cancelled", "Claimed", "Matured", NO_POLICY)

# --- fixed values: cleaning defaults ----------------------------------------
UNKNOWN_OCCUPATION = "Unknown Occupation"
DEFAULT_INCOME_BRACKET = "3L-30L"
DEFAULT_AGENT_CHANNEL = 1
AGENT_BY_CHANNEL = ((2, "Sold by Direct Sales"), (3, "Sold by Digital Sales"))
UNKNOWN_AGENT = "Unknown Agent"
MIN_VALID_AGE = 18
MAX_VALID_AGE = 90
UNRELIABLE_PREMIUM_BELOW = 250
EXPLORATION_LOW_PREMIUM_BELOW = 500

# --- fixed values: feature buckets (labels verbatim, including the doubled
# space in the two lowest labels and the en dashes of the age labels) --------
TENURE_BUCKETS = (  # (lower bound inclusive, label), highest first
    (20, "Long Term (20-30 Yrs)"),
    (10, "Mid Term (10-15 Yrs)"),
)
TENURE_DEFAULT = "Short Term  (1-5 Yrs)"

PREMIUM_VERY_HIGH_ABOVE = 50000
PREMIUM_BUCKETS = (  # (lower bound inclusive, label), below the very-high cut
    (20000, "High (₹20k - ₹50k)"),
    (5000, "Medium (₹5k - ₹19k)"),
)
PREMIUM_VERY_HIGH = "Very High (> ₹50k)"
PREMIUM_DEFAULT = "Short Term  (< ₹5k)"

AGE_UNREALISTIC = "Unrealistic (<18 or >90)"
AGE_BUCKETS = (  # (low inclusive, high inclusive, label)
    (18, 30, "Young (18–30)"),
    (31, 40, "Early Career (31–40)"),
    (41, 50, "Mid Career (41–50)"),
    (51, 65, "Senior (51–65)"),
)
AGE_ELDER_ABOVE = 65
AGE_ELDER = "Elder (65+)"
AGE_UNKNOWN = "Unknown"

PAYMENT_FREQUENCIES = (  # (min gap days, max gap days, label)
    (28, 32, "Monthly"),
    (85, 95, "Quarterly"),
    (175, 190, "Semi Annual"),
    (350, 380, "Annual"),
)
IRREGULAR = "Irregular"

EARLY_DEFAULT_MONTHS = 12

# --- fixed values: dashboard labels -----------------------------------------
EARLY_DEFAULTED = "Early Defaulted"
NOT_EARLY_DEFAULT = "Not Early Default"
PREMIUM_COLLECTED = "Collected"
PREMIUM_UNREALISED = "Unrealised"
PREMIUM_REMAINING = "Remaining Collectable"
CRORE = 10_000_000

# as-of date of the analysed workload; tests over the driver tables use
# FIXTURE_AS_OF (their dates end in 2001)
REFERENCE_AS_OF = _dt.date(2026, 6, 30)
FIXTURE_AS_OF = _dt.date(2000, 6, 30)
