"""Feature operators on hand-made rows (payment gap median, lapse dates, early default)."""

import datetime as dt
from decimal import Decimal

from lapsewise.operators import features as E


def dates(spark, days):
    rows = [(int(d.strftime("%Y%m%d")), d) for d in days]
    return spark.createDataFrame(rows, "date_id int, date date")


def test_payment_summary_median_matches_lag_form(spark):
    d0 = dt.date(2000, 1, 1)
    days = [d0 + dt.timedelta(days=i) for i in range(0, 800)]
    cal = dates(spark, days)
    def did(i):
        return int((d0 + dt.timedelta(days=i)).strftime("%Y%m%d"))
    pays = [
        # policy 1: same-day duplicates -> zeros dominate
        (1, did(0), Decimal("10.00"), False), (1, did(0), Decimal("10.00"), False), (1, did(0), Decimal("-5.00"), True),
        (1, did(30), Decimal("10.00"), False),
        # policy 2: gaps 30, 90, 365 -> lower median 90
        (2, did(0), Decimal("1.00"), False), (2, did(30), Decimal("1.00"), False), (2, did(120), Decimal("1.00"), False),
        (2, did(485), Decimal("1.00"), False),
        # policy 3: one payment -> no gap; policy 4: date missing from calendar
        (3, did(5), Decimal("7.00"), False), (4, 19000101, Decimal("3.00"), False), (4, did(10), Decimal("3.00"), False),
    ]
    p = spark.createDataFrame(pays, "policy_id long, date_id int, premium_amount decimal(18,2), is_invalid_amount boolean")
    got = {r["policy_id"]: (r["total_premium_received"], r["avg_payment_gap"])
           for r in E.payment_summary(p, cal).collect()}
    assert got[1] == (Decimal("30.00"), 0)
    assert got[2] == (Decimal("4.00"), 90)
    assert got[3] == (Decimal("7.00"), None)
    assert got[4] == (Decimal("6.00"), None)
    # the workload's own form: lag over each policy's rows, lower median
    rows = E.gap_rows(p, cal).collect()
    by = {}
    for r in rows:
        if r["payment_gap_days"] is not None:
            by.setdefault(r["policy_id"], []).append(r["payment_gap_days"])
    for pid, gaps in by.items():
        gaps.sort()
        assert gaps[(len(gaps) + 1) // 2 - 1] == got[pid][1]


def test_event_summary_first_lapse_and_grace(spark):
    cal = dates(spark, [dt.date(2000, 1, 1), dt.date(2000, 3, 1)])
    ev = spark.createDataFrame([
        (1, 20000301, "in_grace", "lapsed"), (1, 20000101, None, "lapsed"), (2, 20000501, "active", "lapsed"),
        (3, 20000101, None, "active")], "policy_id long, date_id int, previous_status string, current_status string")
    got = {r["policy_id"]: (r["first_lapsed_date"], r["is_lapsed_after_grace"]) for r in E.event_summary(ev, cal).collect()}
    assert got[1] == (dt.date(2000, 1, 1), True)
    assert got[2] == (None, False)        # lapse on a date missing from the calendar
    assert got[3] == (None, False)


def test_early_default_boundaries(spark):
    rows = [("lapsed", dt.date(2000, 1, 15), dt.date(2001, 1, 15)),   # exactly 12 months
            ("lapsed", dt.date(2000, 1, 15), dt.date(2001, 1, 16)),   # just over
            ("lapsed", dt.date(2000, 1, 15), dt.date(1999, 6, 1)),    # lapse before issue counts
            ("active", dt.date(2000, 1, 15), dt.date(2000, 2, 1)),
            ("lapsed", dt.date(2000, 1, 15), None)]
    df = spark.createDataFrame(rows, "latest_status string, issue_date date, first_lapsed_date date")
    assert [r[0] for r in df.select(E.early_defaulted()).collect()] == [True, False, True, False, False]
