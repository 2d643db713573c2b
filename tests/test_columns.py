"""Column helpers: exact rounding, bucket boundaries, flags."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from lapsewise.functions import columns as fx
from lapsewise.functions import constants as K


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def test_rate_half_up_and_zero_denominator(spark):
    assert one(spark, fx.rate(F.lit(1), F.lit(3))) == 33.33
    assert one(spark, fx.rate(F.lit(2), F.lit(3))) == 66.67
    # 107 / 4000 = 2.675 % exactly: half-up, not binary-float rounding
    assert one(spark, fx.rate(F.lit(107), F.lit(4000))) == 2.68
    assert one(spark, fx.rate(F.lit(0), F.lit(7))) == 0.0
    assert one(spark, fx.rate(F.lit(5), F.lit(0))) is None


def test_round_ratio_negative_and_large(spark):
    assert one(spark, fx.round_ratio(F.lit(-5), F.lit(2), 0)) == -3.0
    big = F.lit(Decimal("123456789012345678901234")).cast("decimal(38,0)")
    assert one(spark, fx.round_ratio(big, F.lit(10**18), 2)) == 123456.79


def test_buckets_boundaries(spark):
    rows = [(a,) for a in (None, 17, 18, 30, 31, 40, 41, 50, 51, 65, 66, 90, 91)]
    df = spark.createDataFrame(rows, "customer_age int").select("customer_age", fx.age_bucket().alias("b"))
    got = {r["customer_age"]: r["b"] for r in df.collect()}
    assert got[None] == K.AGE_UNKNOWN
    assert got[17] == got[91] == K.AGE_UNREALISTIC
    assert got[18] == got[30] == "Young (18–30)"
    assert got[31] == "Early Career (31–40)" and got[41] == "Mid Career (41–50)"
    assert got[51] == got[65] == "Senior (51–65)"
    assert got[66] == got[90] == K.AGE_ELDER

    prem = [(Decimal(x),) for x in ("249.99", "4999.99", "5000", "19999.99", "20000", "50000", "50000.01")]
    df = spark.createDataFrame(prem + [(None,)], "policy_premium decimal(18,2)")
    got = {r[0]: r[1] for r in df.select("policy_premium", fx.premium_bucket()).collect()}
    assert got[Decimal("4999.99")] == got[None] == K.PREMIUM_DEFAULT
    assert got[Decimal("5000.00")] == got[Decimal("19999.99")] == "Medium (₹5k - ₹19k)"
    assert got[Decimal("20000.00")] == got[Decimal("50000.00")] == "High (₹20k - ₹50k)"
    assert got[Decimal("50000.01")] == K.PREMIUM_VERY_HIGH

    ten = spark.createDataFrame([(t,) for t in (None, 5, 9, 10, 19, 20)], "policy_tenure int")
    got = {r[0]: r[1] for r in ten.select("policy_tenure", fx.tenure_bucket()).collect()}
    assert got[None] == got[5] == got[9] == K.TENURE_DEFAULT
    assert got[10] == got[19] == "Mid Term (10-15 Yrs)" and got[20] == "Long Term (20-30 Yrs)"


def test_payment_frequency_edges(spark):
    gaps = [None, 27, 28, 32, 33, 85, 95, 175, 190, 350, 380, 381]
    df = spark.createDataFrame([(g,) for g in gaps], "avg_payment_gap int")
    got = {r[0]: r[1] for r in df.select("avg_payment_gap", fx.payment_frequency()).collect()}
    assert got[None] == got[27] == got[33] == got[381] == K.IRREGULAR
    assert got[28] == got[32] == "Monthly" and got[85] == got[95] == "Quarterly"
    assert got[175] == got[190] == "Semi Annual" and got[350] == got[380] == "Annual"


def test_flag_null_is_false(spark):
    assert one(spark, fx.flag(F.lit(None).cast("boolean"))) is False
    assert one(spark, fx.date_lit(dt.date(2000, 6, 30))) == dt.date(2000, 6, 30)
