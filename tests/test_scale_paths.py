"""Scale-related paths: exact statistics of large groups, results that do not
depend on the layout, and policies holding a third of all rows."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lapsewise.operators import clean as C
from lapsewise.operators import features as E
from lapsewise.sources.adapter import previous_status


@pytest.mark.parametrize("parts", [2, 16])
def test_group_median_is_exact_above_a_million_values(spark, parts):
    n = 1_200_001
    value = (F.col("id") * 7919 % 1_000_003).cast("decimal(18,2)") / 100
    df = spark.range(n, numPartitions=parts).select(F.lit("hot").alias("g"), value.cast("decimal(18,2)").alias("x"))
    df = df.union(spark.createDataFrame([("small", Decimal("3.00")), ("small", Decimal("1.00")), ("none", None), (None, Decimal("5.00"))],
                                        "g string, x decimal(18,2)"))
    got = {r["g"]: r["__fill"] for r in C.group_median(df, "x", "g").collect()}
    ordered = sorted(i * 7919 % 1_000_003 for i in range(n))
    assert got == {"hot": Decimal(ordered[(n + 1) // 2 - 1]) / 100, "small": Decimal("1.00"), None: Decimal("5.00")}


def test_group_mode_takes_the_lowest_of_equals(spark):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", "y"), ("a", "x"), ("a", None), ("b", None), (None, "q")], "g string, v string")
    assert {r["g"]: r["__fill"] for r in C.group_mode(df, "v", "g").collect()} == {"a": "x", None: "q"}


def test_payments_survivor_does_not_depend_on_the_layout(spark):
    from lapsewise.plans.cleaning import clean_payments
    rows = [(i % 40, 1 if i % 3 == 0 else i % 7, 19950101, Decimal(i * 37 % 101), "O", i % 2, 0) for i in range(900)]
    schema = "payment_id long, policy_id long, date_id int, premium_amount decimal(18,2), payment_status string, is_missed int, is_in_grace_period int"
    keys = spark.range(5).withColumnRenamed("id", "policy_id")
    layers = [sorted(map(tuple, clean_payments(spark.createDataFrame(r, schema).repartition(p), keys).collect()))
              for r, p in ((rows, 3), (rows[::-1], 11))]
    assert layers[0] == layers[1] and len({r[:3] for r in layers[0]}) == len(layers[0])


def test_hot_policy_is_split_in_the_orphan_join(spark):
    from lapsewise.plans.cleaning import clean_payments
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 60_000
        pay = spark.range(n).select(F.col("id").alias("payment_id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("policy_id"),
                                    F.lit(19950101).alias("date_id"), F.col("id").cast("decimal(18,2)").alias("premium_amount"),
                                    F.lit("O").alias("payment_status"), F.lit(0).alias("is_missed"), F.lit(0).alias("is_in_grace_period"))
        out = clean_payments(pay, spark.range(5000).withColumnRenamed("id", "policy_id"))
        assert len(out.collect()) == n
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_hot_policy_payment_median_matches_brute_force(spark):
    rnd = random.Random(3)
    d0 = dt.date(2001, 1, 1)
    days = [d0 + dt.timedelta(days=i) for i in range(1500)]
    cal = spark.createDataFrame([(int(d.strftime("%Y%m%d")), d) for d in days], "date_id int, date date")
    rows = []
    for pid in range(1, 61):                      # 60 ordinary policies, 3-12 payments each
        for _ in range(rnd.randint(3, 12)):
            d = days[rnd.randrange(len(days))]
            rows.append((pid, int(d.strftime("%Y%m%d")), Decimal("10.00"), False))
    hot = len(rows) // 2                          # policy 0 gets a third of all rows
    for _ in range(hot):
        d = days[rnd.randrange(200)]              # many same-day repeats
        rows.append((0, int(d.strftime("%Y%m%d")), Decimal("1.00"), rnd.random() < 0.1))
    pay = spark.createDataFrame(rows, "policy_id long, date_id int, premium_amount decimal(18,2), "
                                      "is_invalid_amount boolean")
    got = {r["policy_id"]: r["avg_payment_gap"] for r in E.payment_summary(pay, cal).collect()}

    by = {}
    for pid, did, _, _ in rows:
        by.setdefault(pid, []).append(dt.datetime.strptime(str(did), "%Y%m%d").date())
    for pid, ds in by.items():
        ds.sort()
        gaps = sorted((b - a).days for a, b in zip(ds, ds[1:]))
        want = gaps[(len(gaps) + 1) // 2 - 1] if gaps else None
        assert got[pid] == want, pid
    hist = {r["payment_gap_days"]: r["n_gaps"] for r in E.gap_histogram(pay, cal).collect()}
    assert sum(hist.values()) == len(rows) - len(by)


def test_previous_status_matches_lag_with_a_hot_policy(spark):
    rows = [(0 if i % 3 == 0 else i % 97, 19950101 + i // 7 % 28 + 100 * (i // 500), i, None if i % 11 == 0 else f"s{i % 5}") for i in range(3000)]
    df = spark.createDataFrame(rows, "policy_id long, date_id int, event_id long, current_status string")
    got = previous_status(df)
    lag = F.lag("current_status").over(Window.partitionBy("policy_id").orderBy("date_id", "event_id"))
    want = df.withColumn("previous_status", lag).select(*got.columns)
    assert got.count() == 3000
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_previous_status_keeps_events_without_policy_or_date(spark):
    rows = [(None, 19950101, 1, "a"), (None, 19950201, 2, "b"), (5, None, 3, "c"), (5, 19950101, 4, "d"), (5, 19950102, 5, "e")]
    got = previous_status(spark.createDataFrame(rows, "policy_id long, date_id int, event_id long, current_status string")).collect()
    assert {r["event_id"]: r["previous_status"] for r in got} == {1: None, 2: "a", 3: None, 4: "c", 5: "d"} and len(got) == 5
