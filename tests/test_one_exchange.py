"""Rows of a table without heavy keys are shuffled once where a step used to shuffle them again, and give the same rows."""

import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from lapsewise.functions import constants as K
from lapsewise.operators import clean as C
from lapsewise.operators import features as E
from lapsewise.operators import ordered
from lapsewise.plans import cleaning, pipeline
from lapsewise.session import shared_dir
from lapsewise.sources import adapter


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def without_broadcast(spark, make):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        return make()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def payments(spark, policy):
    """Every payment twice, the later copy with other values, one in five of a policy that doesn't exist."""
    copy, amount = F.expr("1 + place div 4000"), F.when(F.col("place") < 4000, F.col("id") % 90 - 5).otherwise(7)
    return spark.range(8000).select((F.col("id") % 4000).alias("id"), F.col("id").alias("place")).select(
        F.col("id").alias("payment_id"), policy.cast("long").alias("policy_id"), F.lit(20200101).alias("date_id"),
        amount.cast("decimal(18,2)").alias("premium_amount"), F.lit("F").alias("payment_status"),
        (F.col("id") % 2).cast("int").alias("is_missed"), F.lit(0).alias("is_in_grace_period"),
        copy.alias("l_partkey"), F.lit(1).cast("long").alias("l_suppkey"), F.lit(1).alias("l_shipdate"))


def test_payments_are_shuffled_once(spark):
    pay, policies = payments(spark, F.col("id") % 1000), spark.range(800).select(F.col("id").alias("policy_id"))
    # one exchange of the payments, one of the policies' keys
    assert without_broadcast(spark, lambda: exchanges(cleaning.clean_payments(pay, policies))) == 2
    got = cleaning.clean_payments(pay, policies)
    assert got.count() == 3200 and got.select("payment_id").distinct().count() == 3200
    assert got.where(F.col("premium_amount") != F.col("payment_id") % 90 - 5).count() == 0


def test_a_heavy_or_null_policy_gives_the_same_payments(spark):
    policy = F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 1000)
    pay, policies = payments(spark, policy), spark.range(800).select(F.col("id").alias("policy_id"))
    assert ordered.heavy_keys(pay, "policy_id", 8) == [5]
    known = pay.where("l_partkey = 1 and policy_id < 800")
    got = cleaning.clean_payments(pay, policies)
    columns = ["payment_id", "policy_id", "premium_amount"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, known.select(columns).collect()))


def test_previous_without_heavy_keys_lands_nothing(spark):
    df = spark.range(4000).select((F.col("id") % 500).alias("k"), (F.col("id") * 7919 % 4000).alias("o"), F.col("id").alias("v"))
    at = f"{shared_dir(spark).removeprefix('file:')}/lapsewise-slices"
    before = set(os.listdir(at)) if os.path.exists(at) else set()
    got = ordered.previous(df, "k", ["o"], {"p": "v"})
    assert (set(os.listdir(at)) if os.path.exists(at) else set()) == before and exchanges(got) == 1
    want = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("o")))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_null_keys_count_as_a_heavy_key(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"))
    assert ordered.heavy_keys(df, "k", 8) == [] and ordered.heavy_keys(df, "k", 8, nulls=True) == [None]


def test_rows_are_not_dealt_by_the_group_of_their_median(spark):
    df = spark.range(3000).select("id", (F.col("id") % 3).alias("g"), F.when(F.col("id") % 7 > 0, F.col("id").cast("double")).alias("v"))
    filled = C.impute_group_median(df, "v", "g")
    assert exchanges(filled) == 0 and filled.where("v is null").count() == 0


def test_payment_days_are_shuffled_once_unless_a_policy_is_heavy(spark):
    dates = spark.range(40).select(F.col("id").cast("int").alias("date_id"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("date"))
    i = F.col("id")

    def days(policy):
        pay = spark.range(4000).select(policy.cast("long").alias("policy_id"), (i * 7 % 45).cast("int").alias("date_id"),
                                       (i % 90 - 5).cast("decimal(18,2)").alias("premium_amount"), (i % 90 < 5).alias("is_invalid_amount"))
        return pay, E.payment_days(pay, dates)

    even, heavy = i % 500, F.when(i % 3 == 0, 5).when(i % 7 == 0, None).otherwise(i % 500)
    assert exchanges(days(even)[1].groupBy("policy_id").count()) == 1
    assert exchanges(days(heavy)[1]) == 2
    for policy in (even, heavy):
        pay, got = days(policy)
        want = pay.join(dates, "date_id", "left").groupBy("policy_id", F.col("date").alias("d")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.expr("if(is_invalid_amount, null, premium_amount)")).alias("a"))
        gap = F.datediff("d", F.lag("d").over(Window.partitionBy("policy_id").orderBy("d")))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.withColumn("g", gap).toDF(*got.columns).collect()))


def test_policies_are_shuffled_once_for_the_refresh_and_their_features(spark, monkeypatch, tmp_path):
    plans, write = {}, pipeline.write_measured

    def record(df, root, name, **kw):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        write(df, root, name, **kw)

    monkeypatch.setattr(pipeline, "write_measured", record)
    raw = adapter.raw_tables(spark, "/root/testdata/sf0.001")
    model = without_broadcast(spark, lambda: pipeline.run_pipeline(spark, raw, str(tmp_path / "a"), K.FIXTURE_AS_OF))
    assert "Exchange" not in plans["clean/policies"]
    # a column that the features don't have keeps its place in the cleaned table
    raw["policies"] = raw["policies"].withColumn("note", F.concat(F.lit("n"), "policy_id"))
    wider = pipeline.run_pipeline(spark, raw, str(tmp_path / "b"), K.FIXTURE_AS_OF)
    assert wider["policies"].where("note = concat('n', policy_id)").count() == raw["policies"].count()
    for name in ("policies", "policy_features"):
        same, columns = model[name], model[name].columns
        assert same.exceptAll(wider[name].select(*columns)).count() == 0 == wider[name].select(*columns).exceptAll(same).count()
