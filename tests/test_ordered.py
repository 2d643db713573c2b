"""Global order over slices, against plain windows on rows with hot and null keys and empty slices."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lapsewise.operators import ordered


def rows(spark):
    base = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 97 == 0, F.lit(None)).otherwise(F.col("id") % 50).alias("k"),
        (F.col("id") * 7919 % 3000).alias("o"), F.col("id").alias("v"))
    return base.union(spark.createDataFrame([(None, 5000, None), (8, 5001, None), (8, 5002, 1)], "k long, o long, v long"))


def test_previous_equals_lag(spark):
    df = rows(spark)
    want = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("o")))
    got = ordered.previous(df, "k", ["o"], {"p": "v"}, slice_rows=100)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_hot_key_spreads_over_slices(spark):
    df = spark.range(5000).select(F.lit(1).alias("k"), F.lit(1).alias("day"), "id")
    sliced = ordered.slices(df, ["k", "day"], slice_rows=250)
    sizes = [r["count"] for r in sliced.groupBy("__slice").count().collect()]
    assert len(sizes) >= 15 and max(sizes) < 1000


def test_rank_and_running_sum(spark):
    df = rows(spark).where("v is not null")
    got = ordered.ranked(df, ["o"], "r", slice_rows=100).collect()
    assert [x["o"] for x in sorted(got, key=lambda x: x["r"])] == sorted(x["o"] for x in got)
    assert sorted(x["r"] for x in got) == list(range(len(got)))
    sums, total = ordered.running(df, ["o"], "v", "s", slice_rows=100).collect(), 0
    for x in sorted(sums, key=lambda x: x["o"]):
        assert x["s"] == total
        total += x["v"]


def test_empty(spark):
    df = spark.createDataFrame([], "k long, o long, v long")
    assert ordered.previous(df, "k", ["o"], {"p": "v"}).collect() == []
    assert ordered.ranked(df, ["o"], "r").collect() == [] and ordered.running(df, ["o"], "v", "s").collect() == []


def test_gap_rows_of_a_hot_policy(spark):
    """A policy with a third of all payments, many of them on one day, against a plain window."""
    from lapsewise.operators.features import gap_rows

    pay = spark.range(6000).select(F.col("id").alias("payment_id"), F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 40).alias("policy_id"),
                                   F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id") * 13 % 700).cast("int").alias("date_id"))
    dates = spark.range(650).select(F.col("id").cast("int").alias("date_id"), F.expr("date_add(DATE'2020-01-01', CAST(id AS INT))").alias("date"))
    lag = F.lag("date").over(Window.partitionBy("policy_id").orderBy("date", "payment_id"))
    want = pay.join(dates, "date_id").select("payment_id", F.datediff("date", lag).alias("gap"))
    got = gap_rows(pay, dates, tie="payment_id").select("payment_id", "payment_gap_days")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
