"""Exact mean and deviation: against Python's integers, and the same for any partitioning."""

import random
import statistics

from pyspark.sql import functions as F

from lapsewise.operators import profile


def test_deviation_is_exact_and_independent_of_partitions(spark):
    rng = random.Random(4)
    values = [10**15 + rng.randrange(-3, 4) for _ in range(4000)]  # a float merge loses this spread
    df = spark.createDataFrame([(v, v % 1000) for v in values], "x long, y int").withColumn("z", (F.col("y") / 4).cast("decimal(12,2)"))
    results = {tuple(map(str, profile.describe(df.repartition(n), "t", ["x", "y", "z"]).collect())) for n in (1, 3, 16)}
    assert len(results) == 1
    rows = {r["column_name"]: r for r in profile.describe(df, "t", ["x", "y", "z"]).collect()}
    assert rows["x"]["stddev"] == round(statistics.stdev(v - 10**15 for v in values), 6)
    assert rows["y"]["stddev"] == round(statistics.stdev(v % 1000 for v in values), 6)


def test_few_values(spark):
    df = spark.createDataFrame([(5, None, -1), (None, None, -1), (None, None, 3)], "one int, none long, two int")
    rows = {r["column_name"]: (r["n"], r["mean"], r["stddev"], r["min"]) for r in profile.describe(df, "t", ["one", "none", "two"]).collect()}
    assert rows == {"one": (1, 5.0, None, 5.0), "none": (0, None, None, None), "two": (3, 0.33, 2.309401, -1.0)}
