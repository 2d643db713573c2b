"""Group medians by bracket refinement, against sorting, with few values left per group in the end."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lapsewise.operators.clean import _sketched, group_median, impute_group_median


def check(rows, df, finish):
    groups = defaultdict(list)
    for g, v in rows:
        if v is not None:
            groups[g].append(v)
    want = {g: sorted(vs)[(len(vs) + 1) // 2 - 1] for g, vs in groups.items()}
    got = group_median(df, "v", "g", finish=finish).collect()
    assert {r["g"]: r["__fill"] for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("finish", [1, 20, 100_000])
def test_hot_continuous_tied_and_null_groups(spark, finish):
    rng = random.Random(2)
    rows = [("hot", rng.random()) for _ in range(9000)]  # one group of nearly all rows, no value twice
    rows += [("ties", 5.0)] * 700 + [("ties", 5.0 + rng.random()) for _ in range(701)] + [("same", 3.0)] * 400
    rows += [(None, float(i % 7)) for i in range(50)] + [("one", -1.0), ("two", 1.0), ("two", 2.0), ("none", None)]
    check(rows, spark.createDataFrame(rows, "g string, v double").repartition(7), finish)


def test_dates_and_integers(spark):
    rows = [(i % 3, dt.date(2000, 1, 1) + dt.timedelta(days=i * 37 % 500)) for i in range(600)]
    check(rows, spark.createDataFrame(rows, "g int, v date"), 5)
    rows = [(1, i % 11 - 5) for i in range(3000)]
    check(rows, spark.createDataFrame(rows, "g int, v int"), 2)


def test_a_round_leaves_a_few_grid_steps(spark):
    df = spark.range(200_000).select(F.lit(1).alias("__by"), (F.col("id") * 7919 % 200_003).cast("double").alias("__v"))
    first = _sketched(df, None)
    second = _sketched(df, first.select(F.col("__by").alias("__of"), "__rank", F.col("__next_lo").alias("__lo"), F.col("__next_hi").alias("__hi")))
    assert second.first()["__inside"] <= 200_000 * 3.5 / 1000


def test_impute_and_empty(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, None), (None, 4.0), ("b", None)], "g string, v double")
    assert sorted(map(str, impute_group_median(df, "v", "g").collect())) == sorted(map(str, spark.createDataFrame(
        [("a", 1.0), ("a", 1.0), (None, 4.0), (None, 4.0), ("b", None)], "g string, v double").collect()))
    assert impute_group_median(df, "v", "g", global_fallback=True).where("v IS NULL").count() == 0
    assert group_median(df.limit(0), "v", "g").collect() == []
