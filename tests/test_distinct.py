"""Bitmap distinct counts: repeated, negative, zero, far and null keys; merging over slices; the plan."""

from pyspark.sql import functions as F

from lapsewise.operators import distinct as D


def frame(spark):
    odd = [("a", 0), ("a", -1), ("a", 1), ("b", -32768), ("b", -32767), ("b", 32768), ("b", 32769), ("a", 2**62), ("a", -(2**62)), ("c", None), (None, 5)]
    return spark.createDataFrame(odd * 3, "g string, k long").union(
        spark.range(100_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise("a"), F.col("id") * 7919 % 70_000 - 35_000)).withColumn("s", F.abs(F.hash("k", "g")) % 4)


def test_equal_to_count_distinct(spark):
    df = frame(spark)
    got = {r["g"]: r["n_distinct"] for r in D.count_keys(D.key_bitmaps(df, ["g"], {"k": "k"}), ["g"]).collect()}
    want = {r["g"]: r["n"] for r in df.groupBy("g").agg(F.count_distinct("k").alias("n")).collect()}
    assert want.pop("c") == 0 and got == want


def test_slices_merge(spark):
    df = frame(spark)
    slices = D.key_bitmaps(df, ["s", "g"], {"k": "k", "s": "s"})
    got = {(r["g"], r["name"]): r["n_distinct"] for r in D.count_keys(D.merge_bitmaps(slices, ["g"]), ["g"]).collect()}
    want = {}
    for r in df.groupBy("g").agg(F.count_distinct("k").alias("k"), F.count_distinct("s").alias("s")).collect():
        want |= {(r["g"], n): r[n] for n in ("k", "s") if r[n]}
    assert got == want
    assert D.count_keys(D.merge_bitmaps(slices, []), []).where("name = 'k'").first()["n_distinct"] == df.select("k").where("k IS NOT NULL").distinct().count()


def test_no_expand_and_one_exchange_per_aggregate(spark):
    plan = D.key_bitmaps(frame(spark).drop("s"), ["g"], {"k": "k"})._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Exchange") == 1
