"""The semi-join of a hot foreign key: same rows as a plain one, and no task with the hot key alone, without AQE's help."""

from pyspark.sql import functions as F

from lapsewise.operators.clean import drop_orphans, heavy_keys


def frames(spark):
    child = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.when(F.col("id") % 2 == 0, -9)).otherwise(F.col("id") % 5000).alias("k"), "id")
    parent = spark.range(0, 5000, 2).select(F.col("id").alias("k")).union(spark.createDataFrame([(7,), (7,), (None,)], "k long"))
    return child, parent


def test_same_rows_as_a_plain_semi_join(spark):
    child, parent = frames(spark)
    want = child.join(parent, "k", "left_semi")
    assert sorted(map(tuple, drop_orphans(child, parent, "k").collect())) == sorted(map(tuple, want.collect()))
    assert drop_orphans(child.limit(0), parent, "k").collect() == []
    assert drop_orphans(child, parent.limit(0), "k").collect() == []


def test_other_key_name_and_texts(spark):
    child = spark.createDataFrame([("a", 1)] * 50 + [("b", 2), (None, 3)], "k string, v int")
    parent = spark.createDataFrame([("a",), ("c",)], "name string")
    assert drop_orphans(child, parent, "k", "name").collect() == [("a", 1)] * 50


def test_hot_key_is_spread(spark):
    child, parent = frames(spark)
    assert 7 in heavy_keys(child, "k", 8)
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        kept = drop_orphans(child, parent, "k").withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in kept.where("k = 7").groupBy("task").count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert sum(sizes) == 10_002 and len(sizes) >= 5 and max(sizes) < 4_500
