"""Checks measured by a layer's write: equal to counting the layer, also when it is empty, and no scan of their own."""

import re
import uuid

from pyspark.sql import functions as F

from lapsewise.plans.queries import REGISTRY
from lapsewise.sources.io import read_layer
from lapsewise.sources.measured import read_checks, table_checks, write_measured

from .conftest import SF001


def root(spark):
    return f"{spark.sparkContext.getCheckpointDir()}/measured-{uuid.uuid4().hex}"


def by_check(df):
    return {(r["check_name"], r["table_name"], r["column_name"]): r["value"] for r in df.collect()}


def test_checks_equal_counts_of_the_layer(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 7 != 0, F.col("id")).alias("x"), (F.col("id") % 3 == 0).alias("third")).repartition(5, "x")
    path, flags, rules = root(spark), {"third": F.col("id") % 6 == 0}, {"large": F.col("x") > 900}
    write_measured(df, path, "clean/t", flags=flags, rules=rules)
    got = by_check(read_checks(spark, path, ["clean/t"]))
    layer = read_layer(spark, path, "clean/t")
    wide = layer.agg(*[c.alias(f"m{i}") for i, c in enumerate(table_checks(layer, flags, rules).values())]).first()
    assert got == {(k, "t", c): wide[i] for i, (k, c) in enumerate(table_checks(layer, flags, rules))}
    assert got["row_count", "t", None] == 1000 and got["null_count", "t", "x"] == 143 and got["flag_set", "t", "third"] == 334
    assert got["flag_missing", "t", "third"] == 0 and got["rule_violations", "t", "large"] == 85


def test_wrong_flag_is_counted(spark):
    path = root(spark)
    write_measured(spark.range(10).select("id", F.lit(False).alias("even")), path, "t", flags={"even": F.col("id") % 2 == 0})
    assert by_check(read_checks(spark, path, ["t"]))["flag_missing", "t", "even"] == 5


def test_empty_table(spark):
    path = root(spark)
    write_measured(spark.createDataFrame([], "a int, b boolean"), path, "t", rules={"r": F.col("a") > 0})
    assert set(by_check(read_checks(spark, path, ["t"])).values()) == {0}


def test_report_scans_layers_for_duplicates_and_orphans_only(spark):
    report = REGISTRY["quality_report"](spark, SF001)
    read = set(re.findall(r"ReadSchema: struct<([^>]*)>", report._jdf.queryExecution().executedPlan().toString()))
    columns = {c.partition(":")[0] for schema in read for c in schema.split(",")}
    assert columns == {"check_name", "table_name", "column_name", "value", "customer_id", "agent_id", "date", "policy_id", "event_id",
                       "payment_id", "date_id", "channel_id"}  # keys, and the stored numbers
    tables = {r["table_name"] for r in report.where("check_name = 'row_count'").collect()}
    assert tables == {"customers", "agents", "channels", "products", "dates", "policies", "policy_events", "premium_payments",
                      "policy_features", "customer_features"}
