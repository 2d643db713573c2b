"""CSV quarantine: malformed records, values that don't parse, nulls and good rows; the pipeline over them."""

import uuid

from pyspark.sql import functions as F

from lapsewise.plans.pipeline import materialize_raw, run_from_csv
from lapsewise.sources import landing, schemas
from lapsewise.sources.measured import read_checks

from .conftest import SF001

TEXT = """policy_id,value,day,name,ok
1,10.5,2020-01-02,"a, b",true
2,,,,
3,x,2020-01-02,c,true
4,1.5,2020-02-30,d,maybe
5,1.5
6,1.5,2020-01-01,e,true,extra
7,123456789012345678.1,2020-01-01,f,false
"""


def test_rows_are_split_and_counted(spark, tmp_path):
    (tmp_path / "t.csv").write_text(TEXT)
    schema = spark.createDataFrame([], "policy_id long, value decimal(10,2), day date, name string, ok boolean").schema
    root = f"{spark.sparkContext.getCheckpointDir()}/landing-{uuid.uuid4().hex}"
    good = landing.land_csv(spark, str(tmp_path / "t.csv"), schema, root, "landed/t")
    assert good.schema == schema
    assert sorted(r["policy_id"] for r in good.collect()) == [1, 2]
    assert good.where("policy_id = 1").first()["name"] == "a, b" and good.where("policy_id = 2").first()["value"] is None
    bad = {r["__record"][0]: r["__reasons"] for r in landing.quarantined(spark, root, "landed/t").collect()}
    assert bad == {"3": ["value"], "4": ["day", "ok"], "5": ["malformed"], "6": ["malformed"], "7": ["value"]}
    checks = {(r["check_name"], r["column_name"]): r["value"] for r in read_checks(spark, root, ["landed/t"]).collect()}
    assert checks == {("landed", None): 7, ("good", None): 2, ("malformed", None): 2, ("uncastable", "policy_id"): 0, ("uncastable", "value"): 2,
                      ("uncastable", "day"): 1, ("uncastable", "ok"): 1}


def test_empty_file(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n")
    schema = spark.createDataFrame([], "a int, b string").schema
    root = f"{spark.sparkContext.getCheckpointDir()}/landing-{uuid.uuid4().hex}"
    assert landing.land_csv(spark, str(tmp_path / "t.csv"), schema, root, "landed/t").collect() == []
    assert {r["value"] for r in read_checks(spark, root, ["landed/t"]).collect()} == {0}


def test_pipeline_goes_on_with_the_good_rows(spark, tmp_path):
    paths = {}
    for name, df in materialize_raw(spark, SF001).items():
        paths[name] = str(tmp_path / name)
        cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.RAW[name].fields]
        df.select(*cols).write.option("header", True).csv(paths[name])
    spoiled = spark.read.csv(paths["customers"], header=True).limit(3).withColumn("customer_age", F.lit("old"))
    spoiled.withColumn("customer_id", F.concat(F.lit("bad-"), "customer_id")).coalesce(1).write.mode("append").option("header", True).csv(paths["customers"])
    model = run_from_csv(spark, paths, str(tmp_path / "layers"), quarantine=True)
    bad = landing.quarantined(spark, str(tmp_path / "layers"), "landed/customers")
    assert [r["__reasons"] for r in bad.collect()] == [["customer_age"]] * 3
    assert model["customers"].where("customer_id LIKE 'bad-%'").count() == 0
    assert model["customers"].count() == materialize_raw(spark, SF001)["customers"].count()
