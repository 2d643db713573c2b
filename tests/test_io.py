"""Sources and sinks: CSV raw scan with a declared schema, Parquet layers,
temp views queried with Spark SQL."""

import datetime as dt
from decimal import Decimal

from lapsewise.operators import kpi as Q
from lapsewise.sources import io


def test_csv_raw_scan_declared_and_inferred(spark, tmp_path):
    p = tmp_path / "policies.csv"
    p.write_text(
        "policy_id,policy_number,customer_id,product_id,channel_id,agent_id,policy_value,policy_tenure,"
        "policy_premium,latest_status,issue_date,expiry_date,is_current,cost_spent,total_time_in_grace,issue_year\n"
        "P1,N1,C1,1,1,A1,1000.50,5,200.25,active,2020-01-01,2025-01-01,1,10.00,0,2020\n"
        "P2,N2,C2,2,2,,500.00,10,,lapsed,2021-02-03,2031-02-03,0,,7,2021\n")
    df = io.read_raw(spark, str(p), "policies")
    rows = {r["policy_id"]: r for r in df.collect()}
    assert rows["P1"]["policy_value"] == Decimal("1000.50") and rows["P1"]["issue_date"] == dt.date(2020, 1, 1)
    assert rows["P2"]["policy_premium"] is None and rows["P2"]["agent_id"] is None
    inferred = io.read_raw(spark, str(p))
    assert inferred.count() == 2 and "policy_tenure" in inferred.columns


def test_layers_and_views(spark, tmp_path):
    df = spark.createDataFrame([(1, "active"), (2, "lapsed"), (3, "active")], "policy_id long, latest_status string")
    io.write_layer(df, str(tmp_path), "features/policies")
    back = io.read_layer(spark, str(tmp_path), "features/policies")
    assert sorted(back.collect()) == sorted(df.collect())
    io.register_views(spark, {"policies": back})
    sql = spark.sql("SELECT round(count_if(latest_status = 'active') * 100.0 / count(policy_id), 2) AS p FROM policies")
    assert float(sql.first()["p"]) == Q.persistency(back).first()["persistency_ratio"] == 66.67


def test_bi_extracts_written_as_csv(spark, tmp_path):
    from lapsewise.plans.pipeline import materialize, write_bi_extracts
    from lapsewise.sources import io as sio

    from .conftest import SF001
    m = materialize(spark, SF001)
    paths = write_bi_extracts(m, str(tmp_path))
    pol = sio.read_raw(spark, paths["policies"], inferSchema=False)
    assert pol.count() == m.policies.count() and "channel_name" in pol.columns and "product_category" in pol.columns
    prem = spark.read.option("header", True).csv(paths["premium_distribution"])
    assert sorted(r["premium_status"] for r in prem.collect()) == ["Collected", "Remaining Collectable", "Unrealised"]
