"""Packed rows: sorted as structs are, read back as they were, chosen by hash aggregates."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lapsewise.operators import clean as C
from lapsewise.operators import features as E
from lapsewise.operators import packed
from lapsewise.plans import cleaning
from lapsewise.sources.io import write_layer

from .conftest import SF001

SCHEMA = "k long, i int, l long, b boolean, d date, t timestamp, w timestamp_ntz, m decimal(18,2), s string, empty int, nothing string"


def rows(n):
    rng = random.Random(7)
    maybe = lambda v: None if rng.random() < 0.15 else v
    return [(rng.randrange(40), maybe(rng.randrange(-3, 4)), maybe(rng.randrange(-50, 50)), maybe(rng.random() < 0.5),
             maybe(dt.date(1960, 1, 1) + dt.timedelta(rng.randrange(20000))),
             maybe(dt.datetime(1969, 12, 31) + dt.timedelta(seconds=rng.randrange(200000))),
             maybe(dt.datetime(1950, 3, 8) + dt.timedelta(microseconds=rng.randrange(-10**12, 10**12))),
             maybe(Decimal(rng.randrange(-999, 999)) / 100), maybe(rng.choice(["", "é", "z", "\U0001f600", "￮"])), None, None)
            for _ in range(n)]


@pytest.mark.parametrize("cols", [["w", "s", "b"], ["i", "m", "d", "t", "b", "s", "same", "empty", "nothing"], ["s", "l", "k", "d"], ["empty"], ["same", "k"]])
def test_packed_rows_read_back_and_sort_as_structs(spark, cols):
    df = spark.createDataFrame(rows(300), SCHEMA).select("*", F.lit("2001-01-01").cast("timestamp_ntz").alias("same"))
    packing = packed.fit(df, cols)
    both = df.select(F.struct(*cols).alias("row"), packing.pack().alias("p"))
    read = both.select("row", "p", F.struct(*[v.alias(c) for c, v in packing.unpack(F.col("p")).items()]).alias("back"))
    assert read.where("not (row <=> back)").count() == 0
    assert [f.dataType for f in read.schema["row"].dataType] == [f.dataType for f in read.schema["back"].dataType]
    assert [r["p"] for r in both.orderBy("row").collect()] == sorted(r["p"] for r in both.collect())


def test_what_cannot_be_packed(spark):
    many = spark.range(packed.DICTIONARY + 1).select(F.col("id").cast("string").alias("s"))
    assert packed.fit(many, ["s"]) is None and packed.fit(many.limit(packed.DICTIONARY), ["s"])
    assert packed.fit(spark.range(3).select(F.col("id").cast("double").alias("x")), ["x"]) is None
    ends = spark.createDataFrame([(-(1 << 63), 0), ((1 << 63) - 1, 1)], "a long, b long")
    assert packed.fit(ends, ["a"]) is None
    far = spark.createDataFrame([(0, 0), (1 << 40, 1 << 30)], "a long, b long")
    assert packed.fit(far, ["a"]) and packed.fit(far, ["a", "b"]) is None


@pytest.mark.parametrize("other", ["m", "x"])
def test_survivors_equal_the_struct_form(spark, other):
    df = spark.createDataFrame(rows(400), SCHEMA).withColumn("x", F.col("m").cast("double"))  # a double can't be packed
    df = df.select("k", "i", "w", "d", "s", other).repartition(5)
    got = {r["k"]: tuple(r) for r in C.dedupe(df, ["k"], order=["w", "i"]).collect()}
    key = lambda r: tuple((v is not None, v.encode() if isinstance(v, str) else v) for v in (r["w"], r["i"], r["d"], r["s"], r[other]))
    want = {}
    for r in df.collect():
        if r["k"] not in want or key(r) < key(want[r["k"]]):
            want[r["k"]] = r
    assert got == {k: tuple(r) for k, r in want.items()}
    last = {r["k"]: r["s"] for r in C.latest_by(df, "k", "s", ["i", "d"]).collect()}
    newest = lambda r: tuple((v is not None, v.encode() if isinstance(v, str) else v) for v in (r["i"], r["d"], r["s"]))
    assert last == {k: max((r for r in df.collect() if r["k"] == k), key=newest)["s"] for k in want}


def test_nulls_ties_and_no_rows(spark):
    ev = spark.createDataFrame([(1, None, 1, "a"), (1, None, 2, None), (2, 5, 1, "b"), (2, 5, 1, "c"), (None, 1, 1, "d")],
                               "k long, date_id int, event_id long, s string")
    assert {r["k"]: r["s"] for r in C.latest_by(ev, "k", "s", ["date_id", "event_id"]).collect()} == {1: None, 2: "c", None: "d"}
    assert C.latest_by(ev.limit(0), "k", "s", ["date_id", "event_id"]).collect() == []
    assert C.dedupe(ev.limit(0), ["k"]).collect() == [] and C.dedupe(ev.select("k"), ["k"]).count() == 3


def test_newest_rows_take_hash_aggregates(spark):
    from lapsewise.plans import cleaning
    from lapsewise.plans.pipeline import materialize
    events = materialize(spark, SF001).events
    for df in (cleaning.latest_policy_status(events), E.customer_event_summary(events)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHash" not in plan


def test_packed_rest_is_two_longs_that_sort_as_the_columns(spark):
    """Rows cross a shuffle as their keys and two longs, and come back as they were; the smallest of a key is the same row."""
    rows = [(1, 7, 3, Decimal("1.50"), "O", None), (1, 7, None, Decimal("9.99"), None, True), (1, 7, 3, Decimal("-1.50"), "F", False),
            (2, None, 5, None, "O", True), (None, 7, 5, Decimal("0.00"), "F", None), (1, 7, 3, Decimal("1.50"), "O", None)]
    df = spark.createDataFrame(rows, "id long, policy long, tie int, amount decimal(18,2), status string, flag boolean") \
        .select("id", "amount", "policy", "tie", "status", "flag")
    small, read = C.packed_rest(df, ["id", "policy"], ["tie"])
    assert small.dtypes == [("id", "bigint"), ("policy", "bigint"), ("__order", "bigint"), ("__rest", "bigint")]
    assert read(small).dtypes == df.dtypes and sorted(map(repr, read(small).collect())) == sorted(map(repr, df.collect()))
    picked = read(C.dedupe(small, ["id", "policy"], order=["__order", "__rest"]))
    assert sorted(map(repr, picked.collect())) == sorted(map(repr, C.dedupe(df, ["id", "policy"], order=["tie"]).collect()))
    floats = df.withColumn("amount", df["amount"].cast("double"))  # no long holds a double
    same, read = C.packed_rest(floats, ["id", "policy"], ["tie"])
    assert same.columns == ["id", "policy", "tie", "amount", "status", "flag"] and read(same).columns == floats.columns


def test_payments_and_layers_take_fewer_bytes(spark, tmp_path):
    """Payments are shuffled as keys and two longs; layers are written with zstd."""
    rows = [(i * 10 + k, i, 20200101 + k, Decimal(i), "O", i % 2, 0, i * 3, i * 7, dt.date(2020, 1, 1 + k)) for i in range(1, 50) for k in range(3)]
    pay = spark.createDataFrame(rows, "payment_id long, policy_id long, date_id int, premium_amount decimal(18,2), payment_status string, "
                                      "is_missed int, is_in_grace_period int, l_partkey long, l_suppkey long, l_shipdate date")
    policies = pay.select("policy_id").where("policy_id < 40").distinct()
    out = cleaning.clean_payments(pay, policies)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "__order" in plan and "__rest" in plan
    got = {(r.payment_id, r.premium_amount, r.payment_status, r.is_missed_premium) for r in out.collect()}
    assert got == {(r[0], r[3], r[4], bool(r[5])) for r in rows if r[1] < 40}
    write_layer(out, str(tmp_path), "pay")
    assert list((tmp_path / "pay").glob("*.zstd.parquet"))
