"""Cleaning operators on hand-made rows: nulls, ties, all-null groups, orphans, duplicates."""

from decimal import Decimal

from pyspark.sql import functions as F

from lapsewise.operators import clean as C


def test_group_median_null_group_and_all_null_group(spark):
    rows = [(1, "a", 10), (2, "a", 20), (3, "a", None), (4, "a", 30), (5, None, 40), (6, None, None),
            (7, "b", None), (8, "c", 1), (9, "c", 2), (10, "c", None)]
    df = spark.createDataFrame(rows, "id int, occ string, age int")
    got = {r["id"]: r["age"] for r in C.impute_group_median(df, "age", "occ").collect()}
    assert got[3] == 20          # median of 10, 20, 30
    assert got[6] == 40          # null occupations form their own group
    assert got[7] is None        # all-null group stays null without fallback
    assert got[10] == 1          # even group: lower median (rank ceil(n/2))
    fb = {r["id"]: r["age"] for r in C.impute_group_median(df, "age", "occ", global_fallback=True).collect()}
    assert fb[7] == 10           # lower median of 1, 2, 10, 20, 30, 40


def test_group_mode_tie_lowest_then_default(spark):
    rows = [(1, "x", "b"), (2, "x", "a"), (3, "x", None), (4, "y", None), (5, "z", "c"), (6, "z", "c"),
            (7, "z", "a"), (8, "z", None)]
    df = spark.createDataFrame(rows, "id int, occ string, br string")
    got = {r["id"]: r["br"] for r in C.impute_group_mode(df, "br", "occ", "D").collect()}
    assert got[3] == "a" and got[4] == "D" and got[8] == "c" and got[1] == "b"


def test_impute_case_and_const(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, None), (1, "A7")], "ch int, agent string")
    out = C.impute_case(df, "agent", "ch", ((2, "direct"), (3, "digital")), "unknown")
    assert sorted(r["agent"] for r in out.collect()) == ["A7", "digital", "direct", "unknown"]
    filled = C.impute_const(spark.createDataFrame([(None,), (2,)], "ch int"), {"ch": 1})
    assert sorted(r["ch"] for r in filled.collect()) == [1, 2]


def test_drop_orphans_and_ordered_dedupe(spark):
    parent = spark.createDataFrame([(1,), (2,)], "policy_id long")
    child = spark.createDataFrame([(1, 10, Decimal("5.00"), 3), (1, 10, Decimal("6.00"), 1), (2, 11, None, 2),
                                   (9, 12, Decimal("1.00"), 1)], "policy_id long, pid long, amt decimal(18,2), o int")
    kept = C.drop_orphans(child, parent, "policy_id")
    assert kept.count() == 3
    d = C.dedupe(kept, ["policy_id", "pid"], order=["o"])
    got = {(r["policy_id"], r["pid"]): r["amt"] for r in d.collect()}
    assert got == {(1, 10): Decimal("6.00"), (2, 11): None}
    assert d.columns == child.columns


def test_latest_by_tie_break_and_refresh(spark):
    ev = spark.createDataFrame([(1, 20000101, 5, "active"), (1, 20000101, 7, "lapsed"), (1, 19990101, 9, "claimed"),
                                (2, 20000102, 1, "in_grace")], "policy_id long, date_id int, event_id long, s string")
    latest = C.latest_by(ev, "policy_id", "s", ["date_id", "event_id"], alias="new")
    pol = spark.createDataFrame([(1, "active"), (2, "active"), (3, "matured")], "policy_id long, st string")
    out = {r["policy_id"]: r["st"] for r in C.refresh_status(pol, latest, "st", "new", "policy_id", "unknown").collect()}
    assert out == {1: "lapsed", 2: "in_grace", 3: "unknown"}
    keep = C.refresh_status(pol, latest, "st", "new", "policy_id", "unknown", keep_original=True)
    assert {r["policy_id"]: r["st"] for r in keep.collect()}[3] == "matured"


def test_standardise_text_initcap_on_spaces_only(spark):
    df = spark.createDataFrame([("  in_grace ",), (" new delhi",)], "t string")
    assert sorted(r["t"] for r in C.standardise_text(df, ["t"]).collect()) == ["In_grace", "New Delhi"]
    assert C.add_flags(df, {"f": F.col("t").isNull()}).filter("f").count() == 0
