"""Layers whose schema has grown: added columns, widened types, misfits, and slices replaced alone."""

import uuid

import pytest

from lapsewise.sources import evolve
from lapsewise.sources.io import layer_path


def test_read_by_todays_contract(spark):
    root = f"{spark.sparkContext.getCheckpointDir()}/evolve-{uuid.uuid4().hex}"
    old = spark.createDataFrame([(1, 5, 1995), (2, 6, 1996), (3, 7, 1997)], "id int, n smallint, year int")
    new = spark.createDataFrame([(20, 1 << 40, "x", 1996)], "id long, n long, note string, year int")
    evolve.replace_slices(old, root, "t", ["year"])
    files = {f for f in spark.read.parquet(layer_path(root, "t")).inputFiles() if "1996" not in f}
    evolve.replace_slices(new, root, "t", ["year"], new.schema)
    assert files < set(spark.read.parquet(layer_path(root, "t")).inputFiles())  # the other years' files are the same
    got = evolve.read_evolved(spark, root, "t", new.schema)
    assert got.schema == new.schema
    assert sorted(map(tuple, got.collect())) == [(1, 5, None, 1995), (3, 7, None, 1997), (20, 1 << 40, "x", 1996)]
    with pytest.raises(ValueError, match="n: bigint is not within smallint"):
        evolve.read_evolved(spark, root, "t", old.schema)


def test_reconcile(spark):
    contract = spark.createDataFrame([], "a long, b decimal(12,2), c string").schema
    got = evolve.reconcile(spark.sql("SELECT CAST(1 AS DECIMAL(10,2)) AS b, 2 AS a"), contract)
    assert got.schema.simpleString() == contract.simpleString() and [tuple(map(str, r)) for r in got.collect()] == [("2", "1.00", "None")]
    for wrong in ("a string", "b decimal(12,3)", "d int"):
        with pytest.raises(ValueError):
            evolve.reconcile(spark.createDataFrame([], wrong), contract)
