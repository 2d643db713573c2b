"""Neighbours: groups of leaves, exactness inside them, lengths searched alone, and a tree that prunes."""

import numpy as np
from pyspark.sql import functions as F

from lapsewise.llm import neighbours as nb


def test_meet_equals_a_plain_scan_of_the_visited_leaves():
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal(size=(500, 8)), np.repeat(rng.normal(size=(1, 8)), 30, axis=0), 1e8 + rng.normal(size=(50, 8))])
    least, leaves = rng.permutation(len(points)), rng.integers(0, 9, len(points))
    queries = np.concatenate([points[::40], rng.normal(size=(70, 8))])
    visited = [rng.choice(9, rng.integers(0, 6), replace=False).tolist() for _ in queries]
    for (near, d), q, own in zip(nb._meet(points, least, leaves, queries, visited, 11), queries, visited, strict=True):
        rows = np.flatnonzero(np.isin(leaves, own))
        want, exact = nb._nearest(points[rows], least[rows], q, 11)
        assert rows[want].tolist() == near.tolist() and exact.tolist() == d.tolist()


def test_leaves_in_order_are_all_leaves_once():
    tree = nb.Tree(np.random.default_rng(1).normal(size=(3000, 5)))
    assert sorted(tree.in_order()) == [i for i, c in enumerate(tree.children) if c is None]


def test_lengths_are_searched_alone(spark):
    rows = [(i, [float(i), 1.0]) for i in range(0, 30)] + [(100 + i, [float(i), 1.0, 2.0]) for i in range(20)] + [(200, [1.0])]
    got = nb.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 10 == 0, k=3).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    assert found == {0: [1, 2, 3], 10: [9, 11, 8], 20: [19, 21, 18], 100: [101, 102, 103], 110: [109, 111, 108]}


def test_clustered_rows_need_few_leaves_and_a_large_leaf_is_dealt_out(spark, monkeypatch):
    """Tight clusters: calibration stops after a few leaves; one cluster holds a third of the rows and passes a group's size."""
    monkeypatch.setattr(nb, "GROUP_BYTES", 8 * 16 * 300)
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 30, (40, 16))
    own = np.where(rng.random(6000) < 0.33, 0, rng.integers(0, 40, 6000))
    points = centres[own] + rng.normal(0, 0.1, (6000, 16))
    seen = []
    plain = nb._calibrate
    monkeypatch.setattr(nb, "_calibrate", lambda *a: seen.append(plain(*a)) or seen[-1])
    frame = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    got = {}
    for r in nb.nearest_neighbours(frame, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((points - points[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        hits += len(found & set(np.argsort(d)[:10].tolist()))
    assert hits >= 0.95 * 10 * len(got) and len(got) == 60
    assert seen[0] <= 60  # of some 150 leaves
