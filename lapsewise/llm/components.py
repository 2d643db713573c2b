"""Connected components of a graph given as edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _hook(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over ``(a, b)``: tie each node's neighbours to the smallest node around it.

    Large: the larger neighbours; small: the node itself and the smaller ones.
    The minimum is aggregated before the join, so no neighbourhood is collected
    and a hub's edges may be split over tasks.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    seen = both.join(least, "a")
    out = seen.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) if large else \
        seen.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (longs ``a``, ``b``), the root being its component's smallest node.

    Each round is written to the shared folder; rounds grow with the logarithm
    of the longest path.  Self loops vanish; no edges give no rows.
    """
    def digest(df):
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    now = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    mark = digest(now)
    while mark[0]:
        now = materialise(_hook(_hook(now, large=True), large=False), "edges")
        before, mark = mark, digest(now)
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
