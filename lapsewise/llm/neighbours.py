"""Operator 10: approximate nearest neighbours with a hierarchical k-means tree and best-bin-first search.

Equal vectors become one node that keeps its ``k + 1`` smallest ids, which is
all that any answer can name.  The tree is fitted on a bounded sample of nodes
(``SAMPLE``); every node is assigned a leaf.  A query walks the tree through a
priority queue, nearest centroid first, until it has visited ``visits`` leaves.
How many are needed is calibrated: for ``CALIBRATION`` queries the true
neighbours are found by brute force, and the visits are widened until the
leaves of ``RECALL`` of them are among those visited.

Rows and queries meet in groups of neighbouring leaves, as many groups as the
cluster has tasks a few times over, and more only where a group would pass
``GROUP_BYTES``; a leaf above that is dealt to several groups, each of which all
its queries visit.  A query enters a group once, with the leaves it visits
there, and leaves it with one running list of ``k + 1`` rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, materialise, prepare, shuffle_partitions

SAMPLE, LEAF_SAMPLE, BRANCHES, CALIBRATION, RECALL = 20_000, 40, 8, 64, 0.98
#: Bytes of vectors in a group at most; groups a task has on average while they are smaller; queries compared at once.
GROUP_BYTES, TASK_GROUPS, BLOCK = 8 << 20, 4, 64


class Tree:
    """Nodes of a hierarchical k-means tree: ``centres``, and ``children`` (None: a leaf)."""

    def __init__(self, points: np.ndarray, branches: int = BRANCHES, leaf: int = LEAF_SAMPLE, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.centres, self.children = [points.mean(axis=0)], [None]
        todo = [(0, points)]
        while todo:
            at, own = todo.pop()
            if len(own) <= leaf:
                continue
            parts = self._split(own, min(branches, max(2, len(own) // leaf)), rng)
            if len(parts) < 2:
                continue
            self.children[at] = list(range(len(self.centres), len(self.centres) + len(parts)))
            for part in parts:
                todo.append((len(self.centres), part))
                self.centres.append(part.mean(axis=0))
                self.children.append(None)
        self.centres = np.array(self.centres)

    @staticmethod
    def _split(points: np.ndarray, k: int, rng: np.random.Generator) -> list[np.ndarray]:
        centres = points[rng.choice(len(points), k, replace=False)]
        for _ in range(8):
            own = _squares(points, centres).argmin(axis=1)
            centres = np.array([points[own == i].mean(axis=0) if (own == i).any() else centres[i] for i in range(k)])
        own = _squares(points, centres).argmin(axis=1)
        return [points[own == i] for i in range(k) if (own == i).any()]

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf that each point falls into, nearest child first."""
        out, todo = np.zeros(len(points), np.int32), [(0, np.arange(len(points)))]
        while todo:
            at, rows = todo.pop()
            if self.children[at] is None:
                out[rows] = at
                continue
            own = _squares(points[rows], self.centres[self.children[at]]).argmin(axis=1)
            todo += [(child, rows[own == i]) for i, child in enumerate(self.children[at]) if (own == i).any()]
        return out

    def in_order(self) -> list[int]:
        """All leaves, neighbours in the tree side by side."""
        out, todo = [], [0]
        while todo:
            at = todo.pop()
            if self.children[at] is None:
                out.append(at)
            else:
                todo += reversed(self.children[at])
        return out

    def best_first(self, point: np.ndarray, visits: int) -> list[int]:
        """The first ``visits`` leaves by best-bin-first traversal."""
        queue, out = [(0.0, 0)], []
        while queue and len(out) < visits:
            _, at = heapq.heappop(queue)
            if self.children[at] is None:
                out.append(at)
                continue
            for d, child in zip(_squares(point[None], self.centres[self.children[at]])[0].tolist(), self.children[at], strict=True):
                heapq.heappush(queue, (d, child))
        return out


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(axis=1)[:, None] - 2 * a @ b.T + (b * b).sum(axis=1)[None]


def _matrix(column) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths, in double precision."""
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _distances(points: np.ndarray, query: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - query) ** 2).sum(axis=1))


def _nearest(points: np.ndarray, least: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the k nearest points, ties to the smaller id, and their distances."""
    d = _distances(points, query)
    if len(d) > k:
        near = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
    else:
        near = np.arange(len(d))
    near = near[np.lexsort((least[near], d[near]))][:k]
    return near, d[near]


def _meet(points: np.ndarray, least: np.ndarray, leaves: np.ndarray, queries: np.ndarray, visited: list[list[int]], k: int):
    """For each query the k nearest points of the leaves it visits, and their distances.

    Products of matrices sort out what can't be near; what can, within their
    error, is measured exactly.
    """
    names, leaf = np.unique(leaves, return_inverse=True)
    squares = (points * points).sum(axis=1)
    for i in range(0, len(queries), BLOCK):
        block = queries[i: i + BLOCK]
        own = (block * block).sum(axis=1)
        rough = squares[None] - 2 * block @ points.T + own[:, None]
        for q, row, size, wanted in zip(block, rough, own, visited[i: i + BLOCK], strict=True):
            row = np.where(np.isin(names, wanted)[leaf], row, np.inf)
            if len(row) > k:
                slack = 1e-9 * (size + squares.max()) + 1e-300
                near = np.flatnonzero((row <= np.partition(row, k - 1)[k - 1] + slack) & np.isfinite(row))
            else:
                near = np.flatnonzero(np.isfinite(row))
            found, d = _nearest(points[near], least[near], q, k)
            yield near[found], d


def nodes_of(vectors: DataFrame, id_col: str, vector_col: str, k: int) -> DataFrame:
    """``(node, v, ids)``: distinct usable vectors, each with its ``k + 1`` smallest ids in order."""
    v = F.col("v")
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where("id is not null and v is not null") \
        .where(usable).distinct()
    first = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    return rows.withColumn("place", first).where(f"place <= {k + 1}").groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")) \
        .select(F.xxhash64("v").alias("node"), "v", "ids", F.size("v").alias("size"))


def nearest_neighbours(vectors: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
                       recall: float = RECALL) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every row where ``is_query`` (a condition on ``id_col``) holds, the ``k``
    nearest other rows found, by Euclidean distance, ties to the smaller id.

    Null, zero, null-holding and non-finite vectors and null ids take no part,
    vectors of different lengths are never near each other: each length is
    searched alone (a row per length reaches the driver); a repeated row counts
    once; a query never finds its own id; fewer rows than ``k`` are all
    returned; no rows give no rows.  Nodes are told apart by a 64-bit hash of
    the vector.
    """
    spark = vectors.sparkSession
    prepare(spark, rows=4096)
    every = materialise(nodes_of(vectors, id_col, vector_col, k), "nodes")
    wanted = vectors.select(F.col(id_col).cast("long").alias(id_col), F.col(vector_col)).where(is_query) \
        .select(F.col(id_col).alias("query_id"), F.xxhash64(vector_col).alias("node")).distinct()
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for row in every.groupBy("size").count().orderBy("size").collect():
        out = out.union(_search(every.where(F.col("size") == row["size"]).drop("size"), wanted, row["count"], row["size"], k, recall))
    return out


def _search(nodes: DataFrame, wanted: DataFrame, total: int, size: int, k: int, recall: float) -> DataFrame:
    """``nearest_neighbours`` among nodes of one length."""
    spark = nodes.sparkSession
    draw = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1 << 20)) < -(-SAMPLE * (1 << 20) // total)
    drawn = nodes.where(draw).select("v").toArrow()  # about SAMPLE rows
    points = _matrix(drawn["v"]) if drawn.num_rows else np.zeros((1, 1))
    tree = spark.sparkContext.broadcast(Tree(points))  # at most SAMPLE leaves; usually SAMPLE / LEAF_SAMPLE
    schema = pa.schema([("node", pa.int64()), ("v", pa.list_(pa.float64())), ("ids", pa.list_(pa.int64())), ("leaf", pa.int32())])

    def assign(tables):
        for b in tables:
            if b.num_rows:
                m = _matrix(b.column(1))
                yield batches({"node": b.column(0), "v": b.column(1).cast(pa.list_(pa.float64())), "ids": b.column(2), "leaf": tree.value.leaf_of(m)}, schema)

    placed = materialise(nodes.mapInArrow(assign, "node long, v array<double>, ids array<bigint>, leaf int"), "placed")
    asking = placed.select("node", "v").join(wanted.select("node").distinct(), "node")
    visits = _calibrate(placed, asking, tree, k, recall)

    found_schema = pa.schema([("query", pa.int64()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())])
    partitions = shuffle_partitions(spark)
    rows_of = max(1, min(GROUP_BYTES // (8 * size), max(256, -(-total // (TASK_GROUPS * partitions)))))
    sizes = dict(map(tuple, placed.groupBy("leaf").count().collect()))  # a row per leaf
    plan, held, group = {}, 0, 0  # leaf: its first group, and the number of its groups
    for leaf in tree.value.in_order():
        n = sizes.get(leaf, 0)
        if held and held + n > rows_of:
            group, held = group + 1, 0
        parts = max(1, -(-n // rows_of))
        plan[leaf], held = (group, parts), held + n
        if parts > 1:
            group, held = group + parts, 0
    layout = spark.createDataFrame([(leaf, g, p) for leaf, (g, p) in plan.items()], "leaf int, first int, parts int")

    def ask(tables):
        schema = pa.schema([("query", pa.int64()), ("v", pa.list_(pa.float64())), ("group", pa.int32()), ("leaves", pa.list_(pa.int32()))])
        for b in tables:
            rows = []
            for i, x in enumerate(_matrix(b.column(1)) if b.num_rows else ()):
                visited: dict[int, list[int]] = {}
                for leaf in tree.value.best_first(x, visits):
                    first, parts = plan[leaf]
                    for g in range(first, first + parts):
                        visited.setdefault(g, []).append(leaf)
                rows += [(i, g, leaves) for g, leaves in visited.items()]
            at = pa.array([r[0] for r in rows], pa.int64())
            yield batches({"query": b.column(0).take(at), "v": b.column(1).take(at), "group": [r[1] for r in rows], "leaves": [r[2] for r in rows]}, schema)

    def meet(rows, queries):
        if not rows.num_rows or not queries.num_rows:
            return found_schema.empty_table()
        points, ids = _matrix(rows["v"]), rows["ids"].combine_chunks()
        least = np.array([x[0] for x in ids.to_pylist()])
        at, scores, names = [], [], []
        met = _meet(points, least, rows["leaf"].to_numpy(), _matrix(queries["v"]), queries["leaves"].to_pylist(), k + 1)
        for name, (near, d) in zip(queries["query"].to_pylist(), met, strict=True):
            at.append(near)
            scores.append(d)
            names += [name] * len(near)
        return pa.Table.from_arrays([pa.array(names, pa.int64()), ids.take(pa.array(np.concatenate(at))), pa.array(np.concatenate(scores))], schema=found_schema)

    n = max(partitions, -(-(group + 1) // TASK_GROUPS))
    grouped = placed.join(layout, "leaf").select(
        (F.col("first") + F.pmod(F.xxhash64("node", F.lit(2)), F.col("parts").cast("long"))).cast("int").alias("group"), "leaf", "v", "ids")
    asked = asking.mapInArrow(ask, "query long, v array<double>, group int, leaves array<int>")
    found = grouped.repartition(n, "group").groupBy("group") \
        .cogroup(asked.repartition(n, "group").groupBy("group")).applyInArrow(meet, "query long, ids array<bigint>, score double")
    entries = found.select("query", "score", F.explode("ids").alias("vec_id"))
    place = F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))
    best = entries.withColumn("place", place).where(f"place <= {k + 1}").drop("place")
    answers = wanted.join(best, wanted["node"] == best["query"]).where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return answers.withColumn("rank", rank).where(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")


def _calibrate(placed: DataFrame, asking: DataFrame, tree, k: int, recall: float) -> int:
    """Leaf visits after which ``recall`` of the calibration queries' true neighbours have been met."""
    few = asking.orderBy(F.xxhash64("node", F.lit(3))).limit(CALIBRATION).toArrow()
    if not few.num_rows:
        return 1
    queries = few["node"].to_numpy(), _matrix(few["v"])
    schema = pa.schema([("query", pa.int64()), ("score", pa.float64()), ("least", pa.int64()), ("leaf", pa.int32())])

    def scan(tables):
        for b in tables:
            if not b.num_rows:
                continue
            points, leaves = _matrix(b.column(1)), b.column(3).to_numpy()
            least = np.array([x[0] for x in b.column(2).to_pylist()])
            for name, q in zip(*queries, strict=True):
                near, d = _nearest(points, least, q, k + 1)
                yield batches({"query": [name] * len(near), "score": d, "least": least[near], "leaf": leaves[near]}, schema)

    place = F.row_number().over(Window.partitionBy("query").orderBy("score", "least"))
    truth = placed.select("node", "v", "ids", "leaf").mapInArrow(scan, "query long, score double, least long, leaf int") \
        .withColumn("place", place).where(f"place <= {k + 1}").select("query", "leaf").collect()  # CALIBRATION x (k + 1) rows
    order = {name: {leaf: i for i, leaf in enumerate(tree.value.best_first(q, 1 << 30))} for name, q in zip(queries[0].tolist(), queries[1], strict=True)}
    needed = np.sort([order[r["query"]][r["leaf"]] + 1 for r in truth])
    visits = 1
    while (needed <= visits).mean() < recall:
        visits += max(1, visits // 4)
    return visits
