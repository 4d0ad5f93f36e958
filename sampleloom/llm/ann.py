"""Nearest neighbours by inner product: a hierarchical k-means tree searched best bin first.

Vectors get one more component so that all are equally long; the largest inner product is then the smallest distance.
The tree is fitted on a bounded sample and every row goes to its leaf. A query walks the tree with a priority queue of
branches by distance and visits leaves in that order; how many follows from calibration queries, whose visits are
widened until their recall against all rows is reached. Queries then meet the rows of their leaves in blocks.
"""

from __future__ import annotations

import heapq
import pickle
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sampleloom.llm.frames import in_one_task, schema_of, shared_path, smallest, table
from sampleloom.llm.registry import query

#: Rows that the tree is fitted on, and queries that calibrate the visits (against all rows): bounded samples.
FIT_ROWS, CALIBRATION = 20_000, 64
BRANCH, LEAF_ROWS, MOST_LEAVES = 8, 100, 2048
RECALL = 0.98
#: Rows and queries that one task compares at a time.
BLOCK_ROWS, BLOCK_QUERIES = 2048, 4096


@dataclass
class Tree:
    """Centres of all nodes; ``child[i]`` lists the nodes below node i, ``leaf[i]`` is its leaf number or -1."""

    top: float
    centre: np.ndarray
    child: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)

    @property
    def leaves(self) -> int:
        return max(self.leaf) + 1

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Rows with the component that makes all as long as the longest."""
        return np.column_stack([x, np.sqrt(np.maximum(0, self.top ** 2 - (x * x).sum(1)))])

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each vector: the nearest child, level by level."""
        x, out = self.lifted(x), np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            below = self.child[node]
            if not below:
                out[rows] = self.leaf[node]
                continue
            c = self.centre[below]
            near = ((c * c).sum(1) - 2 * x[rows] @ c.T).argmin(1)
            todo += [(n, rows[near == i]) for i, n in enumerate(below)]
        return out

    def visits(self, q: np.ndarray, n: int) -> list[list[int]]:
        """The first ``n`` leaves of each query, best bin first."""
        scale = self.top / np.maximum(np.linalg.norm(q, axis=1), 1e-300)
        q = np.column_stack([q * scale[:, None], np.zeros(len(q))])
        out = []
        for a in range(0, len(q), 512):
            gap = (self.centre * self.centre).sum(1) - 2 * q[a:a + 512] @ self.centre.T
            for row in gap.tolist():
                queue, seen = [(row[0], 0)], []
                while queue and len(seen) < n:
                    _, node = heapq.heappop(queue)
                    if self.leaf[node] >= 0:
                        seen.append(self.leaf[node])
                    for c in self.child[node]:
                        heapq.heappush(queue, (row[c], c))
                out.append(seen)
        return out


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, steps: int = 12) -> np.ndarray:
    c = x[rng.choice(len(x), k, replace=False)]
    near = np.zeros(len(x), np.int64)
    for _ in range(steps):
        near = ((c * c).sum(1) - 2 * x @ c.T).argmin(1)
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return near


def fit_tree(x: np.ndarray, top: float, leaves: int, seed: int = 7) -> Tree:
    """A tree of about ``leaves`` leaves of even size; equal vectors stay together."""
    tree = Tree(top, np.zeros((0, 0)))
    x, rng = tree.lifted(x), np.random.default_rng(seed)
    goal = max(1, len(x) // max(1, leaves))
    centres, todo = [x.mean(0)], [(0, np.arange(len(x)))]
    tree.child.append([])
    tree.leaf.append(-1)
    done = 0
    while todo:
        node, rows = todo.pop()
        parts = []
        if len(rows) > goal * 1.5:
            near = _kmeans(x[rows], min(BRANCH, max(2, len(rows) // goal)), rng)
            parts = [p for k in range(near.max() + 1) if len(p := rows[near == k])]
        if len(parts) < 2:
            tree.leaf[node], done = done, done + 1
            continue
        for p in parts:
            tree.child[node].append(len(centres))
            todo.append((len(centres), p))
            centres.append(x[p].mean(0))
            tree.child.append([])
            tree.leaf.append(-1)
    tree.centre = np.array(centres)
    return tree


def _matrix(column) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64) if len(column) else np.zeros((0, 0))


def best(ids: np.ndarray, x: np.ndarray, qid: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query place, row place, score) of the ``k`` best other rows of each query; ties go to the smaller id.
    Candidates come from one product; their scores are summed row by row, so equal vectors have equal scores."""
    rough = q @ x.T
    rough[qid[:, None] == ids[None, :]] = -np.inf
    out = []
    slack = 1e-9 * (np.abs(rough[np.isfinite(rough)]).max() + 1e-300) if np.isfinite(rough).any() else 0
    for i, row in enumerate(rough):
        some = np.flatnonzero(np.isfinite(row))
        if len(some) > k:
            some = np.flatnonzero(row >= np.partition(row, len(row) - k)[len(row) - k] - slack)
        score = (x[some] * q[i]).sum(1)
        order = np.lexsort((ids[some], -score))[:k]
        out.append((np.full(len(order), i), some[order], score[order]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, v`` of rows with an id and a finite vector that is neither null, empty nor zero."""
    v = F.col(vec_col).cast("array<double>")
    ok = (F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
          & F.exists(v, lambda x: x != 0))
    return df.where(ok).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def _top(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


@dataclass
class Index:
    """A fitted tree, the table of all rows by leaf, and the leaf visits that reached the recall."""

    tree: Tree
    path: str
    sizes: dict[int, int]
    visits: int
    recall: float


def build_index(df: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding", recall: float = RECALL,
                fit_rows: int = FIT_ROWS, calibration: int = CALIBRATION) -> Index | None:
    """An index of every usable row; None without any. Tree and visits come from bounded samples, see the module."""
    spark = df.sparkSession
    rows = usable(df, id_col, vec_col)
    stat = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("t")).first()
    if not stat["n"]:
        return None
    leaves = min(MOST_LEAVES, max(1, min(stat["n"], fit_rows) // LEAF_ROWS))
    top = float(np.sqrt(stat["t"])) * (1 + 1e-9)
    blob = in_one_task(smallest(rows, "vec_id", fit_rows), lambda t: pickle.dumps(fit_tree(_matrix(t["v"]), top, leaves)))
    tree = pickle.loads(blob)
    shared = spark.sparkContext.broadcast(tree)

    def to_leaf(batches):
        for b in batches:
            leaf = shared.value.assign(_matrix(b.column(1))) if b.num_rows else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(leaf, pa.int32())], names=["vec_id", "v", "leaf"])

    path = shared_path(spark, "leaves")
    rows.mapInArrow(to_leaf, schema_of("vec_id long, v array<double>, leaf int")).write.parquet(path)
    stored = spark.read.parquet(path)
    sizes = {r["leaf"]: r["count"] for r in stored.groupBy("leaf").count().collect()}  # one row per leaf
    asked = smallest(usable(queries, id_col, vec_col), "vec_id", calibration).collect()
    qid, q = np.array([r["vec_id"] for r in asked], np.int64), np.array([r["v"] for r in asked])
    if not len(asked):
        return Index(tree, path, sizes, tree.leaves, 1.0)

    def exact(batches):
        for b in batches:
            for a in range(0, b.num_rows, BLOCK_ROWS):
                c = b.slice(a, BLOCK_ROWS)
                ids = np.asarray(c.column(0))
                i, j, s = best(ids, _matrix(c.column(1)), qid, q, k)
                yield pa.RecordBatch.from_arrays([pa.array(qid[i]), pa.array(ids[j]), pa.array(np.asarray(c.column(2))[j], pa.int32()), pa.array(s)],
                                                 names=["query_id", "vec_id", "leaf", "score"])

    truth = _top(stored.mapInArrow(exact, schema_of("query_id long, vec_id long, leaf int, score double")), k).select("query_id", "leaf").collect()
    place = {int(i): {leaf: p for p, leaf in enumerate(order)} for i, order in zip(qid, tree.visits(q, tree.leaves))}
    at = np.array([place[r["query_id"]][r["leaf"]] for r in truth])
    n, got = 1, 0.0
    while n < tree.leaves and (got := float((at < n).mean()) if len(at) else 1.0) < recall:
        n = max(n + 1, int(n * 1.2))
    n = min(n, tree.leaves)
    return Index(tree, path, sizes, n, float((at < n).mean()) if len(at) else 1.0)


def search(index: Index, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found rows of each usable query, without the row of its own id."""
    spark = queries.sparkSession
    stored = spark.read.parquet(index.path)
    shared = spark.sparkContext.broadcast(index.tree)
    n = index.visits

    def route(batches):
        for b in batches:
            if not b.num_rows:
                continue
            seen = shared.value.visits(_matrix(b.column(1)), n)
            pick = pa.array(np.repeat(np.arange(b.num_rows), [len(s) for s in seen]))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pick), b.column(1).take(pick), pa.array([x for s in seen for x in s], pa.int32())],
                                             names=["query_id", "q", "leaf"])

    routed = usable(queries, id_col, vec_col).mapInArrow(route, schema_of("query_id long, q array<double>, leaf int"))
    asks = {r["leaf"]: r["count"] for r in routed.groupBy("leaf").count().collect()}  # one row per leaf
    cut = lambda counts, size: F.create_map(*[F.lit(int(x)) for k_, v in (counts or {0: 1}).items() for x in (k_, -(-v // size))])
    rows_cut, asks_cut = F.coalesce(cut(index.sizes, BLOCK_ROWS)[F.col("leaf")], F.lit(1)), F.coalesce(cut(asks, BLOCK_QUERIES)[F.col("leaf")], F.lit(1))
    spread = lambda n_: F.explode(F.sequence(F.lit(0), n_ - 1))
    left = stored.withColumn("i", F.pmod(F.xxhash64("vec_id"), rows_cut).cast("int")).withColumn("j", spread(asks_cut))
    right = routed.withColumn("j", F.pmod(F.xxhash64("query_id"), asks_cut).cast("int")).withColumn("i", spread(rows_cut))

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        if not len(a) or not len(b):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        ids, qid = np.asarray(a["vec_id"]), np.asarray(b["query_id"])
        i, j, s = best(ids, _matrix(a["v"]), qid, _matrix(b["q"]), k)
        return pa.table({"query_id": qid[i], "vec_id": ids[j], "score": s})

    found = left.groupBy("leaf", "i", "j").cogroup(right.groupBy("leaf", "i", "j")).applyInArrow(
        meet, schema_of("query_id long, vec_id long, score double"))
    return _top(found, k).select("query_id", "rank", "vec_id", "score")


def nearest(df: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding", recall: float = RECALL) -> DataFrame:
    """Builds an index over ``df`` and searches it. Rows and queries whose id is null or whose vector is null, empty, zero or holds
    null or non-finite components take no part; fewer rows than ``k`` give all of them; repeated rows are rows of their own;
    an empty table gives an empty result. Other columns are not read."""
    index = build_index(df, queries, k, id_col, vec_col, recall)
    if index is None:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return search(index, queries, k, id_col, vec_col)


@query("op1_ann_kmeans_tree")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(rows, rows.where("vec_id % 20 = 0"), 20)
