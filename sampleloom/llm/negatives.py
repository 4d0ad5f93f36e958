"""Hard negatives by segment summaries.

A vector is cut into segments, and each segment keeps its mean and its deviation (the length of what is left without the
mean). Over a segment of m entries a product lies within m·mean·mean ± deviation·deviation, so the sums over segments bound
the inner product of two whole vectors. Pairs are bounded by one segment, then by two, four and more; only pairs that
can still matter reach the next level, and the last are scored exactly in integers.

Anchors meet the rows in blocks. A task takes one block of anchors and some blocks of rows in turn, so what the first
rows gave bounds what the later ones must reach.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sampleloom.llm.frames import light, schema_of, shared_path, table
from sampleloom.llm.registry import query

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
#: A negative's score lies between these shares of the positive's, in hundredths.
LOW, HIGH = 80, 100
#: Segments of the levels, as far as a vector has so many entries.
LEVELS = (1, 2, 4, 8, 16)
#: Anchors and rows that a task takes at a time, and the rows it looks at together.
ANCHOR_BLOCK, ROW_BLOCK, TILE = 1024, 8192, 2048
#: Scaled entries stay below this, so that integer scores of up to 4096 entries do not overflow.
LIMIT = 1 << 25
#: A level is taken by products of whole blocks while this share of pairs is open, pair by pair below it.
OPEN = 0.2
_FAR = np.int64(-(1 << 62))


@dataclass
class Summaries:
    """Rows of integers with the scaled means and deviations of their segments, level by level."""

    x: np.ndarray
    mean: list[np.ndarray]
    dev: list[np.ndarray]

    @classmethod
    def of(cls, x: np.ndarray) -> "Summaries":
        mean, dev = [], []
        dim = x.shape[1]
        for s in LEVELS:
            if s > dim:
                break
            cut = np.arange(s) * dim // s
            size = np.diff(np.append(cut, dim))
            total, square = np.add.reduceat(x, cut, axis=1).astype(np.float64), np.add.reduceat(x * x, cut, axis=1).astype(np.float64)
            mean.append(total / np.sqrt(size))  # two of these multiply to m·mean·mean
            dev.append(np.sqrt(np.maximum(0.0, square - total * total / size)))
        return cls(x, mean, dev)

    @property
    def slack(self) -> np.ndarray:
        """Part of what rounding may take from a bound; the parts of two rows are multiplied."""
        return 3e-4 * (np.hypot(self.mean[0][:, 0], self.dev[0][:, 0]) + 1)


def bounds(a: Summaries, b: Summaries, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest possible scores of all pairs, widened by what rounding may take."""
    mid, wide = a.mean[level] @ b.mean[level].T, a.dev[level] @ b.dev[level].T
    wide += a.slack[:, None] * b.slack[None]
    return mid - wide, mid + wide


def pair_bounds(a: Summaries, b: Summaries, i: np.ndarray, j: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    mid = np.einsum("ij,ij->i", a.mean[level][i], b.mean[level][j])
    wide = np.einsum("ij,ij->i", a.dev[level][i], b.dev[level][j]) + a.slack[i] * b.slack[j]
    return mid - wide, mid + wide


def open_pairs(a: Summaries, b: Summaries, allowed: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Allowed pairs whose score may lie within ``least`` and ``most`` of the anchor, refined over all levels."""
    i = j = None
    for level in range(len(a.mean)):
        if i is None:
            low, high = bounds(a, b, level)
            allowed = allowed & (high >= least[:, None]) & (low <= most[:, None])
            if allowed.mean() < OPEN or level + 1 == len(a.mean):
                i, j = np.nonzero(allowed)
        else:
            low, high = pair_bounds(a, b, i, j, level)
            keep = (high >= least[i]) & (low <= most[i])
            i, j = i[keep], j[keep]
    return i, j


def scores(a: Summaries, b: Summaries, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact integer scores of pairs: one product while doubles hold them exactly, else integer sums."""
    top = float(np.abs(a.x).max(initial=0)) * float(np.abs(b.x).max(initial=0)) * max(1, a.x.shape[1])
    if top < 2 ** 53 and len(i) * 8 > len(a.x) * len(b.x):
        return (a.x.astype(np.float64) @ b.x.T.astype(np.float64))[i, j].astype(np.int64)
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), 1 << 16):
        out[at:at + (1 << 16)] = (a.x[i[at:at + (1 << 16)]] * b.x[j[at:at + (1 << 16)]]).sum(1)
    return out


class Best:
    """The ``k`` best (score, id) of each of ``n`` lists; ties go to the smaller id."""

    def __init__(self, n: int, k: int):
        self.k, self.score, self.id = k, np.full((n, k), _FAR), np.zeros((n, k), np.int64)

    def add(self, of: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(of):
            return
        touched = np.unique(of)
        old = self.score[touched] > _FAR
        of = np.concatenate([of, np.repeat(touched, old.sum(1))])
        score, ids = np.concatenate([score, self.score[touched][old]]), np.concatenate([ids, self.id[touched][old]])
        order = np.lexsort((ids, -score, of))
        of, score, ids = of[order], score[order], ids[order]
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        rank = np.arange(len(of)) - np.repeat(first, np.diff(np.append(first, len(of))))
        keep = rank < self.k
        self.score[touched] = _FAR
        self.score[of[keep], rank[keep]], self.id[of[keep], rank[keep]] = score[keep], ids[keep]

    @property
    def least(self) -> np.ndarray:
        """Scores below this change nothing."""
        return self.score[:, -1]

    def listed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        of, at = np.nonzero(self.score > _FAR)
        return of, self.score[of, at], self.id[of, at]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _least(x: np.ndarray) -> np.ndarray:
    return np.where(x > _FAR, x.astype(np.float64), -np.inf)


def positives_of(a: Summaries, ids: np.ndarray, label: np.ndarray, rows: pa.Table, k: int) -> Best:
    """The best rows of the anchors' own labels among ``rows``."""
    best = Best(len(ids), k)
    r_id, r_label, x = np.asarray(rows["vec_id"]), np.asarray(rows["label"]), _matrix(rows["x"])
    for at in range(0, len(r_id), TILE):
        t = slice(at, at + TILE)
        b = Summaries.of(x[t])
        same = (label[:, None] == r_label[t][None]) & (ids[:, None] != r_id[t][None])
        # the k-th highest lower bound is reached by k rows, so nothing below it can be among the best
        low = np.where(same, bounds(a, b, len(a.mean) - 1)[0], -np.inf)
        sure = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k] if low.shape[1] >= k else np.full(len(ids), -np.inf)
        i, j = open_pairs(a, b, same, np.maximum(sure, _least(best.least)), np.full(len(ids), np.inf))
        best.add(i, scores(a, b, i, j), r_id[t][j])
    return best


def negatives_of(a: Summaries, label: np.ndarray, wanted: np.ndarray, rows: pa.Table, k: int, low: int, high: int) -> Best:
    """The best rows of other labels for each anchor and positive score: list ``i * wanted.shape[1] + p``."""
    n, p = wanted.shape
    best = Best(n * p, k)
    there = wanted > _FAR
    # a window is empty below zero; windows of an anchor together are one range to bound against
    some = there & (wanted >= 0)
    whole, rest = wanted // 100, wanted % 100
    least = np.where(some, low * whole - (-low * rest // 100), np.iinfo(np.int64).max)
    most = np.where(some, high * whole + high * rest // 100, np.iinfo(np.int64).min)
    r_id, r_label, x = np.asarray(rows["vec_id"]), np.asarray(rows["label"]), _matrix(rows["x"])
    bottom, top = least.min(1, initial=np.iinfo(np.int64).max).astype(np.float64), most.max(1, initial=np.iinfo(np.int64).min).astype(np.float64)
    for at in range(0, len(r_id), TILE):
        t = slice(at, at + TILE)
        b = Summaries.of(x[t])
        full = np.where(some, best.least.reshape(n, p), np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max)
        i, j = open_pairs(a, b, label[:, None] != r_label[t][None], np.maximum(bottom, _least(full)), top)
        s = scores(a, b, i, j)
        for q in range(p):
            fit = (s >= least[i, q]) & (s <= most[i, q])
            best.add(i[fit] * p + q, s[fit], r_id[t][j[fit]])
    return best


def scaled(df: DataFrame, id_col: str, vec_col: str, label: Column) -> DataFrame:
    """``vec_id, label, x``: integer vectors of the rows that take part."""
    v = F.col(vec_col).cast("array<double>")
    ok = (F.col(id_col).isNotNull() & label.isNotNull() & v.isNotNull() & (F.size(v) > 0)
          & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LIMIT / SCALE)))
    return df.where(ok).select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"),
                               F.transform(v, lambda c: F.when(F.abs(c) < LIMIT / SCALE, F.floor(c * SCALE))).alias("x"))


def _meet(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, run: Callable[[pa.Table, pa.Table], pa.Table], ddl: str) -> DataFrame:
    """Each block of anchors with each block of rows: the stated query set against all rows."""
    a_blocks, r_blocks = max(1, -(-n_anchors // ANCHOR_BLOCK)), max(1, -(-n_rows // ROW_BLOCK))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("i", F.pmod(F.xxhash64("anchor"), F.lit(a_blocks)).cast("int")).withColumn("j", each(r_blocks))
    right = rows.withColumn("j", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(r_blocks)).cast("int")).withColumn("i", each(a_blocks))
    empty = schema_of(ddl)

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        if not len(a) or not len(b):
            return pa.table({f.name: pa.array([], pa.int64()) for f in empty})
        return run(a, b)

    return left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(light(meet), empty)


def hard_negatives(df: DataFrame, anchors: Column, label: Column, id_col: str = "vec_id", vec_col: str = "embedding", positives: int = POSITIVES,
                   negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for each row of ``df`` that ``anchors`` marks.

    A row's score is the inner product of floor(256 x) with the anchor's. The positives of an anchor are its best rows of
    its label; the negatives of a positive are the best rows of other labels whose score is ``low`` to ``high`` hundredths
    of the positive's, so a negative positive score has none. Ties go to the smaller id; fewer rows give all of them.

    Rows without an id, label or vector take no part, nor do vectors that are empty, hold null, NaN, infinite entries or entries from
    2^17 on, or are of another length than most (of equally many, the longer). Rows that share the anchor's id are not its
    positives; repeated rows are rows of their own, and each of repeated anchors has its results. An empty table
    gives an empty result. Other columns are not read.
    """
    spark = df.sparkSession
    ddl = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = scaled(df, id_col, vec_col, label)
    size = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if size is None:
        return spark.createDataFrame([], ddl)
    rows = rows.where(F.size("x") == size["d"])
    path = shared_path(spark, "anchors")
    marked = scaled(df.where(anchors), id_col, vec_col, label).where(F.size("x") == size["d"])
    marked.withColumn("anchor", F.monotonically_increasing_id()).write.parquet(path)  # a number for each, whatever its id
    asked = spark.read.parquet(path)
    n_anchors, n_rows = asked.count(), size["count"]

    def find_positives(a: pa.Table, b: pa.Table) -> pa.Table:
        best = positives_of(Summaries.of(_matrix(a["x"])), np.asarray(a["vec_id"]), np.asarray(a["label"]), b, positives)
        of, score, ids = best.listed()
        return pa.table({"anchor": np.asarray(a["anchor"])[of], "positive_id": ids, "positive_score": score})

    near = _meet(asked, rows, n_anchors, n_rows, find_positives, "anchor long, positive_id long, positive_score long")
    w = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    found = near.withColumn("at", F.row_number().over(w) - 1).where(F.col("at") < positives)
    found_path = shared_path(spark, "positives")
    found.write.parquet(found_path)
    found = spark.read.parquet(found_path)
    lists = found.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "positive_score"))), lambda s: s["positive_score"]).alias("wanted"))
    with_scores = asked.join(lists, "anchor")

    def find_negatives(a: pa.Table, b: pa.Table) -> pa.Table:
        wanted = np.full((len(a), positives), _FAR)
        for i, s in enumerate(a["wanted"].to_pylist()):
            wanted[i, :len(s)] = s
        best = negatives_of(Summaries.of(_matrix(a["x"])), np.asarray(a["label"]), wanted, b, negatives, low, high)
        of, score, ids = best.listed()
        return pa.table({"anchor": np.asarray(a["anchor"])[of // positives], "at": of % positives, "negative_id": ids, "negative_score": score})

    far = _meet(with_scores, rows, n_anchors, n_rows, find_negatives, "anchor long, at long, negative_id long, negative_score long")
    w = Window.partitionBy("anchor", "at").orderBy(F.desc("negative_score"), "negative_id")
    far = far.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= negatives)
    named = far.join(found, ["anchor", "at"]).join(asked.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@query("op12_hard_negatives", """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.other AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) AS INT) AS rank,
       n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 100 * n.score BETWEEN 80 * p.score AND 100 * p.score
QUALIFY rank <= 5""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)
