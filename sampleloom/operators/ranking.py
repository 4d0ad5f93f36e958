"""Losses and metrics of ranked lists: rows ``(query_id, item_id, label, score[, weight])``.

Labels below 0 mark invalid entries. Every function takes any list size: ranks and totals switch to
a skew-safe form for big lists, and pairwise terms go through tiles.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleloom.functions.base import u01
from sampleloom.functions.numeric import cross_entropy
from sampleloom.operators.ordering import HOT_ROWS, first_in_key, largest_group, positions, running, with_totals
from sampleloom.operators.pairs import TILE_ROWS, Pairs, map_pairs, tile_pairs

Q, ITEM = "query_id", "item_id"
EPSILON = 1e-10  # fixed value: smallest probability given to an invalid entry


def valid(label: str | Column = "label") -> Column:
    return (F.col(label) if isinstance(label, str) else label) >= 0


def _gain(label: Column) -> Column:
    return F.pow(F.lit(2.0), label) - 1.0


def _log_discount(rank: Column) -> Column:
    return F.lit(1.0) / F.log1p(rank.cast("double"))


def top_n_by_score(lists: DataFrame, n: int) -> DataFrame:
    """First ``n`` rows of each list by score, with their rank."""
    return first_in_key(lists, [Q], n, [F.desc("score"), F.col(ITEM)], "rank")


def group_lists(rows: DataFrame, rank_id: str, order: str, hot_rows: int = HOT_ROWS,
                largest: int | None = None) -> DataFrame:
    """Flat rows to lists: the place of each row in its list and the list's size."""
    largest = largest_group(rows, [rank_id]) if largest is None else largest
    placed = positions(rows, [rank_id], [F.col(order)], "place", hot_rows, largest)
    return with_totals(placed, [rank_id], {"list_size": F.count(F.lit(1))}, hot_rows, largest)


def _largest(lists: DataFrame, known: int | None) -> int:
    """Size of the biggest list, measured once per call chain."""
    return largest_group(lists, [Q], TILE_ROWS) if known is None else known


def _clean(lists: DataFrame) -> DataFrame:
    return lists.withColumn("_l", F.when(valid(), F.col("label").cast("double")).otherwise(0.0))


def inverse_max_dcg(lists: DataFrame, topn: int | None = None, gain=_gain, discount=_log_discount,
                    hot_rows: int = HOT_ROWS,
                    largest: int | None = None) -> DataFrame:
    """``(query_id, inv_max_dcg)``: one over the DCG of the ideal order, 0 without any gain."""
    largest = _largest(lists, largest)
    ideal = positions(_clean(lists).select(Q, ITEM, "_l"), [Q], [F.desc("_l"), F.col(ITEM)], "_r", hot_rows, largest)
    if topn is not None:
        ideal = ideal.filter(F.col("_r") <= topn)
    dcg = F.sum(gain(F.col("_l")) * discount(F.col("_r")))
    return ideal.groupBy(Q).agg(F.when(dcg > 0, F.lit(1.0) / dcg).otherwise(0.0).alias("inv_max_dcg"))


def approx_ranks(lists: DataFrame, alpha: float = 10.0, tile_rows: int = TILE_ROWS,
                 largest: int | None = None) -> DataFrame:
    """``(query_id, item_id, approx_rank)``: 0.5 + Σ_j sigmoid(α·(s_j − s_i)) over the list."""
    largest = _largest(lists, largest)
    t = tile_pairs(lists.select(Q, ITEM, "score"), Q, ITEM, [ITEM, "score"], tile_rows=tile_rows, largest=largest)

    kind = lists.schema

    def sums(group: pa.Array, p: Pairs) -> pa.RecordBatch:
        value = 1 / (1 + np.exp(-np.clip((p.b("score") - p.a("score")) * alpha, -700, 700)))
        total = np.bincount(p.l, weights=value, minlength=p.lefts)
        return pa.RecordBatch.from_arrays([group.take(pa.array(p.row_of_left)), p.left.field(ITEM), pa.array(total)], names=[Q, ITEM, "value"])

    part = map_pairs(t, f"{Q} {kind[Q].dataType.simpleString()}, {ITEM} {kind[ITEM].dataType.simpleString()}, value double", sums)
    return part.groupBy(Q, ITEM).agg((F.sum("value") + 0.5).alias("approx_rank"))


def approx_ndcg(lists: DataFrame, alpha: float = 10.0, tile_rows: int = TILE_ROWS,
                hot_rows: int = HOT_ROWS,
                largest: int | None = None) -> DataFrame:
    """``(query_id, loss)``: −DCG over smooth ranks times the inverse ideal DCG; lists without a
    positive label sum are left out."""
    largest = _largest(lists, largest)
    low = with_totals(_clean(lists), [Q], {"_min": F.min("score"), "_sum": F.sum("_l")}, hot_rows, largest)
    # an invalid row sinks far below the lowest score of its list
    rows = low.filter("_sum > 0").withColumn(
        "score", F.when(valid(), F.col("score")).otherwise(F.col("_min") - 1000.0))
    ranks = approx_ranks(rows, alpha, tile_rows, largest)
    dcg = (rows.select(Q, ITEM, "_l").join(ranks, [Q, ITEM]).groupBy(Q)
           .agg(F.sum(_gain(F.col("_l")) * _log_discount(F.col("approx_rank"))).alias("_dcg")))
    inv = inverse_max_dcg(rows, hot_rows=hot_rows, largest=largest)
    return dcg.join(inv, Q).select(Q, (-F.col("_dcg") * F.col("inv_max_dcg")).alias("loss"))


# ---------------------------------------------------------------- lambda weights

@dataclass(frozen=True)
class LambdaWeight:
    """Pair weight: ``dcg``, ``precision``, ``list_mle`` (row weights only) or ``identity``."""

    kind: str
    topn: int | None = None
    gain: str = "exp"  # exp: 2^l − 1, linear: l
    discount: str = "log"  # log: 1/ln(1 + rank), inverse: 1/rank
    normalized: bool = False
    smooth: float = 0.0
    list_size: int = 0

    def __post_init__(self) -> None:
        if self.kind not in ("dcg", "precision", "list_mle", "identity"):
            raise ValueError(f"unknown lambda weight {self.kind}")
        if not 0.0 <= self.smooth <= 1.0:
            raise ValueError("smooth fraction must lie in [0, 1]")
        if self.kind == "precision" and not self.topn:
            raise ValueError("precision needs topn")

    def gain_of(self, label: Column) -> Column:
        return _gain(label) if self.gain == "exp" else label

    def discount_of(self, rank: Column) -> Column:
        r = rank.cast("double")
        return _log_discount(r) if self.discount == "log" else F.lit(1.0) / r

    def mle_weight(self, rank: Column) -> Column:
        """Row weight of position-aware ListMLE."""
        return F.pow(F.lit(2.0), F.lit(float(self.list_size)) - rank.cast("double")) - 1.0


def ndcg_weight(topn: int | None = None, smooth: float = 0.0) -> LambdaWeight:
    return LambdaWeight("dcg", topn, normalized=True, smooth=smooth)


def reciprocal_rank_weight(topn: int | None = None, smooth: float = 0.0) -> LambdaWeight:
    return LambdaWeight("dcg", topn, "linear", "inverse", True, smooth)


def p_list_mle_weight(list_size: int) -> LambdaWeight:
    return LambdaWeight("list_mle", list_size=list_size)


def _ranked(lists: DataFrame, lam: LambdaWeight | None, hot_rows: int, largest: int) -> DataFrame:
    """Add the rank by score (invalid rows last), the list size and the row's gain."""
    cols = [Q, ITEM, "label", "score",
            (F.col("weight") if "weight" in lists.columns else F.lit(1.0)).cast("double").alias("weight")]
    out = _clean(lists.select(*cols))
    out = positions(out, [Q], [F.col("label") < 0, F.desc("score"), F.col(ITEM)], "_rank", hot_rows, largest)
    out = with_totals(out, [Q], {"_size": F.count(F.lit(1))}, hot_rows, largest)
    out = out.withColumn("_size", F.col("_size").cast("double"))
    gain = lam.gain_of(F.col("_l")) if lam and lam.kind == "dcg" else F.col("_l")
    if lam and lam.kind == "dcg" and lam.normalized:
        inv = inverse_max_dcg(lists, lam.topn, lam.gain_of, lam.discount_of, hot_rows, largest)
        from sampleloom.operators.joins import lookup_join
        out = lookup_join(out, inv, Q, hot_rows=hot_rows)
        gain = gain * F.col("inv_max_dcg")
    return out.withColumn("_gain", gain)


def _np_discount(lam: LambdaWeight, rank: np.ndarray) -> np.ndarray:
    return 1 / np.log1p(rank) if lam.discount == "log" else 1 / rank


def _pair_weight(p: Pairs, lam: LambdaWeight | None) -> np.ndarray:
    """Weights of pairs; ranks are counted from 1."""
    if lam is None:
        return np.abs(p.a("_l") - p.b("_l"))
    if lam.kind == "identity":
        return np.ones(len(p.l))
    if lam.kind == "list_mle":
        return p.b("_l")
    ra, rb = p.a("_rank").astype(float), p.b("_rank").astype(float)
    if lam.kind == "precision":
        differ = (p.a("_l") >= 1) != (p.b("_l") >= 1)
        return (differ & ((ra <= lam.topn) != (rb <= lam.topn))).astype(float)
    top = lam.topn or np.inf
    gap = np.abs(np.minimum(ra, top + 1) - np.minimum(rb, top + 1))
    near = np.maximum(gap, 1)  # equal ranks have weight 0
    u = np.where(gap > 0, np.abs(_np_discount(lam, near) - _np_discount(lam, near + 1)), 0) * (1 - lam.smooth)
    if lam.smooth > 0:
        at = lambda r: np.where(r > top, 0, _np_discount(lam, r))
        u = u + np.abs(at(ra) - at(rb)) * lam.smooth
    return np.where((ra <= top) | (rb <= top), np.abs(p.a("_gain") - p.b("_gain")) * u, 0)


def pair_loss(kind: str, diff: np.ndarray) -> np.ndarray:
    if kind == "hinge":
        return np.maximum(1 - diff, 0)
    if kind == "logistic":
        return np.maximum(-diff, 0) + np.log1p(np.exp(-np.abs(diff)))
    if kind == "soft_zero_one":
        return 1 / (1 + np.exp(np.clip(diff, -700, 700)))
    raise ValueError(f"unknown pairwise loss {kind}")


def pairwise_loss(lists: DataFrame, kinds: Sequence[str], lam: LambdaWeight | None = None,
                  lambda_scale: bool = True, tile_rows: int = TILE_ROWS,
                  hot_rows: int = HOT_ROWS,
                  largest: int | None = None) -> DataFrame:
    """Per list: weighted sum of each pairwise loss over pairs with l_i > l_j, and the number of
    pairs of nonzero weight. Divide totals by counts with :func:`reduce_nonzero`."""
    largest = _largest(lists, largest)
    rows = _ranked(lists, lam, hot_rows, largest).filter(valid())
    fields = [ITEM, "score", "weight", "_l", "_rank", "_gain", "_size"]
    t = tile_pairs(rows, Q, ITEM, fields, [ITEM, "score", "_l", "_rank", "_gain"], tile_rows=tile_rows, largest=largest)

    def sums(group: pa.Array, p: Pairs) -> pa.RecordBatch:
        ahead = p.a("_l") > p.b("_l")
        w = np.where(ahead, p.a("weight") * _pair_weight(p, lam) * (p.a("_size") if lam is not None and lambda_scale else 1), 0)
        diff = p.a("score") - p.b("score")
        cols = [np.bincount(p.row, weights=np.where(ahead, w * pair_loss(k, diff), 0), minlength=p.rows) for k in kinds]
        n = np.bincount(p.row, weights=ahead & (w != 0), minlength=p.rows).astype(np.int64)
        return pa.RecordBatch.from_arrays([group, *[pa.array(c) for c in cols], pa.array(n)], names=[Q, *kinds, "pairs"])

    schema = ", ".join([f"{Q} {lists.schema[Q].dataType.simpleString()}", *[f"{k} double" for k in kinds], "pairs bigint"])
    return map_pairs(t, schema, sums).groupBy(Q).agg(*[F.sum(k).alias(k) for k in kinds], F.sum("pairs").alias("pairs"))


def reduce_nonzero(parts: DataFrame, sums: Sequence[str], count: str) -> DataFrame:
    """Totals over all lists divided by the number of nonzero weights."""
    n = F.sum(count).cast("double")
    return parts.agg(*[F.when(n > 0, F.sum(s) / n).otherwise(0.0).alias(s) for s in sums],
                     F.sum(count).alias(count))


def dcg_row_weights(lists: DataFrame, lam: LambdaWeight, hot_rows: int = HOT_ROWS,
                    largest: int | None = None) -> DataFrame:
    """``(query_id, item_id, row_weight)``: gain times rank discount at the rank by score."""
    largest = _largest(lists, largest)
    r = _ranked(lists, lam, hot_rows, largest)
    return r.select(Q, ITEM, (F.col("_gain") * lam.discount_of(F.col("_rank"))).alias("row_weight"))


def softmax_list_loss(lists: DataFrame, lam: LambdaWeight | None = None,
                      hot_rows: int = HOT_ROWS,
                      largest: int | None = None) -> DataFrame:
    """``(query_id, loss, label_sum)``: list softmax cross-entropy with normalised labels times the
    label sum; lists without a positive label sum are left out."""
    largest = _largest(lists, largest)
    r = _ranked(lists, lam, hot_rows, largest)
    lab = F.col("_gain") * lam.discount_of(F.col("_rank")) if lam and lam.kind == "dcg" else F.col("_l")
    logit = F.when(valid(), F.col("score")).otherwise(F.lit(math.log(EPSILON)))
    r = r.select(Q, (lab * F.col("weight")).alias("_y"), logit.alias("_s"))
    r = with_totals(r, [Q], {"_max": F.max("_s")}, hot_rows, largest)
    g = r.groupBy(Q).agg(F.sum("_y").alias("label_sum"), F.sum(F.col("_y") * F.col("_s")).alias("_ys"),
                         (F.log(F.sum(F.exp(F.col("_s") - F.col("_max")))) + F.max("_max")).alias("_lse"))
    loss = F.col("_lse") * F.col("label_sum") - F.col("_ys")
    return g.filter("label_sum > 0").select(Q, loss.alias("loss"), "label_sum")


def pointwise_losses(lists: DataFrame) -> DataFrame:
    """Mean sigmoid cross-entropy and mean squared error over valid rows, by nonzero weight."""
    w = (F.col("weight") if "weight" in lists.columns else F.lit(1.0)).cast("double")
    y, s = F.col("label").cast("double"), F.col("score")
    n = F.sum(F.when(w != 0, 1.0).otherwise(0.0))
    return lists.filter(valid()).agg(
        (F.sum(w * cross_entropy(y, s)) / n).alias("sigmoid_cross_entropy"),
        (F.sum(w * (y - s) * (y - s)) / n).alias("mean_squared"),
        n.cast("bigint").alias("rows"))


def list_mle(lists: DataFrame, seed: str = "mle", lam: LambdaWeight | None = None,
             hot_rows: int = HOT_ROWS,
             largest: int | None = None) -> DataFrame:
    """``(query_id, loss)``: Σ log Σ_{j≥i} e^{s_j} − s_i along the label order, ties in a repeatable
    random order. Read backwards, the inner sum is a plain running sum."""
    largest = _largest(lists, largest)
    logit = F.when(valid(), F.col("score")).otherwise(F.lit(math.log(EPSILON)))
    tie = F.when(valid(), u01(F.concat_ws("|", Q, ITEM), seed)).otherwise(F.lit(-1e-6))
    r = _clean(lists).select(Q, ITEM, "_l", logit.alias("_s"), tie.alias("_u"))
    r = with_totals(r, [Q], {"_max": F.max("_s"), "_n": F.count(F.lit(1))}, hot_rows, largest)
    r = r.withColumn("_s", F.col("_s") - F.col("_max"))
    back = [F.col("_l"), F.col("_u"), F.col(ITEM)]
    r = running(r, [Q], back, {"_tail": F.exp(F.col("_s")), "_pos": F.lit(1).cast("bigint")}, hot_rows, largest)
    term = F.log("_tail") - F.col("_s")
    if lam is not None and lam.kind == "list_mle":
        term = term * lam.mle_weight(F.col("_n") - F.col("_pos") + 1)
    return r.groupBy(Q).agg(F.sum(term).alias("loss"))


LOSSES = ("pairwise_hinge", "pairwise_logistic", "pairwise_soft_zero_one", "softmax",
          "sigmoid_cross_entropy", "mean_squared", "list_mle", "approx_ndcg")


def loss_value(lists: DataFrame, key: str, lam: LambdaWeight | None = None, seed: str = "mle") -> DataFrame:
    """One-row frame ``(loss)`` of a named loss over all lists."""
    if key.startswith("pairwise_"):
        kind = key.removeprefix("pairwise_")
        return reduce_nonzero(pairwise_loss(lists, [kind], lam), [kind], "pairs").select(F.col(kind).alias("loss"))
    if key == "softmax":
        return softmax_list_loss(lists, lam).agg(F.avg("loss").alias("loss"))
    if key in ("sigmoid_cross_entropy", "mean_squared"):
        return pointwise_losses(lists).select(F.col(key).alias("loss"))
    if key == "list_mle":
        return list_mle(lists, seed, lam).agg(F.avg("loss").alias("loss"))
    if key == "approx_ndcg":
        return approx_ndcg(lists).agg(F.avg("loss").alias("loss"))
    raise ValueError(f"unknown loss {key}; known: {LOSSES}")


def combined_loss(lists: DataFrame, keys: Sequence[str], weights: Sequence[float] | None = None,
                  lam: LambdaWeight | None = None, seed: str = "mle") -> DataFrame:
    """Weighted sum of named losses, as one row with the parts beside it."""
    if not keys:
        raise ValueError("no loss given")
    if weights is not None and len(weights) != len(keys):
        raise ValueError("one weight per loss is needed")
    weights = weights or [1.0] * len(keys)
    parts = None
    for k, w in zip(keys, weights):
        one = loss_value(lists, k, lam, seed).select(F.lit(k).alias("k"), (F.col("loss") * float(w)).alias("v"))
        parts = one if parts is None else parts.unionByName(one)
    return parts.groupBy().pivot("k", list(keys)).agg(F.sum("v")).withColumn(
        "loss", sum((F.col(k) for k in keys), F.lit(0.0)))
