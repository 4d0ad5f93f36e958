"""Sampling-corrected and in-batch losses."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleloom.functions import numeric as N
from sampleloom.functions import vectors as V
from sampleloom.functions.base import ColumnLike, col_of, let, u01
from sampleloom.operators.ordering import largest_group
from sampleloom.operators.pairs import TILE_ROWS, Pairs, map_pairs, per_left, tile_pairs


def sigmoid_loss(logit: ColumnLike, label: ColumnLike, sample_rate: ColumnLike | None = None,
                 sample_bias: bool = False, instance_weight: ColumnLike | None = None,
                 mask: Column | None = None, logit_clip: float | None = None) -> Column:
    """Loss of one row: cross-entropy at the corrected, optionally clipped logit, times the
    weight; 0 where masked out. Sum it over the batch."""
    z = N.clip_logit(N.logit_correction(logit, sample_rate, sample_bias), logit_clip)
    loss = N.cross_entropy(label, z)
    if instance_weight is not None:
        loss = loss * col_of(instance_weight)
    return loss if mask is None else F.when(mask, loss).otherwise(F.lit(0.0))


def sigmoid_prediction(logit: ColumnLike, sample_rate: ColumnLike | None = None,
                       sample_bias: bool = False, before_correction: bool = True) -> Column:
    return N.sigmoid(logit if before_correction else N.logit_correction(logit, sample_rate, sample_bias))


def softmax_loss(logits: ColumnLike, label: ColumnLike) -> Column:
    """Softmax cross-entropy of one row's logits against its label distribution."""
    x = col_of(logits)

    def at(lse: Column) -> Column:
        return F.aggregate(F.zip_with(col_of(label), x, lambda y, v: y * (lse - v)), F.lit(0.0), lambda s, v: s + v)

    return let(F.array_max(x), lambda top: let(
        F.log(F.aggregate(x, F.lit(0.0), lambda s, v: s + F.exp(v - top))) + top, at))


def softmax_prediction(logits: ColumnLike) -> Column:
    return (F.array_position(col_of(logits), F.array_max(logits)) - 1).cast("int")


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _partition_sums(queries: pd.Series, items: pd.Series, shifts: pd.Series, temperature: pd.Series) -> pd.Series:
    """Per tile pair: for each query the sum of exp(q·v / t − shift) over the items, as one matrix
    product."""
    out = []
    for q, v, f, t in zip(queries, items, shifts, temperature):
        sim = np.stack(q) @ np.stack(v).T / t
        out.append(np.exp(sim - np.asarray(f)[None, :]).sum(axis=1))
    return pd.Series(out)


def _one_tile(t: pa.Table, temperature: float) -> pa.Table:
    """Loss of one batch, its similarities as one matrix product. Rows without a key or weight have items, but no loss of their own."""
    t = t.combine_chunks()
    q, v = (np.stack(t[c].to_numpy()) for c in ("_q", "_v"))
    f, r = np.asarray(t["_f"]), np.asarray(t["_r"].fill_null(0.0))
    sim = q @ v.T / temperature - f[None, :]
    each = r * (np.diagonal(sim) - np.log(np.exp(sim).sum(axis=1)))
    counted = np.asarray(pc.and_(t["_key"], pc.is_valid(t["_r"])))
    loss = pa.array([-each[counted].sum()] if counted.any() else [None], pa.float64())
    return pa.table({t.column_names[0]: t[t.column_names[0]].slice(0, 1), "loss": loss})


def batch_softmax_loss(df: DataFrame, batch: str, key: str, query: str, item: str, interval: str,
                       r: str, normalize: bool = True, temperature: float = 1.0,
                       tile_rows: int = TILE_ROWS) -> DataFrame:
    """``(batch, loss)``: −Σ r·log softmax of a row's own item among all items of its batch, with
    the popularity correction −log(1/max(interval, 1)) on every similarity.

    Batches within one tile are read one after the other by the task that holds them; rows that come partitioned and sorted by
    ``batch`` (:func:`ordering.together_sorted`) are neither moved, sorted nor collected for it. Larger batches meet tile by tile."""
    if temperature <= 0:
        raise ValueError("temperature must be positive")
    unit = V.l2_normalize if normalize else V.doubles
    freq = F.lit(1.0) / F.greatest(F.col(interval).cast("double"), F.lit(1.0))
    rows = df.select(batch, key, unit(V.doubles(query)).alias("_q"), unit(V.doubles(item)).alias("_v"),
                     F.log(freq).alias("_f"), F.col(r).cast("double").alias("_r"))
    if largest_group(df, [batch], tile_rows) <= tile_rows:
        kind = rows.schema[batch].dataType.simpleString()
        scored = rows.filter(F.col(batch).isNotNull()).withColumn("_key", F.col(key).isNotNull()).select(batch, "_key", "_q", "_v", "_f", "_r")

        def run(tile: pa.Table) -> pa.Table:
            return _one_tile(tile, float(temperature))

        return scored.groupBy(batch).applyInArrow(run, f"{batch} {kind}, loss double")
    t = tile_pairs(rows, batch, key, [key, "_q"], [key, "_v", "_f"], tile_rows=tile_rows, largest=tile_rows + 1)
    scores = _partition_sums(V.each("left", "_q"), V.each("right", "_v"), V.each("right", "_f"), F.lit(float(temperature)))
    each_key = F.arrays_zip(V.each("left", key).alias(key), scores.alias("value"))
    sums = t.select(batch, F.inline(each_key)).toDF(batch, key, "value").groupBy(batch, key).agg(F.sum("value").alias("_all"))
    own = V.dot("_q", "_v") / F.lit(float(temperature)) - F.col("_f")
    each = rows.select(batch, key, "_r", own.alias("_own")).join(sums, [batch, key])
    return each.groupBy(batch).agg((-F.sum(F.col("_r") * (F.col("_own") - F.log("_all")))).alias("loss"))


# Labels at or below this are neither positive nor negative; the range in which the
# exponential of a difference is taken.
NOT_A_LABEL = -10000.0
DIFF_LOW, DIFF_HIGH = -87.0, 88.0


def _signs(label: str) -> tuple[Column, Column]:
    y = F.col(label)
    return y > 0, (y <= 0) & (y > NOT_A_LABEL)


def inbatch_auc(df: DataFrame, batch: str, key: str, label: str, logit: str,
                tile_rows: int = TILE_ROWS) -> DataFrame:
    """``(batch, loss)``: Σ log sigmoid(s_pos − s_neg) over positive × negative pairs."""
    rows = df.select(batch, key, F.col(label).alias("_y"), F.col(logit).cast("double").alias("_s"))
    pos, neg = _signs("_y")
    t = tile_pairs(rows, batch, key, [key, "_s"], left_if=pos, right_if=neg, tile_rows=tile_rows)

    def sums(group: pa.Array, p: Pairs) -> pa.RecordBatch:
        d = p.a("_s") - p.b("_s")
        inside = d - np.log1p(np.exp(np.clip(d, DIFF_LOW, DIFF_HIGH)))
        x = np.where(d <= DIFF_LOW, d, np.where(d < DIFF_HIGH, inside, 0))
        return pa.RecordBatch.from_arrays([group, pa.array(np.bincount(p.row, weights=x, minlength=p.rows))], names=[batch, "_x"])

    schema = f"{batch} {df.schema[batch].dataType.simpleString()}, _x double"
    return map_pairs(t, schema, sums).groupBy(batch).agg(F.sum("_x").alias("loss"))


def inbatch_auc_gradient(df: DataFrame, batch: str, key: str, label: str, logit: str,
                         grad: float = 1.0, neg_weight: float = 1.0,
                         tile_rows: int = TILE_ROWS) -> DataFrame:
    """``(batch, key, grad)``: derivative of :func:`inbatch_auc`; the negative side is scaled by
    ``neg_weight``."""
    if not 0 < neg_weight <= 1:
        raise ValueError("neg_weight must lie in (0, 1]")
    rows = df.select(batch, key, F.col(label).alias("_y"), F.col(logit).cast("double").alias("_s"))
    pos, neg = _signs("_y")

    def pair(d: Column) -> Column:
        mid = F.lit(1.0) / (F.lit(1.0) + F.exp(F.least(F.greatest(d, F.lit(DIFF_LOW)), F.lit(DIFF_HIGH))))
        return F.when(d <= DIFF_LOW, F.lit(1.0)).when(d < DIFF_HIGH, mid).otherwise(F.lit(0.0))

    t = tile_pairs(rows, batch, key, [key, "_s"], left_if=pos, right_if=neg, tile_rows=tile_rows)
    ups = per_left(F.col("left"), F.col("right"), F.lit(0.0),
                   lambda acc, a, b: acc + pair(a.getField("_s") - b.getField("_s")), key)
    downs = per_left(F.col("right"), F.col("left"), F.lit(0.0),
                     lambda acc, b, a: acc - F.lit(float(neg_weight)) * pair(a.getField("_s") - b.getField("_s")), key)
    moved = (t.select(batch, F.inline(F.concat(ups, downs))).groupBy(batch, key)
             .agg((F.sum("value") * float(grad)).alias("grad")))
    return rows.select(batch, key).join(moved, [batch, key], "left").select(
        batch, key, F.coalesce("grad", F.lit(0.0)).alias("grad"))


def eval_samples(df: DataFrame, key: str, ratio: float, fields: Sequence[str]) -> DataFrame:
    """Repeatable share of the evaluated samples as JSON text, one line per sample."""
    return df.filter(u01(key, "eval") < ratio).select(key, F.to_json(F.struct(*fields)).alias("record"))
