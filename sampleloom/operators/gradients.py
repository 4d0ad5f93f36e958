"""Gradients per id: merge, norm and clip."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleloom.functions import vectors as V


def merge_gradients(grads: DataFrame, dim: int, keys: tuple[str, ...] = ("fid",)) -> DataFrame:
    """Sum the gradients of equal ids. Partial sums are taken before the shuffle, so a hot id
    costs one row per input partition."""
    return grads.groupBy(*keys).agg(F.array(*V.sum_agg("grad", dim)).alias("grad"))


def clip_by_global_norm(grads: DataFrame, clip: float, vector: str = "grad") -> DataFrame:
    """Scale all vectors by ``clip / max(norm, clip)`` with the norm over the whole table, which
    enters as a scalar subquery."""
    norm = grads.agg(F.sqrt(F.coalesce(F.sum(V.sum_squares(vector)), F.lit(0.0)))).scalar()
    out = grads.withColumn("global_norm", norm)
    k = F.lit(float(clip)) / F.greatest(F.col("global_norm"), F.lit(float(clip)))
    return out.withColumn(vector, V.scale(vector, k))
