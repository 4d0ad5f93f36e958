"""Batches of rows: fixed-size windows, row/column layouts, last-row flags, step gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleloom.functions.vectors import each
from sampleloom.operators.joins import lookup_join
from sampleloom.operators.ordering import HOT_ROWS, positions, with_totals


def count_window(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int,
                 drop_remainder: bool = True, name: str = "batch_no",
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """Number consecutive groups of ``size`` rows inside ``keys``; a short last group is dropped
    when asked."""
    n = positions(df, keys, [F.col(c) for c in order], "_pos", hot_rows)
    out = n.withColumn(name, F.floor((F.col("_pos") - 1) / F.lit(size)).cast("bigint"))
    if drop_remainder:
        out = with_totals(out, list(keys), {"_n": F.count(F.lit(1))}, hot_rows)
        out = out.filter(F.col(name) < F.floor(F.col("_n") / F.lit(size)))
    return out.select(*df.columns, name)


def merge_windows(batches: DataFrame, keys: Sequence[str], batch_no: str, size: int,
                  drop_remainder: bool = True) -> DataFrame:
    """Merge ``size`` consecutive batches into one window."""
    out = batches.withColumn("window_no", F.floor(F.col(batch_no) / F.lit(size)).cast("bigint"))
    if not drop_remainder:
        return out
    last = batches.groupBy(F.struct(*keys).alias("_k")).agg((F.max(batch_no) + 1).alias("_n"))
    j = lookup_join(out.withColumn("_k", F.struct(*keys)), last, "_k")
    return j.filter(F.col("window_no") < F.floor(F.col("_n") / F.lit(size))).select(*out.columns)


def mark_last(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              name: str = "is_last") -> DataFrame:
    """Flag the last row of each key. The maximum is a partial aggregate, so no key is sorted."""
    at, key = F.struct(*order), F.struct(*keys)
    last = df.groupBy(key.alias("_k")).agg(F.max(at).alias("_last"))
    j = lookup_join(df.withColumn("_k", key), last, "_k")
    return j.select(*df.columns, (F.struct(*order) == F.col("_last")).alias(name))


def rows_to_batches(df: DataFrame, batch: str, order: str, columns: Sequence[str]) -> DataFrame:
    """One row per batch with an ordered list per column. ``batch`` comes from a window of fixed
    size, so the lists are bounded."""
    g = df.groupBy(batch).agg(
        F.array_sort(F.collect_list(F.struct(order, *columns))).alias("_r"))
    return g.select(batch, F.size("_r").alias("batch_size"),
                    *[each("_r", c).alias(c) for c in [order, *columns]])


def batches_to_rows(batches: DataFrame, batch: str, columns: Sequence[str],
                    context: DataFrame | None = None) -> DataFrame:
    """Back to rows, repeating shared per-batch columns."""
    zipped = F.arrays_zip(*columns)
    rows = (batches.select(batch, F.posexplode(zipped).alias("pos", "_r"))
            .select(batch, "pos", *[F.col("_r").getField(c).alias(c) for c in columns]))
    return rows if context is None else lookup_join(rows, context, batch)


def step_interval(seen: DataFrame, key: str, step: str, alpha: float = 0.1,
                  start: float = 0.0, chunk_steps: int = 4096) -> DataFrame:
    """Moving mean gap between appearances: B = (1−α)·B + α·(step − A), A = step.

    The recurrence is linear, so each (key, chunk of steps) is reduced to the count, the weighted
    gap sum and its first and last step; the chunks of a key are then chained in order. Lists
    hold at most ``chunk_steps`` distinct steps, or one entry per chunk.
    """
    keep = 1.0 - alpha
    steps = seen.groupBy(key, F.col(step).cast("bigint").alias("_s")).agg(
        F.count(F.lit(1)).alias("_m"))
    chunk = F.floor(F.col("_s") / F.lit(chunk_steps)).cast("bigint")
    lists = steps.groupBy(key, chunk.alias("_c")).agg(
        F.array_sort(F.collect_list(F.struct("_s", "_m"))).alias("_l"))

    def advance(acc: Column, s: Column, m: Column, gap: Column) -> Column:
        # the first appearance in a step sees the gap, repeats in the same step see 0
        m = m.cast("double")
        b = acc.getField("b") * F.pow(F.lit(keep), m) + gap * F.lit(alpha) * F.pow(F.lit(keep), m - 1)
        return F.struct(b.alias("b"), (acc.getField("n") + m).alias("n"), s.alias("last"))

    first = F.get("_l", F.lit(0))
    zero = F.struct(F.lit(0.0).alias("b"), F.lit(0.0).alias("n"),
                    first.getField("_s").alias("last"))
    inner = F.aggregate("_l", zero, lambda a, e: advance(
        a, e.getField("_s"), e.getField("_m"), (e.getField("_s") - a.getField("last")).cast("double")))
    part = lists.select(key, "_c", first.getField("_s").alias("first"),
                        inner.alias("r"))
    # A chunk maps B to keep^n·B + b plus the share of the gap before its first step.
    chained = part.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(
        "_c", "first", F.col("r.b").alias("b"), F.col("r.n").alias("n"),
        F.col("r.last").alias("last")))).alias("_p"), F.sum("r.n").alias("appearances"))
    begin = F.struct(F.lit(float(start)).alias("b"), F.lit(0).cast("bigint").alias("last"))
    end = F.aggregate("_p", begin, lambda a, e: F.struct(
        (a.getField("b") * F.pow(F.lit(keep), e.getField("n")) + e.getField("b")
         + (e.getField("first") - a.getField("last")).cast("double") * F.lit(alpha)
         * F.pow(F.lit(keep), e.getField("n") - 1)).alias("b"),
        e.getField("last").alias("last")))
    return chained.select(key, F.col("appearances").cast("bigint").alias("appearances"),
                          end.getField("b").alias("interval"))
