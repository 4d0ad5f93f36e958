"""Keyed joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from sampleloom.operators.ordering import sampling

# Keys heavier than this go the broadcast way; at most MAX_HOT of them, the rest is shuffled.
HOT_ROWS = 1_000_000
MAX_HOT = 1_000
# So many rows of a table, vectors for example, may be sent to every task.
SENT_ROWS = 1 << 15


def heavy_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS, max_hot: int = MAX_HOT) -> list:
    """Values of ``key`` with more than about ``hot_rows`` rows, heaviest first, ``max_hot`` at
    most. A thin sample is enough: the list only decides which way a row is joined."""
    thin, share = sampling(df.select(key), hot_rows)
    top = (thin.groupBy(key).count().filter((F.col("count") > hot_rows * share) & F.col(key).isNotNull())
           .orderBy(F.desc("count"), key).limit(max_hot))
    return [r[0] for r in top.collect()]


def _literal(value, dtype: str) -> Column:
    """Key value, plain or a struct, as a literal of the key's type."""
    if isinstance(value, Row):
        return F.struct(*[F.lit(v).alias(n) for n, v in value.asDict().items()]).cast(dtype)
    return F.lit(value)


def lookup_join(left: DataFrame, right: DataFrame, key: str, how: str = "left",
                hot_rows: int | None = None, largest: int | None = None) -> DataFrame:
    """Join many rows to a table that holds each ``key`` once.

    By default no job runs here: adaptive execution splits the skewed partitions of ``left`` and picks a broadcast by
    measured size. With ``hot_rows`` the heavy keys of ``left`` are looked up first (a job over its key column); they
    (few by construction) meet a broadcast of just their rows of ``right``, all others take the shuffle. ``largest`` is
    a known upper bound of the rows per key; a low one saves the count.
    """
    if left.isStreaming or hot_rows is None or (largest is not None and largest <= hot_rows):
        return left.join(right, key, how)
    hot = heavy_keys(left, key, hot_rows)
    if not hot:
        return left.join(right, key, how)
    is_hot = F.col(key).isin([_literal(v, dict(left.dtypes)[key]) for v in hot])
    cold = left.filter(~is_hot | F.col(key).isNull()).join(right.filter(~is_hot), key, how)
    warm = left.filter(is_hot).join(F.broadcast(right.filter(is_hot)), key, how)
    return cold.unionByName(warm)


def few_keys(left: DataFrame, key: str, most: int = SENT_ROWS) -> bool:
    """Whether ``left`` names at most ``most`` different keys: a job over its key column."""
    return not left.isStreaming and left.select(key).filter(F.col(key).isNotNull()).distinct().limit(most + 1).count() <= most


def sent_rows(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The rows of ``right`` that ``left``, one of :func:`few_keys`, names, to be sent to every task of a join: the other side
    stays where it is and keeps its partitioning."""
    named = left.select(key).filter(F.col(key).isNotNull()).distinct()
    return F.broadcast(right.join(named, key, "left_semi"))


def context_join(rows: DataFrame, context: DataFrame, key: str) -> DataFrame:
    """Attach shared per-request features to the rows of the request."""
    return lookup_join(rows, context, key)


def semi_file(df: DataFrame, values: DataFrame, column: str, op: str) -> DataFrame:
    """Keep rows whose ``column`` is in (or not in) a one-column table of operands."""
    if op not in ("in", "not-in"):
        raise ValueError("an operand file supports in and not-in only")
    (name, dtype), = values.dtypes
    if dtype != dict(df.dtypes)[column]:
        raise ValueError(f"operand type {dtype} differs from {column}: {dict(df.dtypes)[column]}")
    ops = values.select(F.col(name).alias(column)).filter(F.col(column).isNotNull()).distinct()
    how = "left_semi" if op == "in" else "left_anti"
    return lookup_join(df, ops, column, how)  # Spark broadcasts the operands if their measured bytes are few


