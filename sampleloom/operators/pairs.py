"""Work on the pairs of a group without ever producing pair rows.

A group is cut into tiles of bounded size; two tiles meet as two arrays in one row and the caller
folds over them. A group within one tile costs one aggregation. A hot group becomes many tiles that
meet each other in separate rows, so its pairs are spread over tasks and none is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleloom.operators.joins import lookup_join
from sampleloom.operators.ordering import largest_group

TILE_ROWS = 512


def tile_pairs(df: DataFrame, group: str, row_key: str, payload: Sequence[str],
               right_payload: Sequence[str] | None = None, left_if: Column | None = None,
               right_if: Column | None = None, tile_rows: int = TILE_ROWS,
               largest: int | None = None) -> DataFrame:
    """``(group, left, right)``: every ordered pair of rows of a group occurs in exactly one output
    row, one member in ``left`` and one in ``right``. The filters thin out either side."""
    right_payload = payload if right_payload is None else right_payload

    def side(cols: Sequence[str], keep: Column | None) -> Column:
        row = F.struct(row_key, *[c for c in cols if c != row_key])
        return F.collect_list(row if keep is None else F.when(keep, row))

    sides = [side(payload, left_if).alias("left"), side(right_payload, right_if).alias("right")]
    if (largest_group(df, [group], tile_rows) if largest is None else largest) <= tile_rows:
        return df.groupBy(group).agg(*sides)
    sizes = df.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / F.lit(tile_rows)).alias("_tiles"))
    cut = lookup_join(df, sizes, group).withColumn(
        "_tile", F.pmod(F.xxhash64(row_key), F.col("_tiles")))
    tiles = cut.groupBy(group, "_tile", "_tiles").agg(*sides)
    lefts = tiles.select(group, "left", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.col("_tiles") - 1)).alias("_tile"))
    rights = tiles.select(group, F.col("_tile"), "right")
    return lefts.join(rights, [group, "_tile"]).select(group, "left", "right")


def per_left(left: Column, right: Column, zero: Column, step, key: str) -> Column:
    """For each left element ``STRUCT(key, value)`` with the fold of ``step(acc, a, b)`` over the
    right array."""
    return F.transform(left, lambda a: F.struct(
        a.getField(key).alias(key),
        F.aggregate(right, zero, lambda acc, b: step(acc, a, b)).alias("value")))


# Pairs that one numpy call of a kernel works on.
CALL_PAIRS = 1 << 21


class Pairs:
    """All pairs of some rows of :func:`tile_pairs`: ``a(name)`` and ``b(name)`` are the left and right members' numbers."""

    def __init__(self, left: pa.ListArray, right: pa.ListArray) -> None:
        n, m = (np.asarray(x.value_lengths().fill_null(0)) for x in (left, right))
        self.left, self.right = left.flatten(), right.flatten()
        self.rows, self.lefts = len(left), len(self.left)
        row_of = np.repeat(np.arange(len(n)), n)
        size = m[row_of]
        self.l = np.repeat(np.arange(len(row_of)), size)
        start = (np.cumsum(m) - m)[row_of]
        self.r = np.arange(len(self.l)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)
        self.row = row_of[self.l]
        self.row_of_left = row_of

    def a(self, name: str) -> np.ndarray:
        return np.asarray(self.left.field(name))[self.l]

    def b(self, name: str) -> np.ndarray:
        return np.asarray(self.right.field(name))[self.r]


def map_pairs(tiles: DataFrame, schema: str, kernel: Callable[[pa.Array, Pairs], pa.RecordBatch]) -> DataFrame:
    """Rows that ``kernel(group keys, pairs)`` makes from ``(group, left, right)`` tiles, many small groups in one numpy call."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, m = (np.asarray(b.column(i).value_lengths().fill_null(0)).astype(np.int64) for i in (1, 2))
            upto, at = np.cumsum(n * m), 0
            while at < b.num_rows:
                done = upto[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(upto, done + CALL_PAIRS, "right")))
                part = b.slice(at, end - at)
                yield kernel(part.column(0), Pairs(part.column(1), part.column(2)))
                at = end
    return tiles.mapInArrow(run, schema)
