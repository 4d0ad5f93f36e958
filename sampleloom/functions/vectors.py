"""Arithmetic over ARRAY<DOUBLE> columns of a known width."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sampleloom.functions.base import ColumnLike, col_of, let


def doubles(v: ColumnLike) -> Column:
    return col_of(v).cast("array<double>")


def zeros(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0), dim)


def each(v: ColumnLike, field: str) -> Column:
    """One field of every struct of a list."""
    return F.transform(col_of(v), lambda e: e.getField(field))


def add(a: ColumnLike, b: ColumnLike) -> Column:
    return F.zip_with(col_of(a), col_of(b), lambda x, y: x + y)


def multiply(a: ColumnLike, b: ColumnLike) -> Column:
    return F.zip_with(col_of(a), col_of(b), lambda x, y: x * y)


def scale(v: ColumnLike, k: Column | float) -> Column:
    k = k if isinstance(k, Column) else F.lit(float(k))
    return F.transform(col_of(v), lambda x: x * k)


def total(v: ColumnLike) -> Column:
    return F.aggregate(col_of(v), F.lit(0.0), lambda s, x: s + x)


def dot(a: ColumnLike, b: ColumnLike) -> Column:
    return total(multiply(a, b))


def sum_squares(v: ColumnLike) -> Column:
    return F.aggregate(col_of(v), F.lit(0.0), lambda s, x: s + x * x)


def l2_normalize(v: ColumnLike) -> Column:
    """Unit vector, with the squared norm floored at 1e-12."""
    norm = F.sqrt(F.greatest(sum_squares(v), F.lit(1e-12)))
    return let(norm, lambda n: F.transform(col_of(v), lambda x: x / n))


def piece(v: ColumnLike, start: int, end: int) -> Column:
    """Elements ``[start, end)``."""
    if not 0 <= start < end:
        raise ValueError(f"slice [{start}, {end}) is empty or negative")
    return F.slice(col_of(v), start + 1, end - start)


def fixed_width(v: ColumnLike, width: int, pad: float = 0.0) -> Column:
    """Cut or pad a list to ``width``; NULL counts as empty."""
    if width <= 0:
        raise ValueError("dense shape must be positive")
    v = F.coalesce(col_of(v), F.array().cast("array<double>"))
    return F.slice(F.concat(v, F.array_repeat(F.lit(float(pad)), width)), 1, width)


def unrolled(dim: int, at: Callable[[int], Column]) -> Column:
    """Array of ``dim`` expressions, one per element. Unlike a higher-order function this is
    compiled code, which pays off for the widths vectors have."""
    return F.array(*[at(i) for i in range(dim)])


def sum_agg(v: ColumnLike, dim: int) -> list[Column]:
    """Sums of the elements of a vector column, as aggregates.

    One plain SUM per element: each has a fixed-width buffer, so the whole thing is a partial and
    a final hash aggregate. Nothing is collected and the row count is not multiplied by ``dim``.
    """
    v = col_of(v)
    return [F.sum(F.get(v, F.lit(i)).cast("double")) for i in range(dim)]


def sum_squares_agg(v: ColumnLike, dim: int) -> list[Column]:
    parts = [F.get(col_of(v), F.lit(i)).cast("double") for i in range(dim)]
    return [F.sum(p * p) for p in parts]


def fold(vectors: Sequence[ColumnLike], how: str) -> Column:
    """Sum, mean or maximum of several equally wide vectors of one row."""
    if not vectors:
        raise ValueError("nothing to pool")
    cols = [col_of(v) for v in vectors]
    if len(cols) == 1:
        return cols[0]
    out = cols[0]
    for c in cols[1:]:
        out = F.zip_with(out, c, (lambda x, y: F.greatest(x, y)) if how == "max"
                         else (lambda x, y: x + y))
    if how == "avg":
        out = scale(out, 1.0 / len(cols))
    elif how not in ("sum", "max"):
        raise ValueError(f"unknown pooling {how}")
    return out
