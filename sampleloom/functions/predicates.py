"""Row predicates over samples. All are null-safe boolean Columns, so they combine with & and |,
reach the Parquet scan where they touch scalars, and work unchanged on streams."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sampleloom.functions.base import ColumnLike, col_of, lit_array, u01
from sampleloom.functions.fid import slots_of

COMPARE_OPS = ("gt", "ge", "eq", "lt", "le", "neq", "between", "in", "not-in")
STRING_OPS = COMPARE_OPS + ("startswith", "endswith")
SET_OPS = ("any", "all", "diff")


def _known(p: Column) -> Column:
    return F.coalesce(p, F.lit(False))


def compare(value: ColumnLike, op: str, operand) -> Column:
    """Compare a scalar; ``between`` is half-open: [low, high)."""
    v = col_of(value)
    many = list(operand) if isinstance(operand, (list, tuple, set, frozenset)) else [operand]
    if not many:
        raise ValueError("empty operand")
    one = many[0]
    if op == "gt":
        p = v > one
    elif op == "ge":
        p = v >= one
    elif op == "eq":
        p = v == one
    elif op == "lt":
        p = v < one
    elif op == "le":
        p = v <= one
    elif op == "neq":
        p = v != one
    elif op == "between":
        if len(many) != 2:
            raise ValueError("between takes two operands")
        p = (v >= many[0]) & (v < many[1])
    elif op == "in":
        p = v.isin(many)
    elif op == "not-in":
        p = ~v.isin(many)
    elif op == "startswith":
        p = reduce(lambda a, b: a | b, [v.startswith(x) for x in many])
    elif op == "endswith":
        p = reduce(lambda a, b: a | b, [v.endswith(x) for x in many])
    else:
        raise ValueError(f"unknown operator {op}")
    return _known(p)


def set_compare(values: ColumnLike, op: str, operands: Sequence, element: str = "bigint",
                keep_empty: bool = False) -> Column:
    """Compare a list with a set: ``any`` shared, ``all`` operands present, ``diff`` none shared.
    An empty or missing list is decided by ``keep_empty``."""
    v = col_of(values)
    ops = lit_array(sorted(set(operands)), element)
    if op == "any":
        p = F.arrays_overlap(v, ops)
    elif op == "all":
        p = F.size(F.array_except(ops, v)) == 0
    elif op == "diff":
        p = ~F.arrays_overlap(v, ops)
    else:
        raise ValueError(f"unknown set operator {op}")
    empty = v.isNull() | (F.size(v) == 0)
    return F.when(empty, F.lit(keep_empty)).otherwise(_known(p))


def feature_value(values: ColumnLike, op: str, operand, field_type: str,
                  keep_empty: bool = False) -> Column:
    """Compare a named feature: a list that must hold exactly one value, unless ``op`` is a set
    operator; otherwise ``keep_empty`` decides."""
    element = {"int64": "bigint", "float": "double", "double": "double", "bytes": "string"}
    if field_type not in element:
        raise ValueError(f"unknown field type {field_type}")
    if op in SET_OPS:
        if field_type != "int64":
            raise ValueError("set operators work on integer features only")
        return set_compare(values, op, operand, element[field_type], keep_empty)
    v = col_of(values)
    one = F.get(v, F.lit(0)).cast(element[field_type])
    return F.when(F.coalesce(F.size(v), F.lit(0)) == 1, compare(one, op, operand)).otherwise(
        F.lit(keep_empty))


def by_fids(fids: ColumnLike, filter_fids: Sequence[int] = (), has_fids: Sequence[int] = (),
            select_fids: Sequence[int] = (), select_slots: Sequence[int] = (),
            actions: ColumnLike | None = None, has_actions: Sequence[int] = (),
            req_time: ColumnLike | None = None, req_time_min: int = 0,
            version: int = 2) -> Column:
    """All given conditions hold: none of ``filter_fids``, any of ``has_fids``, all of
    ``select_fids``, every slot of ``select_slots``, any of ``has_actions``, not too early."""
    f = F.coalesce(col_of(fids), F.array().cast("array<bigint>"))
    parts: list[Column] = []
    if req_time is not None and req_time_min > 0:
        parts.append(_known(col_of(req_time) >= req_time_min))
    if actions is not None and has_actions:
        parts.append(any_action(actions, has_actions))
    if filter_fids:
        parts.append(~F.arrays_overlap(f, lit_array(filter_fids, "bigint")))
    if has_fids:
        parts.append(F.arrays_overlap(f, lit_array(has_fids, "bigint")))
    if select_fids:
        parts.append(F.size(F.array_except(lit_array(sorted(set(select_fids)), "bigint"), f)) == 0)
    if select_slots:
        parts.append(has_slots(f, select_slots, version))
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def has_slots(fids: ColumnLike, slots: Sequence[int], version: int = 2,
              other_fids: ColumnLike | None = None) -> Column:
    """Every slot occurs, counting v2 ids in ``fids`` and v1 ids in ``other_fids``."""
    seen = slots_of(fids, version)
    if other_fids is not None:
        seen = F.array_union(seen, slots_of(other_fids, 3 - version))
    return F.size(F.array_except(lit_array(sorted(set(slots)), "int"), seen)) == 0


def any_action(actions: ColumnLike, wanted: Sequence[int]) -> Column:
    return _known(F.arrays_overlap(col_of(actions).cast("array<bigint>"),
                                   lit_array(wanted, "bigint")))


def by_label(label: ColumnLike, thresholds: Sequence[float], filter_equal: bool = False) -> Column:
    """Some label exceeds its threshold (or equals it, unless ``filter_equal``); too few labels
    fail the row."""
    v = col_of(label)

    def hit(i: int, t: float) -> Column:
        x = F.get(v, F.lit(i))
        return x > F.lit(float(t)) if filter_equal else x >= F.lit(float(t))

    hits = reduce(lambda a, b: a | b, [hit(i, t) for i, t in enumerate(thresholds)])
    return _known((F.size(v) >= len(thresholds)) & hits)


def negative_kept(key: ColumnLike, label: ColumnLike, drop_rate: Column | float,
                  threshold: float = 0.0, salt: str = "neg") -> Column:
    """Keep labels at or above ``threshold``; drop the rest with ``drop_rate``, drawn in steps of
    1/1000."""
    rate = drop_rate if isinstance(drop_rate, Column) else F.lit(float(drop_rate))
    draw = F.floor(u01(key, salt) * 1000) / F.lit(1000.0)
    return _known((col_of(label) >= threshold) | (draw >= rate))
