"""Label, action and weight expressions of a sample row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sampleloom.functions.base import (INVALID_LABEL, POSITIVE_LABEL, ColumnLike, col_of, lit_array,
                                       lit_map, tail, u01)
from sampleloom.functions.predicates import any_action, compare


@dataclass(frozen=True)
class Task:
    """One label task: actions that make it positive or negative, and the negative sample rate."""

    positive: tuple[int, ...]
    negative: tuple[int, ...] = ()
    rate: float = 1.0

    def __post_init__(self) -> None:
        if not self.positive:
            raise ValueError("a task needs positive actions")
        if set(self.positive) & set(self.negative):
            raise ValueError("an action cannot be positive and negative")
        if not 0.0 <= self.rate <= 1.0:
            raise ValueError("sample rate must lie in [0, 1]")


def parse_tasks(config: str) -> list[Task]:
    """``pos,pos:neg,neg:rate;…`` with an optional negative list."""
    tasks = []
    for part in filter(None, config.split(";")):
        fields = part.split(":")
        if len(fields) != 3:
            raise ValueError(f"task {part!r} is not pos:neg:rate")
        pos, neg = ([int(a) for a in f.split(",") if a] for f in fields[:2])
        tasks.append(Task(tuple(pos), tuple(neg), float(fields[2])))
    if not tasks:
        raise ValueError("no label task given")
    return tasks


def invalid() -> Column:
    return F.lit(INVALID_LABEL)


def task_label(actions: ColumnLike, task: Task, sampled: Column | bool = True,
               positive_value: float = POSITIVE_LABEL, negative_value: float = 0.0) -> Column:
    """Positive hit wins; then a negative hit (or any miss when the task lists no negatives) gives
    the negative value if it was sampled; everything else is invalid."""
    sampled = sampled if isinstance(sampled, Column) else F.lit(sampled)
    negative = any_action(actions, task.negative) if task.negative else F.lit(True)
    return (F.when(any_action(actions, task.positive), F.lit(float(positive_value)))
            .when(negative & sampled, F.lit(float(negative_value)))
            .otherwise(invalid()))


def add_label(key: ColumnLike, label: ColumnLike, actions: ColumnLike, config: str,
              negative_value: float = 0.0) -> Column:
    """Append one label per task; a first label at or below 0 turns invalid."""
    v = col_of(label)
    first = F.get(v, F.lit(0))
    fixed = F.when(first <= 0, F.concat(F.array(invalid()), tail(v, 1))).otherwise(v)
    extra = []
    for i, t in enumerate(parse_tasks(config)):
        sampled = F.lit(True) if t.rate == 1.0 else u01(key, f"label{i}") < t.rate
        extra.append(task_label(actions, t, sampled, negative_value=negative_value))
    return F.concat(fixed, F.array(*extra))


def labels_from_actions(actions: ColumnLike, config: str, positive_value: float = 1.0,
                        negative_value: float = 0.0) -> Column:
    """One label per task from the actions alone, without sampling."""
    return F.array(*[task_label(actions, t, True, positive_value, negative_value)
                     for t in parse_tasks(config)])


def add_action(actions: ColumnLike, new: Sequence[int], field: ColumnLike, op: str,
               operand) -> Column:
    """Append actions where a scalar field satisfies a comparison."""
    a = col_of(actions)
    return F.when(compare(field, op, operand), F.concat(a, lit_array(new, "int"))).otherwise(a)


def _at_index(index: Column, size: int, value: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)),
                       lambda i: F.when(i == index, value).otherwise(invalid()))


def scatter_label(label: ColumnLike, chnid: ColumnLike, config: str) -> Column:
    """Move the first label to the index of its channel; all other places are invalid."""
    index = {int(c): int(i) for c, i in (p.split(":") for p in config.split(","))}
    first = F.coalesce(F.get(col_of(label), F.lit(0)), invalid())
    return _at_index(lit_map(index, "bigint", "int")[col_of(chnid).cast("bigint")],
                     max(index.values()) + 1, first)


def most_prior_action(actions: ColumnLike, priority: Sequence[int],
                      fallback_first: bool = True) -> Column:
    """Listed action of the highest priority (front of ``priority``). With none listed: the first
    action, or NULL."""
    a = col_of(actions)
    listed = F.filter(lit_array(priority, "int"), lambda p: F.array_contains(a, p))
    best = F.get(listed, F.lit(0))
    return F.coalesce(best, F.get(a, F.lit(0))) if fallback_first else best


def multi_label(label: ColumnLike, actions: ColumnLike, head: ColumnLike, heads: dict[str, int],
                priority: Sequence[int] = (), positive: Sequence[int] = (),
                negative: Sequence[int] = (), use_origin_label: bool = False,
                positive_value: float = 1.0, negative_value: float = 0.0) -> Column:
    """One label at the index of the row's head field, from its highest-priority action or from
    the original label."""
    if use_origin_label:
        value = F.coalesce(F.get(col_of(label), F.lit(0)), invalid())
    else:
        act = most_prior_action(actions, priority)
        value = (F.when(act.isin(list(positive)), F.lit(float(positive_value)))
                 .when(act.isin(list(negative)), F.lit(float(negative_value)))
                 .otherwise(invalid()))
    return _at_index(lit_map(heads, "string", "int")[col_of(head).cast("string")],
                     max(heads.values()) + 1, value)


def label_upper_bound(label: ColumnLike, bounds: Sequence[float]) -> Column:
    """Clip the leading labels to their bounds; a row with too few labels stays as it is."""
    v, n = col_of(label), len(bounds)
    clipped = F.zip_with(F.slice(v, 1, n), lit_array([float(b) for b in bounds], "double"),
                         lambda x, b: F.least(x, b))
    return F.when(F.size(v) < n, v).otherwise(F.concat(clipped, tail(v, n)))


def normalize_label(label: ColumnLike, methods: Sequence[tuple[str, float]]) -> Column:
    """Apply the methods in order to every label; log of 0 is -inf."""

    def log0(x: Column) -> Column:
        return F.when(x > 0, F.log(x)).otherwise(F.lit(float("-inf")))

    def step(x: Column, how: str, k: float) -> Column:
        kk = F.lit(float(k))
        if how == "log":
            return log0(F.greatest(x + kk, F.lit(0.0)))
        if how == "scale":
            return x / kk
        if how == "scale2int":
            return (x / kk).cast("int").cast("double")
        if how == "pow":
            return F.pow(x + 1, kk)
        if how == "repow":
            return F.when(x > 0, F.pow(x, kk)).otherwise(F.lit(0.0))
        if how == "scalelog":
            return log0(F.greatest(x / kk + 1, F.lit(0.0)))
        raise ValueError(f"unknown label normalization {how}")

    return F.transform(col_of(label), lambda x: reduce(lambda a, m: step(a, *m), methods, x))


def multi_rank_label(label: ColumnLike, is_draw: ColumnLike | None = None,
                     chnid: ColumnLike | None = None, rank: ColumnLike | None = None,
                     rank_num: int = 0) -> Column:
    """Append a rank label from the draw flag, else the channel (0, 1, other), else the capped
    rank."""
    if is_draw is not None:
        r = F.when(col_of(is_draw), 1).otherwise(0)
    elif chnid is not None:
        c = col_of(chnid)
        r = F.when(c.isin(0, 1), c).otherwise(2)
    elif rank is not None:
        r = F.least(col_of(rank), F.lit(rank_num - 1))
    else:
        return col_of(label)
    return F.concat(col_of(label), F.array(r.cast("double")))


def map_id(x: ColumnLike, mapping: dict[int, int], default: int = -1) -> Column:
    return F.coalesce(lit_map(mapping, "bigint", "bigint")[col_of(x).cast("bigint")],
                      F.lit(default).cast("bigint"))


def field_as_label(field: ColumnLike, threshold: float | None = None,
                   overwrite: float = 0.0) -> Column:
    """A scalar field as the only label, overwritten from ``threshold`` on."""
    x = col_of(field).cast("double")
    if threshold is not None:
        x = F.when(x >= threshold, F.lit(float(overwrite))).otherwise(x)
    return F.array(x)


def sampled_negative_weight(neg_num: int, freq: ColumnLike, time: ColumnLike,
                            decay: float = 1.0, fixed: float = -1.0,
                            unbias: bool = True) -> Column:
    """Weight of a generated negative: the fixed one, or 1 + neg_num · time^decay · freq, or 1."""
    if fixed > 0.00001:
        return F.lit(float(fixed))
    if unbias:
        return F.lit(1.0) + F.lit(float(neg_num)) * F.pow(col_of(time), F.lit(float(decay))) * col_of(freq)
    return F.lit(1.0)


def real_weight(is_positive: ColumnLike, real_negative: float = 1.0) -> Column:
    neg = real_negative if real_negative > 0.00001 else 1.0
    return F.when(col_of(is_positive), F.lit(1.0)).otherwise(F.lit(float(neg)))


def _reweight_count(actions: Column, best: Column, priority: Sequence[int],
                    reweight: dict[int, tuple[int, int]], additive: bool) -> Column:
    """Copies asked for by a list of actions: unlisted actions and the best one count."""
    table = lit_map({a: w for a, (w, _) in reweight.items()}, "int", "bigint")
    listed = lit_array(priority, "int")
    used = F.filter(actions, lambda a: ~F.array_contains(listed, a) | (a == F.coalesce(best, F.lit(0))))
    start = F.when(F.size(actions) > 0, 1).otherwise(0).cast("bigint")
    return F.aggregate(used, start, lambda n, a: n + F.coalesce(table[a], F.lit(0).cast("bigint"))
                       if additive else n * F.coalesce(table[a], F.lit(1).cast("bigint")))


def _ladder(actions: Column, priority: Sequence[int], values: Sequence[int]) -> Column:
    """The value beside the first listed action that a row has, or NULL: a chain of conditions that compiles."""
    out = None
    for p, v in zip(priority, values):
        test = F.array_contains(actions, F.lit(int(p)))
        out = F.when(test, F.lit(int(v))) if out is None else out.when(test, F.lit(int(v)))
    return F.lit(None).cast("int") if out is None else out.cast("int")


def reweight_columns(actions: ColumnLike, priority: Sequence[int], table: dict[int, tuple[int, int]], additive: bool) -> tuple[Column, Column, Column]:
    """Best action, its place (behind all for unlisted, last for no actions) and the copies of one list of actions."""
    a = F.coalesce(col_of(actions).cast("array<int>"), F.array().cast("array<int>"))
    best = _ladder(a, priority, priority)
    place = F.coalesce(_ladder(a, priority, range(len(priority))), F.lit(len(priority)))
    return best, F.when(F.size(a) == 0, len(priority) + 1).otherwise(place), _reweight_count(a, best, priority, table, additive)


def reweight_result(label0: ColumnLike, cur: tuple[Column, Column, Column], pre: tuple[Column, Column, Column], absent: int,
                    table: dict[int, tuple[int, int]]) -> Column:
    """``STRUCT(copies, label)`` from the best action, place and copies of a row's actions and of its earlier ones."""
    labels = lit_map({a: lab for a, (_, lab) in table.items()}, "int", "double")
    (cur_best, cur_place, n_cur), (pre_best, pre_place, n_pre) = cur, pre
    first = col_of(label0).cast("double")
    cur_label, pre_label = F.coalesce(labels[cur_best], first), labels[pre_best]

    def out(n: Column, lab: Column) -> Column:
        return F.struct(n.cast("bigint").alias("copies"), lab.alias("label"))

    later = pre_place > cur_place
    return (F.when(later & pre_label.isNull(), out(n_cur, cur_label))
            .when(later & (pre_label != cur_label), out(n_pre + n_cur, cur_label))
            .when(later & (n_pre > n_cur), out(n_pre - n_cur, -cur_label))
            .when(later, out(n_cur - n_pre, cur_label))
            .when((pre_place == absent) & (cur_place == absent), out(F.lit(1), first))
            .otherwise(out(F.lit(0), first)))


def reweight(actions: ColumnLike, pre_actions: ColumnLike, label0: ColumnLike,
             priority: Sequence[int], table: dict[int, tuple[int, int]],
             additive: bool = False) -> Column:
    """``STRUCT(copies, label)`` of a sample.

    ``table`` maps an action to (weight, label). An earlier fast-emitted negative recorded in
    ``pre_actions`` is corrected by the copies that follow; a sample that was emitted with an
    action of equal or higher priority is emitted no more.
    """
    return reweight_result(label0, reweight_columns(actions, priority, table, additive), reweight_columns(pre_actions, priority, table, additive),
                           len(priority) + 1, table)
