"""Transforms as data: a tree of named steps with parameters that is stored as JSON, checked against a schema, and compiled.

A leaf names a filter, a new column or a row operator of this library with its parameters; ``every`` runs steps in order,
``either`` keeps rows that pass one of several filters. Neighbouring filters are compiled into a single expression.
"""

from __future__ import annotations

import inspect
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleloom.functions import labels as L
from sampleloom.functions import predicates as P
from sampleloom.operators import samples as S

_NUMBER = (T.IntegralType, T.FractionalType)
_FAMILY = {"list": (T.ArrayType,), "number": _NUMBER, "text": (T.StringType,), "flag": (T.BooleanType,), "any": (T.DataType,)}


@dataclass(frozen=True)
class Kind:
    """A library function: its parameters that name columns, with the family of their types, and the column that it sets (None: it is
    a filter). A row operator takes and gives whole rows."""

    make: Callable
    columns: dict[str, str]
    sets: str | None = None
    rows: bool = False

    @property
    def is_filter(self) -> bool:
        return self.sets is None and not self.rows


KINDS: dict[str, Kind] = {
    "by_fids": Kind(P.by_fids, {"fids": "list", "actions": "list", "req_time": "number"}),
    "has_slots": Kind(P.has_slots, {"fids": "list", "other_fids": "list"}),
    "any_action": Kind(P.any_action, {"actions": "list"}),
    "by_label": Kind(P.by_label, {"label": "list"}),
    "compare": Kind(P.compare, {"value": "any"}),
    "set_compare": Kind(P.set_compare, {"values": "list"}),
    "feature_value": Kind(P.feature_value, {"values": "list"}),
    "negative_kept": Kind(P.negative_kept, {"key": "any", "label": "number"}),
    "add_action": Kind(L.add_action, {"actions": "list", "field": "any"}, "actions"),
    "add_label": Kind(L.add_label, {"key": "any", "label": "list", "actions": "list"}, "label"),
    "scatter_label": Kind(L.scatter_label, {"label": "list", "chnid": "number"}, "label"),
    "multi_label": Kind(L.multi_label, {"label": "list", "actions": "list", "head": "any"}, "label"),
    "label_upper_bound": Kind(L.label_upper_bound, {"label": "list"}, "label"),
    "normalize_label": Kind(L.normalize_label, {"label": "list"}, "label"),
    "multi_rank_label": Kind(L.multi_rank_label, {"label": "list", "is_draw": "flag", "chnid": "number", "rank": "number"}, "label"),
    "map_id": Kind(L.map_id, {"x": "number"}, "x"),
    "field_as_label": Kind(L.field_as_label, {"field": "number"}, "label"),
    "special_strategy": Kind(S.special_strategy, {"key": "any", "column": "list"}, rows=True),
    "negative_sample": Kind(S.negative_sample, {"key": "any"}, rows=True),
    "instance_reweight": Kind(S.instance_reweight, {}, rows=True),
}


@dataclass(frozen=True)
class Step:
    """A leaf. Parameters have the names of the library function's; a column parameter is the name of a column."""

    kind: str
    params: dict

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown step {self.kind}")
        known = inspect.signature(KINDS[self.kind].make).parameters
        for name in self.params:
            if name not in known or name == "df":
                raise ValueError(f"step {self.kind} has no parameter {name}")
        for name, p in known.items():
            if p.default is p.empty and name != "df" and name not in self.params:
                raise ValueError(f"step {self.kind} needs {name}")


@dataclass(frozen=True)
class Every:
    steps: tuple


@dataclass(frozen=True)
class Either:
    """Filters of which one must pass."""

    steps: tuple

    def __post_init__(self) -> None:
        if not self.steps or not all(is_filter(s) for s in self.steps):
            raise ValueError("either takes filters only, at least one")


Tree = Step | Every | Either


def step(kind: str, **params) -> Step:
    return Step(kind, params)


def every(*steps: Tree) -> Every:
    return Every(tuple(steps))


def either(*steps: Tree) -> Either:
    return Either(tuple(steps))


def is_filter(tree: Tree) -> bool:
    return KINDS[tree.kind].is_filter if isinstance(tree, Step) else all(is_filter(s) for s in tree.steps)


# ---- text

def _plain(x: object) -> object:
    if isinstance(x, dict):
        return {"pairs": [[_plain(k), _plain(v)] for k, v in x.items()]}  # keys keep their types
    return [_plain(v) for v in x] if isinstance(x, (list, tuple, set, frozenset)) else x


def _value(x: object) -> object:
    if isinstance(x, dict):
        return {_value(k): _value(v) for k, v in x["pairs"]}
    return [_value(v) for v in x] if isinstance(x, list) else x


def to_json(tree: Tree) -> str:
    def node(t: Tree) -> dict:
        if isinstance(t, Step):
            return {"step": t.kind, "params": {k: _plain(v) for k, v in t.params.items()}}
        return {"every" if isinstance(t, Every) else "either": [node(s) for s in t.steps]}
    return json.dumps(node(tree))


def from_json(text: str) -> Tree:
    """The tree of a text; unknown kinds, steps and parameters are refused."""
    def node(d: dict) -> Tree:
        if set(d) == {"step", "params"}:
            return Step(d["step"], {k: _value(v) for k, v in d["params"].items()})
        for name, make in (("every", every), ("either", either)):
            if set(d) == {name}:
                return make(*map(node, d[name]))
        raise ValueError(f"neither a step nor a list of steps: {sorted(d)}")
    return node(json.loads(text))


# ---- use

def check(tree: Tree, schema: T.StructType) -> T.StructType:
    """The schema after the steps; refuses a column that is not there, or not of the family that its step reads."""
    if isinstance(tree, (Every, Either)):
        for s in tree.steps:
            schema = check(s, schema)
        return schema
    kind, types = KINDS[tree.kind], {f.name: f.dataType for f in schema}
    for name, family in kind.columns.items():
        column = tree.params.get(name)
        if column is None:
            continue
        if column not in types:
            raise ValueError(f"step {tree.kind} reads column {column}, which is not there")
        if not isinstance(types[column], _FAMILY[family]):
            raise ValueError(f"step {tree.kind} reads a {family} from column {column}, which is {types[column].simpleString()}")
    target = _target(tree)
    return schema.add(target, T.ArrayType(T.DoubleType())) if target and target not in types else schema


def _target(s: Step) -> str | None:
    """The column that a step sets: the one it reads under that name, if it does."""
    kind = KINDS[s.kind]
    return s.params.get(kind.sets, kind.sets) if kind.sets in kind.columns else kind.sets


def predicate(tree: Tree) -> Column:
    """Filters as one expression."""
    if isinstance(tree, Step):
        if not KINDS[tree.kind].is_filter:
            raise ValueError(f"step {tree.kind} is no filter")
        return KINDS[tree.kind].make(**tree.params)
    if not tree.steps:
        return F.lit(True)
    return reduce((lambda a, b: a & b) if isinstance(tree, Every) else (lambda a, b: a | b), map(predicate, tree.steps))


def _flat(tree: Tree) -> list[Tree]:
    return [x for s in tree.steps for x in _flat(s)] if isinstance(tree, Every) else [tree]


def compiled(tree: Tree) -> S.Transform:
    """A function from DataFrame to DataFrame. Filters that follow each other are one filter."""
    parts: list[Sequence[Tree] | Step] = []
    for t in _flat(tree):
        if is_filter(t):
            if not parts or isinstance(parts[-1], Step):
                parts.append([])
            parts[-1].append(t)
        else:
            parts.append(t)

    def run(df: DataFrame) -> DataFrame:
        check(tree, df.schema)
        for p in parts:
            if not isinstance(p, Step):
                df = df.filter(predicate(Every(tuple(p))))
            elif KINDS[p.kind].rows:
                df = KINDS[p.kind].make(df, **p.params)
            else:
                df = df.withColumn(_target(p), KINDS[p.kind].make(**p.params))
        return df
    return run
