"""Sparse optimizer rules as Column expressions.

A rule takes the row's vector, its merged gradient and its state, and returns the new vector and
state. State is a struct whose fields are arrays (one value per element) or doubles (one value per
row); ``initial`` builds it for a row that has none yet.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from sampleloom.functions import vectors as V
from sampleloom.functions.base import ColumnLike, col_of, let

Elementwise = Callable[[Column, Column, dict[str, Column], Column, dict[str, float]],
                       tuple[Column, dict[str, Column]]]


def _num(x: float) -> Column:
    return F.lit(float(x))


@dataclass(frozen=True)
class Rule:
    """An optimizer: names of per-element and per-row state with their initial values, the default
    parameters, and the update."""

    name: str
    update: Elementwise
    params: dict[str, float]
    vector_state: dict[str, str | float] = field(default_factory=dict)
    row_state: dict[str, str | float] = field(default_factory=dict)
    row_update: Callable | None = None
    whole: Callable | None = None

    def config(self, overrides: dict[str, float]) -> dict[str, float]:
        unknown = set(overrides) - set(self.params)
        if unknown:
            raise ValueError(f"{self.name} has no parameter {sorted(unknown)}")
        return {**self.params, **overrides}

    @property
    def state_type(self) -> str:
        parts = [f"{n}:array<double>" for n in self.vector_state]
        parts += [f"{n}:double" for n in self.row_state]
        return f"struct<{','.join(parts or ['none:double'])}>"

    def initial(self, dim: int, **overrides: float) -> Column:
        p = self.config(overrides)

        def start(v: str | float) -> Column:
            return _num(p[v] if isinstance(v, str) else v)

        cols = [F.array_repeat(start(v), dim).alias(n) for n, v in self.vector_state.items()]
        cols += [start(v).alias(n) for n, v in self.row_state.items()]
        return F.struct(*(cols or [_num(0).alias("none")])).cast(self.state_type)

    def apply(self, num: ColumnLike, grad: ColumnLike, state: ColumnLike,
              lr: ColumnLike | float | None = None, **overrides: float) -> Column:
        """``STRUCT(num, opt)`` after one step."""
        p = self.config(overrides)
        w, g, s = col_of(num), col_of(grad), col_of(state)
        rate = _num(p.get("learning_rate", 0.0)) if lr is None else (
            _num(lr) if isinstance(lr, (int, float)) else col_of(lr))
        row = {n: s.getField(n) for n in self.row_state}
        if self.whole is not None:
            return self.whole(w, g, s, rate, p)
        names = list(self.vector_state)
        after = self.row_update(row, p) if self.row_update else row
        zipped = F.arrays_zip(w.alias("w"), g.alias("g"), *[s.getField(n).alias(n) for n in names])
        # arrays_zip names nested accesses after the field; rebuild with fixed names instead.
        typed = zipped.cast("array<struct<" + ",".join(
            f"{n}:double" for n in ["w", "g", *names]) + ">>")

        def one(e: Column) -> Column:
            st = {n: e.getField(n) for n in names} | row
            new_w, new_state = self.update(e.getField("w"), e.getField("g"), st, rate, p)
            return F.struct(new_w.alias("w"), *[new_state[n].alias(n) for n in names])

        def collect(done: Column) -> Column:
            kept = [V.each(done, n).alias(n) for n in names]
            kept += [after[n].alias(n) for n in self.row_state]
            opt = F.struct(*(kept or [_num(0).alias("none")])).cast(self.state_type)
            return F.struct(V.each(done, "w").alias("num"), opt.alias("opt"))

        return let(F.transform(typed, one), collect)


def _sgd(w, g, s, lr, p):
    return w - lr * g, {}


def _adagrad(w, g, s, lr, p):
    d = g + _num(p["weight_decay"]) * w
    n = s["norm"] + d * d
    return w - lr / F.sqrt(n) * d, {"norm": n}


def _dynamic_wd_adagrad(w, g, s, lr, p):
    decay = _num(p["weight_decay"]) * w
    if p["decouple"]:
        n = s["norm"] + g * g
        return w - lr / F.sqrt(n) * g - lr * decay, {"norm": n}
    return _adagrad(w, g, s, lr, p)


def _ftrl(w, g, s, lr, p):
    n = s["norm"] + g * g
    z = s["zero"] + g - (F.sqrt(n) - F.sqrt(s["norm"])) / lr * w
    l1, l2 = _num(p["l1"]), _num(p["l2"])
    pulled = lr * (F.signum(z) * l1 - z) / (F.sqrt(n) + _num(p["beta"]) + l2 * lr)
    return F.when(F.abs(z) > l1, pulled).otherwise(_num(0)), {"norm": n, "zero": z}


def _adadelta(w, g, s, lr, p):
    r, eps = _num(p["averaging_ratio"]), _num(p["epsilon"])
    d = g + _num(p["weight_decay"]) * w
    accum = s["accum"] * r + d * d * (1 - r)
    step = F.sqrt(s["accum_update"] + eps) / F.sqrt(accum + eps) * d
    return w - step * lr, {"accum": accum, "accum_update": s["accum_update"] * r + step * step * (1 - r)}


def _moments(w, g, s, p):
    d = g + _num(p["weight_decay"]) * w
    m = s["m"] + (d - s["m"]) * _num(1 - p["beta1"])
    v = s["v"] + (d * d - s["v"]) * _num(1 - p["beta2"])
    lead = d * _num(1 - p["beta1"]) + _num(p["beta1"]) * m if p["nesterov"] else m
    return m, v, lead


def _adam_rate(s, lr):
    return lr * F.sqrt(1 - s["beta2_power"]) / (1 - s["beta1_power"])


def _adam(w, g, s, lr, p):
    m, v, lead = _moments(w, g, s, p)
    return w - lead * _adam_rate(s, lr) / (F.sqrt(v) + _num(p["epsilon"])), {"m": m, "v": v}


def _amsgrad(w, g, s, lr, p):
    m, v, lead = _moments(w, g, s, p)
    top = F.greatest(s["vhat"], v)
    return (w - lead * _adam_rate(s, lr) / (F.sqrt(top) + _num(p["epsilon"])),
            {"m": m, "v": v, "vhat": top})


def _powers(row, p):
    return {"beta1_power": row["beta1_power"] * _num(p["beta1"]),
            "beta2_power": row["beta2_power"] * _num(p["beta2"])}


def _momentum(w, g, s, lr, p):
    mu = _num(p["momentum"])
    n = mu * s["n"] - lr * (g + _num(p["weight_decay"]) * w)
    move = (1 + mu) * n - mu * s["n"] if p["nesterov"] else n
    return w + move, {"n": n}


def _moving_average(w, g, s, lr, p):
    return _num(p["momentum"]) * w + _num(1 - p["momentum"]) * g, {}


def _rmsprop(w, g, s, lr, p):
    d = g + _num(p["weight_decay"]) * w
    n = _num(p["momentum"]) * s["n"] + _num(1 - p["momentum"]) * d * d
    return w - _num(p["learning_rate"]) / (F.sqrt(n) + 1) * d, {"n": n}


def _rmspropv2(w, g, s, lr, p):
    d = g + _num(p["weight_decay"]) * w
    n = _num(p["momentum"]) * s["n"] + d * d
    return w - lr / (F.sqrt(n) + 1) * d, {"n": n}


def _group_ftrl(w, g, s, lr, p):
    """Group soft threshold: the whole vector is zero while the norm of z stays under l1."""
    old = s.getField("norm")
    l1, l2, beta = _num(p["l1"]), _num(p["l2"]), _num(p["beta"])
    pulled = F.zip_with(g, w, lambda a, b: F.struct(a.alias("g"), b.alias("w")))
    moved = F.zip_with(pulled, old, lambda e, n0: F.struct(
        (n0 + e.getField("g") * e.getField("g")).alias("n"),
        (e.getField("g") - (F.sqrt(n0 + e.getField("g") * e.getField("g")) - F.sqrt(n0)) / lr
         * e.getField("w")).alias("dz")))
    parts = F.zip_with(moved, s.getField("zero"), lambda e, z0: F.struct(
        e.getField("n").alias("n"), (z0 + e.getField("dz")).alias("z")))

    def finish(nz: Column) -> Column:
        norm = F.sqrt(V.sum_squares(V.each(nz, "z")))
        return let(norm, lambda t: F.struct(
            F.transform(nz, lambda e: F.when(t < l1, _num(0)).otherwise(
                lr * e.getField("z") * (l1 - t) / F.when(t == 0, _num(1)).otherwise(t)
                / (beta + F.sqrt(e.getField("n")) + l2 * lr))).alias("num"),
            F.struct(V.each(nz, "n").alias("norm"), V.each(nz, "z").alias("zero")).alias("opt")))

    return let(parts, finish)


def _group_adagrad(w, g, s, lr, p):
    """One accumulator per row, fed by the largest squared gradient, and a proximal l2 step."""
    l2 = _num(p["l2"])
    d = F.zip_with(g, w, lambda a, b: a + _num(p["weight_decay"]) * b)

    def with_rate(dd: Column) -> Column:
        acc = s.getField("grad_square_sum") + F.array_max(F.transform(dd, lambda x: x * x))
        return let(acc, lambda a: let(lr / (_num(p["beta"]) + F.sqrt(a)), lambda r: pull(dd, a, r)))

    def pull(dd: Column, acc: Column, rate: Column) -> Column:
        return let(F.zip_with(dd, w, lambda a, b: a - b / rate), lambda z: let(
            F.sqrt(V.sum_squares(z)), lambda t: F.struct(
                F.transform(z, lambda x: F.when(t < l2, _num(0)).otherwise(
                    -rate * (t - l2) / F.when(t == 0, _num(1)).otherwise(t) * x)).alias("num"),
                F.struct(acc.alias("grad_square_sum")).alias("opt"))))

    return let(d, with_rate)


_DECAY = {"learning_rate": 0.01, "weight_decay": 0.0}
_ADAM = {**_DECAY, "beta1": 0.9, "beta2": 0.99, "epsilon": 0.01, "nesterov": 0.0}
_FTRL = {"learning_rate": 0.01, "initial_accumulator": 0.1, "beta": 0.0, "l1": 0.0, "l2": 0.0}
_WD = {"learning_rate": 0.001, "initial_accumulator": 0.1, "weight_decay": 0.0}

RULES: dict[str, Rule] = {r.name: r for r in [
    Rule("sgd", _sgd, {"learning_rate": 0.01}),
    Rule("adagrad", _adagrad, {**_DECAY, "initial_accumulator": 0.1},
         {"norm": "initial_accumulator"}),
    Rule("dynamic_wd_adagrad", _dynamic_wd_adagrad, {**_WD, "decouple": 0.0},
         {"norm": "initial_accumulator"}),
    Rule("ftrl", _ftrl, _FTRL, {"norm": "initial_accumulator", "zero": 0.0}),
    Rule("group_ftrl", _ftrl, {**_FTRL, "initial_accumulator": 0.0, "beta": 1.0},
         {"norm": "initial_accumulator", "zero": 0.0}, whole=_group_ftrl),
    Rule("group_adagrad", _adagrad, {**_DECAY, "initial_accumulator": 0.1, "beta": 0.0, "l2": 0.0},
         row_state={"grad_square_sum": "initial_accumulator"}, whole=_group_adagrad),
    Rule("adadelta", _adadelta, {**_DECAY, "averaging_ratio": 0.9, "epsilon": 0.01},
         {"accum": 0.0, "accum_update": 0.0}),
    Rule("adam", _adam, _ADAM, {"m": 0.0, "v": 0.0},
         {"beta1_power": "beta1", "beta2_power": "beta2"}, _powers),
    Rule("amsgrad", _amsgrad, _ADAM, {"m": 0.0, "v": 0.0, "vhat": 0.0},
         {"beta1_power": "beta1", "beta2_power": "beta2"}, _powers),
    Rule("momentum", _momentum, {**_DECAY, "momentum": 0.9, "nesterov": 0.0}, {"n": 0.0}),
    Rule("moving_average", _moving_average, {"momentum": 0.9}),
    Rule("rmsprop", _rmsprop, {**_DECAY, "momentum": 0.9}, {"n": 0.0}),
    Rule("rmspropv2", _rmspropv2, {**_DECAY, "momentum": 0.9}, {"n": 0.0}),
]}


def rule(name: str) -> Rule:
    if name not in RULES:
        raise ValueError(f"unknown optimizer {name}; known: {sorted(RULES)}")
    return RULES[name]


def delay_compensated(grad: ColumnLike, num: ColumnLike, latest: ColumnLike,
                      strength: float) -> Column:
    """Gradient corrected for a vector that moved since it was read: g + λ·g²·(w − w_latest).
    Feed the result to any rule."""
    moved = F.zip_with(col_of(num), col_of(latest), lambda a, b: a - b)
    return F.zip_with(col_of(grad), moved, lambda g, m: g + _num(strength) * g * g * m)
