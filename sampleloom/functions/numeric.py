"""Scalar numeric functions: corrections, quantizers, schedules."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from sampleloom.functions.base import ColumnLike, col_of


def safe_log_sigmoid(x: ColumnLike) -> Column:
    """log(1 / (1 + e^-x)) without overflow on either side."""
    x = col_of(x)
    return -(F.greatest(x, F.lit(0.0)) - x + F.log1p(F.exp(-F.abs(x))))


def sigmoid(x: ColumnLike) -> Column:
    x = col_of(x)
    e = F.exp(-F.abs(x))
    return F.when(x >= 0, F.lit(1.0) / (F.lit(1.0) + e)).otherwise(e / (F.lit(1.0) + e))


def logit_correction(logit: ColumnLike, sample_rate: ColumnLike | None = None,
                     sample_bias: bool = False) -> Column:
    """Undo sampling: subtract log(sample_rate); with ``sample_bias`` take the log-sigmoid first."""
    out = safe_log_sigmoid(logit) if sample_bias else col_of(logit)
    return out if sample_rate is None else out - F.log(col_of(sample_rate))


def clip_logit(logit: ColumnLike, threshold: float | None) -> Column:
    """Clip to the logit of a probability margin in (0, 1)."""
    if threshold is None:
        return col_of(logit)
    if not 0 < threshold < 1:
        raise ValueError("logit clip threshold must lie in (0, 1)")
    bound = math.log((1 - threshold) / threshold)
    lo, hi = min(-bound, bound), max(-bound, bound)
    return F.least(F.greatest(col_of(logit), F.lit(lo)), F.lit(hi))


def cross_entropy(label: ColumnLike, logit: ColumnLike) -> Column:
    """Sigmoid cross-entropy in the overflow-safe form."""
    x, z = col_of(logit), col_of(label)
    return F.greatest(x, F.lit(0.0)) - x * z + F.log1p(F.exp(-F.abs(x)))


def quantize_fixed8(v: ColumnLike, r: float = 1.0) -> Column:
    """Round every element to steps of r/128 inside the int8 range."""
    step = r / 128.0

    def one(x: Column) -> Column:
        shifted = F.when(x >= 0, x + F.lit(step / 2)).otherwise(x - F.lit(step / 2)) / F.lit(step)
        whole = F.when(shifted >= 0, F.floor(shifted)).otherwise(F.ceil(shifted)).cast("double")
        clamped = F.greatest(F.least(whole, F.lit(127.0)), F.lit(-128.0))
        return F.when(F.isnan(x), F.lit(0.0)).otherwise(clamped * F.lit(step))

    return F.transform(col_of(v), one)


def one_bit_scale(step: ColumnLike, init_scale: float = 1.0, max_scale: float = 10000.0,
                  step_size: int = 200) -> Column:
    """Scale in force at ``step``; it is renewed every ``step_size`` steps."""
    gamma, power = 0.005, 0.5  # fixed values of the schedule
    s = col_of(step)
    last = s - s % F.lit(step_size)
    return F.least(F.lit(init_scale) * F.pow(F.lit(1.0) + F.lit(gamma) * last, F.lit(power)),
                   F.lit(max_scale))


def one_bit_forward(v: ColumnLike, scale: Column | float, amplitude: float = 0.1) -> Column:
    k = scale if isinstance(scale, Column) else F.lit(float(scale))
    return F.transform(col_of(v), lambda x: F.lit(amplitude) * F.tanh(k * x))


def fp16_round(v: ColumnLike) -> Column:
    """Nearest half-precision value of every element (ties to even), saturating to infinity."""

    def one(x: Column) -> Column:
        a = F.abs(x)
        exponent = F.greatest(F.floor(F.log2(F.greatest(a, F.lit(1e-300)))), F.lit(-14))
        quantum = F.pow(F.lit(2.0), exponent.cast("double") - 10)
        rounded = F.rint(a / quantum) * quantum
        signed = F.when(x < 0, -rounded).otherwise(rounded)
        limit = F.when(x < 0, F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
        return F.when(a == 0, x).when(rounded > 65504.0, limit).otherwise(signed)

    return F.transform(col_of(v), one)


def polynomial_decay(step: ColumnLike, initial: float, decay_steps: int,
                     end: float = 0.0001, power: float = 1.0, cycle: bool = False) -> Column:
    """Learning rate that falls from ``initial`` to ``end`` over ``decay_steps``."""
    s = col_of(step).cast("double")
    if cycle:
        periods = F.greatest(F.ceil(s / F.lit(float(decay_steps))), F.lit(1)).cast("double")
        span = periods * F.lit(float(decay_steps))
    else:
        span = F.lit(float(decay_steps))
        s = F.least(s, span)
    left = F.pow(F.lit(1.0) - s / span, F.lit(float(power)))
    return F.lit(initial - end) * left + F.lit(end)
