"""Optimizer rules over several steps against a plain numpy loop."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sampleloom.functions.optimizers import RULES, rule

DIM, STEPS = 6, 3
RNG = np.random.default_rng(11)
W0 = RNG.normal(size=DIM)
GRADS = RNG.normal(size=(STEPS, DIM))


def loop(name, p):
    w = W0.copy()
    n = np.full(DIM, p.get("initial_accumulator", 0.0))
    z, m, v, vh, acc_up = (np.zeros(DIM) for _ in range(5))
    gs, b1, b2 = p.get("initial_accumulator", 0.0), p.get("beta1", 0.0), p.get("beta2", 0.0)
    lr, wd, mu = p.get("learning_rate", 0.0), p.get("weight_decay", 0.0), p.get("momentum", 0.0)
    for g in GRADS:
        d = g + wd * w
        if name == "sgd":
            w = w - lr * g
        elif name == "adagrad":
            n = n + d * d
            w = w - lr / np.sqrt(n) * d
        elif name == "dynamic_wd_adagrad":
            n = n + g * g
            w = w - lr / np.sqrt(n) * g - lr * wd * w
        elif name in ("ftrl", "group_ftrl"):
            n1 = n + g * g
            z = z + g - (np.sqrt(n1) - np.sqrt(n)) / lr * w
            n = n1
            if name == "ftrl":
                w = np.where(np.abs(z) > p["l1"], lr * (np.sign(z) * p["l1"] - z) / (np.sqrt(n) + p["beta"] + p["l2"] * lr), 0)
            else:
                t = np.sqrt((z * z).sum())
                w = np.zeros(DIM) if t < p["l1"] else lr * z * (p["l1"] - t) / t / (p["beta"] + np.sqrt(n) + p["l2"] * lr)
        elif name == "group_adagrad":
            gs += (d * d).max()
            r = lr / (p["beta"] + np.sqrt(gs))
            zz = d - w / r
            t = np.sqrt((zz * zz).sum())
            w = np.zeros(DIM) if t < p["l2"] else -r * (t - p["l2"]) / t * zz
        elif name == "adadelta":
            rho, eps = p["averaging_ratio"], p["epsilon"]
            n = n * rho + d * d * (1 - rho)
            up = np.sqrt(acc_up + eps) / np.sqrt(n + eps) * d
            w, acc_up = w - lr * up, acc_up * rho + up * up * (1 - rho)
        elif name in ("adam", "amsgrad"):
            m = m + (d - m) * (1 - p["beta1"])
            v = v + (d * d - v) * (1 - p["beta2"])
            vh = np.maximum(vh, v)
            lead = d * (1 - p["beta1"]) + p["beta1"] * m if p["nesterov"] else m
            rate = lr * np.sqrt(1 - b2) / (1 - b1)
            w = w - lead * rate / (np.sqrt(vh if name == "amsgrad" else v) + p["epsilon"])
            b1, b2 = b1 * p["beta1"], b2 * p["beta2"]
        elif name == "momentum":
            old, z = z, mu * z - lr * d
            w = w + (-mu * old + (1 + mu) * z if p["nesterov"] else z)
        elif name == "moving_average":
            w = mu * w + (1 - mu) * g
        elif name == "rmsprop":
            n = mu * n + (1 - mu) * d * d
            w = w - lr / (np.sqrt(n) + 1) * d
        elif name == "rmspropv2":
            n = mu * n + d * d
            w = w - lr / (np.sqrt(n) + 1) * d
    return w


CASES = [(n, {}) for n in RULES if n != "dynamic_wd_adagrad"] + [
    ("adagrad", {"weight_decay": 0.1, "learning_rate": 0.5}), ("dynamic_wd_adagrad", {"decouple": 1.0, "weight_decay": 0.1, "learning_rate": 0.3}),
    ("ftrl", {"l1": 0.5, "l2": 0.2, "beta": 1.0}), ("group_ftrl", {"l1": 2.0, "l2": 0.1}), ("group_ftrl", {"l1": 1e6}),
    ("group_adagrad", {"l2": 0.5, "weight_decay": 0.1, "beta": 0.2}), ("group_adagrad", {"l2": 1e9}), ("adam", {"nesterov": 1.0, "weight_decay": 0.2}),
    ("amsgrad", {"nesterov": 1.0}), ("momentum", {"nesterov": 1.0, "weight_decay": 0.1}), ("rmsprop", {"weight_decay": 0.1})]


@pytest.mark.parametrize("name,over", CASES)
def test_rule_matches_loop(spark, name, over):
    r = rule(name)
    df = spark.createDataFrame([(W0.tolist(),)], "num array<double>").withColumn("opt", r.initial(DIM, **over))
    for g in GRADS:
        df = df.withColumn("g", F.array(*[F.lit(float(x)) for x in g])).select(r.apply("num", "g", "opt", **over).alias("r")).select("r.*")
    p = r.config(over)
    want = loop(name, p) if name != "dynamic_wd_adagrad" or p["decouple"] else loop("adagrad", p)
    assert np.allclose(df.first()["num"], want, rtol=1e-9, atol=1e-12)


def test_unknown_names():
    with pytest.raises(ValueError):
        rule("nope")
    with pytest.raises(ValueError):
        rule("sgd").config({"beta": 1})
