"""Worked examples of the column expressions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sampleloom.functions import fid as U
from sampleloom.functions import labels as L
from sampleloom.functions import numeric as N
from sampleloom.functions import predicates as P
from sampleloom.functions.base import INVALID_LABEL as INV

MASK64 = (1 << 64) - 1


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def arr(values, kind):
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


def signed(x):
    x &= MASK64
    return x - (1 << 64) if x >= 1 << 63 else x


def test_fid_layouts(spark):
    r = one(spark, U.make_fid(301, F.lit(5)), U.slot_of(U.make_fid(1023, F.lit(7), 1), 1), U.make_fid(1023, F.lit(0), 1),
            U.v1_to_v2(U.make_fid(600, F.lit(9), 1)))
    assert tuple(r) == (84723967989907461, 1023, -18014398509481984, (600 << 48) | 9)
    with pytest.raises(ValueError):
        U.make_fid(1024, F.lit(1), 1)


@pytest.mark.parametrize("a,b", [((5 << 48) + 3, (200 << 48) + 77), (-18014398509481984, -1), (0, 12345), (MASK64 >> 1, MASK64 >> 1)])
def test_fid_mix_matches_integers(spark, a, b):
    p = (a & MASK64) * (b & MASK64)
    want = signed((p >> 64) ^ (p & MASK64))
    assert one(spark, U.fid_mix(F.lit(a).cast("bigint"), F.lit(b).cast("bigint")))[0] == want


@pytest.mark.parametrize("text", ["", "pc", "mobile", "a long data source name", "überraschung"])
def test_java_hash(spark, text):
    h = 0
    for b in text.encode():
        h = (31 * h + (b - 256 if b > 127 else b)) & 0xFFFFFFFF
    want = h - (1 << 32) if h >= 1 << 31 else h
    r = one(spark, U.java_hash(F.lit(text)), U.data_source_key(F.lit(text)))
    assert tuple(r) == (want, (h << 8) & 0xFFFFFFFF)


def test_masks(spark):
    rows = spark.createDataFrame([([1, 2, 3],), ([3],), ([],), ([4, 5, 6],)], "f array<bigint>")
    assert [r[0] for r in rows.select(U.fid_mask("f", 3)).collect()] == [1.0, 1.0, 0.0, 0.0]
    assert one(spark, U.seq_mask(F.lit(2), 4))[0] == [1, 1, 0, 0]


def test_switch_slot_keeps_one_bit_in_compat(spark):
    f = (201 << 48) + 9
    r = one(spark, U.switch_slot(arr([f], "bigint"), 2), U.switch_slot(arr([f], "bigint"), 2, compat=True))
    assert r[0] == [(2 << 48) + 9] and r[1] == [(3 << 48) + 9]


def test_float_bucket(spark):
    for v in (0.0, 1.0, -3.5, 1000.0):
        assert one(spark, U.float_bucket(F.lit(v)))[0] == int(math.log2(abs(v) + 1))


def test_between_is_half_open(spark):
    r = one(spark, P.compare(F.lit(1), "between", [0, 1]), P.compare(F.lit(1), "between", [1, 2]))
    assert tuple(r) == (False, True)


def test_compare_null_is_false(spark):
    x = F.lit(None).cast("bigint")
    assert one(spark, P.compare(x, "neq", 1), P.compare(x, "not-in", [1]))[0:2] == (False, False)


def test_set_compare_and_empty(spark):
    a, e = arr([1, 2], "bigint"), arr([], "bigint")
    r = one(spark, P.set_compare(a, "any", [2, 9]), P.set_compare(a, "all", [1, 2, 9]), P.set_compare(a, "diff", [3]),
            P.set_compare(e, "any", [1], keep_empty=True), P.set_compare(e, "diff", [1]))
    assert tuple(r) == (True, False, True, True, False)


def test_feature_value_needs_one_value(spark):
    r = one(spark, P.feature_value(arr([5], "bigint"), "gt", 3, "int64"), P.feature_value(arr([5, 6], "bigint"), "gt", 3, "int64"),
            P.feature_value(arr([], "bigint"), "gt", 3, "int64", keep_empty=True))
    assert tuple(r) == (True, False, True)


def test_filter_by_label_examples(spark):
    rows = spark.createDataFrame([([0.0, 1.0],), ([0.0, 2.0],), ([5.0],)], "label array<double>")
    assert rows.filter(P.by_label("label", [0.0, 1.0])).count() == 2
    assert rows.filter(P.by_label("label", [0.0, 1.0], filter_equal=True)).count() == 1


def test_add_label_examples(spark):
    rows = spark.createDataFrame([(1, [0.0], [1, 2, 4]), (2, [1.0], [1]), (3, [-1.0], [3, 4]), (4, [], [5])],
                                 "id int, label array<double>, actions array<int>")
    got = [r[0] for r in rows.orderBy("id").select(L.add_label("id", "label", "actions", "1,2:3:1.0;4::0.0")).collect()]
    assert got == [[INV, 1.0, 1.0], [1.0, 1.0, INV], [INV, 0.0, 1.0], [INV, INV]]


def test_add_label_rates_are_shares(spark):
    rows = spark.range(4000).select("id", arr([0.0], "double").alias("label"), arr([5], "int").alias("actions"))
    neg = rows.select(F.get(L.add_label("id", "label", "actions", "4::0.5"), F.lit(1)).alias("x")).filter("x = 0").count()
    assert 1800 < neg < 2200


def test_task_config_errors():
    for bad in ("1:1:0.5", ":2:1.0", "1:2:1.5", "", "1:2"):
        with pytest.raises(ValueError):
            L.parse_tasks(bad)


def test_scatter_label_examples(spark):
    rows = spark.createDataFrame([(0, [1.0]), (100, [2.0]), (200, [3.0]), (300, [])], "c bigint, label array<double>")
    got = [r[0] for r in rows.orderBy("c").select(L.scatter_label("label", "c", "100:3,200:1,300:4")).collect()]
    assert got == [[INV] * 5, [INV, INV, INV, 2.0, INV], [INV, 3.0, INV, INV, INV], [INV] * 5]


def test_multi_label_examples(spark):
    rows = spark.createDataFrame([(0, "ios", [1, 2]), (1, "wp", [3]), (2, "android", [2]), (3, "ios", [1]), (4, "tv", [1])],
                                 "i int, dev string, actions array<int>")
    lab = L.multi_label(arr([], "double"), "actions", "dev", {"ios": 3, "wp": 1, "android": 4, "other": 0}, [4, 3, 2, 1, 0], [3, 2], [1])
    got = [[(i, v) for i, v in enumerate(r[0]) if v != INV] for r in rows.orderBy("i").select(lab).collect()]
    assert got == [[(3, 1.0)], [(1, 1.0)], [(4, 1.0)], [(3, 0.0)], []]


def test_label_bounds_and_normalization(spark):
    a, b = arr([0, 1], "double"), arr([0, 2], "double")
    r = one(spark, L.label_upper_bound(a, [0.5, 0.5]), L.label_upper_bound(b, [0.5, 0.5]), L.label_upper_bound(arr([3], "double"), [1, 1]),
            L.normalize_label(a, [("scale", 0.5), ("repow", 3)]), L.normalize_label(a, [("log", 0.0)]), L.normalize_label(b, [("pow", 2)]))
    assert list(r) == [[0.0, 0.5], [0.0, 0.5], [3.0], [0.0, 8.0], [float("-inf"), 0.0], [1.0, 9.0]]


def test_map_id_and_field_label(spark):
    m = {123: 0, 456: 1, 789: 2}
    assert list(one(spark, *[L.map_id(F.lit(x), m) for x in (123, 456, 789, 912)])) == [0, 1, 2, -1]
    assert one(spark, L.field_as_label(F.lit(7), 5.0))[0] == [0.0]


def test_most_prior_action(spark):
    r = one(spark, L.most_prior_action(arr([1, 2], "int"), [2, 1]), L.most_prior_action(arr([8, 9], "int"), [2, 1]),
            L.most_prior_action(arr([8, 9], "int"), [2, 1], False), L.most_prior_action(arr([], "int"), [2]))
    assert tuple(r) == (2, 8, None, None)


@pytest.mark.parametrize("cur,pre,label,want", [
    ([2], [], 1.0, (2, 1.0)), ([], [], 1.0, (1, 1.0)), ([], [2], 1.0, (0, 1.0)), ([1], [3], 0.0, (4, 1.0)),
    ([2], [3], 0.0, (1, 1.0)), ([9], [], 1.0, (1, 1.0)), ([1], [1], 1.0, (0, 1.0))])
def test_reweight_cases(spark, cur, pre, label, want):
    # priority 1 > 2 > 3; weights: 1 -> 3, 2 -> 2, 3 -> 1; labels 1, 1, -1 except (2 after 3)
    table = {1: (3, 1), 2: (2, -1), 3: (1, -1)} if (cur, pre) == ([2], [3]) else {1: (3, 1), 2: (2, 1), 3: (1, -1)}
    if (cur, pre) == ([2], [3]):
        want = (1, -1.0)
    r = one(spark, L.reweight(arr(cur, "int"), arr(pre, "int"), F.lit(label), [1, 2, 3], table))[0]
    assert (r["copies"], r["label"]) == want


def test_corrections(spark):
    r = one(spark, N.safe_log_sigmoid(F.lit(800.0)), N.safe_log_sigmoid(F.lit(-800.0)), N.logit_correction(F.lit(1.0), F.lit(0.5)),
            N.cross_entropy(F.lit(1.0), F.lit(2.0)), N.clip_logit(F.lit(99.0), 0.1))
    assert np.allclose(list(r), [0.0, -800.0, 1 - math.log(0.5), math.log1p(math.exp(-2)), math.log(9)])


def test_quantizers(spark):
    x = [0.5, -0.3, 0.0, 5.0, -5.0, 0.004, -0.0038]
    step = 1 / 128
    want = [max(-128, min(127, int((v + (step / 2 if v >= 0 else -step / 2)) / step))) * step for v in x]
    assert np.allclose(one(spark, N.quantize_fixed8(arr(x, "double")))[0], want)
    assert np.allclose(one(spark, N.one_bit_forward(arr(x, "double"), 2.0))[0], 0.1 * np.tanh(2 * np.array(x)))


def test_fp16_round_is_numpy_half(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=400), rng.normal(size=200) * 1e-5, rng.normal(size=100) * 3e4, [0.0, 65504.0, 1e6, -1e6, 6e-8, 2048.5, 1.00048828125]])
    with np.errstate(over="ignore"):
        want = x.astype(np.float16).astype(float)
    df = spark.createDataFrame([(x.tolist(),)], "v array<double>")
    assert np.array_equal(df.select(N.fp16_round("v")).first()[0], want)


def test_decay(spark):
    r = one(spark, N.polynomial_decay(F.lit(50), 1.0, 100, 0.0), N.polynomial_decay(F.lit(500), 1.0, 100, 0.1, 2.0),
            N.polynomial_decay(F.lit(150), 1.0, 100, 0.0, cycle=True))
    assert np.allclose(list(r), [0.5, 0.1, 0.25])
