"""SQL functions say what the column functions say, without Python in the plan."""

import pytest
from pyspark.sql import functions as F

from sampleloom.functions import fid as U
from sampleloom.functions import labels as L
from sampleloom.functions import numeric as N
from sampleloom.functions import predicates as P
from sampleloom.functions import sql as SQL
from sampleloom.plans import bindings as bind

SF = "/root/testdata/sf0.001"
TAG = (5 << 48) + 70


def same():
    """SQL texts with the column functions that they stand for."""
    v1 = F.get("fids_v1", F.lit(3))
    return {
        "sl_make_fid(7, uid)": U.make_fid(7, "uid"),
        "sl_make_fid_v1(700, uid)": U.make_fid(700, "uid", 1),
        "sl_slot_of(f_item[0])": U.slot_of(F.get("f_item", F.lit(0))),
        "sl_slot_of_v1(fids_v1[3])": U.slot_of(v1, 1),
        "sl_signature_of(f_item[0])": U.signature_of(F.get("f_item", F.lit(0))),
        "sl_v1_to_v2(fids_v1[0])": U.v1_to_v2(F.get("fids_v1", F.lit(0))),
        "sl_switch_slot(f_tags, 9)": U.switch_slot("f_tags", 9),
        "sl_extract_fid(uid, 3)": U.extract_fid("uid", 3),
        "sl_feature_hash(CAST(uid AS STRING), 'a', 3)": U.feature_hash("uid", "a", 3),
        "sl_float_bucket(label[1])": U.float_bucket(F.get("label", F.lit(1))),
        f"sl_fid_mask(f_tags, {TAG}L)": U.fid_mask("f_tags", TAG),
        "sl_seq_mask(size(f_tags), 3)": U.seq_mask(F.size("f_tags"), 3),
        "sl_safe_log_sigmoid(label[1] - 2)": N.safe_log_sigmoid(F.get("label", F.lit(1)) - 2),
        "sl_sigmoid(label[1] - 2)": N.sigmoid(F.get("label", F.lit(1)) - 2),
        "sl_logit_correction(label[1], sample_rate)": N.logit_correction(F.get("label", F.lit(1)), "sample_rate"),
        "sl_polynomial_decay(uid, 0.1, 300, 0.001, 2.0)": N.polynomial_decay("uid", 0.1, 300, 0.001, 2.0),
        "sl_any_action(actions, array(1, 2))": P.any_action("actions", [1, 2]),
        "sl_map_id(chnid, map(1L, 10L, 2L, 20L))": L.map_id("chnid", {1: 10, 2: 20}),
        "sl_has_slots(f_tags, array(5))": P.has_slots("f_tags", [5]),
        "sl_by_label(label, array(1.0D, 0.2D))": P.by_label("label", [1.0, 0.2]),
        "sl_label_upper_bound(label, array(0.5D))": L.label_upper_bound("label", [0.5]),
        "sl_field_as_label(CAST(uid AS DOUBLE), 50, 7)": L.field_as_label("uid", 50.0, 7.0),
        "sl_real_weight(is_draw, 0.25)": L.real_weight("is_draw", 0.25),
    }


@pytest.fixture(scope="module")
def rows(spark):
    names = SQL.register(spark)
    assert {n for n in names} == {t.split("(")[0] for t in same()}
    return bind.samples(spark, SF)


def test_functions_agree(spark, rows):
    both = same()
    got = rows.select(*[F.expr(text).alias(f"s{i}") for i, text in enumerate(both)], *[c.alias(f"c{i}") for i, c in enumerate(both.values())])
    for r in got.collect():
        for i, text in enumerate(both):
            assert r[f"s{i}"] == r[f"c{i}"], text
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "sl_" not in plan  # inlined


def test_null_inputs(spark, rows):
    nulls = spark.sql("""SELECT sl_any_action(NULL, array(1)) AS a, sl_by_label(array(CAST(NULL AS DOUBLE), 1.0D), array(0.5D, 0.5D)) AS b,
        sl_by_label(array(1.0D), array(0.5D, 0.5D)) AS c, sl_fid_mask(NULL, 1L) AS d, sl_map_id(NULL, map(1L, 2L)) AS e""").first()
    assert tuple(nulls) == (False, True, False, 0.0, -1)


def test_request_function(spark):
    SQL.register_request(spark, "fid BIGINT, name STRING")
    df = spark.sql("SELECT 1 AS id, array(named_struct('fid', 5L, 'name', 'a'), named_struct('fid', 6L, 'name', 'b')) AS x UNION ALL SELECT 2, array()")
    df.createOrReplaceTempView("sl_some_requests")
    got = spark.sql("SELECT id, pos, fid, name FROM sl_some_requests, LATERAL sl_explode_request(x)").collect()
    assert sorted(map(tuple, got)) == [(1, 0, 5, "a"), (1, 1, 6, "b")]
