"""Labels, actions, weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from sampleloom.functions import labels as L
from sampleloom.functions.numeric import logit_correction, safe_log_sigmoid
from sampleloom.operators import samples as S
from sampleloom.operators.admission import counter_weight
from sampleloom.plans import bindings as bind
from sampleloom.plans.bindings import MULTI, SAMPLES, w
from sampleloom.plans.registry import INV, ints, labs, query, r6, s_ints, s_labs, s_r6, s_u


@query("add_action", w(SAMPLES) + f"""
SELECT sample_id, {s_ints('CASE WHEN uid >= 10 AND uid < 60 THEN list_concat(actions, [7, 8]) ELSE actions END')} AS actions FROM samples""")
def _(spark, d):
    return bind.samples(spark, d).select("sample_id", ints(L.add_action("actions", [7, 8], "uid", "between", [10, 60])).alias("actions"))


@query("add_label", w(SAMPLES, MULTI) + f"""
SELECT sample_id, {s_labs(f'''[CASE WHEN label[1] <= 0 THEN {INV} ELSE label[1] END, label[2],
  CASE WHEN list_has_any(actions, [1, 2]) THEN 1.0::DOUBLE WHEN list_has_any(actions, [3]) THEN 0.0::DOUBLE ELSE {INV} END,
  CASE WHEN list_has_any(actions, [4]) THEN 1.0::DOUBLE WHEN {s_u('sample_id', "'label1'")} < 0.5::DOUBLE THEN 0.0::DOUBLE ELSE {INV} END]''')} AS label
FROM multi""")
def _(spark, d):
    return bind.multi_samples(spark, d).select("sample_id", labs(L.add_label(
        "sample_id", "label", "actions", "1,2:3:1.0;4::0.5")).alias("label"))


_SCATTER = "[" + ", ".join(f"CASE WHEN {c} THEN label[1] ELSE {INV} END" for c in (
    "FALSE", "chnid = 3", "FALSE", "chnid = 1", "chnid = 8")) + "]"


@query("scatter_label", w(SAMPLES) + f"SELECT sample_id, {s_labs(_SCATTER)} AS label FROM samples")
def _(spark, d):
    return bind.samples(spark, d).select("sample_id", labs(L.scatter_label("label", "chnid", "1:3,3:1,8:4")).alias("label"))


@query("most_prior_action", w(SAMPLES, MULTI) + """
SELECT sample_id, coalesce(best, actions[1]) AS with_fallback, best AS listed_only
FROM (SELECT sample_id, actions, CASE WHEN list_contains(actions, 4) THEN 4 WHEN list_contains(actions, 2) THEN 2 END AS best FROM multi)""")
def _(spark, d):
    return bind.multi_samples(spark, d).select("sample_id", L.most_prior_action("actions", [4, 2]).alias("with_fallback"),
                                               L.most_prior_action("actions", [4, 2], False).alias("listed_only"))


_HEAD = "[" + ", ".join(f"CASE WHEN h = {i} THEN v ELSE {INV} END" for i in range(5)) + "]"


@query("multi_label_gen", w(SAMPLES) + f"""
SELECT sample_id, {s_labs(_HEAD)} AS label
FROM (SELECT sample_id, CASE device_type WHEN 'pc' THEN 3 WHEN 'mobile' THEN 1 ELSE -1 END AS h,
             CASE WHEN actions[1] IN (3, 2) THEN 1.0::DOUBLE WHEN actions[1] = 1 THEN 0.0::DOUBLE ELSE {INV} END AS v FROM samples)""")
def _(spark, d):
    lab = L.multi_label("label", "actions", "device_type", {"pc": 3, "mobile": 1, "tv": 4}, [4, 3, 2, 1], [3, 2], [1])
    return bind.samples(spark, d).select("sample_id", labs(lab).alias("label"))


@query("label_upper_bound", w(SAMPLES) + f"SELECT sample_id, {s_labs('[least(label[1], 0.5::DOUBLE), least(label[2], 0.25::DOUBLE)]')} AS label FROM samples")
def _(spark, d):
    return bind.samples(spark, d).select("sample_id", labs(L.label_upper_bound("label", [0.5, 0.25])).alias("label"))


@query("label_normalization", w(SAMPLES) + f"""
SELECT sample_id, {s_labs('list_transform(label, lambda x: CASE WHEN x / 0.5::DOUBLE > 0 THEN power(x / 0.5::DOUBLE, 3) ELSE 0.0::DOUBLE END)')} AS repowed,
       {s_labs('list_transform(label, lambda x: ln(x / 0.1::DOUBLE + 1))')} AS scalelogged,
       {s_labs('list_transform(label, lambda x: CAST(trunc(x / 0.01::DOUBLE) AS DOUBLE))')} AS whole
FROM samples""")
def _(spark, d):
    return bind.samples(spark, d).select(
        "sample_id", labs(L.normalize_label("label", [("scale", 0.5), ("repow", 3.0)])).alias("repowed"),
        labs(L.normalize_label("label", [("scalelog", 0.1)])).alias("scalelogged"),
        labs(L.normalize_label("label", [("scale2int", 0.01)])).alias("whole"))


@query("fill_multi_rank_output", w(SAMPLES) + """
SELECT sample_id, CASE WHEN is_draw THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS draw_rank,
       CAST(CASE WHEN chnid IN (0, 1) THEN chnid ELSE 2 END AS DOUBLE) AS channel_rank, CAST(least(rank, 3) AS DOUBLE) AS capped_rank
FROM samples""")
def _(spark, d):
    third = F.lit(2)
    return bind.samples(spark, d).select(
        "sample_id", F.get(L.multi_rank_label("label", is_draw="is_draw"), third).alias("draw_rank"),
        F.get(L.multi_rank_label("label", chnid="chnid"), third).alias("channel_rank"),
        F.get(L.multi_rank_label("label", rank="rank", rank_num=4), third).alias("capped_rank"))


# action -> (weight, label); priority 4, 3, 2, 1. Written out again in SQL with one CASE per rule.
_WEIGHTS = {4: (3, 1), 3: (2, 1), 2: (2, -1), 1: (1, -1)}


def _sql_count(a: str, best: str) -> str:
    mult = " * ".join(f"CASE WHEN list_contains({a}, {k}) AND {best} = {k} THEN {v} ELSE 1 END" for k, (v, _) in _WEIGHTS.items())
    return f"(CASE WHEN len({a}) > 0 THEN 1 ELSE 0 END * {mult})"


def _sql_rank(a: str) -> str:
    return (f"CASE WHEN len({a}) = 0 THEN 5 WHEN list_contains({a}, 4) THEN 0 WHEN list_contains({a}, 3) THEN 1 "
            f"WHEN list_contains({a}, 2) THEN 2 WHEN list_contains({a}, 1) THEN 3 ELSE 4 END")


_BEST = "CASE {r} WHEN 0 THEN 4 WHEN 1 THEN 3 WHEN 2 THEN 2 WHEN 3 THEN 1 ELSE 0 END"
_LAB = "CASE {b} WHEN 4 THEN 1 WHEN 3 THEN 1 WHEN 2 THEN -1 WHEN 1 THEN -1 END"


@query("instance_reweight", w(SAMPLES, MULTI, f"""
ra AS (SELECT *, {_sql_rank('actions')} AS rc, {_sql_rank('pre_actions')} AS rp FROM multi)""", f"""
rb AS (SELECT *, {_BEST.format(r='rc')} AS bc, {_BEST.format(r='rp')} AS bp FROM ra)""", f"""
rd AS (SELECT *, coalesce({_LAB.format(b='bc')}, label[1]) AS lc, {_LAB.format(b='bp')} AS lp,
              {_sql_count('actions', 'bc')} AS nc, {_sql_count('pre_actions', 'bp')} AS np FROM rb)""", """
re AS (SELECT *, CASE WHEN rp > rc AND lp IS NULL THEN nc WHEN rp > rc AND lp <> lc THEN np + nc WHEN rp > rc THEN abs(np - nc)
                      WHEN rp = 5 AND rc = 5 THEN 1 ELSE 0 END AS copies,
              CASE WHEN rp > rc AND lp IS NOT NULL AND lp = lc AND np > nc THEN -lc WHEN rp > rc THEN lc ELSE label[1] END AS l FROM rd)""") + """
SELECT sample_id, CAST(l AS DOUBLE) AS label, CAST(i AS BIGINT) AS copy_no FROM re, range(1, 40) t(i) WHERE i <= copies""")
def _(spark, d):
    out = S.instance_reweight(bind.multi_samples(spark, d), [4, 3, 2, 1], _WEIGHTS)
    return out.select("sample_id", F.get("label", F.lit(0)).alias("label"), "copy_no")


@query("map_id", w(SAMPLES) + "SELECT sample_id, CASE item_id WHEN 3 THEN 0 WHEN 45 THEN 1 WHEN 78 THEN 2 ELSE -1 END::BIGINT AS mapped FROM samples")
def _(spark, d):
    return bind.samples(spark, d).select("sample_id", L.map_id("item_id", {3: 0, 45: 1, 78: 2}).alias("mapped"))


@query("logit_correction", w(SAMPLES) + f"""
SELECT sample_id, {s_r6('x - ln(sample_rate)')} AS plain,
       {s_r6('-(greatest(x, 0) - x + ln(1.0::DOUBLE + exp(-abs(x)))) - ln(sample_rate)')} AS biased,
       {s_r6('-(greatest(x, 0) - x + ln(1.0::DOUBLE + exp(-abs(x))))')} AS bias_only
FROM (SELECT sample_id, sample_rate, label[2] * 8.0::DOUBLE - 2.0::DOUBLE AS x FROM samples)""")
def _(spark, d):
    x = F.get("label", F.lit(1)) * 8.0 - 2.0
    return bind.samples(spark, d).select("sample_id", r6(logit_correction(x, "sample_rate")).alias("plain"),
                                         r6(logit_correction(x, "sample_rate", True)).alias("biased"),
                                         r6(logit_correction(x, None, True)).alias("bias_only"))


@query("safe_log_sigmoid", w(SAMPLES) + f"""
SELECT sample_id, {s_r6('CASE WHEN x >= 0 THEN -ln(1.0::DOUBLE + exp(-x)) ELSE x - ln(1.0::DOUBLE + exp(x)) END')} AS y
FROM (SELECT sample_id, label[2] * 800.0::DOUBLE - 200.0::DOUBLE AS x FROM samples)""")
def _(spark, d):
    return bind.samples(spark, d).select("sample_id", r6(safe_log_sigmoid(F.get("label", F.lit(1)) * 800.0 - 200.0)).alias("y"))


@query("counter_weight", w(SAMPLES) + f"""
SELECT fid, counter, {s_r6('1.0::DOUBLE / (1.0::DOUBLE + exp(4.0::DOUBLE - 0.03::DOUBLE * counter))')} AS weight
FROM (SELECT f_item[1] AS fid, CAST(least(count(*) + 1, 100) AS DOUBLE) AS counter FROM samples GROUP BY 1)""")
def _(spark, d):
    ids = bind.samples(spark, d).select(F.get("f_item", F.lit(0)).alias("fid"))
    return counter_weight(ids, 100).withColumn("weight", r6("weight"))
