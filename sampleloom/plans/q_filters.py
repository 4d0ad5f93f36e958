"""Filters and their composition."""

from __future__ import annotations

from pyspark.sql import functions as F

from sampleloom.functions import predicates as P
from sampleloom.functions.fid import make_fid
from sampleloom.operators import samples as S
from sampleloom.operators import steps as ST
from sampleloom.operators.joins import semi_file
from sampleloom.plans import bindings as bind
from sampleloom.plans.bindings import MULTI, SAMPLES, read, w
from sampleloom.plans.registry import INV, ORACLES, ints, labs, query, s_ints, s_labs, s_u
from sampleloom.sources.table_store import read_text, write_text
from sampleloom.streaming.flows import work_dir


def _tag(n: int) -> int:
    return (5 << 48) + n


def _keep(spark, d, p):
    return bind.samples(spark, d).filter(p).select("sample_id")


@query("filter_by_fids", w(SAMPLES) + f"""
SELECT sample_id FROM samples
WHERE req_time >= 1704200000 AND list_has_any(actions, [1,2,3,4]) AND NOT list_has_any(f_tags, [{_tag(70)}, {_tag(71)}])
  AND list_has_any(f_tags, [{','.join(str(_tag(i * 7 + 1)) for i in range(0, 100, 3))}])
  AND len(f_tags) > 0""")
def _(spark, d):
    return _keep(spark, d, P.by_fids(
        "f_tags", [_tag(70), _tag(71)], [_tag(i * 7 + 1) for i in range(0, 100, 3)], actions="actions",
        has_actions=[1, 2, 3, 4], req_time="req_time", req_time_min=1704200000, select_slots=[5]))


@query("select_fids", w(SAMPLES) + f"SELECT sample_id FROM samples WHERE list_has_all(f_tags, [{_tag(21)}, {_tag(22)}])")
def _(spark, d):
    return _keep(spark, d, P.by_fids("f_tags", select_fids=[_tag(21), _tag(22)]))


@query("filter_by_slots", w(SAMPLES) + """
SELECT sample_id FROM samples WHERE item_id % 3 = 2 AND len(f_tags) >= 1""")
def _(spark, d):
    # v1 slot 1000 holds item % 3; v2 slot 5 holds the tags
    s = bind.samples(spark, d).withColumn("fids_v1", F.when(F.col("item_id") % 3 == 2, F.col("fids_v1")).otherwise(
        F.slice("fids_v1", 1, 3)))
    return s.filter(P.has_slots("f_tags", [5, 301, 1000], 2, "fids_v1")).select("sample_id")


@query("filter_by_action", w(SAMPLES, MULTI) + "SELECT sample_id FROM multi WHERE list_has_any(actions, [3, 5])")
def _(spark, d):
    return bind.multi_samples(spark, d).filter(P.any_action("actions", [3, 5])).select("sample_id")


@query("filter_by_label", w(SAMPLES) + "SELECT sample_id FROM samples WHERE label[1] > 1 OR label[2] > 0.3::DOUBLE")
def _(spark, d):
    return _keep(spark, d, P.by_label("label", [1.0, 0.3], filter_equal=True))


@query("filter_by_label_equal", w(SAMPLES) + "SELECT sample_id FROM samples WHERE label[1] >= 1")
def _(spark, d):
    return _keep(spark, d, P.by_label("label", [1.0]))


@query("filter_by_value", w(SAMPLES) + """
SELECT sample_id FROM samples WHERE uid >= 20 AND uid < 90 AND rank NOT IN (2, 4) AND sample_rate > 0.6::DOUBLE AND chnid <> 7""")
def _(spark, d):
    return _keep(spark, d, P.compare("uid", "between", [20, 90]) & P.compare("rank", "not-in", [2, 4])
                 & P.compare("sample_rate", "gt", 0.6) & P.compare("chnid", "neq", 7))


@query("filter_by_string", w(SAMPLES) + """
SELECT sample_id FROM samples WHERE (starts_with(device_type, 'p') OR starts_with(device_type, 'mo')) AND device_type >= 'n'
UNION ALL SELECT sample_id FROM samples WHERE ends_with(device_type, 'ud')""")
def _(spark, d):
    a = P.compare("device_type", "startswith", ["p", "mo"]) & P.compare("device_type", "ge", "n")
    return _keep(spark, d, a | P.compare("device_type", "endswith", ["ud"]))


@query("filter_by_set", w(SAMPLES) + """
SELECT sample_id,
       CASE WHEN len(special_strategies) = 0 THEN FALSE ELSE list_has_any(special_strategies, [2, 3]) END AS any_hit,
       CASE WHEN len(special_strategies) = 0 THEN TRUE ELSE list_has_all(special_strategies, [1, 2]) END AS all_hit,
       CASE WHEN len(special_strategies) = 0 THEN TRUE ELSE NOT list_has_any(special_strategies, [1]) END AS diff_hit
FROM samples""")
def _(spark, d):
    c = "special_strategies"
    return bind.samples(spark, d).select(
        "sample_id", P.set_compare(c, "any", [2, 3], "int").alias("any_hit"),
        P.set_compare(c, "all", [1, 2], "int", True).alias("all_hit"),
        P.set_compare(c, "diff", [1], "int", True).alias("diff_hit"))


@query("filter_by_value_file", """
SELECT event_id FROM events WHERE user_id IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def _(spark, d):
    ops = read(spark, d, "orders").filter("o_totalprice > 400000").select("o_custkey")
    return semi_file(read(spark, d, "events").select("event_id", "user_id"), ops, "user_id", "in").select("event_id")


@query("filter_by_value_file_not_in", """
SELECT event_id FROM events WHERE user_id NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def _(spark, d):
    ops = read(spark, d, "orders").filter("o_totalprice > 400000").select("o_custkey")
    return semi_file(read(spark, d, "events").select("event_id", "user_id"), ops, "user_id", "not-in").select("event_id")


@query("filter_by_feature_value", w(SAMPLES) + f"""
SELECT sample_id, CASE WHEN len(f_tags) = 1 THEN f_tags[1] > {_tag(300)} ELSE TRUE END AS single_hit,
       CASE WHEN len(f_tags) = 0 THEN FALSE ELSE list_has_any(f_tags, [{_tag(28)}, {_tag(15)}]) END AS set_hit,
       label[2] >= 0.1::DOUBLE AND label[2] < 0.2::DOUBLE AS between_hit
FROM samples""")
def _(spark, d):
    return bind.samples(spark, d).select(
        "sample_id", P.feature_value("f_tags", "gt", _tag(300), "int64", keep_empty=True).alias("single_hit"),
        P.feature_value("f_tags", "any", [_tag(28), _tag(15)], "int64").alias("set_hit"),
        P.feature_value(F.slice("label", 2, 1), "between", [0.1, 0.2], "double").alias("between_hit"))


@query("special_strategy", w(SAMPLES) + f"""
SELECT sample_id, {s_labs("CASE WHEN list_contains(special_strategies, 2) THEN [0.25::DOUBLE, label[2]] ELSE label END")} AS label
FROM samples
WHERE len(special_strategies) = 0
   OR (list_contains(special_strategies, 2) AND {s_u('sample_id', "'strategy'")} <= 0.5::DOUBLE)
   OR (NOT list_contains(special_strategies, 2) AND list_contains(special_strategies, 1))""")
def _(spark, d):
    out = S.special_strategy(bind.samples(spark, d), [2, 1], {2: 0.5}, {2: 0.25}, keep_empty=True)
    return out.select("sample_id", labs("label").alias("label"))


@query("negative_sample", w(SAMPLES) + f"""
SELECT sample_id FROM samples
WHERE label[1] >= 1 OR floor({s_u('sample_id', "'neg'")} * 1000) / 1000.0::DOUBLE
      >= CASE actions[1] WHEN 1 THEN 0.3::DOUBLE WHEN 5 THEN 0.9::DOUBLE ELSE 0.5::DOUBLE END""")
def _(spark, d):
    return S.negative_sample(bind.samples(spark, d), 0.5, 0, 1.0, [5, 1], {1: 0.3, 5: 0.9}).select("sample_id")


_COMPOSED = f"""
SELECT sample_id, {s_labs(f"[CASE WHEN label[1] <= 0 THEN {INV} ELSE label[1] END, label[2], CASE WHEN actions[1] = 4 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END]")} AS label
FROM samples
WHERE NOT list_has_any(f_tags, [{_tag(70)}]) AND actions[1] IN (1, 2, 4) AND (label[1] >= 1 OR label[2] >= 0.2::DOUBLE) AND uid < 100"""


@query("transform_compose", w(SAMPLES) + _COMPOSED)
def _(spark, d):
    flow = S.compose(S.keep_if(P.by_fids("f_tags", [_tag(70)])), S.keep_if(P.any_action("actions", [1, 2, 4])),
                     S.keep_if(P.by_label("label", [1.0, 0.2])), S.keep_if(P.compare("uid", "lt", 100)),
                     S.with_label("sample_id", "4::1.0"))
    return bind.samples(spark, d).transform(flow).select("sample_id", labs("label").alias("label"))


@query("logical_or", w(SAMPLES) + "SELECT sample_id FROM samples WHERE actions[1] = 4 OR label[2] > 0.3::DOUBLE")
def _(spark, d):
    either = S.logical_or(P.any_action("actions", [4]), P.by_label("label", [9.0, 0.3]))
    return bind.samples(spark, d).transform(either).select("sample_id")


def _stored(spark, name, tree):
    """A tree of steps, written as text and read back."""
    path = f"{work_dir(spark, name)}/steps.json"
    write_text(spark, path, ST.to_json(tree))
    return ST.compiled(ST.from_json(read_text(spark, path)))


@query("steps_from_text", ORACLES["transform_compose"])
def _(spark, d):
    tree = ST.every(ST.step("by_fids", fids="f_tags", filter_fids=[_tag(70)]),
                    ST.every(ST.step("any_action", actions="actions", wanted=[1, 2, 4]), ST.step("by_label", label="label", thresholds=[1.0, 0.2])),
                    ST.step("compare", value="uid", op="lt", operand=100),
                    ST.step("add_label", key="sample_id", label="label", actions="actions", config="4::1.0"))
    return bind.samples(spark, d).transform(_stored(spark, "steps", tree)).select("sample_id", labs("label").alias("label"))


@query("either_from_text", ORACLES["logical_or"])
def _(spark, d):
    tree = ST.either(ST.step("any_action", actions="actions", wanted=[4]), ST.step("by_label", label="label", thresholds=[9.0, 0.3]))
    return bind.samples(spark, d).transform(_stored(spark, "either", tree)).select("sample_id")


@query("retention_stats", w(SAMPLES, """
p AS (SELECT actions[1] IN (1, 2, 4) AS a, uid < 100 AS b FROM samples)""") + """
SELECT 'by_action' AS transform, count(*) AS input, count(*) FILTER (WHERE a) AS output,
       count(*) FILTER (WHERE a) / CAST(count(*) AS DOUBLE) AS retention FROM p
UNION ALL
SELECT 'by_uid', count(*) FILTER (WHERE a), count(*) FILTER (WHERE a AND b),
       count(*) FILTER (WHERE a AND b) / CAST(count(*) FILTER (WHERE a) AS DOUBLE) FROM p""")
def _(spark, d):
    return S.retention(bind.samples(spark, d), {"by_action": P.any_action("actions", [1, 2, 4]),
                                                "by_uid": P.compare("uid", "lt", 100)})


@query("merge_flow", w(SAMPLES) + """
SELECT sample_id, 'data_sourcea' AS data_source_name FROM samples WHERE is_draw
UNION ALL SELECT sample_id, 'data_sourceb' FROM samples WHERE rank < 3""")
def _(spark, d):
    s = bind.samples(spark, d).select("sample_id", "rank", "is_draw")
    return S.merge_flow({"a": s.filter("is_draw"), "b": s.filter("rank < 3")}).select("sample_id", "data_source_name")


def _java(s: str) -> int:
    h = 0
    for b in s.encode():
        h = (31 * h + b) & 0xFFFFFFFF
    return h


_KEYS = {n: (_java(n) << 8) & 0xFFFFFFFF for n in ("pc", "mobile", "cloud")}
_CASE = "CASE device_type " + " ".join(f"WHEN '{n}' THEN {k}::BIGINT" for n, k in _KEYS.items()) + " END"


@query("split_flow", w(SAMPLES) + f"""
SELECT sample_id, device_type AS flow, {_CASE} AS data_source_key FROM samples WHERE device_type IN ('pc', 'mobile')""")
def _(spark, d):
    from sampleloom.functions.fid import data_source_key

    s = bind.samples(spark, d).select("sample_id", data_source_key("device_type").alias("data_source_key"))
    return S.route_flow(s, ["pc", "mobile"])


@query("fid_intersection", w(SAMPLES) + f"""
SELECT sample_id, {s_ints('list_sort(list_intersect(f_tags, x))')} AS both,
       {s_ints('list_sort(list_distinct(list_concat(f_tags, x)))')} AS either,
       {s_ints('list_sort(list_filter(list_distinct(f_tags), lambda e: NOT list_contains(x, e)))')} AS only_left
FROM (SELECT sample_id, f_tags, [(5::BIGINT << 48) + (sample_id % 100) * 7, (5::BIGINT << 48) + 14] AS x FROM samples)""")
def _(spark, d):
    s = bind.samples(spark, d).select("sample_id", "f_tags", F.array(
        make_fid(5, (F.col("sample_id") % 100) * 7), make_fid(5, F.lit(14))).alias("x"))
    return s.select("sample_id", ints(F.sort_array(F.array_intersect("f_tags", "x"))).alias("both"),
                    ints(F.sort_array(F.array_union("f_tags", "x"))).alias("either"),
                    ints(F.sort_array(F.array_except("f_tags", "x"))).alias("only_left"))
