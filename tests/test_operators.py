"""Worked examples of lookups, pooling, sharding, samples and tables."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sampleloom.functions.fid import make_fid
from sampleloom.operators import features as FE
from sampleloom.operators import gradients as G
from sampleloom.operators import losses as X
from sampleloom.operators import negatives as N
from sampleloom.operators import pooling as P
from sampleloom.operators import ranking as R
from sampleloom.operators import samples as S
from sampleloom.operators import sharding as H
from sampleloom.operators import tables as E
from sampleloom.operators.admission import approximate_frequency, counter_weight
from sampleloom.operators.joins import semi_file


def vecs(spark, rows):
    return spark.createDataFrame([(r, i, [float(x) for x in v]) for i, (r, v) in enumerate(rows)], "row int, pos int, num array<double>")


@pytest.mark.parametrize("how,inp,want", [
    ("sum", [(0, [1, 1]), (0, [2, 2]), (1, [4, 4])], [[3, 3], [4, 4]]),
    ("mean", [(0, [4, 4]), (0, [2, 2]), (1, [1, 1])], [[3, 3], [1, 1]]),
    ("sqrt_sum_sq", [(0, [3, 3]), (0, [4, 4]), (1, [4, 4])], [[5, 5], [4, 4]])])
def test_pooling_examples(spark, how, inp, want):
    assert [r["num"] for r in P.pool(vecs(spark, inp), "row", 2, how).orderBy("row").collect()] == want


def test_empty_row_missing_and_repeated_ids(spark):
    table = spark.createDataFrame([("t", 1, [1.0, 2.0]), ("t", 3, [5.0, 6.0])], "table string, fid bigint, num array<double>")
    lists = spark.createDataFrame([(0, []), (1, [1, 3, 1, 9]), (2, [9])], "row int, ids array<bigint>")
    ids = P.explode_ids(lists, "row", "ids")
    for look in (P.lookup, P.dedup_lookup):
        got = look(ids, table, 2)
        assert {r["row"]: r["num"] for r in P.pool(got, "row", 2).collect()} == {0: [0, 0], 1: [7, 10], 2: [0, 0]}
        assert {r["row"]: r["num"] for r in P.pool(got, "row", 2, "mean").collect()} == {0: [0, 0], 1: [1.75, 2.5], 2: [0, 0]}
    nan = {r["row"]: r["num"] for r in P.pool(got, "row", 2, "mean", nan_on_empty=True).collect()}
    assert np.isnan(nan[0]).all()
    first = {r["row"]: r["nums"] for r in P.pool_first_n(got, "row", 2, 2).collect()}
    assert first == {0: [[0, 0], [0, 0]], 1: [[1, 2], [5, 6]], 2: [[0, 0], [0, 0]]}


def test_first_n_lengths(spark):
    df = spark.createDataFrame([(0, 0, 0, [1.0]), (1, 0, 0, [2.0]), (1, 1, 0, [3.0]), (2, 0, 0, [4.0]), (2, 1, 0, [5.0]), (2, 2, 0, [6.0])],
                               "row int, pos int, fid bigint, num array<double>")
    assert [[v[0] for v in r["nums"]] for r in P.pool_first_n(df, "row", 1, 2).orderBy("row").collect()] == [[1, 0], [2, 3], [4, 5]]


def test_gradient_of_sqrt_pool(spark):
    df = vecs(spark, [(0, [3, 4]), (0, [4, 3])]).withColumn("fid", F.col("pos").cast("bigint"))
    g = spark.createDataFrame([(0, [-1.0, -1.0])], "row int, grad array<double>")
    got = [r["grad"] for r in P.pool_gradients(df, g, "row", 2, "sqrt_sum_sq").orderBy("pos").collect()]
    assert np.allclose(got, [[-.6, -.8], [-.8, -.6]])


def test_layout_rules(spark):
    a, b = F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(3.0), F.lit(4.0))
    r = spark.range(1).select(P.layout([a, b], "concat"), P.layout([a, b], "stack"), P.layout([a, b], "addn"), P.layout([F.array(a, b)], "concat", True)).first()
    assert list(r) == [[1, 2, 3, 4], [[1, 2], [3, 4]], [4, 6], [1, 2, 3, 4]]
    with pytest.raises(ValueError):
        P.layout([a], "addn", first_n=True)


def test_feature_insight(spark):
    v = F.array(*[F.lit(float(x)) for x in (1, 2, 3)])
    w = [[1, 0], [0, 1], [2, 2]]
    r = spark.range(1).select(P.feature_insight(v, w, [2, 1]), P.feature_insight(v, w, [2, 1], aggregate=True)).first()
    assert list(r) == [[1, 2, 6, 6], [5, 72]]


def test_shard_layout_example(spark):
    ids = [("a", 0), ("a", 1), ("a", 0), ("b", 3), ("b", 2), ("b", 3), ("c", 5), ("c", 6), ("c", 7)]
    u = H.shard_unique_ids(spark.createDataFrame(ids, "table string, fid bigint"), 2)
    sizes = H.shard_sizes(u).orderBy("shard", "table").collect()
    assert [r["table_size"] for r in sizes] == [1, 1, 1, 1, 1, 2] and sorted({(r["shard"], r["shard_size"]) for r in sizes}) == [(0, 3), (1, 4)]
    for hot in (1, 1000):
        off = {(r["table"], r["fid"]): r["offset"] for r in H.shard_offsets(u, {"a": 1, "b": 2, "c": 3}, hot).collect()}
        assert [off[i] for i in ids] == [0, 6, 0, 7, 1, 7, 9, 3, 12]


def test_split_examples(spark):
    rows = spark.createDataFrame([([0, 1, 2, 2, 3],), ([],)], "f array<bigint>")
    got = rows.select(H.split_list("f", 3).alias("s")).collect()
    assert [e["ids"] for e in got[0]["s"]] == [[0, 3], [1], [2, 2]] and [e["positions"] for e in got[0]["s"]] == [[0, 4], [1], [2, 3]]
    assert all(e["ids"] == [] and e["positions"] == [] for e in got[1]["s"])
    assert [e["ids"] for e in rows.select(H.split_list("f", 3, True).alias("s")).first()["s"]] == [[0, 3], [1], [2]]


def test_special_strategy(spark):
    rows = spark.createDataFrame([(1, [], [0.0, 5.0]), (2, [9], [0.0, 5.0]), (3, [1, 2], [0.0, 5.0]), (4, [1], [0.0, 5.0])],
                                 "sample_id int, special_strategies array<int>, label array<double>")
    got = S.special_strategy(rows, [2, 1], {2: 1.0, 1: 0.0}, {2: 7.0}).collect()
    assert [(r["sample_id"], r["label"]) for r in got] == [(3, [7.0, 5.0])]
    assert {r["sample_id"] for r in S.special_strategy(rows, [2, 1], {}, keep_empty=True).collect()} == {1, 3, 4}


def test_layout_validation():
    for bad in (dict(sparse=("a",), extra={"a": 0}), dict(dense={"x": (0, "float")}), dict(dense={"x": (2, "string")}), dict(dense={"x": (1, "date")})):
        with pytest.raises(ValueError):
            S.Layout(**bad)


def test_line_id_fields_are_checked(spark):
    df = spark.range(1).select(F.struct(F.lit(1).alias("uid"), F.lit(True).alias("is_draw")).alias("line_id"))
    for name in ("nope", "is_draw"):
        with pytest.raises(ValueError):
            S.line_id_field(df, name, 0)


def test_flat_record(spark):
    df = spark.createDataFrame([(True, 3, 2.5, None, 1.0)], "b boolean, i int, x double, w double, y double")
    out = S.flat_to_sample(df.withColumn("b", F.col("b").cast("int")), {"b": 1, "x": 2}, ["i"], "y", "w").first()
    assert out["b"] == [(1 << 48) + 1] and out["x"] == [(2 << 48) + 1] and out["i"] == 3 and out["instance_weight"] == 1.0
    for bad in (({"b": 1, "i": 1}, []), ({"b": 1}, ["b"]), ({"zz": 1}, [])):
        with pytest.raises(ValueError):
            S.flat_to_sample(df, *bad, "y")


def test_operand_file_type(spark):
    df = spark.range(5)
    with pytest.raises(ValueError):
        semi_file(df, spark.createDataFrame([("1",)], "v string"), "id", "in")
    with pytest.raises(ValueError):
        semi_file(df, spark.range(2), "id", "gt")


def test_flows(spark):
    df = spark.createDataFrame([(1, "pc"), (2, "tv"), (3, "pc")], "i int, d string")
    from sampleloom.functions.fid import data_source_key

    keyed = df.withColumn("data_source_key", data_source_key("d"))
    parts = S.split_flow(keyed, ["pc", "tv"])
    assert parts["pc"].count() == 2 and parts["tv"].count() == 1 and S.route_flow(keyed, ["pc"]).count() == 2
    merged = S.merge_flow({"0": df, "1": df})
    assert {r[0] for r in merged.select("data_source_name").distinct().collect()} == {"data_source0", "data_source1"}


def test_switch_slots_copy(spark):
    df = spark.range(1).select(F.array(make_fid(3, F.lit(8))).alias("f"))
    out = FE.switch_slots(df, {"f": (False, 9)}, "share").first()
    assert out["f"] == [(3 << 48) + 8] and out["f_share"] == [(9 << 48) + 8]


# ---------------------------------------------------------------- tables

def table(spark, rows, dim=2):
    return spark.createDataFrame([("t", f, [float(x) for x in v], ts) for f, v, ts in rows], "table string, fid bigint, num array<double>, last_update_ts bigint")


def test_sgd_sums_equal_ids(spark):
    seg = [E.Segment(1, "sgd", (("learning_rate", 0.1),))]
    t = E.with_empty_state(table(spark, []), seg)
    g = spark.createDataFrame([("t", f, [-1.0]) for f in (0, 1, 0, 1, 0)], "table string, fid bigint, grad array<double>")
    got = {r["fid"]: r["num"][0] for r in E.apply_gradients(t, g, seg, 5).collect()}
    assert np.allclose([got[0], got[1]], [0.3, 0.2])


def test_two_updates_keep_state_and_untouched_rows(spark):
    seg = [E.Segment(1, "adagrad", (("learning_rate", 1.0),)), E.Segment(1, "adam")]
    t = E.with_empty_state(table(spark, [(1, [1, 1], 7), (2, [2, 2], 7)]), seg)
    g = spark.createDataFrame([("t", 1, [1.0, 1.0])], "table string, fid bigint, grad array<double>")
    for now in (10, 11):
        t = E.apply_gradients(t, g, seg, now)
    r = {x["fid"]: x for x in t.collect()}
    assert r[2]["num"] == [2, 2] and r[2]["last_update_ts"] == 7 and r[2]["opt"] is None
    assert np.isclose(r[1]["num"][0], 1 - 1 / np.sqrt(1.1) - 1 / np.sqrt(2.1)) and r[1]["last_update_ts"] == 11
    assert np.isclose(r[1]["opt"]["s0"]["norm"][0], 2.1) and np.isclose(r[1]["opt"]["s1"]["beta1_power"], 0.9 ** 3)


def test_assign_last_write_and_zero_delete(spark):
    t = E.with_empty_state(table(spark, [(1, [1, 1], 7), (2, [2, 2], 7)]), [E.Segment(2, "sgd")])
    up = spark.createDataFrame([("t", 1, 1, [5.0, 5.0], 9), ("t", 1, 2, [6.0, 6.0], 8), ("t", 2, 1, [0.0, 0.0], 9), ("t", 3, 1, [3.0, 3.0], 9)],
                               "table string, fid bigint, seq bigint, num array<double>, ts bigint")
    got = {r["fid"]: (r["num"], r["last_update_ts"]) for r in E.assign(t, up, "seq", skip_zero=True).collect()}
    assert got == {1: ([6, 6], 9), 3: ([3, 3], 9)}


def test_expiry_by_slot(spark):
    t = table(spark, [((1 << 48) + 5, [1, 1], 100), ((2 << 48) + 5, [1, 1], 100)])
    assert [r["fid"] >> 48 for r in E.evict(t, {1: 0, 2: 1}).collect()] == [2]
    assert [r["fid"] >> 48 for r in E.evict(t, {1: 0, 2: 1}, keep_expired=True).collect()] == [1]


def test_merge_plan_and_pages(spark):
    plan = E.merge_plan({"b": "x", "a": "x", "c": "y"})
    assert plan["a"] == plan["b"] == E.merged_name(["a", "b"]) != plan["c"]
    t = table(spark, [(i, [0, 0], 1) for i in range(30)])
    for hot in (3, 1000):
        assert [r["fid"] for r in E.iterate(t, 3, 1, 4, 2, hot).orderBy("fid").collect()] == [7, 10, 13, 16]


def test_delta_chunks_are_bounded(spark):
    t = table(spark, [(i, [0, 0], 1) for i in range(100)])
    touched = t.filter("fid < 60").unionByName(t.filter("fid < 10")).select("table", "fid")
    for hot in (2, 1000):
        d = E.delta_since(t, touched, 4, 3, hot)
        assert d.count() == 60 and d.groupBy("table", "bucket", "chunk_no").count().agg(F.max("count")).first()[0] <= 4


def test_norm_clip(spark):
    g = spark.createDataFrame([(1, [3.0, 0.0]), (2, [0.0, 4.0])], "fid bigint, grad array<double>")
    assert sorted(r["grad"] for r in G.clip_by_global_norm(g, 2.5).collect()) == [[0, 2], [1.5, 0]]
    assert sorted(r["grad"] for r in G.clip_by_global_norm(g, 9.0).collect()) == [[0, 4], [3, 0]]


def test_counter_weight_and_sketch(spark):
    ids = spark.createDataFrame([(1,), (1,), (2,)], "fid bigint")
    got = {r["fid"]: r["counter"] for r in counter_weight(ids, 2).collect()}
    assert got == {1: 2.0, 2: 2.0} and approximate_frequency(ids).first()["sketch"] is not None


def test_losses_need_matching_weights(spark):
    with pytest.raises(ValueError):
        R.combined_loss(spark.range(1), ["softmax"], [1.0, 2.0])
    with pytest.raises(ValueError):
        R.loss_value(spark.range(1), "nope")
    with pytest.raises(ValueError):
        X.batch_softmax_loss(spark.range(1), "b", "i", "q", "v", "g", "r", temperature=0)


def test_all_named_losses(spark):
    rng = np.random.default_rng(2)
    rows = [(int(q), i, float(rng.integers(0, 4)), float(rng.normal()), 1.0) for q in range(4) for i in range(5)]
    df = spark.createDataFrame(rows, "query_id bigint, item_id bigint, label double, score double, weight double")
    out = R.combined_loss(df, list(R.LOSSES)).first()
    assert np.isclose(out["loss"], sum(out[k] for k in R.LOSSES))
    nd = []
    for q in range(4):
        lab = np.array([r[2] for r in rows if r[0] == q]); s = np.array([r[3] for r in rows if r[0] == q])
        rank = (1 / (1 + np.exp(-10 * (s[None, :] - s[:, None])))).sum(1) + .5
        ideal = ((2 ** np.sort(lab)[::-1] - 1) / np.log1p(np.arange(1, 6))).sum()
        nd.append(-((2 ** lab - 1) / np.log1p(rank)).sum() / ideal)
    assert np.isclose(out["approx_ndcg"], np.mean(nd))


# ---------------------------------------------------------------- negatives

def test_negative_counts_and_start(spark):
    """Every positive gets neg_num negatives once the pool has more than start_num items, none
    before; labels, actions and user features follow the rules."""
    rows = [(i, 1000 + i, i % 40, 1 + i % 3, [1 if i % 2 else 3], [1.0 if i % 2 else 0.0], 1.0, [10 ** 6 + i], [i % 40]) for i in range(400)]
    df = spark.createDataFrame(rows, "sample_id bigint, req_time bigint, item_id bigint, channel bigint, actions array<int>, label array<double>, instance_weight double, f_user array<bigint>, f_item array<bigint>")
    cfg = N.NegativeConfig(5, ("f_item",), per_channel=True, start_num=3, positive_actions=(1,), negative_action=7, sampled_neg_instance_weight=0.5)
    out = N.negative_gen(df, cfg).collect()
    made = [r for r in out if r["gen_no"] < 5]
    seen, want = {c: set() for c in (1, 2, 3)}, 0
    for r in rows:
        if r[4] == [1]:
            seen[r[3]].add(r[2])
            want += 5 if len(seen[r[3]]) > 3 else 0
    assert len(made) == want and len(out) == want + 400
    for r in made:
        assert r["actions"] == [7] and r["label"] == [-1.0] and r["instance_weight"] == 0.5
        assert r["f_item"] == [r["item_id"]] and r["f_user"] == [10 ** 6 + r["sample_id"]] and r["item_id"] in seen[1 + r["sample_id"] % 3]


def test_negative_config_checks():
    for bad in (dict(label_index=-1), dict(positive_actions=(1,), cache_negative_actions=(1,)), dict(action_priority=(1, 1))):
        with pytest.raises(ValueError):
            N.NegativeConfig(1, **bad)


def test_expiry_is_per_table_and_keeps_every_row(spark):
    day = 86400
    rows = [("a", 1, 100 * day), ("a", 2, 95 * day), ("a", 3, None), ("b", 4, 10 * day), ("b", 5, 1 * day), (None, 6, None)]
    df = spark.createDataFrame(rows, "table string, fid bigint, last_update_ts bigint")
    live = {r.fid for r in E.evict(df, {}, 7).collect()}
    dead = {r.fid for r in E.evict(df, {}, 7, keep_expired=True).collect()}
    assert live == {1, 2, 4, 6} and dead == {3, 5}


def test_assign_gives_one_row_per_id(spark):
    table = spark.createDataFrame([("t", 1, [0.0], None, 1)], "table string, fid bigint, num array<double>, opt int, last_update_ts bigint")
    up = spark.createDataFrame([("t", 1, [1.0], 5), ("t", 1, [2.0], 7), ("t", 2, [3.0], 5), ("t", 2, [4.0], 5)], "table string, fid bigint, num array<double>, ts bigint")
    assert sorted((r.fid, r.num, r.last_update_ts) for r in E.assign(table, up).collect()) == [(1, [2.0], 7), (2, [4.0], 5)]


def test_labels_beyond_a_million_stay(spark):
    from sampleloom.functions import labels as L

    n = (1 << 20) + 5
    df = spark.range(1).select(F.array_repeat(F.lit(1.0), n).alias("label"), F.array(F.lit(4)).alias("actions"), F.lit(1).alias("sample_id"))
    got = df.select(F.size(L.label_upper_bound("label", [0.5])).alias("a"), F.size(L.add_label("sample_id", "label", "actions", "4::1.0")).alias("b")).first()
    assert tuple(got) == (n, n + 1)


def _queue_by_hand(rows, neg, start, most):
    queue, drawn, out = [], {}, []
    for sid, item, pos in rows:
        if pos:
            if item not in drawn:
                queue.append(item)
                drawn[item] = 0
            if len(queue) > most:
                del drawn[queue.pop(0)]
            if len(queue) > start:
                for k in range(neg):
                    at = int(hashlib.md5(f"{sid}|{k}|item".encode()).hexdigest()[:8], 16) % len(queue)
                    drawn[queue[at]] += 1
                    out.append((sid, k, queue[at], 1 / drawn[queue[at]], (at + 1) / len(queue)))
    return sorted(out)


@pytest.mark.parametrize("neg", [0, 2])
def test_batch_pool_is_the_queue(spark, neg):
    """Capacity below the number of items: they leave and return, and draws count from the return."""
    rnd = random.Random(4)
    data = [(i, rnd.randrange(12), rnd.random() < 0.7) for i in range(300)]
    rows = [(i, 1000 + i, item, 1, [1.0 if pos else 0.0], [1]) for i, item, pos in data]
    df = spark.createDataFrame(rows, "sample_id bigint, req_time bigint, item_id bigint, channel bigint, label array<double>, actions array<int>")
    cfg = N.NegativeConfig(neg_num=neg, per_channel=True, start_num=2, max_item_num=5)
    got = sorted(tuple(r) for r in N.draws(df, cfg).select("sample_id", "k", "drawn_item", "freq", "time_factor").collect())
    assert got == _queue_by_hand(data, neg, 2, 5)


def test_last_writes_hash_by_id(spark):
    """The vectors of all writes are never sorted, and a last write that is NULL changes nothing."""
    rows = [("t", i % 5, i, [float(i), -float(i)], 100 + i) for i in range(40)] + [("t", 7, 1, [1.0, 2.0], 5), ("t", 7, 2, None, 4)]
    up = spark.createDataFrame(rows, "table string, fid bigint, seq bigint, num array<double>, ts bigint")
    table = spark.createDataFrame([("t", 7, [9.0, 9.0], 1), ("t", 8, [8.0, 8.0], 2)], "table string, fid bigint, num array<double>, last_update_ts bigint")
    got = E.assign(table.withColumn("opt", F.lit(None).cast("struct<none:double>")), up, "seq", dim=2)
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.fid, r.num, r.last_update_ts) for r in got.collect()) == [
        *[(i, [35.0 + i, -35.0 - i], 135 + i) for i in range(5)], (7, [9.0, 9.0], 5), (8, [8.0, 8.0], 2)]


@pytest.mark.parametrize("name", ["assign", "assign_skip_zero", "delta_apply", "multi_table_update"])
def test_queries_hash_their_last_writes(spark, name):
    from sampleloom.plans import registry

    registry.load()
    assert "SortAggregate" not in registry.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()


def test_first_n_gathers_ids_before_vectors(spark):
    table = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 4.0])], "fid bigint, num array<double>")
    rows = [(0, 0, 2), (0, 1, 1), (0, 2, 9), (1, 0, 9), (2, None, None), (3, 0, None), (3, 1, 1), (4, 1, 2), (5, 0, 1), (5, 1, 1)]
    ids = spark.createDataFrame(rows, "row int, pos int, fid bigint")
    got = P.first_n(ids, table, "row", 2, 2)
    want = {r["row"]: r["nums"] for r in P.pool_first_n(P.lookup(ids, table, 2), "row", 2, 2).collect()}
    assert {r["row"]: r["nums"] for r in got.collect()} == want
    assert want[0] == [[3.0, 4.0], [1.0, 2.0]] and want[1] == [[0.0, 0.0]] * 2 and want[2] == [[0.0, 0.0]] * 2 and want[3] == [None, [1.0, 2.0]]
    assert "collect_list" not in got._jdf.queryExecution().executedPlan().toString()


def test_first_n_query_collects_no_vectors(spark):
    from sampleloom.plans import registry

    registry.load()
    assert "collect_list" not in registry.QUERIES["pool_first_n"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()


def test_batch_softmax_of_small_batches(spark):
    """Small batches give the same as tiles, rows without a weight count as items only, and nothing is collected."""
    rnd = random.Random(3)
    rows = [(i // 5 if i < 23 else None, i, [rnd.random() for _ in range(3)], [rnd.random() for _ in range(3)], float(i % 4), None if i % 7 == 3 else 0.5 + i)
            for i in range(25)]
    df = spark.createDataFrame(rows, "b bigint, i bigint, q array<double>, v array<double>, gap double, r double")
    small = X.batch_softmax_loss(df, "b", "i", "q", "v", "gap", "r", temperature=0.7)
    tiles = X.batch_softmax_loss(df.filter("b is not null"), "b", "i", "q", "v", "gap", "r", temperature=0.7, tile_rows=2)
    got, want = ({r["b"]: r["loss"] for r in x.collect()} for x in (small, tiles))
    assert set(got) == set(want) == {0, 1, 2, 3, 4}
    assert all(abs(got[b] - want[b]) < 1e-9 for b in want)


def test_batch_softmax_query_collects_no_vectors(spark):
    from sampleloom.plans import registry

    registry.load()
    plan = registry.QUERIES["batch_softmax_loss"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan


@pytest.mark.parametrize("name", ["negative_gen", "negative_gen_easy_hard"])
def test_item_pool_is_read_not_made_again(spark, name):
    from sampleloom.plans import registry

    registry.load()
    assert "FlatMapGroupsInArrow" not in registry.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
