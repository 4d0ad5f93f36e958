"""Skew-safe forms give the same rows as the simple ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sampleloom.operators import admission as A
from sampleloom.operators import batches as B
from sampleloom.operators import joins as J
from sampleloom.operators import losses as X
from sampleloom.operators import negatives as N
from sampleloom.operators import ordering as O
from sampleloom.operators import pooling as P
from sampleloom.operators import ranking as R
from sampleloom.plans import bindings as bind

SF = "/root/testdata/sf0.001"
BIG = 10 ** 9


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def close(a, b):
    a, b = rows(a), rows(b)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            assert u == v or np.allclose(u, v, rtol=1e-9, atol=1e-9), (x, y)


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows share one key; one key is NULL."""
    k = F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 97 == 0, F.lit(None)).otherwise(F.col("id") % 13)
    return spark.range(5000).select("id", k.alias("k"), (F.col("id") * 7919 % 1009).alias("t"), (F.col("id") % 5).alias("x")).persist()


@pytest.mark.parametrize("keys", [["k"], []])
def test_running_spreads_hot_keys(skewed, keys):
    order = [F.col("t"), F.col("id")]
    tot = {"n": F.lit(1).cast("bigint"), "s": F.col("x")}
    hot = O.running(skewed, keys, order, tot, hot_rows=10)
    assert rows(hot) == rows(O.running(skewed, keys, order, tot, hot_rows=BIG))
    per_part = hot.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_part < 4000


def test_totals(skewed):
    t = {"n": F.count(F.lit(1)), "m": F.max("x")}
    src = skewed.filter("k is not null")
    assert rows(O.with_totals(src, ["k"], t, 10)) == rows(O.with_totals(src, ["k"], t, BIG))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_hot_keys(spark, skewed, how):
    right = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    assert rows(J.lookup_join(skewed, right, "k", how, hot_rows=300)) == rows(skewed.join(right, "k", how))
    assert J.heavy_keys(skewed, "k", 300)[0] == 7


def test_joins_are_built_without_jobs(spark):
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    sc.setJobGroup("build", "building a chain of joins")
    try:
        left, right = spark.range(1000).withColumn("k", F.col("id") % 3), spark.range(3).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        out = J.lookup_join(left, right, "k")
        out = J.context_join(out, right.withColumnRenamed("v", "w"), "k")
        out = J.semi_file(out, right.select("k"), "k", "in")
        assert tracker.getJobIdsForGroup("build") == []
        assert out.count() == 1000 and len(tracker.getJobIdsForGroup("build")) > 0
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_count_window_hot(skewed):
    src = skewed.select("id", "x")
    a = B.count_window(src, ["x"], ["id"], 64, hot_rows=10)
    assert rows(a) == rows(B.count_window(src, ["x"], ["id"], 64))
    assert a.groupBy("x", "batch_no").count().filter("count <> 64").count() == 0


def test_admission_hot(skewed):
    ids = skewed.filter("k is not null").select(F.col("k").alias("fid"), "t", "id")
    got = A.occurrence_admission(ids, ["t", "id"], {}, default=4, hot_rows=50)
    seq = O.positions(ids, ["fid"], [F.col("t"), F.col("id")], "n", BIG)
    assert rows(got) == rows(seq.select("fid", "t", "id", (F.col("n") > 4).alias("admitted")))


def test_admission_worked_example(spark):
    steps = [(s, i, f) for s in range(4) for i, f in enumerate([1, 2, 1])]
    df = spark.createDataFrame(steps, "s int, i int, fid bigint")
    got = A.occurrence_admission(df, ["s", "i"], {}, 3).orderBy("s", "i").collect()
    assert [int(r["admitted"]) for r in got] == [0, 0, 0, 0, 0, 1, 1, 0, 1, 1, 1, 1]


@pytest.fixture(scope="module")
def lists(spark):
    """Few long lists with ties and invalid labels."""
    return spark.range(600).select(
        F.when(F.col("id") < 400, 0).otherwise(F.col("id") % 3 + 1).alias("query_id"), F.col("id").alias("item_id"),
        ((F.col("id") * 31 % 7) - 1).cast("double").alias("label"), F.sin(F.col("id") * 1.7).alias("score"),
        ((F.col("id") % 4) / 3.0).alias("weight")).persist()


@pytest.mark.parametrize("lam", [None, R.ndcg_weight(5, 0.3), R.ndcg_weight(), R.reciprocal_rank_weight(3, 1.0), R.LambdaWeight("precision", 4), R.LambdaWeight("identity")])
def test_pairwise_tiles(lists, lam):
    kinds = ["hinge", "logistic", "soft_zero_one"]
    close(R.pairwise_loss(lists, kinds, lam, tile_rows=32, hot_rows=50), R.pairwise_loss(lists, kinds, lam, tile_rows=BIG, hot_rows=BIG))


def test_list_functions_hot(lists):
    close(R.approx_ranks(lists, tile_rows=32), R.approx_ranks(lists))
    close(R.approx_ndcg(lists, tile_rows=32, hot_rows=50), R.approx_ndcg(lists))
    close(R.inverse_max_dcg(lists, hot_rows=50), R.inverse_max_dcg(lists))
    close(R.list_mle(lists, hot_rows=50), R.list_mle(lists))
    close(R.softmax_list_loss(lists, hot_rows=50), R.softmax_list_loss(lists))


def test_pairwise_against_brute_force(lists):
    got = {r["query_id"]: r for r in R.pairwise_loss(lists, ["hinge"], tile_rows=64).collect()}
    pdf = lists.toPandas()
    for q, g in pdf.groupby("query_id"):
        g = g[g.label >= 0]
        dl = g.label.to_numpy()[:, None] - g.label.to_numpy()[None, :]
        ds = g.score.to_numpy()[:, None] - g.score.to_numpy()[None, :]
        w = np.where(dl > 0, np.abs(dl), 0) * g.weight.to_numpy()[:, None]
        assert np.isclose((w * np.maximum(0, 1 - ds)).sum(), got[q]["hinge"]) and (w != 0).sum() == got[q]["pairs"]


def test_batch_losses_tiled(spark):
    rng = np.random.default_rng(5)
    n, d = 90, 8
    q, v = rng.normal(size=(n, d)), rng.normal(size=(n, d))
    y = rng.choice([1.0, 0.0, -20000.0], size=n)
    s, gap, r = rng.normal(size=n) * 30, rng.uniform(0, 9, size=n), rng.uniform(size=n)
    df = spark.createDataFrame([(0, i, q[i].tolist(), v[i].tolist(), float(gap[i]), float(r[i]), float(y[i]), float(s[i])) for i in range(n)],
                               "b int, i int, q array<double>, v array<double>, gap double, r double, y double, s double")
    un = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    sim = np.exp(un(q) @ un(v).T / 0.7 - np.log(1 / np.maximum(gap, 1))[None, :])
    want = -(r * np.log(np.diag(sim) / sim.sum(1))).sum()
    for tile in (8, 1000):
        got = X.batch_softmax_loss(df, "b", "i", "q", "v", "gap", "r", temperature=0.7, tile_rows=tile).first()["loss"]
        assert np.isclose(got, want)
    pos, neg = np.where(y > 0)[0], np.where((y <= 0) & (y > -10000))[0]
    diff = s[pos][:, None] - s[neg][None, :]
    auc = np.where(diff <= -87, diff, np.where(diff < 88, -np.logaddexp(0, -diff), 0)).sum()
    g = np.where(diff <= -87, 1.0, np.where(diff < 88, 1 / (1 + np.exp(np.clip(diff, -87, 88))), 0))
    grad = np.zeros(n)
    np.add.at(grad, pos, g.sum(1))
    np.add.at(grad, neg, -0.5 * g.sum(0))
    for tile in (8, 1000):
        assert np.isclose(X.inbatch_auc(df, "b", "i", "y", "s", tile).first()["loss"], auc)
        out = X.inbatch_auc_gradient(df, "b", "i", "y", "s", 2.0, 0.5, tile).orderBy("i").collect()
        assert np.allclose([o["grad"] for o in out], 2 * grad)


def test_negatives_hot(spark):
    s = bind.samples(spark, SF).withColumn("chan", F.col("chnid") + 1)
    for easy in (0.0, 0.5):
        cfg = N.NegativeConfig(2, ("f_item",), per_channel=True, channel="chan", start_num=2, max_item_num=6, positive_actions=(2, 3), easy_hard_ratio=easy)
        assert rows(N.draws(s, cfg, hot_rows=20)) == rows(N.draws(s, cfg))


def test_hot_lookup_and_pool(spark):
    ids = bind.order_ids(spark, SF)
    table = bind.emb(spark, SF)
    close(P.pool(P.lookup(ids, table, 64, hot_rows=5), "row", 64), P.pool(P.lookup(ids, table, 64), "row", 64))


def test_step_interval_chunks(spark):
    steps = [(0, s) for s in range(0, 1001, 5)] + [(1, s) for s in range(0, 1001, 10)] + [(2, 3), (2, 3), (2, 3)]
    df = spark.createDataFrame(steps, "item bigint, step bigint")
    out = {r["item"]: r for r in B.step_interval(df, "item", "step", 0.1, chunk_steps=16).collect()}
    assert abs(1 / out[0]["interval"] - 0.2) < 0.01 and abs(1 / out[1]["interval"] - 0.1) < 0.01
    assert np.isclose(out[2]["interval"], 0.3 * 0.81) and out[2]["appearances"] == 3
    whole = {r["item"]: r["interval"] for r in B.step_interval(df, "item", "step", 0.1).collect()}
    assert all(np.isclose(whole[k], out[k]["interval"]) for k in whole)


def test_rank_limit_goes_before_the_shuffle(skewed):
    few = O.first_in_key(skewed, ["k"], 3, [F.col("t"), F.col("id")])
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    many = O.first_in_key(skewed, ["k"], 1200, [F.col("t"), F.col("id")])
    assert rows(many) == rows(O.positions(skewed, ["k"], [F.col("t"), F.col("id")]).filter("position <= 1200"))


def _lists(spark, n=200):
    ids = spark.range(n).select((F.col("id") % 40).alias("row"), F.col("id").alias("pos"), (F.col("id") % 7).alias("fid"))
    table = spark.range(5).select(F.lit("t").alias("table"), F.col("id").alias("fid"), F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: i * F.col("id") * 0.5).alias("num"))
    return ids, table


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["sum", "mean", "sqrt_sum_sq"])
def test_row_gradients_are_never_broadcast(spark, how):
    ids, table = _lists(spark)
    grads = spark.range(40).select(F.col("id").alias("row"), F.array_repeat(F.col("id").cast("double"), 8).alias("grad"))
    looked = P.lookup(ids, table, 8, row_key="row")
    out = P.pool_gradients(looked, grads, "row", 8, how)
    broadcasts = [line for line in _plan(out).splitlines() if "BroadcastExchange" in line]
    assert len(broadcasts) <= _plan(looked).count("BroadcastExchange") * 2  # the ids' vectors and those ids only
    assert "BroadcastHashJoin [row" not in _plan(out) and out.count() == 200


def test_pooling_moves_ids_not_vectors(spark):
    ids, table = _lists(spark)
    near = P.lookup(ids, table, 8, row_key="row")
    plan = _plan(P.pool(near, "row", 8))
    assert plan.count("hashpartitioning(row") == 1 and "REPARTITION_BY_NUM" in plan
    far = P.lookup(ids, table, 8, row_key="row", hot_rows=2)  # rows of more ids stay spread
    assert "REPARTITION_BY_NUM" not in _plan(P.pool(far, "row", 8))
    for how in ("sum", "mean", "sqrt_sum_sq"):
        close(P.pool(near, "row", 8, how), P.pool(far, "row", 8, how))


def test_many_ids_take_the_shuffle(spark, monkeypatch):
    ids, table = _lists(spark)
    few = rows(P.lookup(ids, table, 8))
    monkeypatch.setattr(P, "few_keys", lambda left, key: J.few_keys(left, key, 3))
    assert rows(P.lookup(ids, table, 8)) == few
    assert not J.few_keys(ids, "fid", 6) and J.few_keys(ids, "fid", 7)
